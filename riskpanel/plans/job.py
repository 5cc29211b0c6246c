"""The end-to-end job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskpanel.operators.rows import with_split
from riskpanel.operators.schema import PANEL_RULES, ColumnRule, ingest
from riskpanel.operators.sparse import vector_schema
from riskpanel.operators.tuning import Range
from riskpanel.plans.modelling import Modelling, model_panel
from riskpanel.plans.prepare import CUTOFF, SYMBOL, TEST_START, VAL_START, prepare_panel
from riskpanel.session import shared_folder
from riskpanel.sources.outputs import save_processed


def run_job(spark: SparkSession, raw: DataFrame, prices: DataFrame,
            rules: tuple[ColumnRule, ...] = PANEL_RULES, category_col: str = "INDUSTRY2",
            cutoff=CUTOFF, val_start=VAL_START, test_start=TEST_START, symbol: str = SYMBOL,
            label_col: str = "Y", fit_on: str = "all", n_trials: int = 30,
            space: dict[str, Range] | None = None, parallelism: int = 1, seed: int = 42,
            output: str | None = None, encoding: str = "auto") -> Modelling:
    """Validate, prepare, split, tune, fit and evaluate.

    The raw table is read once and kept as typed Parquet, which every fitting pass
    reads with the columns it needs. The prepared panel is written once, a folder per split, and read back: every
    later job reads only its own split, and a lost executor costs a re-read
    rather than the whole preparation. Without ``output`` that table goes to the
    session's shared folder.
    """
    folder = output or shared_folder(spark)
    panel = ingest(raw, f"{folder}/panel", rules)
    prepared, _ = prepare_panel(panel, prices, category_col, cutoff, symbol, label_col,
                                fit_on=fit_on, val_start=val_start, test_start=test_start,
                                summary_path=f"{folder}/summary_statistics", encoding=encoding)
    labelled = with_split(prepared, val_start, test_start)
    save_processed(labelled, f"{folder}/processed")
    processed = spark.read.schema(vector_schema(labelled.schema)).parquet(f"{folder}/processed")
    return model_panel(processed, val_start, test_start, label_col, n_trials=n_trials,
                       space=space, parallelism=parallelism, seed=seed, presplit=True,
                       output=None if output is None else folder)
