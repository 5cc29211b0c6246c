"""From the prepared panel to an evaluated model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskpanel.functions.columns import ref
from riskpanel.operators.metrics import confusion_matrix, evaluate_long
from riskpanel.operators.model import (FittedModel, Inputs, feature_importance, fit_classifier,
                                       fit_inputs, save_model, score)
from riskpanel.operators.rows import (NON_FEATURES, drop_columns, feature_columns, split_frames,
                                      with_split)
from riskpanel.operators.tuning import Range, Study, best_trial
from riskpanel.sources.outputs import save_best_params


@dataclass(frozen=True)
class Modelling:
    """The model and its result tables."""

    model: FittedModel
    trials: DataFrame
    best: DataFrame
    metrics: DataFrame
    importance: DataFrame
    confusion: DataFrame


def tune(train: DataFrame, val: DataFrame, label_col: str = "Y", n_trials: int = 30,
         space: dict[str, Range] | None = None, parallelism: int = 1, seed: int = 42,
         trials_path: str | None = None,
         inputs: Inputs | None = None) -> tuple[DataFrame, DataFrame]:
    """The trials and the best of them."""
    study = Study(train, val, label_col, space=space, seed=seed, trials_path=trials_path,
                  inputs=inputs)
    trials = study.run(n_trials, parallelism)
    return trials, best_trial(trials)


def model_panel(prepared: DataFrame, val_start, test_start, label_col: str = "Y",
                drop: tuple[str, ...] = NON_FEATURES, split_col: str = "indicator",
                n_trials: int = 30, space: dict[str, Range] | None = None,
                parallelism: int = 1, seed: int = 42, presplit: bool = False,
                output: str | None = None) -> Modelling:
    """Split by date, tune on validation, fit the best parameters on train, evaluate
    on validation and test, and count the model's splits and test outcomes.

    A split column the table brings along is replaced, unless ``presplit`` says it
    is this split already, as in a table written by split.
    """
    labelled = prepared
    if not presplit:
        labelled = with_split(prepared, val_start, test_start, split_col=split_col)
    unwanted = tuple(c for c in drop if c != split_col)
    slim = drop_columns(labelled, unwanted)
    train, val, _ = (part.drop(split_col) for part in split_frames(slim, split_col))
    inputs = fit_inputs(train, feature_columns(train, label_col))
    trials, best = tune(train, val, label_col, n_trials, space, parallelism, seed,
                        None if output is None else f"{output}/study", inputs)
    chosen = best.first()["params"]
    model = fit_classifier(train, chosen, label_col, seed=seed, inputs=inputs)
    held_out = slim.where(ref(split_col).isin("val", "test"))
    scored = score(model, held_out)
    metrics = evaluate_long(scored, label_col, by=(split_col,))
    confusion = confusion_matrix(scored.where(ref(split_col) == "test"), label_col)
    importance_path = None
    if output is not None:
        save_best_params(best, f"{output}/best_params")
        save_model(model, f"{output}/model")
        importance_path = f"{output}/trees"
    importance = feature_importance(model, path=importance_path)
    return Modelling(model, trials, best, metrics, importance, confusion)
