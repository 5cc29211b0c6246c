"""The trials table: a folder for every finished trial, so that no two writers share one."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIAL_SCHEMA = ("study string, trial_id int, params map<string,double>, metric double, "
                "model_path string")
STORED_SCHEMA = f"{TRIAL_SCHEMA}, experiment string"


def append_trial(spark: SparkSession, path: str, experiment: str, row: tuple) -> None:
    """Record one row of TRIAL_SCHEMA; the first trial creates the experiment.

    A trial that is recorded again replaces itself, and trials that end at the same
    time write apart from each other.
    """
    name = hashlib.sha1(repr((experiment, *row[:2])).encode()).hexdigest()
    (spark.createDataFrame([(*row, experiment)], STORED_SCHEMA).coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/trials/{name}"))


def read_trials(spark: SparkSession, path: str, experiment: str | None = None,
                study: str | None = None) -> DataFrame:
    """Recorded trials with their experiment; of a trial recorded twice, one row stays."""
    try:
        found = (spark.read.schema(STORED_SCHEMA).option("recursiveFileLookup", True)
                 .parquet(f"{path}/trials"))
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], STORED_SCHEMA)
    if experiment is not None:
        found = found.where(F.col("experiment") == experiment)
    if study is not None:
        found = found.where(F.col("study") == study)
    return found.dropDuplicates(["experiment", "study", "trial_id"])
