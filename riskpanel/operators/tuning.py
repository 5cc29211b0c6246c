"""Parameter search on fixed train and validation tables."""

from __future__ import annotations

import hashlib
import random
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.functions.columns import ref
from riskpanel.operators.metrics import average_precision, class_ratio
from riskpanel.operators.model import (FittedModel, Inputs, fit_inputs, fit_trees, save_model,
                                       training_rows)
from riskpanel.operators.rows import feature_columns
from riskpanel.sources.trials import TRIAL_SCHEMA, append_trial, read_trials


@dataclass(frozen=True)
class Range:
    """A uniform range, both ends included for whole numbers."""

    low: float
    high: float
    whole: bool = False

    def draw(self, rng: random.Random) -> float:
        if self.whole:
            return rng.randint(int(self.low), int(self.high))
        return rng.uniform(self.low, self.high)

    def steps(self, n: int) -> list[float]:
        points = [self.low + (self.high - self.low) * i / max(n - 1, 1) for i in range(n)]
        return [round(p) for p in points] if self.whole else points


# The search ranges.
FULL_SPACE = {
    "lambda_l1": Range(0.01, 10.0),
    "lambda_l2": Range(0.01, 10.0),
    "num_leaves": Range(2, 64, whole=True),
    "feature_fraction": Range(0.4, 0.8),
    "bagging_fraction": Range(0.4, 0.8),
    "bagging_freq": Range(1, 7, whole=True),
    "min_child_samples": Range(10, 200, whole=True),
    "learning_rate": Range(0.01, 0.2),
    "max_depth": Range(-1, 16, whole=True),
    "min_split_gain": Range(0.0, 0.1),
    "n_estimators": Range(100, 2000, whole=True),
}
DEFAULT_SPACE = FULL_SPACE
#: Trials whose parameters tell one search from another.
TOLD_TRIALS = 64


def draw_params(space: dict[str, Range], trial_id: int, seed: int = 42) -> dict[str, float]:
    """The parameters of one trial: a function of seed and trial number alone, so
    a repeated, parallel or resumed trial draws the same ones."""
    rng = random.Random(f"{seed}:{trial_id}")
    return {name: r.draw(rng) for name, r in space.items()}


def grid_params(space: dict[str, Range], trial_id: int, steps: int) -> dict[str, float]:
    """The parameters of one point of the full grid with ``steps`` values per range."""
    params = {}
    for name, r in space.items():
        trial_id, slot = divmod(trial_id, steps)
        params[name] = r.steps(steps)[slot]
    return params


def best_trial(trials: DataFrame) -> DataFrame:
    """One row (trial_id, params, metric): the highest metric, the earliest on a tie."""
    best = F.struct(F.col("metric"), -F.col("trial_id"))
    return trials.where("metric IS NOT NULL").agg(
        F.max_by("trial_id", best).alias("trial_id"), F.max_by("params", best).alias("params"),
        F.max("metric").alias("metric"))


@dataclass
class Study:
    """A search that maximises average precision on the validation table.

    With ``trials_path`` every finished trial is appended to the trials table
    under the experiment's name, with its model next to it. A study that is
    started again on the same rows, features, space and seed skips the trials
    already recorded; on anything else it is another study of the experiment.
    ``attempts`` counts whole passes over the missing trials; finished trials
    count across passes.
    """

    train: DataFrame
    val: DataFrame
    label_col: str = "Y"
    features: list[str] | None = None
    space: dict[str, Range] | None = None
    seed: int = 42
    experiment: str = "boosted-trees"
    trials_path: str | None = None
    sampler: Callable[[int], dict[str, float]] | None = None
    inputs: Inputs | None = None

    def params_of(self, trial_id: int) -> dict[str, float]:
        if self.sampler:
            return self.sampler(trial_id)
        return draw_params(self.space or DEFAULT_SPACE, trial_id, self.seed)

    def run(self, n_trials: int = 30, parallelism: int = 1, attempts: int = 3,
            delay: float = 5.0) -> DataFrame:
        """The trials table. Raises RuntimeError when trials still fail at the end."""
        spark = self.train.sparkSession
        done: dict[int, tuple] = {}
        if self.trials_path:
            self._study = self._identity()
            stored = read_trials(spark, self.trials_path, self.experiment, self._study)
            for r in stored.drop("experiment").collect():
                done[r["trial_id"]] = tuple(r)
        if any(t not in done for t in range(n_trials)):
            self._run_missing(n_trials, parallelism, attempts, delay, done)
        rows = [done[t] for t in sorted(done) if t < n_trials]
        return spark.createDataFrame(rows, TRIAL_SCHEMA)

    def _run_missing(self, n_trials: int, parallelism: int, attempts: int, delay: float,
                     done: dict[int, tuple]) -> None:
        inputs = self.inputs or fit_inputs(
            self.train, self.features or feature_columns(self.train, self.label_col))
        ratio = class_ratio(self.train, self.label_col).first()["ratio"]
        held_out = inputs.transform(self.val.select(
            *[ref(c) for c in [*inputs.features, self.label_col]]))
        rows = training_rows(self.train, inputs, self.label_col, ratio or 1.0)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        held_out = held_out.select("__features", ref(self.label_col).alias("__label"))
        held_out = held_out.persist(StorageLevel.MEMORY_AND_DISK)

        def trial(trial_id: int) -> tuple:
            """Draw, fit on train, average precision on validation, record."""
            params = {k: float(v) for k, v in self.params_of(trial_id).items()}
            if ratio is not None:
                params["scale_pos_weight"] = ratio
            trees = fit_trees(rows, params, self.seed)
            probability = vector_to_array("__probability")[1].alias("score")
            scored = trees.transform(held_out).select("__label", probability)
            metric = (average_precision(scored, "__label").first() or {"pr_auc": None})["pr_auc"]
            if metric is None:
                raise ValueError("the validation table is empty")
            return self._record(trial_id, params, metric, FittedModel(inputs, trees))

        try:
            for attempt in range(1, attempts + 1):
                missing = [t for t in range(n_trials) if t not in done]
                failure = _run_trials(inheritable_thread_target(rows.sparkSession)(trial),
                                      missing, parallelism, done)
                if failure is None:
                    return
                if attempt == attempts:
                    raise RuntimeError(f"study failed after {attempts} attempts") from failure
                time.sleep(delay)
        finally:
            rows.unpersist()
            held_out.unpersist()

    def _identity(self) -> str:
        """A name that changes with the rows, the features, the drawn parameters or the seed."""
        features = self.features or feature_columns(self.train, self.label_col)
        columns = [ref(c) for c in [*features, self.label_col]]
        # sums, as equal rows in pairs would cancel out of a xor
        marks = [tuple(df.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38, 0)")),
            F.sum(F.xxhash64(F.lit(1), *columns).cast("decimal(38, 0)"))).first())
            for df in (self.train, self.val)]
        space = sorted((self.space or DEFAULT_SPACE).items())
        told = (marks, features, self.label_col, self.seed, space,
                [self.params_of(t) for t in range(TOLD_TRIALS)])
        return hashlib.sha1(repr(told).encode()).hexdigest()[:16]

    def _record(self, trial_id: int, params: dict[str, float], metric: float,
                model: FittedModel) -> tuple:
        if not self.trials_path:
            return (None, trial_id, params, metric, None)
        model_path = f"{self.trials_path}/models/{self.experiment}/{self._study}/{trial_id}"
        save_model(model, model_path)
        row = (self._study, trial_id, params, metric, model_path)
        append_trial(self.train.sparkSession, self.trials_path, self.experiment, row)
        return row


def _run_trials(trial: Callable[[int], tuple], missing: list[int], parallelism: int,
                done: dict[int, tuple]) -> Exception | None:
    """Run the trials, a few at a time; finished ones land in ``done``."""
    failure = None
    with ThreadPoolExecutor(max_workers=max(parallelism, 1)) as pool:
        jobs = {t: pool.submit(trial, t) for t in missing}
        for t, job in jobs.items():
            try:
                done[t] = job.result()
            except Exception as exc:  # whatever it was, the trial is tried again
                failure = exc
    return failure
