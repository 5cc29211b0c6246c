"""Sums over the rows where both of two columns are present, for all pairs at once.

A task turns its rows into a matrix of values (0 where missing) and one of presence
flags. Products of these matrices hold, for every pair of columns, the number of rows that
have both, the sums and squares of either column over these rows, and the sum of
products. Only one row of sums a column leaves a task, whatever the number of rows;
they are added in two steps, first some tasks' and then the rest.

Values are shifted and scaled by their column, which changes no correlation. A pair
whose rows hold a small part of a column's spread would lose digits by that; such
pairs are summed again about their own means, and tested for being constant.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A pair keeps at least this share of a column's squares about the pair's own mean, or is
#: summed again.
LEAST_SHARE = 1e-6
#: Pairs whose columns are copied side by side when they are summed again.
PAIRS_AT_ONCE = 64
ROW_SUMS = 7


@dataclass(frozen=True)
class Scale:
    """What is subtracted from a column and what the rest is divided by."""

    shift: float
    width: float


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The columns of a batch as doubles, NaN where missing."""
    if not batch.num_rows:
        return np.zeros((0, batch.num_columns))
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(float)
                            for c in batch.columns])


class PairSums:
    """The sums of all pairs over some rows."""

    def __init__(self, scales: list[Scale]):
        self.shift = np.array([s.shift for s in scales])
        self.width = np.array([s.width for s in scales])
        size = len(scales)
        self.both, self.value, self.square, self.product, self.infinite = (
            np.zeros((size, size)) for _ in range(5))

    def add(self, values: np.ndarray) -> None:
        endless = np.isinf(values)
        here = ~np.isnan(values)
        with np.errstate(over="ignore", invalid="ignore"):
            scaled = np.where(here & ~endless, (values - self.shift) / self.width, 0.0)
        here = here.astype(float)
        self.both += here.T @ here
        self.value += scaled.T @ here
        self.square += (scaled * scaled).T @ here
        self.product += scaled.T @ scaled
        if endless.any():
            self.infinite += endless.T.astype(float) @ here

    def rows(self) -> np.ndarray:
        """Per column its sums with all others: ROW_SUMS numbers for each."""
        return np.stack([self.both, self.value, self.value.T, self.square, self.square.T,
                         self.product, self.infinite + self.infinite.T], 1)


def _sum_rows(scales: list[Scale], lots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = PairSums(scales)
        for batch in batches:
            sums.add(_matrix(batch))
        size = len(scales)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()),
             pa.array([TaskContext.get().partitionId() % lots] * size, pa.int32()),
             pa.array([r.tobytes() for r in sums.rows()], pa.binary())],
            names=["i", "lot", "sums"])
    return run


def _added(table: pa.Table) -> np.ndarray:
    total = None
    for blob in table.column("sums").to_pylist():
        one = np.frombuffer(blob)
        total = one if total is None else total + one
    return total


def _add_lot(table: pa.Table) -> pa.Table:
    return pa.table({"i": table.column("i")[:1],
                     "sums": pa.array([_added(table).tobytes()], pa.binary())})


def _add_all(table: pa.Table) -> pa.Table:
    """Rows (i, j, n, corr, shift_x, shift_y, doubtful) of column i with itself and later ones."""
    i = table.column("i")[0].as_py()
    n, sx, sy, xx, yy, xy, infinite = _added(table).reshape(ROW_SUMS, -1)[:, i:]
    with np.errstate(divide="ignore", invalid="ignore"):
        mean_x, mean_y = sx / n, sy / n
        vx, vy, cov = xx - sx * mean_x, yy - sy * mean_y, xy - sx * mean_y
        corr = cov / np.sqrt(vx * vy)
    known = (n >= 2) & (infinite == 0)
    doubtful = known & ((vx <= LEAST_SHARE * xx) | (vy <= LEAST_SHARE * yy))
    good = known & ~doubtful
    size = len(n)
    return pa.table({
        "i": pa.array([i] * size, pa.int32()), "j": pa.array(range(i, i + size), pa.int32()),
        "n": pa.array(n.astype(np.int64)), "corr": pa.array(corr, mask=~good),
        "mean_x": pa.array(np.where(known, mean_x, 0.0)),
        "mean_y": pa.array(np.where(known, mean_y, 0.0)), "doubtful": pa.array(doubtful)})


def pair_correlations(numbers: DataFrame, scales: list[Scale], lots: int) -> DataFrame:
    """One row for each pair i <= j of the columns: n, corr, the means (shifted and scaled)
    over the rows that have both, and whether the pair has to be summed again.

    ``corr`` is NULL for fewer than two rows and where a value is infinite.
    """
    return (numbers.mapInArrow(_sum_rows(scales, lots), "i int, lot int, sums binary")
            .groupBy("i", "lot").applyInArrow(_add_lot, "i int, sums binary")
            .groupBy("i").applyInArrow(_add_all, "i int, j int, n bigint, corr double, "
                                       "mean_x double, mean_y double, doubtful boolean"))


def _about_means(pairs: list[tuple[int, int, float, float]], scales: list[Scale]):
    """Sums of the pairs (i, j, mean of i, mean of j) about these means, and the bounds."""
    shift = np.array([s.shift for s in scales])
    width = np.array([s.width for s in scales])
    ends = {c: np.array([p[c] for p in pairs], np.int64) for c in (0, 1)}
    # the means in the columns' own units
    means = {c: np.array([p[c + 2] for p in pairs]) * width[ends[c]] + shift[ends[c]]
             for c in (0, 1)}
    names = ["n", "x", "y", "xx", "yy", "xy", "low_x", "high_x", "low_y", "high_y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(pairs)))
        low, high = np.full((2, len(pairs)), np.inf), np.full((2, len(pairs)), -np.inf)
        for batch in batches:
            values = _matrix(batch)
            for at in range(0, len(pairs) if len(values) else 0, PAIRS_AT_ONCE):
                some = slice(at, at + PAIRS_AT_ONCE)
                raw = [values[:, ends[c][some]] for c in (0, 1)]
                here = ~np.isnan(raw[0]) & ~np.isnan(raw[1])
                x, y = (np.where(here, (raw[c] - means[c][some]) / width[ends[c][some]], 0.0)
                        for c in (0, 1))
                total[:, some] += [here.sum(0), x.sum(0), y.sum(0), (x * x).sum(0),
                                   (y * y).sum(0), (x * y).sum(0)]
                for c in (0, 1):
                    low[c, some] = np.minimum(low[c, some],
                                              np.where(here, raw[c], np.inf).min(0))
                    high[c, some] = np.maximum(high[c, some],
                                               np.where(here, raw[c], -np.inf).max(0))
        columns = [*total, low[0], high[0], low[1], high[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ends[0], pa.int32()), pa.array(ends[1], pa.int32()),
             *(pa.array(c) for c in columns)], names=["i", "j", *names])
    return run, names


def exact_pairs(numbers: DataFrame, pairs: list[tuple[int, int, float, float]],
                scales: list[Scale]) -> DataFrame:
    """Rows (i, j, corr) of the given pairs; NULL where a column is constant."""
    run, names = _about_means(pairs, scales)
    rows = numbers.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in names))
    total = rows.groupBy("i", "j").agg(*[
        (F.min(c) if c.startswith("low") else F.max(c) if c.startswith("high") else F.sum(c))
        .alias(c) for c in names])
    vx, vy, cov = (F.expr(f"{a}{b} - {a} * {b} / n") for a, b in ("xx", "yy", "xy"))
    varies = (F.col("low_x") < F.col("high_x")) & (F.col("low_y") < F.col("high_y"))
    return total.select("i", "j", F.when(varies, F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy)))
                        .alias("corr"))
