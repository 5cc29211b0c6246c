"""The most frequent values of text columns without moving every distinct text.

Each task keeps a bounded summary of its values' hashes: when it holds too many, the same
count is taken from all and those without any left go, so no value is undercounted by
more than what was taken. Summaries add up, and so do their errors. The largest sums
propose values and one exact count of these decides: it is the answer if the k-th count is
above what any value that was not proposed can have.

Where it is not, as with values that are nearly all different, the values are counted by
short keys: a short text is its own key, a long one a 128-bit digest and its length. Keys
that can be among the first k by count and by the start of the text are few, or the start
is lengthened until they are; their texts are then counted as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.functions.columns import ref
from riskpanel.session import kept, workers_find_package

#: Values in a summary.
SUMMARY = 1_000
#: Texts up to this many bytes are their own keys.
SHORT = 24
#: Characters of a text that go with its key.
HEAD = 16
#: Keys beyond k whose whole texts are counted at the end.
FEW = 1_000

TOP_SCHEMA = "column string, value string, n bigint, position int"


def value_key(value: Column) -> Column:
    """A text's key: the same for the same text, of 33 bytes at most."""
    raw = value.cast("binary")
    size = F.octet_length(value)
    digest = F.concat(F.lit(b"\1"), F.unhex(F.md5(raw)), F.unhex(F.lpad(F.hex(size), 16, "0")))
    return F.when(size <= SHORT, F.concat(F.lit(b"\0"), raw)).otherwise(digest)


def stacked_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (slot, value): every present value of the text columns."""
    cells = [x for i, c in enumerate(columns) for x in (F.lit(i), ref(c).cast("string"))]
    return df.select(F.stack(F.lit(len(columns)), *cells).alias("slot", "value")).where(
        "value IS NOT NULL")


def key_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (slot, key, head, n) of the distinct values of the columns."""
    return stacked_texts(df, columns).groupBy(
        "slot", value_key(F.col("value")).alias("key"),
        F.substring("value", 1, HEAD).alias("head")).agg(F.count("*").alias("n"))


# -- summaries --------------------------------------------------------------------------


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, counts, len(found)).astype(np.int64)


def shortened(keys: np.ndarray, counts: np.ndarray, most: int):
    """At most ``most`` keys: the next largest count is taken from all; also what was taken."""
    if len(keys) <= most:
        return keys, counts, 0
    taken = int(np.partition(counts, len(counts) - most - 1)[len(counts) - most - 1])
    left = counts > taken
    return keys[left], counts[left] - taken, taken


def _summaries(most: int):
    """Per task and slot its summary, and in a row without hash what was taken."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            slots, hashes = (np.asarray(batch.column(c)) for c in ("slot", "hash"))
            for slot in np.unique(slots).tolist():
                own = hashes[slots == slot]
                keys, counts, lost = held.get(slot, (own[:0], np.zeros(0, np.int64), 0))
                keys, counts = summed(np.concatenate([keys, own]), np.concatenate(
                    [counts, np.ones(len(own), np.int64)]))
                keys, counts, taken = shortened(keys, counts, most)
                held[slot] = keys, counts, lost + taken
        for slot, (keys, counts, lost) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot] * (len(keys) + 1), pa.int32()), pa.array([*keys.tolist(), None],
                                                                          pa.int64()),
                 pa.array([*counts.tolist(), lost], pa.int64())], names=["slot", "hash", "n"])
    return run


def proposals(cells: DataFrame, slots: int, most: int) -> tuple[DataFrame, dict[int, int]]:
    """Rows (slot, hash) of the values with the largest sums, at most ``most`` of a slot, and per
    slot the count that no other value exceeds."""
    hashed = cells.select("slot", F.xxhash64("value").alias("hash"))
    total = kept(hashed.mapInArrow(_summaries(most), "slot int, hash bigint, n bigint")
                 .groupBy("slot", "hash").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("slot").orderBy(F.desc("n"), "hash")
    best = total.where("hash IS NOT NULL").withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= most + 1).collect()
    bound = {i: 0 for i in range(slots)}
    for r in total.where("hash IS NULL").collect():
        bound[r["slot"]] = r["n"]
    chosen = []
    for r in best:
        if r["place"] <= most:
            chosen.append((r["slot"], r["hash"]))
        else:
            bound[r["slot"]] += r["n"]
    return cells.sparkSession.createDataFrame(chosen, "slot int, hash bigint"), bound


# -- the first k -------------------------------------------------------------------------


def _first(counted: DataFrame, k: int) -> DataFrame:
    """The k most frequent (slot, value, n), ties by value; each task keeps its own k before
    the last shuffle."""
    order = Window.partitionBy("slot").orderBy(F.desc("n"), "value")
    return counted.withColumn("position", F.row_number().over(order)).where(
        F.col("position") <= k)


def _by_proposals(cells: DataFrame, slots: int, k: int, most: int) -> tuple[list, list[int]]:
    """Rows (slot, value, n, position) of the slots that the summaries settle, and the others."""
    wanted, bound = proposals(cells, slots, most)
    counted = (cells.withColumn("hash", F.xxhash64("value"))
               .join(F.broadcast(wanted), ["slot", "hash"], "left_semi")
               .groupBy("slot", "value").agg(F.count("*").alias("n")))
    found: dict[int, list] = {i: [] for i in range(slots)}
    for r in _first(counted, k).collect():
        found[r["slot"]].append((r["slot"], r["value"], r["n"], r["position"]))
    rows, unsettled = [], []
    for slot, own in found.items():
        last = min((r[2] for r in own), default=0) if len(own) == k else 0
        if bound[slot] == 0 or last > bound[slot]:
            rows += own
        else:
            unsettled.append(slot)
    return rows, unsettled


def _candidates(counts: DataFrame, cells: DataFrame, slots: list[int], k: int,
                few: int) -> DataFrame:
    """Rows (slot, key) that hold the k first values of each slot, and few others."""
    ends = Window.partitionBy("slot").orderBy(F.desc("n"), "head")
    last = (counts.where(F.col("slot").isin(slots)).withColumn("place", F.row_number().over(ends))
            .where(F.col("place") <= k).groupBy("slot").agg(
                F.max_by(F.struct("n", "head"), "place").alias("end")).collect())
    spark = counts.sparkSession
    bounds = spark.createDataFrame([(r["slot"], r["end"]["n"], r["end"]["head"]) for r in last],
                                   "slot int, end_n bigint, end_head string")
    near = counts.join(F.broadcast(bounds), "slot").where(
        (F.col("n") > F.col("end_n"))
        | ((F.col("n") == F.col("end_n")) & (F.col("head") <= F.col("end_head"))))
    tied = (F.col("n") == F.col("end_n")) & (F.col("head") == F.col("end_head"))
    sizes = {r["slot"]: (r["sure"], r["open"]) for r in near.groupBy("slot").agg(
        F.count_if(~tied).alias("sure"), F.count_if(tied).alias("open")).collect()}
    wide = [r["slot"] for r in last if sum(sizes[r["slot"]]) > k + few]
    if not wide:
        return near.select("slot", "key")
    # too many texts start alike: only these are told apart by more of their text
    parts = near.where(~F.col("slot").isin(wide) | ~tied).select("slot", "key")
    for r in last:
        if r["slot"] in wide:
            same = cells.where((F.col("slot") == r["slot"])
                               & (F.substring("value", 1, HEAD) == r["end"]["head"]))
            parts = parts.unionByName(_longer(same, r["end"]["n"], k - sizes[r["slot"]][0], few))
    return parts


def _longer(cells: DataFrame, n: int, k: int, few: int) -> DataFrame:
    """Of the values with the count n, the keys of the k smallest and few others."""
    size = HEAD
    start = F.lit(True)
    parts = None
    while True:
        size *= 8
        head = F.substring("value", 1, size)
        counted = kept(cells.where(start).groupBy(
            "slot", value_key(F.col("value")).alias("key"), head.alias("head")).agg(
            F.max(F.char_length("value")).alias("length"), F.count("*").alias("n"))
            .where(F.col("n") == n))
        end = counted.orderBy("head").limit(k).agg(F.max("head")).first()[0]
        below = counted.where(F.col("head") < end)
        tied = counted.where(F.col("head") == end)
        sure, (open_, longest) = below.count(), tied.agg(F.count("*"), F.max("length")).first()
        parts = below if parts is None else parts.unionByName(below)
        if open_ <= few or longest <= size:
            return parts.unionByName(tied).select("slot", "key")
        start, k = head == F.lit(end), k - sure


def top_values(df: DataFrame, columns: list[str], k: int, most: int = SUMMARY,
               few: int = FEW, counts: DataFrame | None = None) -> DataFrame:
    """Rows (column, value, n, position): the k most frequent values of each column, ties by
    value. ``counts`` are the columns' ``key_counts``, which decide at once if they are known."""
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = df.sparkSession
    workers_find_package(spark)
    cells = stacked_texts(df, columns)
    rows, unsettled = [], list(range(len(columns)))
    if counts is None:
        rows, unsettled = _by_proposals(cells, len(columns), k, max(most, k))
    if unsettled:
        counts = kept(key_counts(df, columns)) if counts is None else counts
        wanted = _candidates(counts, cells, unsettled, k, few)
        counted = (cells.withColumn("key", value_key(F.col("value")))
                   .join(F.broadcast(wanted), ["slot", "key"], "left_semi")
                   .groupBy("slot", "value").agg(F.count("*").alias("n")))
        rows += [(r["slot"], r["value"], r["n"], r["position"])
                 for r in _first(counted, k).collect()]
    return spark.createDataFrame([(columns[s], v, n, p) for s, v, n, p in rows], TOP_SCHEMA)
