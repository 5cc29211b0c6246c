"""Importance resampling of documents towards a target distribution.

Words of every document and every target text fall into buckets by their CRC-32. A
bucket's gain is the logarithm of its share in the target over its share in the documents;
a document's weight is the mean gain of its words, and its score the weight and
a Gumbel draw that depends on the doc_id alone. The best scores are drawn.

Weights come from arrays: the words of a part of the texts are found, hashed and summed up
at once. The cutoff is found by weighted medians of medians. Each task's keys (score,
doc_id) lie in sorted arrays; a round takes the median of what remains in each array, and
the median of these medians, weighted by what remains, is the pivot. At least a
quarter of the remaining keys are on either side of it, so each count of the keys before
the pivot discards a quarter or more, until the pivot is the last key that is drawn.
Driver and tasks exchange one row for each array and round. The drawn rows are sorted by
ranges and numbered from the ranges' sizes.

Defined results: a null or empty text has no words and weight 0; a null doc_id draws as
the empty string and comes after every other in ties; repeated rows count one by one, and of rows
with equal keys at the cutoff as many are drawn as there is room for; an empty target gives every
bucket the share of its prior; an empty table gives an empty result; other columns play no
part, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm import texts

BUCKETS = 10_000
MIN_WORDS = 20
SHARE = 10  # per cent of the documents with MIN_WORDS words
SEED = 2024
#: Words up to this many bytes are hashed together, longer ones one by one.
TOGETHER = 64
#: Keys of one sorted array.
KEYS = 1 << 20
#: Winners of one range, about.
RANGE_ROWS = 500_000
NO_ID = int(texts.NO_ID)

# ASCII but letters and digits separates words; capitals become small.
PLAIN = texts.LOWER.copy()
PLAIN[[b for b in range(128) if not chr(PLAIN[b]).isalnum()]] = 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of each byte range."""
    order = np.argsort(-np.minimum(lengths, TOGETHER + 1), kind="stable")
    at, size = starts[order], lengths[order]
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    longer = int(np.searchsorted(-size, -TOGETHER, "left")) if len(size) else 0
    for j in range(int(min(size[longer], TOGETHER)) if longer < len(size) else 0):
        live = int(np.searchsorted(-size[longer:], -j, "left")) + longer
        now = crc[longer:live]
        crc[longer:live] = CRC[(now ^ data[at[longer:live] + j]) & np.uint32(255)] ^ (
            now >> np.uint32(8))
    out = np.empty(len(at), np.uint32)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    for i in order[:longer].tolist():
        out[i] = zlib.crc32(data[starts[i]:starts[i] + lengths[i]].tobytes())
    return out


def buckets_of(data: np.ndarray, offsets: np.ndarray,
               buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word, and for document d its words first[d]:first[d + 1]."""
    data = PLAIN[data]
    words = texts.words_of(data, offsets)
    out = np.empty(len(words.starts), np.int64)
    for low, high in texts.chunks(words.ends):
        out[low:high] = checksums(data, words.starts[low:high],
                                  words.ends[low:high] - words.starts[low:high]) % buckets
    return out, words.first


def bucket_counts(table: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Words of all texts by bucket: ``buckets`` numbers, whatever the input."""
    texts.workers_find_package(table.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, data, offsets in texts.parts(batches, "__text"):
            total += np.bincount(buckets_of(data, offsets, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])],
                                         names=["bucket", "n"])

    found = (table.select(F.col(f"`{text}`").alias("__text")).mapInArrow(
        run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for bucket, n in found:
        out[bucket] = n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(target share / documents' share)) of every bucket, add-one smoothed."""
    size = len(documents)
    of, to = float(documents.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(1000 * math.log((float(t) + 1) * of / ((float(s) + 1) * to)))
                     for s, t in zip(documents, target)], np.int64)


def draw(ids: list, seed: int = SEED) -> np.ndarray:
    """The Gumbel draw of each id, in thousandths, rounded down."""
    out = []
    for i in ids:
        told = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
        h = int(told[:8], 16)
        out.append(math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
    return np.array(out, np.int64)


def scored(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS,
           seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight and score of every document (stored)."""
    spark = documents.sparkSession
    texts.workers_find_package(spark)
    gain = spark.sparkContext.broadcast(gains(bucket_counts(documents, buckets=buckets),
                                              bucket_counts(target, buckets=buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = gain.value
        for rows, data, offsets in texts.parts(batches):
            words, first = buckets_of(data, offsets, buckets)
            sums = np.concatenate([[0], np.cumsum(of[words])])[first]
            n = np.diff(first)
            weight = np.diff(sums) // np.maximum(n, 1)
            score = weight + draw(rows.column("doc_id").to_pylist(), seed)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *map(pa.array, (n, weight, score))],
                names=["doc_id", "n_features", "weight", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return texts.stored(documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_features bigint, weight bigint, score bigint"))


# -- the cutoff -----------------------------------------------------------------------

#: (-score, doc_id): the smallest keys are drawn first.
Key = tuple[int, int]


def sorted_keys(keys: DataFrame) -> DataFrame:
    """The keys (a, b) as arrays, each of one task and sorted (stored)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0

        def packed() -> pa.RecordBatch:
            a, b = (np.concatenate([k[i] for k in kept]) for i in (0, 1))
            order = np.lexsort((b, a))
            return pa.RecordBatch.from_arrays([texts.binary_array(
                [texts.pack(a[order], b[order])])], names=["keys"])

        for batch in batches:
            kept.append([np.asarray(batch.column(c)) for c in (0, 1)])
            size += batch.num_rows
            if size >= KEYS:
                yield packed()
                kept, size = [], 0
        if size:
            yield packed()

    return texts.stored(keys.select("a", "b").mapInArrow(run, "keys binary"))


def _before(a: np.ndarray, b: np.ndarray, key: Key) -> tuple[int, int]:
    """How many of the sorted keys are smaller than ``key``, and how many are not larger."""
    low, high = np.searchsorted(a, key[0], "left"), np.searchsorted(a, key[0], "right")
    ties = b[low:high]
    return (int(low + np.searchsorted(ties, key[1], "left")),
            int(low + np.searchsorted(ties, key[1], "right")))


def _round(arrays: DataFrame, pivot: Key | None, above: Key | None, below: Key | None):
    """Per array: the keys between ``above`` and ``below`` (exclusive) that are before the
    pivot, equal to it and after it, and the medians of those before and after."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            for blob in batch.column("keys").to_pylist():
                a, b = texts.unpack(blob, np.int64, np.int64)
                start = _before(a, b, above)[1] if above else 0
                end = _before(a, b, below)[0] if below else len(a)
                low, high = _before(a, b, pivot) if pivot else (start, start)
                row = [low - start, high - low, end - high]
                for x, y in ((start, low), (high, end)):
                    middle = (x + y - 1) // 2
                    row += [int(a[middle]), int(b[middle])] if x < y else [0, 0]
                out.append(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*out)] if out else
            [pa.array([], pa.int64())] * 7, names=["n0", "n1", "n2", "a0", "b0", "a2", "b2"])

    return arrays.mapInArrow(run, "n0 bigint, n1 bigint, n2 bigint, a0 bigint, b0 bigint, "
                                  "a2 bigint, b2 bigint").where("n0 + n1 + n2 > 0").collect()


def weighted_median(keys: list[tuple[Key, int]]) -> Key:
    """The smallest key at which half of the weight is reached."""
    total, reached = sum(n for _, n in keys), 0
    for key, n in sorted(keys):
        reached += n
        if 2 * reached >= total:
            return key
    raise ValueError("no keys")


def cutoff(arrays: DataFrame, k: int) -> tuple[Key, list[tuple[int, int]]]:
    """The k-th smallest key, and for each round the keys that remained and those discarded."""
    pivot = above = below = None
    rounds = []
    while True:
        found = _round(arrays, pivot, above, below)
        before, same, after = (sum(r[f"n{i}"] for r in found) for i in range(3))
        if pivot is not None and before < k <= before + same:
            return pivot, rounds
        if k <= before:
            below, side = pivot, 0
        else:
            above, side, k = pivot, 2, k - before - same
        if pivot is not None:
            rounds.append((before + same + after, same + (after if side == 0 else before)))
        pivot = weighted_median([((r[f"a{side}"], r[f"b{side}"]), r[f"n{side}"])
                                 for r in found if r[f"n{side}"]])


# -- the draw ------------------------------------------------------------------------


def resampled(documents: DataFrame, target: DataFrame, share: int = SHARE,
              least: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; undrawn ones without rank."""
    table = scored(documents, target, buckets, seed)
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    keyed = table.withColumns({"a": -F.col("score"), "b": order})
    k = share * table.where(F.col("n_features") >= least).count() // 100
    names = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if not k:
        return table.select(*names, none)
    able = F.col("n_features") >= least
    (a, b), _ = cutoff(sorted_keys(keyed.where(able)), k)
    won = able & ((F.col("a") < a) | ((F.col("a") == a) & (F.col("b") <= b)))
    # rows with the cutoff's key may be more than there is room for
    ranked = numbered(keyed.where(won), k).select(
        *names, F.when(F.col("place") <= k, F.col("place")).alias("rank"))
    return ranked.unionByName(keyed.where(~won).select(*names, none))


def numbered(keyed: DataFrame, rows: int) -> DataFrame:
    """The rows with ``place``: 1, 2, 3 ... by (a, b).

    Each range of keys is one sorted partition; its first place is the sum of the sizes
    of those before it. Rows with one key may fall into several ranges.
    """
    order = ["a", "b", "n_features", "row"]
    keyed = keyed.withColumn("row", F.monotonically_increasing_id())
    ranges = max(1, -(-rows // RANGE_ROWS))
    apart = texts.stored(keyed.repartitionByRange(ranges, *order).withColumn(
        "range", F.spark_partition_id()))
    sizes = dict(apart.groupBy("range").count().collect())
    first, at = {}, 0
    for r in sorted(sizes):
        first[r], at = at, at + sizes[r]
    spark = keyed.sparkSession
    starts = F.broadcast(spark.createDataFrame(list(first.items()), "range int, first bigint"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return apart.withColumn("within", within).join(starts, "range").withColumn(
        "place", F.col("first") + F.col("within"))
