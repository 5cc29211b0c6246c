"""Words, hashes and packed strings of Arrow text columns, and tables kept between jobs.

Texts are handled as UTF-8 bytes. A word is a run of bytes other than space and
0x09-0x0D, the same split as ``bytes.split()``.
"""

from __future__ import annotations

import gc
import os
import struct
import tempfile
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART_BYTES = 2 << 20
#: Bytes handled at once where an array of 8 bytes for each is needed.
CHUNK = 1 << 19
NO_ID = np.iinfo(np.int64).max

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: Odd factors of the words of a window, by place in it.
FACTORS = np.random.default_rng(21).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it, unless shipped."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local master without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.environ.setdefault("RISKPANEL_LLM_FOLDER",
                                       tempfile.mkdtemp(prefix="riskpanel-llm-"))
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Later jobs read the files, so a lost executor costs a re-read. The files go
    when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/riskpanel-llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of tables that nobody refers to any more.

    Python's references to the JVM go first, in the background; what they held is found by
    a second collection.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_fields(schema: T.StructType, *added: tuple[str, str]) -> T.StructType:
    """A schema with further fields of simple types."""
    kinds = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
             "array<int>": T.ArrayType(T.IntegerType())}
    return T.StructType([*schema.fields, *(T.StructField(n, kinds[k]) for n, k in added)])


def text_key(text) -> F.Column:
    """64 bits of the text's digest, null as empty."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


# -- Arrow columns as bytes ------------------------------------------------------


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes (uint8) and offsets (int64, from 0); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type)
                              or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def parts(batches: Iterator[pa.RecordBatch], column: str = "text",
          most: int = PART_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``most`` bytes of text (or one row), with bytes and offsets."""
    for batch in batches:
        data, offsets = column_bytes(batch.column(column))
        low, rows = 0, batch.num_rows
        while low < rows:
            high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
            high = min(max(high, low + 1), rows)
            yield (batch.slice(low, high - low), data[offsets[low]:offsets[high]],
                   offsets[low:high + 1] - offsets[low])
            low = high


def ids(column: pa.Array) -> np.ndarray:
    """Ids as int64; null as the largest number, so that it comes after every id."""
    return np.asarray(pc.fill_null(column.cast(pa.int64()), int(NO_ID)))


# -- words ---------------------------------------------------------------------------


@dataclass
class Words:
    """Byte ranges of words, and for document d its words first[d]:first[d + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    begins[cuts] = inside[cuts]
    cuts = cuts[cuts > 0]
    ends[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(which: str, size: int) -> np.ndarray:
    if len(_powers.get(which, ())) < size:
        base = np.full(max(size, CHUNK + 1), _BASE if which == "up" else _BASE_INVERSE,
                       np.uint64)
        base[0] = 1
        _powers[which] = np.cumprod(base)
    return _powers[which]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums of byte values times powers of a base, modulo 2^64."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", len(data))[:len(data)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, the same for the same bytes at any place."""
    raw = (sums[ends] - sums[starts]) * _power("down", len(sums))[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """Hashes of all words, some CHUNK bytes at a time."""
    out = np.empty(len(words.starts), np.uint64)
    for low, high in chunks(words.ends):
        begin = int(words.starts[low])
        sums = prefix_sums(data[begin:int(words.ends[high - 1])])
        out[low:high] = range_hashes(sums, words.starts[low:high] - begin,
                                     words.ends[low:high] - begin)
    return out


def chunks(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Index ranges of ascending places that span about CHUNK each (one item at least)."""
    low = 0
    while low < len(ends):
        begin = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, begin + CHUNK, "right")))
        yield low, high
        low = high


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` consecutive words, across documents too."""
    count = max(0, len(hashes) - width + 1)
    out = np.zeros(count, np.uint64)
    for j in range(width):
        out += hashes[j:j + count] * FACTORS[j]
    return mix(out)


def whole_windows(words: Words, width: int) -> np.ndarray:
    """Starts (word numbers) of the windows that lie in one document."""
    count = max(0, int(words.first[-1]) - width + 1)
    inside = np.ones(count, bool)
    for j in range(1, width):  # a window that starts less than width before a cut crosses it
        cuts = words.first[1:-1] - j
        inside[cuts[(cuts >= 0) & (cuts < count)]] = False
    return np.flatnonzero(inside)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest (by its upper half) of every ``width`` values, the first of
    equals."""
    low = np.uint64(0xFFFFFFFF)
    best = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if width > size:
        best = np.minimum(best[:len(best) - (width - size)], best[width - size:])
    return (best & low).astype(np.int64)


def covered(starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in any range [start, start + length)."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + lengths, size), -1)
    return np.cumsum(edge[:-1]) > 0


def slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of the ranges one after another."""
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for low, high in chunks(ends):
        begin = int(ends[low] - lengths[low])
        before = ends[low:high] - lengths[low:high] - begin
        size = int(ends[high - 1]) - begin
        at = np.repeat(starts[low:high] - before, lengths[low:high])
        at += np.arange(size)
        out[begin:begin + size] = data[at]
    return out


# -- packed arrays -------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of fixed kinds as one compressed string; see ``unpack``."""
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    sizes = struct.pack(f"<{len(arrays)}q", *(a.nbytes for a in arrays))
    return zstandard.ZstdCompressor(level=1).compress(sizes + body)


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = struct.unpack_from(f"<{len(kinds)}q", raw)
    out, at = [], 8 * len(kinds)
    for size, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def binary_array(pieces: list[bytes]) -> pa.Array:
    return pa.array(pieces, pa.binary())
