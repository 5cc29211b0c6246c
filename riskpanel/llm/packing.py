"""Packing of token pieces into sequences of one size, by minimum bin slack.

Texts are encoded and cut into pieces of at most ``size`` tokens. How many pieces have
which length, at most ``size`` numbers, decides the packing. A sequence is seeded with
the longest length that is left; a dynamic program over bit sets finds the largest sum
of other lengths left that fits, preferring long ones among equal sums, and the
combination is removed. The same combination is the answer for as long as
its lengths last, so it is removed that many times at once: the number of combinations
depends on the size and not on the number of pieces.

The pieces of a length are numbered: by Spark within lots of pieces, a lot's first number being
the count of the length in the lots before it. A piece's number leads to its combination,
sequence and offset by arithmetic, so a length that many pieces have is no single task.

Words between white space are encoded by the tokenizers library, each distinct one once
while a Python worker remembers it; its splits never join two of them. Words of plain
letters are first cut into the pieces that its model encodes.

Defined results: a null or empty text, or one of white space only, is one piece, the end
token alone; a null doc_id and repeated rows are pieces like any others; an empty table
gives an empty result; other columns play no part, whatever their names.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm import texts

VOCABULARY = "word_bpe_49k.json"
SIZE = 2048
END_ID = 0
#: Pieces of one lot, at most about; there are as many lots as shuffle partitions or more.
LOT = 100_000
#: Words kept with their tokens in a Python worker, and the longest of them in bytes.
KEPT_WORDS = 600_000
KEPT_BYTES = 64
# Words of these letters are composed, have a small form of the same length and are cut by the
# vocabulary file's pattern as here. The library itself cuts all others.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]"
                    "|[!-/:-@\\[-`{-~]+")
ADDED = "<|"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


# -- tokens ---------------------------------------------------------------------------


class Encoder:
    """The library's ids of texts, as little-endian unsigned 32-bit numbers."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(file)
        self._library.no_truncation()
        self._library.no_padding()
        self._letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        self._kept: dict[bytes, bytes] = {}

    def _pieces(self, word: bytes) -> list[bytes] | None:
        """The library's cut of a word of plain letters, digits and ASCII; None for others."""
        text = word.decode()
        if PLAIN.fullmatch(text) and ADDED not in text:
            return [p.encode() for p in PIECES.findall(text.lower())]
        return None

    def _piece_ids(self, piece: bytes) -> bytes:
        """The ids of one piece, by the library's model."""
        spelled = piece.decode("latin-1").translate(self._letters)
        return packed_ids([t.id for t in self._library.model.tokenize(spelled)])

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of new words; the model sees each of their pieces once."""
        kept, found, others = self._kept, {}, []
        for word in words:
            cut = self._pieces(word)
            if cut is None:
                others.append(word)
                continue
            for p in cut:
                if p not in kept and p not in found:
                    found[p] = self._piece_ids(p)
            if word not in found:
                found[word] = b"".join([found[p] if p in found else kept[p] for p in cut])
        whole = self._library.encode_batch([w.decode() for w in others], add_special_tokens=False)
        return found | {w: packed_ids(e.ids) for w, e in zip(others, whole)}

    def ids(self, raw: bytes) -> bytes:
        words, kept = raw.split(), self._kept
        out = list(map(kept.get, words))
        if None not in out:
            return b"".join(out)
        found = self._learn({w for w, ids in zip(words, out) if ids is None})
        whole = b"".join([found[w] if ids is None else ids for w, ids in zip(words, out)])
        if len(kept) + len(found) > KEPT_WORDS:
            kept.clear()
        kept.update((w, ids) for w, ids in found.items() if len(w) <= KEPT_BYTES)
        return whole


_encoders: dict[int, Encoder] = {}


def _encoder(file: str) -> Encoder:
    """The worker's encoder; what it remembers outlives a task."""
    key = hash(file)
    if key not in _encoders:
        _encoders[key] = Encoder(file)
    return _encoders[key]


def pieces(documents: DataFrame, size: int = SIZE, path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of the pieces of every text, and their
    ``ids`` if asked for."""
    spark = documents.sparkSession
    texts.workers_find_package(spark)
    with open(path or default_path(), encoding="utf-8") as f:
        file = spark.sparkContext.broadcast(f.read())  # a few MB, whatever the input
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file.value)
        for rows, data, offsets in texts.parts(batches):
            raw = data.tobytes()
            row, number, length, crc, ids = [], [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                whole = encoder.ids(raw[a:b]) + end
                for n, at in enumerate(range(0, len(whole), 4 * size)):
                    piece = whole[at:at + 4 * size]
                    row.append(i)
                    number.append(n)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
            number = np.array(number, np.int32)
            out = [rows.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number),
                   pa.array(number.astype(np.int64) * size), pa.array(length, pa.int64()),
                   pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
             + (", ids array<int>" if with_ids else ""))


# -- combinations ---------------------------------------------------------------------


@dataclass(frozen=True)
class Pattern:
    """A combination: how many pieces of which length, longest first, and how often."""

    used: tuple[tuple[int, int], ...]
    times: int

    @property
    def filled(self) -> int:
        return sum(length * n for length, n in self.used)


def fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """The lengths that are left with the largest sum up to ``room``, and of equal sums
    the one with the longest lengths.

    Bit s of a set is whether lengths up to some one reach the sum s; ``left`` says how
    many there are of each length.
    """
    lengths = sorted(n for n in left if n <= room)
    whole = (1 << (room + 1)) - 1
    reached = [1]
    for length in lengths:
        sums, many, step = reached[-1], min(left[length], room // length), 1
        while many:  # 1, 2, 4 ... and the rest of them
            step = min(step, many)
            sums |= (sums << (length * step)) & whole
            many -= step
            step *= 2
        reached.append(sums)
    target = reached[-1].bit_length() - 1
    used = {}
    for i in range(len(lengths) - 1, -1, -1):
        length = lengths[i]
        n = min(left[length], target // length)
        while not reached[i] >> (target - n * length) & 1:
            n -= 1
        if n:
            used[length] = n
            target -= n * length
    return used


def patterns(count: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Combinations that use up ``count`` (pieces by length), each as full as it can be."""
    left = {length: n for length, n in count.items() if n}
    out = []
    while left:
        seed = max(left)
        left[seed] -= 1
        used = fullest({k: n for k, n in left.items() if n}, size - seed)
        left[seed] += 1
        used[seed] = used.get(seed, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        out.append(Pattern(tuple(sorted(used.items(), reverse=True)), times))
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def places(found: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """For the pieces of a length from number ``first`` on: (length, first, the first
    sequence, pieces of the length in a sequence, their offset)."""
    out, taken, sequence = [], {}, 0
    for pattern in found:
        offset = 0
        for length, n in pattern.used:
            out.append((length, taken.get(length, 0), sequence, n, offset))
            taken[length] = taken.get(length, 0) + n * pattern.times
            offset += length * n
        sequence += pattern.times
    return out


# -- the packing -------------------------------------------------------------------------


def packed(documents: DataFrame, size: int = SIZE, path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and the ``offset`` there."""
    spark = documents.sparkSession
    # rows are told apart by a number that is written with them
    cut = texts.stored(pieces(documents, size, path, with_ids).withColumn(
        "row", F.monotonically_increasing_id()))
    lots = max(texts.partitions(spark), cut.count() // LOT)
    dealt = cut.withColumn("lot", F.pmod(F.xxhash64("row"), F.lit(lots)).cast("int"))
    lot_counts = texts.stored(dealt.groupBy("length", "lot").agg(F.count("*").alias("n")))
    count = dict(lot_counts.groupBy("length").agg(F.sum("n")).collect())  # size rows at most
    by_length = Window.partitionBy("length").orderBy("lot")
    first = lot_counts.select("length", "lot", (
        F.sum("n").over(by_length) - F.col("n")).alias("lot_first"))
    within = F.row_number().over(Window.partitionBy("length", "lot").orderBy("row"))
    numbered = dealt.withColumn("within", within - 1).join(first, ["length", "lot"]).withColumn(
        "number", F.col("lot_first") + F.col("within"))
    table = spark.createDataFrame(
        places(patterns(count, size)), "length bigint, first bigint, sequence bigint, "
                                       "n bigint, place bigint")
    # per length its combinations in order, found by their first number
    table = table.groupBy("length").agg(F.sort_array(F.collect_list(
        F.struct("first", "sequence", "n", "place"))).alias("uses"))
    use = F.element_at(F.filter("uses", lambda u: u["first"] <= F.col("number")), -1)
    step = F.col("number") - F.col("use.first")
    return numbered.join(F.broadcast(table), "length").withColumn("use", use).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("use.sequence") + F.floor(step / F.col("use.n"))).alias("sequence_id"),
        (F.col("use.place") + step % F.col("use.n") * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []))


def sequences(documents: DataFrame, size: int = SIZE, path: str | None = None) -> DataFrame:
    """sequence_id, n_tokens, ``ids`` and ``parts`` (offset, doc_id, piece) of every sequence;
    a sequence holds at most ``size`` tokens."""
    rows = packed(documents, size, path, with_ids=True)
    gathered = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(
        F.struct("offset", "doc_id", "piece", "ids"))).alias("parts"))
    return gathered.select(
        "sequence_id", F.expr("aggregate(parts, 0, (n, p) -> n + size(p.ids))").alias("n_tokens"),
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["offset"], p["doc_id"], p["piece"])).alias(
            "parts"))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    return packed(documents)
