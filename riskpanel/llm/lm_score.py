"""Cross-entropy difference of a target and a background language model.

Both models are bigram models over one vocabulary, smoothed alike: the target's
counts come from the documents labelled good, the background's from all documents.
A document's score is the mean, over its tokens, of the target loss less the
background loss; the lower, the more it is like the target.

Every word and every bigram of the corpus counts, whatever their number. The texts
are cut into parts of some megabytes. A part sends each of its distinct words and bigrams
once, with its own counts, to the bucket of the key's hash; the bucket adds them up and
answers every part with the totals, so no table of counts has to fit anywhere, and a key
is one entry of a part however frequent it is. P(w | h) = (c(h, w) + MASS * p(w)) /
(c(h) + MASS), where c(h) counts the tokens behind h (a word or a text's start) and
p(w) = (c(w) + 1) / (tokens + words + 1), the last one being the unknown word. Keys are
told apart by 62 bits of their hashes.

A caller may pass a ``share``: the vocabulary is then every word that makes up at least
this share of all tokens, the others are the unknown word, and a model keeps the bigrams
that make up as much of its own tokens and leaves the others to the unigram part.

Words are lower-cased in A-Z. Defined results: a null or empty text has no tokens and
null losses; a document labelled more than once is a target if any label is good;
a null doc_id has no label; repeated rows count and are scored one by one; without
labels the target is uniform; an empty table gives an empty result; other columns
play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm import texts

MASS = 100.0
BUCKETS_PER_PARTITION = 8
SMALL_LABELS = 2_000_000  # target ids that may be broadcast (8 bytes each)
HELD = 2_000_000  # counts that a task holds before it passes them on

COUNTS = "key bigint, n bigint, n_target bigint"
SCORES = "n_tokens bigint, target_loss double, background_loss double, score double"
ASKED = "part bigint, bucket int, keys binary, counts binary"
ANSWERS = "part bigint, bucket int, body binary, words bigint, n bigint, n_target bigint"
START = np.uint64(0x5851F42D4C957F2D)  # stands for the word before a text's first
WORD, BIGRAM, STARTS = map(np.uint64, range(3))  # kinds of keys, in their last two bits


class Counts:
    """Counts of 64-bit keys, over all and over target documents."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, keys: np.ndarray, n: np.ndarray, target: np.ndarray) -> None:
        self.held.append((keys, n, target))
        self.size += len(keys)

    def merged(self) -> tuple[np.ndarray, ...]:
        keys, n, target = map(np.concatenate, zip(*self.held))
        distinct, at = np.unique(keys, return_inverse=True)
        sums = [np.bincount(at, x, len(distinct)).astype(np.int64) for x in (n, target)]
        self.held, self.size = [(distinct, *sums)], len(distinct)
        return self.held[0]

    def batches(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """What has to be passed on now."""
        if not self.held or not (last or self.size > HELD):
            return
        arrays = self.merged()
        if last or self.size > HELD // 2:
            self.held, self.size = [], 0
            yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)),
                                             names=["key", "n", "n_target"])


def words_in(batches: Iterator[pa.RecordBatch]):
    """Parts of a task's rows with the hashes of their words (as int64) and the words."""
    for rows, data, offsets in texts.parts(batches):
        data = texts.LOWER[data]
        words = texts.words_of(data, offsets)
        yield rows, texts.word_hashes(data, words).view(np.int64), words


def _counted(keys: np.ndarray, target: np.ndarray):
    distinct, at = np.unique(keys, return_inverse=True)
    return (distinct, np.bincount(at, minlength=len(distinct)),
            np.bincount(at, target, len(distinct)).astype(np.int64))


def _unigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = Counts()
    for rows, hashes, words in words_in(batches):
        target = np.asarray(rows.column("target"))
        counts.add(*_counted(hashes, target[words.document()]))
        yield from counts.batches()
    yield from counts.batches(last=True)


def numbers(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Places of words in the sorted vocabulary, from 1; 0 is the unknown word."""
    if not len(vocabulary):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at + 1, 0)


def bigrams(word: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Key of every token and the token before it; ``size`` stands for a text's start."""
    before = np.empty_like(word)
    before[1:] = word[:-1]
    starts = first[:-1][np.diff(first) > 0]
    before[starts] = size
    return before * (size + 1) + word


def _pairs(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = vocabulary.value, Counts()
        for rows, hashes, words in words_in(batches):
            target = np.asarray(rows.column("target"))
            keys = bigrams(numbers(hashes, known), words.first, len(known) + 1)
            counts.add(*_counted(keys, target[words.document()]))
            yield from counts.batches()
        yield from counts.batches(last=True)
    return run


class Model:
    """One smoothed bigram model; arrays only."""

    def __init__(self, unigrams: np.ndarray, keys: np.ndarray, n: np.ndarray):
        self.size = len(unigrams)  # known words and the unknown one
        self.word = (unigrams + 1) / (unigrams.sum() + self.size)
        self.keys, self.n = keys[n > 0], n[n > 0].astype(float)
        self.context = np.bincount(self.keys // (self.size + 1), self.n, self.size + 1)

    def losses(self, keys: np.ndarray) -> np.ndarray:
        """-log P of each token, by its bigram."""
        before, word = np.divmod(keys, self.size + 1)
        seen = np.zeros(len(keys))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            seen = np.where(self.keys[at] == keys, self.n[at], 0.0)
        return -np.log((seen + MASS * self.word[word]) / (self.context[before] + MASS))


def _summed(counts: DataFrame, share: float):
    """Total counts, the conditions that a key has the share of all tokens or of the target's,
    and both numbers of tokens."""
    total = texts.stored(counts.groupBy("key").agg(F.sum("n").alias("n"),
                                                   F.sum("n_target").alias("n_target")))
    one = [x or 0 for x in total.agg(F.sum("n"), F.sum("n_target")).first()]
    target = (F.col("n_target") > 0) & (F.col("n_target") >= share * one[1])
    return total, F.col("n") >= share * one[0], target, one


def _arrays(table: DataFrame) -> list[np.ndarray]:
    got = table.toArrow().sort_by("key")
    return [np.asarray(got.column(c).combine_chunks()) for c in ("key", "n", "n_target")]


# -- all counts, by bucket -----------------------------------------------------------


def _key(hashes: np.ndarray, kind: np.uint64) -> np.ndarray:
    return (hashes & ~np.uint64(3)) | kind


def _planes(values: np.ndarray) -> np.ndarray:
    """The values' lowest bytes, then their next ones and so on; these compress better."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.ravel()


def _values(planes: np.ndarray, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def _packed_counts(counts: np.ndarray) -> bytes:
    return texts.pack(_planes(counts.ravel()))


def _counts(blob: bytes, kind) -> np.ndarray:
    """Rows of tokens, the target's tokens, and texts that end with the word, both ways."""
    return _values(texts.unpack(blob, np.uint8)[0], kind).reshape(4, -1)


class Tokens:
    """A part's distinct keys with its counts, by bucket, and where each token finds its own."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, target: np.ndarray, buckets: int):
        words = texts.words_of(data, offsets)
        known, word = np.unique(texts.word_hashes(data, words), return_inverse=True)
        self.document, self.size = words.document(), np.diff(words.first)
        full, size = self.size > 0, len(known)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[words.first[:-1][full]] = size
        pairs, pair = np.unique(before * size + word, return_inverse=True)
        named = np.append(known, START)
        keys = np.concatenate([
            _key(known, WORD),
            _key(texts.mix(named[pairs // max(size, 1)] * texts.FACTORS[0]
                           + known[pairs % max(size, 1)] * texts.FACTORS[1]), BIGRAM),
            _key(named[size:], STARTS)[:int(full.any())]])
        last = word[words.first[1:][full] - 1]
        counts = np.zeros((4, len(keys)), np.uint32)
        for i, token, text in ((0, None, None), (1, target[self.document], target[full])):
            counts[i, :size] = np.bincount(word, token, size)
            counts[i, size:size + len(pairs)] = np.bincount(pair, token, len(pairs))
            counts[i, size + len(pairs):] = full.sum() if text is None else text.sum()
            counts[2 + i, :size] = np.bincount(last, text, size)
        order = np.argsort(keys)
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        self.keys, self.counts = keys[order], counts[:, order]
        # buckets are ranges of hashes, so that neighbours differ little
        half = np.uint64(32)
        bucket = ((self.keys >> half) * np.uint64(buckets)) >> half
        self.cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        self.word, self.pair = place[word], place[size + pair]
        self.before = place[np.where(before == size, len(keys) - 1, before)]

    def loss(self, n: np.ndarray, ends: np.ndarray, tokens: int, words: int) -> np.ndarray:
        """-log P of each token by the keys' total counts."""
        p = (n[self.word] + 1) / (tokens + words + 1)
        return -np.log((n[self.pair] + MASS * p) / ((n - ends)[self.before] + MASS))


def _kept_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows as parts: a number, the rows' ids, and the packed lower-case texts."""
    number = TaskContext.get().partitionId() << 32
    for rows, data, offsets in texts.parts(batches):
        body = texts.pack(texts.LOWER[data], offsets, np.asarray(rows.column("target")))
        ids = pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()),
                                       rows.column("doc_id"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), ids, pa.array([body], pa.binary())],
            names=["part", "ids", "body"])
        number += 1


def _tokens(body: bytes, buckets: int) -> Tokens:
    return Tokens(*texts.unpack(body, np.uint8, np.int64, np.bool_), buckets)


def _asked(buckets: int):
    """Per part and bucket the part's keys and counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, body in zip(batch["part"].to_pylist(), batch["body"]):
                own = _tokens(body.as_py(), buckets)
                full = np.flatnonzero(np.diff(own.cuts))
                ranges = [slice(own.cuts[b], own.cuts[b + 1]) for b in full]
                keys = [texts.pack(_planes(np.diff(own.keys[r], prepend=np.uint64(0))))
                        for r in ranges]
                counts = [_packed_counts(own.counts[:, r]) for r in ranges]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(full), pa.int64()), pa.array(full, pa.int32()),
                     texts.binary_array(keys), texts.binary_array(counts)],
                    names=["part", "bucket", "keys", "counts"])
    return run


def _answered(table: pa.Table) -> pa.Table:
    """Each part's keys of a bucket with their totals, and the bucket's words and tokens."""
    asked = [np.cumsum(_values(texts.unpack(b.as_py(), np.uint8)[0], np.uint64))
             for b in table.column("keys")]
    counts = [_counts(b.as_py(), np.uint32) for b in table.column("counts")]
    out = [[] for _ in asked]
    # ranges of the sorted keys, so that a few million are held at once
    steps = max(1, sum(map(len, asked)) // HELD)
    low, high = int(min(k[0] for k in asked)), int(max(k[-1] for k in asked)) + 1
    bounds = np.array([low + i * (high - low) // steps for i in range(1, steps)], np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(k, bounds), [len(k)]]).astype(np.int64)
            for k in asked]
    sums = np.zeros(3, np.int64)
    for i in range(steps):
        keys = np.concatenate([k[x[i]:x[i + 1]] for k, x in zip(asked, cuts)])
        own = np.concatenate([c[:, x[i]:x[i + 1]] for c, x in zip(counts, cuts)], axis=1)
        distinct, at = np.unique(keys, return_inverse=True)
        total = np.array([np.bincount(at, c, len(distinct)) for c in own]).astype(np.int64)
        words = (distinct & np.uint64(3)) == WORD
        sums += [words.sum(), *total[:2, words].sum(axis=1)]
        ends = np.cumsum([x[i + 1] - x[i] for x in cuts])[:-1]
        for answer, places in zip(out, np.split(at, ends)):
            answer.append(total[:, places])
    bodies = [_packed_counts(np.concatenate(answer, axis=1)) for answer in out]
    size = len(bodies)
    return pa.table({
        "part": pa.array([*table.column("part").to_pylist(), None], pa.int64()),
        "bucket": pa.array([*table.column("bucket").to_pylist(), -1], pa.int32()),
        "body": pa.array([*bodies, None], pa.binary()),
        **{name: pa.array([None] * size + [int(x)], pa.int64())
           for name, x in zip(("words", "n", "n_target"), sums)}})


def _judged(buckets: int, words: int, n: int, n_target: int):
    """Scores of a part's rows by its texts (bucket -1) and the buckets' answers."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        own = _tokens(table.column("body")[0].as_py(), buckets)
        totals = np.concatenate([np.zeros((4, 0), np.int64), *(
            _counts(b.as_py(), np.int64) for b in table.column("body")[1:])], axis=1)
        if totals.shape[1] != len(own.keys):
            raise ValueError("a part's counts are incomplete")
        sums = [np.bincount(own.document, own.loss(totals[i], totals[2 + i], tokens, words),
                            len(own.size)) for i, tokens in ((1, n_target), (0, n))]
        ids = table.column("ids")[0].values
        return pa.Table.from_batches([_scores(ids, own.size, sums)])
    return run


def _scores(ids: pa.Array, size: np.ndarray, sums: list[np.ndarray]) -> pa.RecordBatch:
    empty = size == 0
    means = [np.where(empty, 0, s / np.maximum(size, 1)) for s in sums]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(size, pa.int64()),
         *(pa.array(m, pa.float64(), mask=empty) for m in (*means, means[0] - means[1]))],
        names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])


def score(documents: DataFrame, labels: DataFrame, share: float = 0.0) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (per token) and their difference."""
    spark = documents.sparkSession
    texts.workers_find_package(spark)
    good = texts.stored(labels.where("quality = 1 and doc_id is not null")
                        .select(F.col("doc_id").alias("good_id")).distinct())
    good = F.broadcast(good) if good.count() <= SMALL_LABELS else good
    rows = (documents.select("doc_id", "text")
            .join(good, F.col("doc_id") == F.col("good_id"), "left")
            .select("doc_id", "text", F.col("good_id").isNotNull().alias("target")))
    if share > 0:
        return _pruned(documents, rows.select("text", "target"), share)
    kind = documents.schema["doc_id"].dataType.simpleString()
    buckets = BUCKETS_PER_PARTITION * texts.partitions(spark)
    parts = texts.stored(rows.mapInArrow(
        _kept_parts, f"part bigint, ids array<{kind}>, body binary"))
    answers = texts.stored(parts.select("part", "body").mapInArrow(_asked(buckets), ASKED)
                           .groupBy("bucket").applyInArrow(_answered, ANSWERS))
    texts.let_go(spark)
    sums = [x or 0 for x in answers.agg(*map(F.sum, ("words", "n", "n_target"))).first()]
    both = parts.select("part", F.lit(-1).alias("bucket"), "ids", "body").unionByName(
        answers.where("part is not null").select("part", "bucket", "body"),
        allowMissingColumns=True)
    return both.groupBy("part").applyInArrow(_judged(buckets, *sums),
                                             f"doc_id {kind}, {SCORES}")


def _pruned(documents: DataFrame, rows: DataFrame, share: float) -> DataFrame:
    """``score`` by the words and bigrams that have the share, sent to every task."""
    spark = documents.sparkSession
    total, often, _, one = _summed(rows.mapInArrow(_unigrams, COUNTS), share)
    known, n, n_target = _arrays(total.where(often))
    unknown = [one[0] - n.sum(), one[1] - n_target.sum()]
    vocabulary = spark.sparkContext.broadcast(known)

    total, often, often_target, two = _summed(rows.mapInArrow(_pairs(vocabulary), COUNTS), share)
    keys, pair, pair_target = _arrays(total.where(often | often_target))
    least = share * two[0], share * two[1]
    models = spark.sparkContext.broadcast((
        Model(np.append(unknown[1], n_target), keys, np.where(pair_target >= least[1],
                                                              pair_target, 0)),
        Model(np.append(unknown[0], n), keys, np.where(pair >= least[0], pair, 0))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_known = vocabulary.value
        target, background = models.value
        for part, hashes, words in words_in(batches):
            keys = bigrams(numbers(hashes, words_known), words.first, len(words_known) + 1)
            document, size = words.document(), np.diff(words.first)
            sums = [np.bincount(document, m.losses(keys), len(size))
                    for m in (target, background)]
            yield _scores(part.column("doc_id"), size, sums)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {SCORES}")
