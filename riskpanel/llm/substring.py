"""Repeated passages across documents, by packed runs of windows (super-k-mers).

Every window of 13 words belongs to the smallest hash among its 3-word groups, its
minimiser. Consecutive windows with the same minimiser travel as one packed
string to the minimiser's bucket, so all occurrences of a window meet in one
bucket. There the windows are sorted and each run of equal windows is compared
word by word; every occurrence outside the smallest document is reported.

Copies of a whole text count as one class. Inside a part of a scan they collapse
before the shuffle, and a bucket sees one entry per part however many copies
there are. Class and document number together name a text.

Defined results: a null or empty text has no windows; a null doc_id comes after
every other and is never the smaller of two nulls; rows with the same doc_id
never remove words from each other; an empty table gives an empty result; other
columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm import texts

WINDOW = 13
MINIMISER = 3
BUCKETS_PER_PARTITION = 8
SPANS = "class bigint, first_id bigint, spans binary"


def class_heads(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the rows of a part: the row that stands for each class, its smallest
    document, and whether the class has more than one document here."""
    keys, documents = np.asarray(rows.column("class")), texts.ids(rows.column("doc_id"))
    order = np.lexsort((documents, keys))
    new = np.ones(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    last = documents[order][np.append(np.flatnonzero(new)[1:], len(order)) - 1]
    return order[new], documents[order[new]], last != documents[order[new]]


def only(data: np.ndarray, offsets: np.ndarray, rows: np.ndarray):
    """Bytes and offsets of some of the rows."""
    lengths = np.diff(offsets)[rows]
    return (texts.slices(data, offsets[:-1][rows], lengths),
            np.concatenate([[0], np.cumsum(lengths)]))


def packed_runs(bucket: np.ndarray, columns: list[np.ndarray], data: np.ndarray,
                starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """One packed string per bucket: the columns, lengths and bytes of its runs."""
    order = np.argsort(bucket, kind="stable")
    bucket, lengths = bucket[order], lengths[order]
    columns = [c[order] for c in columns]
    payload = texts.slices(data, starts[order], lengths)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(bucket[a]), texts.pack(*(c[a:b] for c in columns), lengths[a:b].astype(np.int32),
                                         payload[ends[a]:ends[b]])


def run_bounds(place: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (index into ``at``) of the runs of consecutive windows with one minimiser."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1])
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(at)) - 1


def in_pass(minimisers: np.ndarray, number: int, passes: int) -> np.ndarray:
    return (texts.mix(minimisers) >> np.uint64(40)) % np.uint64(passes) == number


def word_runs(buckets: int, number: int, passes: int):
    """A task's texts as (bucket, packed runs); of several passes, those of one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in texts.parts(batches):
            heads, documents, copies = class_heads(rows)
            data, offsets = only(data, offsets, heads)
            raw = data.tobytes()
            plain = [raw[a:b].split() for a, b in zip(offsets[:-1], offsets[1:])]
            raw = b" ".join(w for words in plain for w in words)
            first = np.concatenate([[0], np.cumsum([len(w) for w in plain])]).astype(np.int64)
            data = np.frombuffer(raw, np.uint8)
            words = texts.words_of(data, np.array([0, len(data)], np.int64))
            words.first = first
            at = texts.whole_windows(words, WINDOW)
            if not len(at):
                continue
            hashes = texts.word_hashes(data, words)
            groups = texts.window_hashes(hashes, MINIMISER)
            place = texts.sliding_minimum(groups, WINDOW - MINIMISER + 1)
            low, high = run_bounds(place[at], at)
            low, high = at[low], at[high]
            own = in_pass(groups[place[low]], number, passes)
            low, high = low[own], high[own]
            document = words.document()[low]
            begin, end = words.starts[low], words.ends[high + WINDOW - 1]
            keys = np.asarray(rows.column("class"))[heads]
            columns = [keys[document], documents[document], copies[document],
                       (low - first[document]).astype(np.int32)]
            found = list(packed_runs(texts.mix(groups[place[low]]) % np.uint64(buckets), columns, data,
                                     begin, end - begin))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.int32()),
                 texts.binary_array([b for _, b in found])], names=["bucket", "runs"])
    return run


def span_rows(first: dict[int, int], copied: set[int], keys: np.ndarray, starts: np.ndarray,
              lengths: np.ndarray) -> pa.Table:
    """Rows of SPANS: for each class its smallest document and the ranges found here.

    A class without ranges is reported too if it has copies, as these must know
    their smallest document.
    """
    order = np.lexsort((starts, keys))
    keys, starts, lengths = keys[order], starts[order], lengths[order]
    cuts = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys)
                     else np.zeros(0, np.int64), len(keys))
    out = {k: b"" for k in copied}
    for a, b in zip(cuts[:-1], cuts[1:]):
        out[int(keys[a])] = np.stack([starts[a:b], lengths[a:b]], 1).astype(np.int32).tobytes()
    return pa.table({"class": pa.array(list(out), pa.int64()),
                     "first_id": pa.array([first[k] for k in out], pa.int64()),
                     "spans": texts.binary_array(list(out.values()))})


def smallest_of_classes(keys: np.ndarray, documents: np.ndarray, copies: np.ndarray):
    """Per entry the class's smallest document; the same by class; classes with copies."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    least = np.full(len(distinct), texts.NO_ID)
    np.minimum.at(least, inverse, documents)
    first = dict(zip(distinct.tolist(), least.tolist()))
    copied = set(keys[copies | (documents != least[inverse])].tolist())
    return least[inverse], first, copied


def joined_runs(windows: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Sorted (class, window start) as ranges: class, start and length of consecutive ones."""
    if not len(windows):
        return (np.zeros(0, np.int64),) * 3
    new = np.ones(len(windows), bool)
    new[1:] = (windows[1:, 0] != windows[:-1, 0]) | (windows[1:, 1] != windows[:-1, 1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    return windows[first, 0], windows[first, 1], windows[last, 1] - windows[first, 1] + width


def count_windows(table: pa.Table) -> pa.Table:
    """The ranges of words in a bucket's windows that a smaller document has too."""
    pieces = [texts.unpack(b, np.int64, np.int64, np.bool_, np.int32, np.int32, np.uint8)
              for b in table.column("runs").to_pylist()]
    keys, documents, copies, places, lengths, data = map(np.concatenate, zip(*pieces))
    least, first, copied = smallest_of_classes(keys, documents, copies)
    words = texts.words_of(data, np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]))
    hashes = texts.word_hashes(data, words)
    at = texts.whole_windows(words, WINDOW)
    entry = words.document()[at]
    sorted_by = texts.window_hashes(hashes, WINDOW)[at]
    order = np.lexsort((least[entry], sorted_by))
    at, entry, sorted_by = at[order], entry[order], sorted_by[order]
    new = np.ones(len(at), bool)
    new[1:] = sorted_by[1:] != sorted_by[:-1]
    leader = np.flatnonzero(new)[np.cumsum(new) - 1]
    differs = np.zeros(len(at), bool)
    follow = np.flatnonzero(~new)
    for j in range(WINDOW):
        differs[follow] |= hashes[at[follow] + j] != hashes[at[leader[follow]] + j]
    if differs.any():  # equal hashes of different windows: name the leaders by their words
        leader = _exact_leaders(data, words, at, leader)
    found = least[entry] > least[entry[leader]]
    at, entry = at[found], entry[found]
    windows = np.stack([keys[entry], places[entry] + at - words.first[entry]], 1)
    windows = np.unique(windows, axis=0) if len(windows) else windows
    return span_rows(first, copied, *joined_runs(windows, WINDOW))


def _exact_leaders(data, words, at, leader):
    raw, seen, out = data.tobytes(), {}, leader.copy()
    for i, (w, group) in enumerate(zip(at.tolist(), leader.tolist())):
        key = group, b" ".join(raw[words.starts[k]:words.ends[k]] for k in range(w, w + WINDOW))
        out[i] = seen.setdefault(key, i)
    return out


def with_spans(documents: DataFrame, map_runs, judge_bucket, passes: int = 1) -> DataFrame:
    """doc_id and text of every row with ``first_id`` and the ranges of its class.

    ``first_id`` is null where nothing of the class is found elsewhere. Each pass
    deals with its share of the minimisers, so that only this share of the packed
    strings is on disk at a time.
    """
    spark = documents.sparkSession
    texts.workers_find_package(spark)
    rows = documents.select("doc_id", "text").withColumn("class", texts.text_key(F.col("text")))
    buckets = max(1, BUCKETS_PER_PARTITION * texts.partitions(spark) // passes)
    found = None
    for number in range(passes):
        part = (rows.mapInArrow(map_runs(buckets, number, passes), "bucket int, runs binary")
                .groupBy("bucket").applyInArrow(judge_bucket, SPANS))
        if passes > 1:
            part = texts.stored(part)
            texts.let_go(spark)
        found = part if found is None else found.unionByName(part)
    spans = texts.stored(found.groupBy(F.col("class").alias("same")).agg(
        F.min("first_id").alias("first_id"), F.collect_list("spans").alias("spans")))
    return rows.join(spans, rows["class"] == spans["same"], "left").drop("same", "class")


def ranges(blobs) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(blobs or []), np.int32).reshape(-1, 2).astype(np.int64)
    return pairs[:, 0], pairs[:, 1]


def _kept_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        documents = texts.ids(batch.column("doc_id"))
        out = []
        for row, (text, first, blobs) in enumerate(zip(*(
                batch.column(c).to_pylist() for c in ("text", "first_id", "spans")))):
            words = (text or "").encode().split()
            kept = words
            if first is not None and documents[row] > first:
                kept = []
            elif blobs:
                gone = texts.covered(*ranges(blobs), len(words))
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
            kept_text = b" ".join(kept)
            out.append((len(words), len(words) - len(kept), kept_text.decode(),
                        hashlib.sha256(kept_text).hexdigest()))
        n, removed, kept, digest = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.string()), pa.array(digest, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])


def remove_repeated_windows(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the text that is left) and its kept_sha256."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return with_spans(documents, word_runs, count_windows).mapInArrow(
        _kept_words, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string, "
                     "kept_sha256 string")


def substring_report(documents: DataFrame) -> DataFrame:
    return remove_repeated_windows(documents).drop("kept")


def report_sql() -> str:
    """DuckDB SQL for ``substring_report``."""
    return rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT r, doc_id, i, array_to_string(list_slice(ws, i, i + {WINDOW - 1}), ' ') AS k
  FROM (SELECT r, doc_id, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS i
        FROM d WHERE len(ws) >= {WINDOW})),
least AS (SELECT k, min(doc_id) AS low FROM win GROUP BY k HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, p FROM (
    SELECT r, unnest(generate_series(i, i + {WINDOW - 1})) AS p
    FROM win JOIN least USING (k) WHERE doc_id > low)),
word AS (SELECT r, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS p FROM d),
kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n
  FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
