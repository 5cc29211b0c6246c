"""Repeated byte strings across documents, by the interval tree of suffix arrays.

Every window of 50 bytes belongs to the smallest hash among its 16-byte groups.
Consecutive windows with one such minimiser travel as a packed string to the
minimiser's bucket, so all occurrences of a window meet there. A bucket drops
strings whose minimiser is in no other string or document, collapses equal
strings to one with a list of occurrences, leaves out bytes under windows that occur
once, and builds an enhanced suffix array of what is left: suffix order by prefix doubling, and common prefixes of
neighbours. A scan with a stack gives the common-prefix intervals of 50 bytes or more.
An interval whose suffixes have different letters before them (or a string's
start) is a maximal repeat; the others say no more than the interval of the same
suffixes one letter longer to the left. Each maximal repeat is reported with all
its occurrences, and every one outside its smallest document is removed.

Defined results: a null or empty text has no bytes; a null doc_id comes after every
other and is never the smaller of two nulls; rows with the same doc_id never
remove bytes from each other; an empty table gives an empty result; other
columns play no part, whatever their names. What is left of a text is cut at
bytes, so it may break a letter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskpanel.llm import substring, texts

LENGTH = 50
MINIMISER = 16
#: Passes over the texts; the packed strings of one take a few times the input's space.
PASSES = 2
#: Suffixes are ordered by 128 bytes; a run has 2 * LENGTH - MINIMISER at most.
LEVELS = (8, 16, 32, 64, 128)


def _words8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at every place as a number whose order is theirs; 0 beyond the end."""
    return _words8_at(data).astype(np.uint64)


def _words8_at(data: np.ndarray) -> np.ndarray:
    """The same as a view that is read where it is asked for."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data), ">u8", padded, strides=(1,))


def _groups(data: np.ndarray) -> np.ndarray:
    """Hashes of all groups of MINIMISER bytes."""
    words = _words8(data)
    groups = _group_hash(words[:-8], words[8:])
    return groups[:len(data) - MINIMISER + 1]


def _group_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return texts.mix(first * texts.FACTORS[0] + second * texts.FACTORS[1])


def minimisers_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The hashes of the groups at some places."""
    words = _words8_at(data)
    return _group_hash(words[places].astype(np.uint64), words[places + 8].astype(np.uint64))


def window_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all windows of LENGTH bytes, across strings too, some CHUNK at a time."""
    out = np.empty(max(len(data) - LENGTH + 1, 0), np.uint64)
    parts = [*range(0, LENGTH - 8, 8), LENGTH - 8]
    for low in range(0, len(out), texts.CHUNK):
        high = min(low + texts.CHUNK, len(out))
        words = _words8(data[low:high + LENGTH])
        total = np.zeros(high - low, np.uint64)
        for k, at in enumerate(parts):
            total += words[at:at + high - low] * texts.FACTORS[k]
        out[low:high] = texts.mix(total)
    return out


def repeated_windows(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The starts of the windows within strings whose hash occurs twice or more.

    ``ends`` is for each place the end of its string. A table of counts by some bits of
    the hashes leaves out nearly all that occur once, a sort of the others the rest.
    """
    count = max(len(data) - LENGTH + 1, 0)
    at = np.flatnonzero(np.arange(count) + LENGTH <= ends[:count])
    hashes = window_hashes(data)[at]
    bits = min(24, max(10, len(at).bit_length() + 2))
    slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    often = np.bincount(slot, minlength=1 << bits)[slot] > 1
    at, hashes = at[often], hashes[often]
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    found = np.zeros(len(at), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return at[found]


def byte_runs(buckets: int, number: int, passes: int):
    """A task's texts as (bucket, packed runs of windows); of the passes, those of one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in texts.parts(batches, most=texts.PART_BYTES // 2):
            heads, documents, copies = substring.class_heads(rows)
            data, offsets = substring.only(data, offsets, heads)
            bounds = texts.Words(np.arange(len(data)), np.arange(len(data)), offsets)
            at = texts.whole_windows(bounds, LENGTH)
            if not len(at):
                continue
            groups = _groups(data)
            place = texts.sliding_minimum(groups, LENGTH - MINIMISER + 1)
            low, high = substring.run_bounds(place[at], at)
            low, high = at[low], at[high]
            minimiser = groups[place[low]]
            lead = place[low] - low  # where the minimiser is in the run
            own = substring.in_pass(minimiser, number, passes)
            low, high, minimiser = low[own], high[own], minimiser[own]
            document = np.searchsorted(offsets, low, "right") - 1
            keys = np.asarray(rows.column("class"))[heads]
            columns = [keys[document], documents[document], copies[document],
                       (low - offsets[document]).astype(np.int32), lead[own].astype(np.uint8)]
            bucket = texts.mix(minimiser) % np.uint64(buckets)
            found = list(substring.packed_runs(bucket, columns, data, low, high + LENGTH - low))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.int32()),
                 texts.binary_array([b for _, b in found])], names=["bucket", "runs"])
    return run


def suffix_order(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of the places of ``data`` by 8 to 128 bytes, for places within strings.

    ``ends`` is for each place the end of its string; bytes behind it count as
    smaller than any byte, and differ from those behind another string's end
    only by how far it is.
    """
    places = np.arange(len(data))
    left = ends - places
    words = _words8(data)
    short = left < 8
    shift = (np.uint64(8) * np.maximum(8 - left, 0).astype(np.uint64))[short]
    words[short] = (words[short] >> shift) << shift
    # a string's end is told from zero bytes by the length that is left
    _, rank = np.unique(words, return_inverse=True)
    rank = rank.astype(np.int64)
    if short.any():
        _, rank = np.unique(rank * 9 + np.minimum(left, 8), return_inverse=True)
        rank = rank.astype(np.int64)
    ranks = [rank]
    for half in LEVELS[:-1]:
        after = np.zeros(len(data), np.int64)
        far = places + half < ends
        after[far] = rank[places[far] + half] + 1
        _, rank = np.unique(rank * (len(data) + 2) + after, return_inverse=True)
        rank = rank.astype(np.int64)
        ranks.append(rank)
    return ranks[-1], ranks


def common_prefix(a: np.ndarray, b: np.ndarray, data: np.ndarray, ends: np.ndarray,
                  ranks: list[np.ndarray]) -> np.ndarray:
    """Bytes that the suffixes at a and b have in common, within their strings."""
    most = np.minimum(ends[a] - a, ends[b] - b)
    out = np.zeros(len(a), np.int64)
    for size, rank in reversed(list(zip(LEVELS, ranks))):
        while True:
            fits = out + size <= most
            x, y = a + np.where(fits, out, 0), b + np.where(fits, out, 0)
            same = fits & (rank[x] == rank[y])
            if not same.any():
                break
            out[same] += size
            if size < LEVELS[-1]:
                break
    for _ in range(LEVELS[0]):
        fits = out < most
        x, y = a + np.where(fits, out, 0), b + np.where(fits, out, 0)
        same = fits & (data[x] == data[y])
        if not same.any():
            break
        out[same] += 1
    return out


def maximal_repeats(order: np.ndarray, shared: np.ndarray, before: np.ndarray,
                    least: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the common-prefix intervals of the suffix array that are
    left-diverse: ``before`` holds each suffix's letter before it, -1 at a string's start.

    ``shared[i]`` is the common prefix of the suffixes i - 1 and i of ``order``. An
    interval is left-diverse if two of its suffixes have different letters before
    them or one is at a string's start.
    """
    letters = before[order]
    # the last place up to i at which the letter changes or is a start
    change = np.ones(len(order), bool)
    change[1:] = (letters[1:] != letters[:-1])
    starts = np.where(letters < 0, np.arange(len(order)), -1)
    last_start = np.maximum.accumulate(starts) if len(starts) else starts
    last_change = np.maximum.accumulate(np.where(change, np.arange(len(order)), 0)) \
        if len(order) else starts
    last_start, last_change = last_start.tolist(), last_change.tolist()
    stack: list[tuple[int, int]] = []  # (common prefix, first)
    common = [*shared[1:].tolist(), 0]
    for i, c in enumerate(common):
        first = i
        while stack and stack[-1][0] > c:
            length, first = stack.pop()
            if last_change[i] > first or last_start[i] >= first:
                yield length, first, i
        if c >= least and (not stack or stack[-1][0] < c):
            stack.append((c, first))


def find_repeats(table: pa.Table) -> pa.Table:
    """The ranges of bytes of a bucket's strings that a smaller document has too."""
    pieces = [texts.unpack(b, np.int64, np.int64, np.bool_, np.int32, np.uint8, np.int32, np.uint8)
              for b in table.column("runs").to_pylist()]
    keys, documents, copies, places, lead, lengths, data = map(np.concatenate, zip(*pieces))
    least, first, copied = substring.smallest_of_classes(keys, documents, copies)
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    # entries whose minimiser is nowhere else hold no repeat
    minimisers = minimisers_at(data, starts + lead)
    _, at, count = np.unique(minimisers, return_inverse=True, return_counts=True)
    entry = np.flatnonzero(count[at] > 1)
    string, strings = _equal_strings(data, starts[entry], lengths[entry])
    # equal windows have equal minimisers: only strings with the same one can share any
    _, at, count = np.unique(minimisers[entry][strings], return_inverse=True, return_counts=True)
    mixed = count[at] > 1
    # per string its smallest document
    owner = np.full(len(strings), texts.NO_ID)
    np.minimum.at(owner, string, least[entry])
    string_length = lengths[entry][strings].astype(np.int64)
    removed = _shared_ranges(data, starts[entry][strings], np.where(mixed, string_length, 0), owner)
    # equal strings repeat as a whole
    whole = np.arange(len(strings))
    what = np.concatenate([removed, np.stack([
        whole, np.zeros(len(whole), np.int64), string_length, owner], 1)])
    # occurrences of each string
    by_string = np.argsort(string, kind="stable")
    count = np.bincount(string, minlength=len(strings))
    begin = np.cumsum(count) - count
    times = count[what[:, 0]]
    row = np.repeat(np.arange(len(what)), times)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    occurrence = entry[by_string[begin[what[row, 0]] + inside]]
    gone = least[occurrence] > what[row, 3]
    row, occurrence = row[gone], occurrence[gone]
    spans = np.unique(np.stack([keys[occurrence], places[occurrence] + what[row, 1],
                                what[row, 2]], 1), axis=0)
    return substring.span_rows(first, copied, *spans.T)


def _shared_ranges(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                   owner: np.ndarray) -> np.ndarray:
    """Rows (string, start, length, smallest owner) of the maximal repeats of the strings.

    Bytes under no window that occurs twice are in no repeat; the suffix array is that of
    the runs of the others. A run's first byte has nothing before it that could be in the
    same repeat.
    """
    text = texts.slices(data, starts, lengths)
    end = np.cumsum(lengths)
    ends = np.repeat(end, lengths)
    at = repeated_windows(text, ends)
    if not len(at):
        return np.zeros((0, 4), np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (ends[at[1:]] != ends[at[:-1]])
    first = at[new]
    size = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] + LENGTH - first
    string = np.searchsorted(end, first, "right")
    offset = first - (end - lengths)[string]
    text = texts.slices(text, first, size)
    run_end = np.cumsum(size)
    run_start = run_end - size
    whose = np.repeat(np.arange(len(size)), size)
    ends = run_end[whose]
    rank, ranks = suffix_order(text, ends)
    order = np.argsort(rank, kind="stable")
    order = order[ends[order] - order >= LENGTH]
    shared = np.zeros(len(order), np.int64)
    shared[1:] = common_prefix(order[:-1], order[1:], text, ends, ranks)
    near = shared >= LENGTH
    near[:-1] |= near[1:]
    order, shared = order[near], shared[near]  # the others are in no interval
    before = np.where(np.arange(len(text)) > run_start[whose],
                      np.concatenate([[0], text[:-1]]).astype(np.int64), -1)
    found = np.array(list(maximal_repeats(order, shared, before)), np.int64).reshape(-1, 3)
    length, low, high = found.T
    times = high - low + 1
    row = np.repeat(np.arange(len(found)), times)
    member = order[np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + low[row]]
    run = whose[member]
    smallest = np.full(len(found), texts.NO_ID)
    np.minimum.at(smallest, row, owner[string[run]])
    return np.stack([string[run], member - run_start[run] + offset[run], length[row],
                     smallest[row]], 1)


def _equal_strings(data: np.ndarray, starts: np.ndarray,
                   lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each string the number of its content, and a string of each content."""
    raw, seen, one = data.tobytes(), {}, []
    out = np.empty(len(starts), np.int64)
    for i, (a, n) in enumerate(zip(starts.tolist(), lengths.tolist())):
        text = raw[a:a + n]
        if text not in seen:
            seen[text] = len(one)
            one.append(i)
        out[i] = seen[text]
    return out, np.array(one, np.int64)


def _kept_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        documents = texts.ids(batch.column("doc_id"))
        out = []
        for row, (text, first, blobs) in enumerate(zip(*(
                batch.column(c).to_pylist() for c in ("text", "first_id", "spans")))):
            raw = (text or "").encode()
            kept, spans = raw, 0
            if first is not None and documents[row] > first:
                kept, spans = b"", int(len(raw) > 0)
            elif blobs:
                gone = texts.covered(*substring.ranges(blobs), len(raw))
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
            out.append((len(raw), len(raw) - len(kept), spans, kept,
                        hashlib.sha256(kept).hexdigest()))
        n, removed, spans, kept, digest = zip(*out) if out else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(kept, pa.binary()),
             pa.array(digest, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that are left), kept_sha256."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return substring.with_spans(documents, byte_runs, find_repeats, PASSES).mapInArrow(
        _kept_bytes, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                     "kept binary, kept_sha256 string")


def report(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents).drop("kept")
