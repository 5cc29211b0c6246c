"""BPE encoding and decoding by speculation and verification.

Each distinct word is first cut greedily into the longest tokens. A cut is the
word's encoding exactly if every adjacent pair of tokens is compatible, that is
if merging would not join anything across the border of the two. All pairs of
a batch are tested at once with arrays; only words with a failing pair are merged
pair by pair.

The vocabulary is a public tokenizer file (``path``) of kind BPE with word ends,
where a token's number follows the order of the merges. Texts are brought to NFC and
lower case and split into contractions, letter runs, single digits and symbol
runs; white space goes. The strings of the added tokens are tokens of their own.

Defined results: a null or empty text, or one of white space only, has no tokens;
repeated rows are encoded one by one; an empty table gives an empty result; other
columns are kept (``encode``, ``decode``) or play no part (``digests``).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from riskpanel.llm import texts

VOCABULARY = "word_bpe_49k.json"
END = "</w>"
#: Words kept with their tokens in a Python worker, in two halves; the older one goes first.
KEPT_WORDS = 300_000
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Encoder:
    """The vocabulary's tables. ``whole`` lists the tokens that encode to themselves."""

    def __init__(self, file: str, whole: np.ndarray | None = None):
        spec = json.loads(file)
        model = spec["model"]
        self.number: dict[str, int] = dict(model["vocab"])
        for added in spec["added_tokens"]:
            self.number[added["content"]] = added["id"]
        self.tokens = [""] * (max(self.number.values()) + 1)
        for token, n in self.number.items():
            self.tokens[n] = token
        size = len(self.tokens)
        self.left, self.right = np.arange(size), np.arange(size)
        self.merge: dict[tuple[int, int], int] = {}
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, joined = self.number[a], self.number[b], self.number[a + b]
            self.merge[x, y] = joined
            self.left[joined], self.right[joined] = x, y
        keys = np.array([(x << 32) + y for x, y in self.merge], np.int64)
        order = np.argsort(keys)
        self._pairs = keys[order]
        self._joined = np.array(list(self.merge.values()), np.int64)[order]
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        added = sorted((a["content"] for a in spec["added_tokens"]), key=len, reverse=True)
        self.added = set(added)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, added)) + ")")
        self._hint = added[0][0] if added else None
        self._kept: dict[str, tuple[bytes, bytes]] = {}
        self._older: dict[str, tuple[bytes, bytes]] = {}
        base = [n for n in model["vocab"].values() if self.left[n] == n]
        if whole is None:
            whole = np.array(sorted([*base, *(
                n for n in set(self.merge.values())
                if self.merged(self.symbols(n)) == [n])]), np.int64)
        self.whole = whole
        self._usable = {self.tokens[n]: n for n in whole.tolist()}
        self._longest = max(map(len, self._usable), default=1)

    def symbols(self, token: int) -> list[int]:
        """The single letters that a token is merged from."""
        out, todo = [], [token]
        while todo:
            n = todo.pop()
            if self.left[n] == n:
                out.append(n)
            else:
                todo += [int(self.right[n]), int(self.left[n])]
        return out

    # -- one word -----------------------------------------------------------------

    def merged(self, symbols: list[int]) -> list[int]:
        """Exact merging: the earliest merge first, the leftmost of equals."""
        if len(symbols) < 2:
            return list(symbols)
        at, merge = list(symbols), self.merge
        size = len(at)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(merge[p], i) for i, p in enumerate(zip(at, at[1:])) if p in merge]
        heapq.heapify(heap)
        while heap:
            joined, i = heapq.heappop(heap)
            j = after[i] if at[i] >= 0 else size
            if j >= size or merge.get((at[i], at[j])) != joined:
                continue
            at[i], at[j] = joined, -1
            after[i] = k = after[j]
            if k < size:
                before[k] = i
                if (at[i], at[k]) in merge:
                    heapq.heappush(heap, (merge[at[i], at[k]], i))
            h = before[i]
            if h >= 0 and (at[h], at[i]) in merge:
                heapq.heappush(heap, (merge[at[h], at[i]], h))
        return [n for n in at if n >= 0]

    def proposed(self, word: str) -> list[int]:
        """The greedy cut of a word (in the vocabulary's letters, with its end)."""
        usable, out, i, size = self._usable, [], 0, len(word) - len(END)
        while i < size:
            j = min(size, i + self._longest)
            while True:
                piece = word[i:] if j == size else word[i:j]
                if piece in usable:
                    out.append(usable[piece])
                    break
                j -= 1
            i = j
        return out

    # -- all words of a batch --------------------------------------------------------

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair merges to; the largest number if none."""
        keys = (a << 32) + b
        at = np.minimum(np.searchsorted(self._pairs, keys), len(self._pairs) - 1)
        return np.where(self._pairs[at] == keys, self._joined[at], np.iinfo(np.int64).max)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the letters of a and b together gives a, b again.

        Walks back in time: the later made of the two tokens at the border is undone,
        and no pair at the border may have merged before that.
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            bad = self.joined(a, b) < limit
            good[live[bad]] = False
            undo_a = a > b
            part_a, part_b = self.right[a], self.left[b]
            whole_a, whole_b = part_a == a, part_b == b
            undo_a = (undo_a & ~whole_a) | (~undo_a & whole_b & ~whole_a)
            undo_b = ~undo_a & ~whole_b
            limit = np.where(undo_a, a, np.where(undo_b, b + 1, limit))
            a, b = np.where(undo_a, part_a, a), np.where(undo_b, part_b, b)
            go = ~bad & (undo_a | undo_b)
            live, a, b, limit = live[go], a[go], b[go], limit[go]
        return good

    def learn(self, words: set[str]) -> None:
        """Adds the tokens of new words to the kept ones."""
        plain = list(words)
        spelled = [w.encode().decode("latin-1").translate(self.letters) + END for w in plain]
        cuts = [self.proposed(w) for w in spelled]
        flat = np.array([n for cut in cuts for n in cut], np.int64)
        word = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
        inner = word[1:] == word[:-1]
        pairs = np.unique((flat[:-1][inner] << 32) + flat[1:][inner])
        bad = pairs[~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)]
        failing = np.zeros(len(flat), bool)
        failing[1:] = inner & np.isin((flat[:-1] << 32) + flat[1:], bad)
        for w in np.unique(word[failing]).tolist():
            s = spelled[w][:-len(END)]
            cuts[w] = self.merged([self.number[c] for c in s[:-1]] + [self.number[s[-1] + END]])
        for w, cut in zip(plain, cuts):
            self._kept[w] = (" ".join(map(str, cut)).encode(), self.decoded(cut).encode())

    def decoded(self, numbers) -> str:
        """The decoding of a file without decoder: the tokens with spaces between."""
        return " ".join([self.tokens[n] for n in numbers])

    def words(self, text: str) -> list[str]:
        pieces = self._cut.split(text) if self._hint and self._hint in text else [text]
        out = []
        for piece in pieces:
            if piece in self.added:
                out.append(piece)
            else:
                # one letter at a time, so that a last sigma is no special case
                plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
                out += SPLIT.findall(plain)
        return out

    def encoded(self, batch: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Per text its token numbers and its decoded text, as bytes. The new words of all texts
        are learned together."""
        split = [self.words(text) for text in batch]
        every = set().union(*split)
        new = every.difference(self._kept)
        if len(self._kept) + len(new) > KEPT_WORDS // 2:
            self._older, self._kept, new = self._kept, {}, every
        kept, older = self._kept, self._older
        for w in new & older.keys():
            kept[w] = older[w]
        new = new.difference(kept, self.added)
        if new:
            self.learn(new)
        for special in self.added & every:
            n = self.number[special]
            kept[special] = (str(n).encode(), self.decoded([n]).encode())
        for words in split:
            pairs = [kept[w] for w in words]
            yield b" ".join([p[0] for p in pairs]), b" ".join([p[1] for p in pairs])


_encoders: dict[str, Encoder] = {}


def _encoder(file: str, whole: np.ndarray) -> Encoder:
    """The worker's encoder; its tables and kept words outlive a task."""
    key = hashlib.sha256(file.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(file, whole)
    return _encoders[key]


def _shared(spark: SparkSession, path: str | None):
    """The vocabulary file (a few MB, whatever the input) for all tasks."""
    texts.workers_find_package(spark)
    with open(path or default_path(), encoding="utf-8") as f:
        file = f.read()
    return spark.sparkContext.broadcast((file, Encoder(file).whole))


def digests(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text."""
    shared = _shared(documents.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*shared.value)
        for rows, _, _ in texts.parts(batches):
            out = [(n.count(b" ") + 1 if n else 0, hashlib.sha256(n).hexdigest(),
                    hashlib.sha256(d).hexdigest())
                   for n, d in encoder.encoded([t or "" for t in rows.column("text").to_pylist()])]
            count, numbers, decoded = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(count, pa.int64()), pa.array(numbers),
                 pa.array(decoded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode(table: DataFrame, text: str = "text", to: str = "ids",
           path: str | None = None) -> DataFrame:
    """The table with a column ``to`` of token numbers."""
    shared = _shared(table.sparkSession, path)
    hidden = texts.fresh("__text", table.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*shared.value)
        for rows, _, _ in texts.parts(batches, hidden):
            found = [np.array(n.split(), np.int32) for n, _ in
                     encoder.encoded([t or "" for t in rows.column(hidden).to_pylist()])]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], pa.array(found, pa.list_(pa.int32()))],
                names=[*rows.schema.names[:-1], to])

    return table.withColumn(hidden, table[text]).mapInArrow(
        run, texts.with_fields(table.schema, (to, "array<int>")))


def decode(table: DataFrame, ids: str = "ids", to: str = "decoded",
           path: str | None = None) -> DataFrame:
    """The table with a column ``to``: the decoded text of token numbers, null as none."""
    shared = _shared(table.sparkSession, path)
    hidden = texts.fresh("__ids", table.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*shared.value)
        for rows in batches:
            found = [encoder.decoded(n or []) for n in rows.column(hidden).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(found, pa.string())],
                                             names=[*rows.schema.names[:-1], to])

    return table.withColumn(hidden, table[ids]).mapInArrow(
        run, texts.with_fields(table.schema, (to, "string")))
