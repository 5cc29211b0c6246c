import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskpanel.llm import packing
from tests.llm.tables import empty_documents, odd_documents, odd_rows, prose, rows_of


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(packing.default_path())
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def encoder():
    with open(packing.default_path(), encoding="utf-8") as f:
        return packing.Encoder(f.read())


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def plain_pieces(library, rows, size):
    for i, text, *_ in rows:
        ids = ids_of(library, text)
        for n, at in enumerate(range(0, len(ids), size)):
            piece = ids[at:at + size]
            yield i, n, at, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())


def assert_gapless(found, size):
    """Every sequence is filled from 0 without gaps and never beyond its size."""
    by = {}
    for r in found:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


@settings(max_examples=250, deadline=None)
@given(st.text(max_size=60) | st.text("aZé'sĀß <|endofx>\x1c\x85 ́İΣ9-,.", max_size=40))
def test_ids_equal_library(library, encoder, text):
    text = text.encode("utf-8", "replace").decode()
    got = np.frombuffer(encoder.ids(text.encode()), "<u4").tolist()
    assert got == ids_of(library, text)[:-1]


@pytest.mark.parametrize("text", [
    "<|endoftext|>", "A<|endoftext|>b's", "<|ENDOFTEXT|>", "it's IT'S 'sand", "Straße ÉLAN, «x»",
    "12ab3", "áb", "e\x00f", "x" * 500 + " " + "é" * 300, "don't!'", "日本語テキスト", "µ ÿŸ"])
def test_odd_words_equal_library(library, encoder, text):
    for _ in range(2):  # new and remembered
        assert np.frombuffer(encoder.ids(text.encode()), "<u4").tolist() == ids_of(library, text)[:-1]


def test_remembered_words_are_bounded(library, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 50)
    with open(packing.default_path(), encoding="utf-8") as f:
        small = packing.Encoder(f.read())
    for i in range(30):
        text = prose(i, 20)
        assert np.frombuffer(small.ids(text.encode()), "<u4").tolist() == ids_of(library, text)[:-1]
        assert len(small._kept) < 120


@pytest.mark.parametrize("size", [7, 64, 2048])
def test_pieces_and_places(spark, library, size):
    got = packing.packed(odd_documents(spark), size).collect()
    have = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
                   for r in got), key=repr)
    assert have == sorted(plain_pieces(library, odd_rows(), size), key=repr)
    used = assert_gapless(got, size)
    assert used <= -(-sum(r["length"] for r in got) // size) + 1


def test_many_lots_number_a_hot_length_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "LOT", 20)
    rows = [(i, "same text here" if i % 3 else prose(i, i % 50), "en", "x", 0) for i in range(300)]
    rows += [(7, "one row many times", "en", "x", 0)] * 100
    got = packing.packed(odd_documents(spark, rows), 128).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got) >= 400
    used = assert_gapless(got, 128)
    assert used <= -(-sum(r["length"] for r in got) // 128) + 1


def test_sequences_hold_the_pieces(spark, library):
    rows = [(i, prose(i, i * 3 % 90), "en", "x", 0) for i in range(60)]
    whole = {i: ids_of(library, t) for i, t, *_ in rows}
    back = {}
    for r in packing.sequences(odd_documents(spark, rows), 100).collect():
        assert r["n_tokens"] == len(r["ids"]) <= 100
        ends = [p["offset"] for p in r["parts"]][1:] + [r["n_tokens"]]
        for p, end in zip(r["parts"], ends):
            back[p["doc_id"], p["piece"]] = r["ids"][p["offset"]:end]
    for i, ids in whole.items():
        assert sum((back[i, n] for n in range(-(-len(ids) // 100))), []) == ids


def test_empty_table_and_types(spark):
    got = packing.report(empty_documents(spark))
    assert got.collect() == []
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [
        ("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"),
        ("ids_crc32", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), max_size=5), st.integers(0, 30))
def test_fullest_equals_trying_all(left, room):
    used = packing.fullest(left, room)
    assert all(0 < n <= left[k] for k, n in used.items())
    tries = itertools.product(*(range(n + 1) for n in left.values()))
    best = max(s for t in tries if (s := sum(k * n for k, n in zip(left, t))) <= room)
    assert sum(k * n for k, n in used.items()) == best


def one_by_one(count, size):
    """The same search without removing a combination more than once at a time."""
    left, bins = Counter(count), Counter()
    while +left:
        left = +left
        seed = max(left)
        left[seed] -= 1
        used = Counter(packing.fullest({k: n for k, n in left.items() if n}, size - seed))
        left.subtract(used)
        used[seed] += 1
        bins[tuple(sorted(used.items(), reverse=True))] += 1
    return bins


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=12))
def test_removing_at_once_equals_one_by_one(count):
    found = Counter()
    for p in packing.patterns(count, 40):
        found[p.used] += p.times
    assert found == one_by_one(count, 40)


@pytest.mark.parametrize("seed", range(4))
def test_close_to_the_bound(seed):
    r = random.Random(seed)
    count = Counter(min(2048, int(r.lognormvariate(5.5, 1.2)) + 1) for _ in range(30_000))
    found = packing.patterns(count)
    total = sum(k * n for k, n in count.items())
    used = Counter()
    for p in found:
        assert p.filled <= packing.SIZE
        for k, n in p.used:
            used[k] += n * p.times
    assert used == count
    assert sum(p.times for p in found) <= -(-total // packing.SIZE) * 1.001 + 1
    assert len(found) < 3 * packing.SIZE
