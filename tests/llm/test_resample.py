import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskpanel.llm import resample
from tests.llm.tables import empty_documents, odd_documents, odd_rows, prose, rows_of

TARGET = [(1, prose(1)), (2, None), (3, "Alpha 1 beta-2 " * 30), (3, ""), (None, prose(50, 80))]


def target_of(spark, rows=TARGET):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, bucket string")


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_rows(rows, target, share=10, least=20, size=10000):
    """The whole result from its definition; ties of whole keys take the first ranks."""
    def counts(all_texts):
        return Counter(zlib.crc32(w.encode()) % size for t in all_texts for w in plain_words(t))

    s, t = counts(r[1] for r in rows), counts(r[1] for r in target)
    of, to = sum(s.values()), sum(t.values())
    out = []
    for i, text, *_ in rows:
        got = [math.floor(1000 * math.log((t[b] + 1) * (of + size) / ((s[b] + 1) * (to + size))))
               for b in (zlib.crc32(w.encode()) % size for w in plain_words(text))]
        weight = sum(got) // len(got) if got else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(got), weight, score, None])
    able = sorted((r for r in out if r[1] >= least),
                  key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for rank, r in enumerate(able[:share * len(able) // 100], 1):
        r[4] = rank
    return sorted([(r[0], r[1], r[4], r[3], r[2]) for r in out], key=repr)


@pytest.mark.parametrize("share", [0, 10, 35, 50, 100])
def test_equals_definition(spark, share):
    rows = odd_rows() + [(100 + i, prose(i, 15 + i % 90), "en", "x", 0) for i in range(150)]
    got = resample.resampled(odd_documents(spark, rows), target_of(spark), share=share)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows_of(got) == plain_rows(rows, TARGET, share)


def test_ranges_number_like_one_sort(spark, monkeypatch):
    monkeypatch.setattr(resample, "RANGE_ROWS", 7)
    monkeypatch.setattr(resample, "KEYS", 5)
    rows = [(i, prose(i % 9, 30), "en", "x", 0) for i in range(120)]
    got = resample.resampled(odd_documents(spark, rows), target_of(spark), share=40)
    assert rows_of(got) == plain_rows(rows, TARGET, 40)


def test_equal_keys_at_the_cutoff_fill_the_room(spark):
    rows = [(7, prose(3, 30), "en", "x", 0)] * 10
    ranks = [r["rank"] for r in resample.resampled(odd_documents(spark, rows), target_of(spark),
                                                   share=30).collect()]
    assert sorted(r for r in ranks if r) == [1, 2, 3]


def test_empty_tables(spark):
    assert resample.resampled(empty_documents(spark), target_of(spark)).collect() == []
    rows = odd_rows()
    got = resample.resampled(odd_documents(spark), target_of(spark, []))
    assert rows_of(got) == plain_rows(rows, [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=90), max_size=12))
def test_buckets_equal_library(found):
    raw = [t.encode("utf-8", "replace") for t in found]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0, *map(len, raw)])
    got, first = resample.buckets_of(data, offsets, 997)
    words = [plain_words(r.decode()) for r in raw]
    assert np.diff(first).tolist() == [len(w) for w in words]
    assert got.tolist() == [zlib.crc32(x.encode()) % 997 for w in words for x in w]


@pytest.mark.parametrize("length", [1, 63, 64, 65, 300])
def test_long_words(length):
    data = np.frombuffer((b"ab9" * length)[:length] + b" x", np.uint8)
    got, _ = resample.buckets_of(data, np.array([0, len(data)]), 10000)
    assert got.tolist() == [zlib.crc32(data[:length].tobytes()) % 10000, zlib.crc32(b"x") % 10000]


@pytest.mark.parametrize("k", [1, 2, 500, 999, 1000])
def test_every_round_discards_a_quarter(spark, k):
    r = np.random.default_rng(k)
    # tasks of very different sizes, a third of the keys the same
    keys = [(int(a) if i % 3 else 0, int(i if i % 3 else 5)) for i, a in
            enumerate(r.integers(-400, 400, 1000))]
    pieces = [keys[:700], keys[700:720], keys[720:990], keys[990:]]
    df = spark.createDataFrame([(a, b) for a, b in pieces[0]], "a long, b long").coalesce(1)
    for p in pieces[1:]:
        df = df.union(spark.createDataFrame(p, "a long, b long").coalesce(1))
    found, rounds = resample.cutoff(resample.sorted_keys(df), k)
    assert found == sorted(keys)[k - 1]
    assert all(4 * gone >= remained for remained, gone in rounds)
    assert len(rounds) <= math.log(1000) / math.log(4 / 3) + 2
