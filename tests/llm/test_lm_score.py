import math
import random
from collections import Counter

import pytest

from riskpanel.llm import lm_score
from tests.llm.tables import empty_documents, odd_documents, odd_rows, rows_of

LABELS = "doc_id long, quality int, toxic int"


def words_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.decode() for w in text.encode().split()]


def plain(rows, good, share):
    """Losses by the definition."""
    split = [(d, words_of(t), d in good) for d, t in rows]
    n, n_target = Counter(), Counter()
    for _, words, target in split:
        n.update(words)
        n_target.update(words if target else [])
    total = sum(n.values())
    known = {w for w in n if n[w] >= share * total}

    def model(counts, some):
        unigram = Counter()
        for w, c in counts.items():
            unigram[w if w in known else None] += c
        tokens, size = sum(counts.values()), len(known) + 1
        pair = Counter()
        for _, words, target in split:
            if target or not some:
                pair.update(zip([""] + [w if w in known else None for w in words],
                                [w if w in known else None for w in words]))
        pair = {k: c for k, c in pair.items() if c >= share * tokens}
        context = Counter()
        for (h, _), c in pair.items():
            context[h] += c

        def loss(h, w):
            p = (unigram[w] + 1) / (tokens + size)
            return -math.log((pair.get((h, w), 0) + lm_score.MASS * p)
                             / (context[h] + lm_score.MASS))
        return loss

    target, background = model(n_target, True), model(n, False)
    out = []
    for d, words, _ in split:
        named = [w if w in known else None for w in words]
        sums = [sum(m(h, w) for h, w in zip([""] + named, named)) / len(words) if words else None
                for m in (target, background)]
        out.append((d, len(words), *sums))
    return sorted(out, key=repr)


def check(spark, rows, labels, share):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    got = lm_score.score(odd_documents(spark, rows), spark.createDataFrame(labels, LABELS), share)
    have = sorted(((r["doc_id"], r["n_tokens"], r["target_loss"], r["background_loss"])
                   for r in got.collect()), key=repr)
    want = plain([r[:2] for r in rows], good, share)
    assert [h[:2] for h in have] == [w[:2] for w in want]
    for h, w in zip(have, want):
        assert h[2:] == pytest.approx(w[2:]) if w[2] is not None else h[2:] == w[2:]
    for r in got.where("n_tokens > 0").collect():
        assert r["score"] == pytest.approx(r["target_loss"] - r["background_loss"])


@pytest.mark.parametrize("share", [1e-6, 0.01, 0.2])
def test_losses_equal_definitions(spark, share):
    r = random.Random(8)
    rows = [(d, " ".join(r.choices("the a of Cat dog é x1 x2 x3 x4".split(),
                                   weights=[9, 8, 7, 5, 4, 3, 2, 1, 1, 1], k=r.randrange(40))),
             "en", "s", 0) for d in range(80)]
    labels = [(d, d % 2, 0) for d in range(0, 60)] + [(1, 1, 0), (None, 1, 0), (999, 1, 0)]
    check(spark, rows, labels, share)


def test_odd_rows(spark):
    check(spark, odd_rows(), [(5, 1, 0), (9, 0, 0), (9, 1, 1), (None, 1, 0), (3, None, 0)], 1e-6)


def test_no_labels_and_no_documents(spark):
    check(spark, odd_rows(), [(5, 0, 0)], 1e-6)
    labels = spark.createDataFrame([(5, 1, 0)], LABELS)
    assert rows_of(lm_score.score(empty_documents(spark), labels)) == []


def test_target_like_documents_score_lower(spark):
    r = random.Random(9)
    rows = [(d, " ".join(r.choices(["ab", "cd", "ef"] if d % 2 else ["uv", "wx", "yz"], k=50)),
             "en", "s", 0) for d in range(60)]
    labels = [(d, 1, 0) for d in range(1, 30, 2)]
    got = lm_score.score(odd_documents(spark, rows), spark.createDataFrame(labels, LABELS))
    by = {r["doc_id"]: r["score"] for r in got.collect()}
    held_out = [d for d in by if d >= 30]
    assert max(by[d] for d in held_out if d % 2) < min(by[d] for d in held_out if not d % 2)


def test_counts_are_passed_on_when_many(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(lm_score, "HELD", 10)
    counts, out = lm_score.Counts(), []
    for i in range(20):
        keys = np.arange(i, i + 7)
        counts.add(keys, np.ones(7, int), np.zeros(7, int))
        out += list(counts.batches())
        assert counts.size <= 17
    out += list(counts.batches(last=True))
    total = Counter()
    for batch in out:
        total.update(dict(zip(batch["key"].to_pylist(), batch["n"].to_pylist())))
    assert total == Counter(k for i in range(20) for k in range(i, i + 7))


@pytest.mark.parametrize("held", [lm_score.HELD, 7])
def test_every_word_and_bigram_counts(spark, monkeypatch, held):
    monkeypatch.setattr(lm_score, "HELD", held)
    r = random.Random(10)
    rows = [(d, " ".join(r.choices("the a of Cat dog é x1 x2 x3 x4".split(),
                                   weights=[9, 8, 7, 5, 4, 3, 2, 1, 1, 1], k=r.randrange(40))),
             "en", "s", 0) for d in range(80)] + odd_rows()
    check(spark, rows, [(d, d % 2, 0) for d in range(60)], 0)


def test_a_rare_bigram_counts_in_a_corpus_of_over_a_million_tokens(spark):
    few = [(1, "rare pair"), (2, "pair rare")]
    many = [(d, "common " * 20_000) for d in range(10, 71)]
    documents = spark.createDataFrame(few + many, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    want = {d: (t, b) for d, _, t, b in plain(few + many, {1}, 0)}
    for r in lm_score.score(documents, labels).collect():
        assert (r["target_loss"], r["background_loss"]) == pytest.approx(want[r["doc_id"]])
