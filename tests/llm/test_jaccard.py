import random
import re

import numpy as np
import pytest

from riskpanel.llm import jaccard
from tests.llm.tables import empty_documents, odd_documents, odd_rows, rows_of


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def plain(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(rows[i][0])
    out = []
    for i, (d, _) in enumerate(rows):
        known = [m for m in members[root(i)] if m is not None]
        out.append((d, len(sets[i]), min(known) if known else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"])
                   for r in jaccard.report(df).collect()), key=repr)


def edited(words, r, share):
    return [r.choice(["x", "y", f"e{r.randrange(10 ** 6)}"]) if r.random() < share else w
            for w in words]


def family_rows(seed):
    """Groups of near copies about the threshold, common passages, short texts."""
    r = random.Random(seed)
    common = [f"c{i}" for i in range(50)]
    rows = []
    for g in range(8):
        base = [f"g{g}w{r.randrange(400)}" for _ in range(r.choice([6, 12, 30, 90, 700]))]
        for _ in range(r.choice([2, 5, 30])):
            words = edited(base, r, r.choice([0, .005, .02, .03, .05, .06]))
            if r.random() < .3:
                at = r.randrange(len(words))
                words[at:at] = common[:r.randrange(50)]
            rows.append(words)
    rows += [r.choices(["a", "b", "c"], k=r.randrange(1, 9)) for _ in range(60)]
    r.shuffle(rows)
    return [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies(spark, seed):
    rows = family_rows(seed)
    assert got(odd_documents(spark, rows)) == plain([r[:2] for r in rows])


def test_many_frequent_shingles(spark, monkeypatch):
    """All shingles count as frequent, so that only pairs are indexed."""
    monkeypatch.setattr(jaccard, "RARE", 0)
    rows = family_rows(3)
    assert got(odd_documents(spark, rows)) == plain([r[:2] for r in rows])


def test_pair_by_pair_when_pivots_do_not_settle_a_key(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    rows = family_rows(4)
    assert got(odd_documents(spark, rows)) == plain([r[:2] for r in rows])


def test_many_rounds_of_pivots(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 6)
    rows = family_rows(5)
    assert got(odd_documents(spark, rows)) == plain([r[:2] for r in rows])


def test_joins_by_shuffle_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", -1)
    rows = family_rows(6)
    assert got(odd_documents(spark, rows)) == plain([r[:2] for r in rows])


def test_chain_is_one_component(spark):
    rows = [(100 - i, " ".join(f"w{j}" for j in range(2 * i, 2 * i + 60)), "en", "s", 0)
            for i in range(40)]
    assert got(odd_documents(spark, rows)) == plain([r[:2] for r in rows])
    assert len({c for _, _, c in got(odd_documents(spark, rows))}) == 1


def test_linked_sets_share_an_index_key():
    """The prefixes of any two linked sets have a key in common, for all frequencies."""
    r = np.random.default_rng(5)
    pool = r.integers(1, 1 << 62, 3000).astype(np.uint64)
    held_by = dict(zip(pool.tolist(), r.choice([2, 10, 17, 40, 900], 3000).tolist()))

    def keys_of(s, alone):
        shared = np.setdiff1d(s, alone)
        held = np.array([held_by[int(k)] for k in shared])
        if len(s) - len(shared) > jaccard.may_lack(len(s)):
            return None
        keys, rooms, roles = jaccard.prefix_keys(len(s), shared, held)
        return {k: (room, role) for k, room, role in zip(*(
            x.tolist() for x in (keys, rooms, roles)))}

    checked = 0
    for _ in range(2500):
        n = int(r.choice([1, 2, 3, 4, 5, 8, 15, 16, 20, 31, 32, 40, 100, 300]))
        one = r.choice(pool, n, replace=False)
        lost = int(r.integers(0, n // 4 + 1))
        other = np.concatenate([one[lost:], r.choice(pool, int(r.integers(0, n // 4 + 1)))])
        other = np.unique(other)
        both = len(np.intersect1d(one, other))
        if (jaccard.linked(both, len(one), len(other))
                and not np.array_equal(np.sort(one), other)):
            checked += 1
            apart = np.setxor1d(one, other)
            alone = apart[r.random(len(apart)) < r.choice([0, .5, 1])]  # in no other set
            small, large = sorted((one, other), key=len)
            a, b = keys_of(small, alone), keys_of(large, alone)
            sizes = len(small), len(large)
            # a key that both have in their roles, and whose rooms allow the link
            assert any(a[k][1] & jaccard.SMALLER and b[k][1] & jaccard.LARGER
                       and jaccard.least_overlap(*sizes) <= min(a[k][0], b[k][0])
                       for k in a.keys() & b.keys())
    assert checked > 400


def test_all_pairs_within_groups():
    group = np.array([3, -1, 5, 3, 3, -1, 5, 7])
    i, j = jaccard.pairs_within(group)
    assert set(zip(i.tolist(), j.tolist())) == {(0, 3), (0, 4), (3, 4), (2, 6)}
    assert all(len(x) == 0 for x in jaccard.pairs_within(np.array([-1, -1, 2])))


def around_a_passage(texts_, copies):
    """Texts of a passage and words of their own, unlinked, in near copies."""
    passage = [f"p{i}" for i in range(44)]
    rows = []
    for t in range(texts_):
        own = [f"o{t}x{i}" for i in range(7 + t % 3)]
        for c in range(copies):
            rows.append(" ".join([*passage, *own, *(["c"] * c)]))
    return [(i, t, "en", "s", 0) for i, t in enumerate(rows)]


@pytest.mark.parametrize("copies", [1, 2])
def test_pairs_around_a_passage_grow_with_the_texts(spark, monkeypatch, copies):
    made = []
    plain_pairs = jaccard._all_pairs

    def counting(active):
        pairs = plain_pairs(active)
        made.append((active.count(), pairs.count()))
        return pairs

    monkeypatch.setattr(jaccard, "_all_pairs", counting)
    rows = around_a_passage(5000 // copies, copies)
    found = jaccard.report(odd_documents(spark, rows)).collect()
    assert len({r["component_id"] for r in found}) == 5000 // copies
    assert sum(n for pair in made for n in pair) <= 4 * len(rows)


def test_odd_rows(spark):
    assert got(odd_documents(spark)) == plain([r[:2] for r in odd_rows()])


def test_one_of_each_keeps_the_first_document(spark):
    df = odd_documents(spark)
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    have = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    want = {}
    rows = [r[:2] for r in odd_rows()]
    for (d, t), (d2, n, c) in zip(sorted(rows, key=repr), plain(rows)):
        assert d == d2 or (d is None and d2 is None)
    for d, t in rows:
        one = {x[2] for x in plain(rows) if x[0] == d and x[1] == len(shingles(t))}
        if d in one:
            want[d, shingles(t)] = t
    assert sorted(((d, t) for (d, _), t in want.items()), key=repr) == have


def test_empty_table(spark):
    assert rows_of(jaccard.report(empty_documents(spark))) == []
    assert rows_of(jaccard.one_of_each(empty_documents(spark))) == []


def near_group(copies, source, seed=7):
    """Near copies of one text of 150 words, four words changed at most or, in some, five to seven.

    A changed word comes from a short list, so that what a copy has instead is in other copies
    too. ``source``: whether the text itself is among them.
    """
    r = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    rows = [base] * source
    for i in range(copies - source):
        words = list(base)
        for _ in range(r.choice([5, 6, 7]) if i % 8 == 0 else r.randrange(1, 5)):
            words[r.randrange(len(words))] = f"e{r.randrange(4)}"
        rows.append(words)
    return [(i, " ".join(w), "en", "s", 0) for i, w in enumerate(rows)]


def test_a_group_of_near_copies_gives_few_pairs(spark, monkeypatch):
    """The copies that link with none are not paired with the whole group."""
    made = []
    plain_pairs = jaccard._all_pairs

    def counting(active):
        pairs = plain_pairs(active)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard, "_all_pairs", counting)
    rows = near_group(1500, True)
    found = jaccard.report(odd_documents(spark, rows)).collect()
    assert len({r["component_id"] for r in found}) > 50
    assert sum(made) <= 20 * len(rows)  # 330 times the rows by rooms alone


def test_group_of_near_copies_without_their_source(spark):
    rows = near_group(250, False)
    assert got(odd_documents(spark, rows)) == plain([r[:2] for r in rows])


def test_octaves_bound_what_sets_share():
    r = np.random.default_rng(8)
    keys = r.integers(1, 1 << 62, 500).astype(np.uint64)
    held = r.choice([1, 2, 3, 4, 7, 8, 100, 70_000, 10 ** 7], 500).astype(np.int32)
    few = jaccard.by_octave(keys[:6], np.array([1, 2, 3, 4, 7, 8], np.int32))
    assert few.reshape(jaccard.OCTAVES, -1).sum(1).tolist()[:5] == [1, 2, 2, 1, 0]
    for _ in range(50):
        one, other = (r.choice(500, 200, replace=False) for _ in range(2))
        bound = np.minimum(*(jaccard.by_octave(keys[x], held[x]) for x in (one, other))).sum()
        assert len(np.intersect1d(one, other)) <= bound <= 200
