import hashlib
import random

import numpy as np

from riskpanel.llm import substring, texts
from tests.llm.tables import empty_documents, odd_documents, odd_rows, rows_of

W = substring.WINDOW


def plain(rows):
    """(doc_id, n_words, n_removed, digest) by the definition; a null id is the largest."""
    split = [(texts.NO_ID if d is None else d, (t or "").encode().split(), d) for d, t in rows]
    least = {}
    for d, words, _ in split:
        for i in range(len(words) - W + 1):
            k = tuple(words[i:i + W])
            least[k] = min(d, least.get(k, d))
    out = []
    for d, words, name in split:
        gone = {j for i in range(len(words) - W + 1) if least[tuple(words[i:i + W])] < d
                for j in range(i, i + W)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((name, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
                   for r in substring.substring_report(df).collect()), key=repr)


def test_odd_rows(spark):
    assert got(odd_documents(spark)) == plain([r[:2] for r in odd_rows()])


def test_random_passages(spark):
    r = random.Random(4)
    passages = [[f"p{i}w{j % 9}" for j in range(60)] for i in range(6)]
    rows = []
    for d in range(150):
        words = []
        for _ in range(r.randrange(5)):
            p, a = r.choice(passages), r.randrange(50)
            words += p[a:a + r.randrange(40)] + [f"u{r.randrange(30)}"] * r.randrange(3)
        rows.append((d, r.choice([" ", "\n", "\t "]).join(words), "en", "s", 0))
    rows += [(d + 200, *rows[d][1:]) for d in range(0, 150, 7)]  # exact copies
    assert got(odd_documents(spark, rows)) == plain([x[:2] for x in rows])


def test_hash_clashes_are_told_apart_by_words(monkeypatch):
    # with all windows in one group, the words decide
    monkeypatch.setattr(texts, "window_hashes", lambda h, w: np.zeros(max(0, len(h) - w + 1), np.uint64))
    texts_ = [b" ".join(b"a%d" % (i % 17) for i in range(40)),
              b" ".join(b"a%d" % (i % 19) for i in range(40))]
    blob = texts.pack(np.array([1, 2]), np.array([10, 20]), np.array([False, False]),
                      np.array([0, 0], np.int32), np.array([len(t) for t in texts_], np.int32),
                      np.frombuffer(b"".join(texts_), np.uint8))
    import pyarrow as pa

    out = substring.count_windows(pa.table({"runs": pa.array([blob], pa.binary())})).to_pylist()
    least = {}
    for d, t in ((10, texts_[0]), (20, texts_[1])):
        words = t.split()
        for i in range(len(words) - W + 1):
            least.setdefault(tuple(words[i:i + W]), d)
    words = texts_[1].split()
    want = {i for i in range(len(words) - W + 1) if least[tuple(words[i:i + W])] < 20}
    have = set()
    for row in out:
        assert row["class"] == 2
        for a, n in zip(*substring.ranges([row["spans"]])):
            have |= set(range(int(a), int(a + n) - W + 1))
    assert have == want


def test_empty_table(spark):
    assert rows_of(substring.substring_report(empty_documents(spark))) == []
