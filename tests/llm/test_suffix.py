import hashlib
import random

import numpy as np

from riskpanel.llm import suffix, texts
from tests.llm.tables import empty_documents, odd_documents, odd_rows, rows_of

N = suffix.LENGTH


def plain(rows):
    raw = [(texts.NO_ID if d is None else d, (t or "").encode(), d) for d, t in rows]
    least = {}
    for d, text, _ in raw:
        for i in range(len(text) - N + 1):
            k = text[i:i + N]
            least[k] = min(d, least.get(k, d))
    out = []
    for d, text, name in raw:
        gone = bytearray(len(text))
        for i in range(len(text) - N + 1):
            if least[text[i:i + N]] < d:
                gone[i:i + N] = b"\1" * N
        kept = bytes(c for c, g in zip(text, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((name, len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                   for r in suffix.report(df).collect()), key=repr)


def test_odd_rows(spark):
    assert got(odd_documents(spark)) == plain([r[:2] for r in odd_rows()])


def test_random_passages(spark):
    r = random.Random(2)
    base = ["".join(r.choice("ab \0é") for _ in range(400)) for _ in range(6)]
    rows = []
    for d in range(200):
        pieces = []
        for _ in range(r.randrange(6)):
            a = r.randrange(400)
            pieces.append(r.choice(base)[a:a + r.randrange(150)])
            if r.random() < .5:
                pieces.append(r.choice(["x", "aaaaaaaaaa" * 9, "\n"]))
        rows.append((d, "".join(pieces), "en", "s", 0))
    rows += [(300 + d, *rows[d][1:]) for d in range(0, 200, 9)]
    assert got(odd_documents(spark, rows)) == plain([x[:2] for x in rows])


def test_maximal_repeats_are_the_definition():
    """Against all substrings: maximal to the right by the tree, to the left by diversity."""
    r = random.Random(7)
    for _ in range(40):
        text = bytes(r.choice(b"ab") for _ in range(60))
        data = np.frombuffer(text, np.uint8)
        ends = np.full(len(data), len(data))
        rank, ranks = suffix.suffix_order(data, ends)
        order = np.argsort(rank, kind="stable")
        assert [text[i:] for i in order] == sorted(text[i:] for i in range(len(text)))
        shared = np.zeros(len(order), np.int64)
        shared[1:] = suffix.common_prefix(order[:-1], order[1:], data, ends, ranks)
        before = np.concatenate([[-1], data[:-1].astype(np.int64)])
        least = 5
        found = {}
        for length, low, high in suffix.maximal_repeats(order, shared, before, least):
            found[text[order[low]:order[low] + length]] = frozenset(order[low:high + 1].tolist())
        want = {}
        for i in range(len(text)):
            for n in range(least, len(text) - i + 1):
                s = text[i:i + n]
                at = frozenset(j for j in range(len(text)) if text.startswith(s, j))
                if len(at) > 1:
                    right = {text[j + n:j + n + 1] for j in at}
                    left = {text[j - 1] if j else -1 for j in at}
                    if len(right) > 1 and (len(left) > 1 or -1 in left):
                        want[s] = at
        assert found == want


def test_empty_table(spark):
    assert rows_of(suffix.report(empty_documents(spark))) == []
