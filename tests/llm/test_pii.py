import hashlib
import random
import re

import numpy as np

from riskpanel.llm import pii
from tests.llm.tables import empty_documents, odd_documents, prose, rows_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """Base spans by the patterns as they stand."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": lambda: True,
                    "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda: 14 <= len(digits) <= 19 and pii.luhn(digits),
                    "phone": lambda: 10 <= len(digits) <= 15}[kind]()
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_of_random_texts():
    r = random.Random(3)
    pieces = ["a", "b@", "@", "a.b", "@c.de", ".", "1", "12", "255", "4", " ", "-", "+", "(", ")",
              "1.2.3.4", "4111111111111111", "+1 555 123 4567", "é", "%", "\n"]
    for _ in range(20_000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(14)))
        assert pii.found_in(text)[0] == plain(text), text


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


ROWS = [
    (1, "mail me at jo.doe@mail.example.com or +1 (319) 555-5132 thanks", "", "", 0),
    (2, "from 39.197.112.39 and 399.1.1.1, card 4425414259157784 or 4425414259157785", "", "", 0),
    (3, "call my phone 319-555-5132 now, version 1.2.3.4 is out", "", "", 0),
    (4, "é🙂 write to ann [at] home [dot] org, signed: my name is Anna Smith", "", "", 0),
    (5, None, "", "", 0), (6, "", "", "", 0), (None, "x@y.zz", "", "", 0),
    (7, "+1 319 555 5132 " * 4000, "", "", 0), (7, "x@y.zz", "", "", 0), (7, "x@y.zz", "", "", 0),
    (8, "1" * 4_000 + " and " + "a" * 4_000 + "@", "", "", 0), (9, prose(4), "", "", 0),
]


def test_report(spark):
    got = pii.report(odd_documents(spark, ROWS)).collect()
    have = sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"],
                    r["base_sha256"]) for r in got), key=repr)
    want = []
    for d, text, *_ in ROWS:
        spans = plain(text)
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((d, *(sum(s[0] == k for s in spans) for k in pii.BASE),
                     hashlib.sha256(said.encode()).hexdigest()))
    assert have == sorted(want, key=repr)
    by = {(d, t): plain(t) for d, t, *_ in ROWS}
    for (d, t), base in by.items():
        found = [r["spans"] for r in got if r["doc_id"] == d]
        assert any({f"{k}:{a}:{b}" for k, a, b in base} <= set(s.split(",")) or not base
                   for s in found)
    spans = {r["doc_id"]: r["spans"] for r in got if r["doc_id"] in (3, 4, 9)}
    assert "phone:14:26" in spans[3]  # added: no country code
    assert spans[9] == ""


def test_reliabilities_are_recovered():
    """Votes drawn from known reliabilities give them back."""
    r = np.random.default_rng(1)
    true = np.array([0.95, 0.9, 0.8, 0.7, 0.85, 0.75, 0.9])
    truth = r.random(20_000) < 0.6
    right = r.random((len(truth), 7)) < true
    votes = np.where(right == truth[:, None], 1, -1) * (r.random(right.shape) < 0.8)
    reliable, posterior = pii.estimate(votes, np.zeros(len(truth), int), np.ones(len(truth)))
    assert np.abs(reliable - true).max() < 0.03
    assert ((posterior > .5) == truth).mean() > 0.9


def test_classifier_learns_held_out_spans():
    r = np.random.default_rng(2)
    x = np.hstack([np.ones((4000, 1)), r.integers(0, 2, (4000, 5))]).astype(float)
    truth = (x @ np.array([-1.5, 2, 1, -1, 0, .5])) > 0
    weights = pii.trained(x[:2000], truth[:2000].astype(float), np.ones(2000))
    assert (((x[2000:] @ weights) > 0) == truth[2000:]).mean() > 0.95


def test_mask(spark):
    df = odd_documents(spark, ROWS)
    out = pii.mask(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    by = {}
    for r in out.collect():
        by.setdefault(r["doc_id"], []).append((r["text"], r["n_chars"]))
    assert by[1] == [("mail me at <EMAIL> or <PHONE> thanks", 36)]
    assert by[5] == [(None, 0)] and by[6] == [("", 0)]
    assert by[9] == [(prose(4), len(prose(4)))]
    assert sorted(t for t, _ in by[7])[:2] == ["<EMAIL>", "<EMAIL>"]


def test_empty_table(spark):
    assert rows_of(pii.report(empty_documents(spark))) == []
    assert rows_of(pii.mask(empty_documents(spark))) == []


def test_very_long_digit_runs():
    text = "0" * 5000 + ".1.2.3 and " + "9" * 6000 + ".1.1.1 at " + "0" * 6000 + "7.2.3.4"
    got = [(kind, passed) for kind, _, _, passed in pii.matches(text) if kind == "ip"]
    assert got == [("ip", True), ("ip", False), ("ip", True)]
