"""Personal data by weak supervision: labelers vote, their reliabilities are estimated.

Base spans come from four patterns and always stay. Candidates are the base
matches, the matches that failed a check, and looser forms (numbers without a
country code, spelled-out addresses, titled names, social security numbers).
Labelers vote yes, no or nothing on each candidate: a strict pattern, a checksum
or range, gazetteers of domains and names, the words before it, its borders and
its digits. Expectation-maximisation over the vote patterns of all candidates
estimates how reliable each labeler is. The posteriors train a logistic span
classifier; a candidate that it accepts is added unless it overlaps a base span.

Only a table of (kind, votes, features) with counts leaves the executors; its
size is bounded by the number of such combinations, not by the corpus.

Defined results: a null or empty text has no spans; repeated rows are judged one by
one; an empty table gives an empty result; other columns are kept by ``mask`` and
play no part, whatever their names. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm import texts

KINDS = ["email", "ip", "card", "phone", "ssn", "name"]
BASE = KINDS[:4]
LABELERS = ["shape", "check", "gazetteer", "context", "other_context", "border", "digits"]
ACCEPT = 0.5

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOOSE = {
    "phone": re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}"
                        r"(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]{1,63})+"),
    "name": re.compile(r"(?:\b[Nn]ame(?: is|:)|\bMrs?\.|\bMs\.|\bDr\.) "
                       r"([A-Z][A-Za-z'-]+(?: [A-Z][A-Za-z'-]+)?)"),
}
STRICT = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"),
    "ip": re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9]{14,19}|[0-9]{4}(?:[ -][0-9]{4}){3}"),
    "phone": re.compile(r"\+?[0-9]{0,3}[ .-]?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"),
    "ssn": re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}"),
    "name": re.compile(r"[A-Z][a-z'-]+ [A-Z][a-z'-]+"),
}
CONTEXT = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write)\b", re.I),
    "ip": re.compile(r"\b(?:ip|address|server|host|login)\b", re.I),
    "card": re.compile(r"\b(?:card|credit|visa|debit|payment)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax|contact)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security)\b", re.I),
    "name": re.compile(r"\b(?:my|signed|from|patient|dear)\b", re.I),
}
OTHER = re.compile(r"\b(?:version|release|section|chapter|page|isbn|order|figure|build|price|id)"
                   r"\b", re.I)
# fixed values: common domain ends and given names
ENDS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl"}
GIVEN = {"James", "Mary", "John", "Anna", "Robert", "Maria", "Michael", "Laura", "David", "Sarah",
         "Thomas", "Julia", "Peter", "Elena", "Paul", "Claire", "Carlos", "Sofia", "Pierre",
         "Hans", "Emma", "Lucas", "Marie", "Martin", "Jose", "Carmen", "Klaus", "Sophie"}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the base pattern, found from their signs: each letter is read once."""
    end, sign = 0, text.find("@")
    while sign >= 0:
        head = text[end:sign]
        size = len(head) - len(head.rstrip(LOCAL))
        tail = DOMAIN.match(text, sign + 1) if size else None
        if tail:
            yield sign - size, tail.end()
            end = tail.end()
        else:
            end = sign + 1
        sign = text.find("@", max(end, sign + 1))


def passes(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p) <= 3 and int(p or 0) <= 255
                   for p in (part.lstrip("0") for part in found.split(".")))
    if kind == "card":
        return 14 <= len(d := _digits(found)) <= 19 and luhn(d)
    if kind == "phone":
        return 10 <= len(_digits(found)) <= 15
    return True


def matches(text: str) -> list[tuple[str, int, int, bool]]:
    """Matches of the base patterns with the outcome of their check."""
    out = []
    if "@" in text:
        out += [("email", a, b, True) for a, b in _emails(text)]
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        out += [(kind, m.start(), m.end(), passes(kind, m[0])) for m in pattern.finditer(text)]
    return out


def ordered(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


NUMBER = re.compile("[0-9]")
NAMED = ("Mr", "Ms.", "Dr.", "ame is ", "ame: ")


def found_in(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and further candidates of a text, both in order."""
    number = NUMBER.search(text) is not None
    tried = matches(text) if number or "@" in text else []
    base = ordered(s[:3] for s in tried if s[3])
    loose = [s[:3] for s in tried if not s[3] and (s[0] != "card" or 13 <= _length(text, s) <= 19)]
    if number:
        loose += [(k, *m.span()) for k in ("phone", "ssn") for m in LOOSE[k].finditer(text)]
    if "at)" in text or "at]" in text:
        loose += [("email", *m.span()) for m in LOOSE["email"].finditer(text)]
    if any(n in text for n in NAMED):
        loose += [("name", *m.span(1)) for m in LOOSE["name"].finditer(text)]
    if base and loose:
        starts = np.array([s[1] for s in base])
        reach = np.maximum.accumulate([s[2] for s in base])
        loose = [s for s in loose
                 if not (i := np.searchsorted(starts, s[2])) or reach[i - 1] <= s[1]]
    return base, ordered(set(loose))


def _length(text: str, span) -> int:
    return len(_digits(text[span[1]:span[2]]))


def votes(text: str, kind: str, start: int, end: int) -> list[int]:
    """One vote per labeler: 1 yes, -1 no, 0 nothing."""
    found, digits = text[start:end], _digits(text[start:end])
    before = text[max(0, start - 40):start]
    left, right = text[start - 1:start], text[end:end + 1]
    checked = {"card": luhn(digits) and 14 <= len(digits) <= 19, "ip": passes("ip", found)
               if kind == "ip" else False, "phone": 10 <= len(digits) <= 15}
    gazetteer = 0
    if kind == "email":
        gazetteer = 1 if re.split(r"[. \])]", found)[-1].lower() in ENDS else -1
    elif kind == "name":
        gazetteer = 1 if found.split(" ")[0] in GIVEN else 0
    return [
        1 if STRICT[kind].fullmatch(found) else -1,
        (1 if checked[kind] else -1) if kind in checked else 0,
        gazetteer,
        1 if CONTEXT[kind].search(before) else 0,
        -1 if OTHER.search(before[-20:]) else 0,
        1 if not (left.isalnum() or right.isalnum()) else -1,
        -1 if len(digits) > 3 and len(set(digits)) == 1 else 0,
    ]


def features(text: str, kind: str, start: int, end: int) -> list[int]:
    """What the classifier sees of a span, besides the votes: small whole numbers."""
    found = text[start:end]
    return [KINDS.index(kind), min(len(_digits(found)) // 4, 5), min((end - start) // 8, 5),
            int(any(c in " ().-" for c in found)), int(start == 0 or text[start - 1].isspace()),
            int(end == len(text) or not text[end].isalnum())]


def _columns(votes_: np.ndarray, features_: np.ndarray) -> np.ndarray:
    """The classifier's inputs: one-hot kinds and bins, and the votes."""
    sizes = [len(KINDS), 6, 6, 2, 2, 2]
    hot = [np.eye(n)[features_[:, j]] for j, n in enumerate(sizes)]
    return np.hstack([np.ones((len(votes_), 1)), *hot, votes_ > 0, votes_ < 0]).astype(float)


def estimate(votes_: np.ndarray, kinds: np.ndarray, counts: np.ndarray,
             rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Reliability of each labeler and the posterior of each row, by EM.

    A labeler that votes is right with its own probability, whatever the class;
    each kind has its own share of true spans. Both keep a weak prior.
    """
    reliable = np.full(votes_.shape[1], 0.8)
    share = np.full(len(KINDS), 0.5)
    posterior = np.full(len(votes_), 0.5)
    for _ in range(rounds):
        odds = np.log(share / (1 - share))[kinds] + votes_ @ np.log(reliable / (1 - reliable))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        right = ((votes_ > 0) * posterior[:, None] + (votes_ < 0) * (1 - posterior[:, None]))
        voted = (votes_ != 0) * counts[:, None]
        reliable = (8 + (right * counts[:, None]).sum(0)) / (10 + voted.sum(0))
        reliable = np.clip(reliable, 0.51, 0.99)
        for k in range(len(KINDS)):
            own = kinds == k
            share[k] = (1 + (posterior * counts)[own].sum()) / (2 + counts[own].sum())
        share = np.clip(share, 0.02, 0.98)
    return reliable, posterior


def trained(columns: np.ndarray, target: np.ndarray, counts: np.ndarray,
            ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps."""
    weights = np.zeros(columns.shape[1])
    scale = counts / max(counts.mean(), 1e-9)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(columns @ weights, -30, 30)))
        slope = columns.T @ (scale * (p - target)) + ridge * weights
        curve = (columns * (scale * p * (1 - p))[:, None]).T @ columns
        weights -= np.linalg.solve(curve + ridge * np.eye(len(weights)), slope)
    return weights


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column("__text").to_pylist():
            if text:
                base, loose = found_in(text)
                for span in [*base, *loose]:
                    seen[bytes([v + 1 for v in votes(text, *span)] + features(text, *span))] += 1
    yield pa.RecordBatch.from_arrays(
        [texts.binary_array(list(seen)), pa.array(seen.values(), pa.int64())], names=["row", "n"])


def fit(documents: DataFrame, text: str = "text") -> np.ndarray | None:
    """The span classifier's weights from all candidates of the table; None without any."""
    texts.workers_find_package(documents.sparkSession)
    table = (documents.select(documents[text].alias("__text"))
             .mapInArrow(_counted, "row binary, n bigint")
             .groupBy("row").agg(F.sum("n").alias("n")).orderBy("row").collect())
    if not table:
        return None
    rows = np.array([list(r["row"]) for r in table], np.int64)
    counts = np.array([r["n"] for r in table], float)
    votes_, features_ = rows[:, :len(LABELERS)] - 1, rows[:, len(LABELERS):]
    _, posterior = estimate(votes_, features_[:, 0], counts)
    return trained(_columns(votes_, features_), posterior, counts)


def accepted(text: str, spans, weights: np.ndarray | None) -> list[tuple[str, int, int]]:
    """The candidates that the classifier takes; of two that overlap, the earlier."""
    if not spans or weights is None:
        return []
    rows = _columns(np.array([votes(text, *s) for s in spans]),
                    np.array([features(text, *s) for s in spans]))
    good = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30))) >= ACCEPT
    out, end = [], -1
    for span, yes in zip(spans, good):
        if yes and span[1] >= end:
            out.append(span)
            end = span[2]
    return out


def _written(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def report(documents: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256 and all spans of every document."""
    weights = fit(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in texts.parts(batches):
            out = []
            for text in rows.column("text").to_pylist():
                base, loose = found_in(text or "")
                spans = ordered([*base, *accepted(text or "", loose, weights)])
                n = Counter(s[0] for s in base)
                out.append((*(n[k] for k in BASE),
                            hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans)))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"n_{k} bigint" for k in BASE)
        + ", base_sha256 string, spans string")


def masked(text: str | None, weights: np.ndarray | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets.

    Spans of several kinds that overlap become one, named after the first.
    """
    if not text:
        return text
    base, loose = found_in(text)
    out, end = [], 0
    for kind, a, b in ordered([*base, *accepted(text, loose, weights)]):
        if a >= end:
            out += [text[end:a], f"<{kind.upper()}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def mask(documents: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The table with personal data in its text replaced, and its length renewed."""
    weights = fit(documents, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in texts.parts(batches, text):
            at = rows.schema.names.index(text)
            clean = pa.array([masked(t, weights) for t in rows.column(at).to_pylist()],
                             rows.schema.types[at])
            yield rows.set_column(at, rows.schema.field(at), clean)

    out = documents.mapInArrow(run, documents.schema)
    if n_chars in documents.columns:
        kind = documents.schema[n_chars].dataType
        out = out.withColumn(n_chars, F.when(F.col(text).isNull(), F.col(n_chars))
                             .otherwise(F.char_length(text).cast(kind)))
    return out
