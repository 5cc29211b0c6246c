"""Quality rules judged per document and per host.

One pass counts the rules' figures per document. Failures of the soft rules are
summed by host, each host's rate is shrunk towards a beta prior fitted to all
hosts, and the verdict is joined back: a host whose shrunk rate of some rule is
clearly above that of all documents loses the documents that fail this rule, and one
whose rate of base failures is, those that fail any soft rule. Clearly means that nine
tenths of the rate's posterior are above. Base failures go on every host.

Defined results: a null or empty text has no words and fails the base rule; a
null host is a host of its own; repeated rows are judged one by one; an empty
table gives an empty result; other columns are kept by ``keep_good`` and play no
part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm import texts

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_SHARE = 30  # per cent of the words
SYMBOL_SHARE = 10  # per cent of the characters in words
LINE_SHARE = 30  # per cent of the lines with a word
WORD_CHARS = (2, 14)  # mean length of a word
ABOVE = 1.2816  # standard errors that hold nine tenths on one side

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["symbols", "lines", "word_length"]
HOST_RULES = ["base", *RULES]


def _repeated_words(hashes: np.ndarray, words: texts.Words) -> np.ndarray:
    """Per document, the words in windows that occur twice or more in it."""
    documents = len(words.first) - 1
    at = texts.whole_windows(words, REPEAT_WINDOW)
    if not len(at):
        return np.zeros(documents, np.int64)
    document = words.document()
    keys = texts.window_hashes(hashes, REPEAT_WINDOW)[at]
    keys = texts.mix(keys + (document[at].astype(np.uint64) + np.uint64(1)) * texts.FACTORS[63])
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    found = np.zeros(len(at), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    hit = texts.covered(at[found], np.full(int(found.sum()), REPEAT_WINDOW), len(hashes))
    return np.bincount(document[hit], minlength=documents)


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def _count_until(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of ``found`` are before each offset."""
    sums = np.zeros(len(found) + 1, np.int32)
    np.cumsum(found, out=sums[1:])
    return sums[offsets].astype(np.int64)


def with_text(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    """The batches with ``__text``, the field at ``place`` of the kept row, not copied."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, b.column("__kept_row").field(place)],
                                         names=[*b.schema.names, "__text"])


def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in texts.parts(batches, "__text"):
        words = texts.words_of(data, offsets)
        hashes = texts.word_hashes(data, words)
        in_words = ~texts.SPACE[data] & ((data & 0xC0) != 0x80)
        sums = [_count_until(in_words, offsets), _count_until(SYMBOLS[data], offsets)]
        raw = data.tobytes()
        lines = np.array([_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])],
                         np.int64).reshape(-1, 2)
        out = [np.diff(words.first), *map(np.diff, sums), lines[:, 1],
               _repeated_words(hashes, words), lines[:, 0]]
        rest = [c for c in rows.schema.names if c != "__text"]
        yield pa.RecordBatch.from_arrays(
            [rows.column(c) for c in rest] + [pa.array(x.astype(np.int64)) for x in out],
            names=[*rest, *(f"__{x}" for x in FIGURES), "__lines"])


def measured(documents: DataFrame, keep: list[str] | None = None, text: str = "text",
             host: str = "source") -> DataFrame:
    """``__kept_row`` (the columns ``keep``, all if None), ``__host``, the figures and one flag
    per rule. A text that is kept goes to Python once."""
    texts.workers_find_package(documents.sparkSession)
    keep = documents.columns if keep is None else keep
    place = keep.index(text) if text in keep else None
    rows = documents.select(
        *([F.struct(*(documents[f"`{c}`"] for c in keep)).alias("__kept_row")] if keep else []),
        documents[host].alias("__host"),
        *([documents[text].alias("__text")] if place is None else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return figures(batches if place is None else with_text(batches, place))

    out = rows.mapInArrow(run, texts.with_fields(
        rows.drop("__text").schema, *((f"__{x}", "bigint") for x in [*FIGURES, "lines"])))
    chars, words = F.col("__word_chars"), F.col("__n_words")
    failed = {
        "symbols": 100 * F.col("__n_symbols") > SYMBOL_SHARE * F.col("__word_chars"),
        "lines": 100 * F.col("__n_dup_lines") > LINE_SHARE * F.col("__lines"),
        "word_length": ~chars.between(WORD_CHARS[0] * words, WORD_CHARS[1] * words),
    }
    base = (F.col("__n_words") < MIN_WORDS) | (
        100 * F.col("__n_repeat_words") > REPEAT_SHARE * F.col("__n_words"))
    return out.withColumns({"__base": base} | {f"__{r}": failed[r] for r in RULES})


def host_verdicts(flags: DataFrame, above: float = ABOVE) -> DataFrame:
    """Hosts that fail a rule: their key and one flag per rule.

    A host's rate is (failures + a) / (documents + a + b). The beta prior (a, b) of
    each rule has the mean and the spread of all hosts' rates, weighted by their
    documents, less the spread that sampling alone gives. A host fails if its rate less
    ``above`` standard errors of its posterior is over the rate of all documents.
    """
    hosts = texts.stored(flags.groupBy("__host").agg(
        F.count("*").alias("n"), *(F.count_if(f"__{r}").alias(r) for r in HOST_RULES)))
    total = F.sum("n")
    one = hosts.agg(
        total.alias("n"), F.count("*").alias("hosts"),
        *(F.sum(r).alias(f"sum_{r}") for r in HOST_RULES),
        *(F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"square_{r}") for r in HOST_RULES),
    ).first()
    bad_flags = {}
    for r in HOST_RULES:
        n, failed = one["n"] or 0, one[f"sum_{r}"] or 0
        a, b = beta_prior(n, one["hosts"], failed, one[f"square_{r}"] or 0.0)
        size = F.col("n") + a + b
        rate = (F.col(r) + a) / size
        error = F.sqrt(rate * (1 - rate) / (size + 1))
        bad_flags[f"__bad_{r}"] = rate - above * error > (failed / n if n else 0.0)
    bad = hosts.select(F.col("__host").alias("__judged"), *(v.alias(k) for k, v in bad_flags.items()))
    return bad.where(" or ".join(f"__bad_{r}" for r in HOST_RULES))


def beta_prior(n: int, hosts: int, failed: int, square: float) -> tuple[float, float]:
    """(a, b) by the moments of the hosts' rates; square is sum(failed^2 / documents)."""
    if n == 0 or failed in (0, n):
        return (0.5, 0.5) if n == 0 else (0.5, 1.5) if failed == 0 else (1.5, 0.5)
    mean = failed / n
    spread = square / n - mean * mean
    binomial = mean * (1 - mean)
    # E[weighted spread] = binomial * (hosts - 1) / n * (1 - r) + binomial * r
    least = (hosts - 1) / n
    r = min(max((spread / binomial - least) / max(1 - least, 1e-9), 1e-3), 0.999)
    strength = 1 / r - 1
    return mean * strength, (1 - mean) * strength


def judged(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``measured`` rows with ``__kept``."""
    joined = rows.join(verdicts, F.col("__host").eqNullSafe(F.col("__judged")), "left")
    failed = F.lit(False)
    for r in RULES:
        failed = failed | (F.col(f"__{r}") & F.coalesce(
            F.col(f"__bad_{r}") | F.col("__bad_base"), F.lit(False)))
    return joined.withColumn("__kept", ~F.col("__base") & ~failed)


def quality_report(documents: DataFrame) -> DataFrame:
    """doc_id, the base figures, base_failed and kept of every document."""
    rows = texts.stored(measured(documents, ["doc_id"]))
    out = judged(rows, host_verdicts(rows))
    return out.select("__kept_row.doc_id", *(F.col(f"__{x}").alias(x) for x in FIGURES),
                      F.col("__base").alias("base_failed"), F.col("__kept").alias("kept"))


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their columns."""
    verdicts = host_verdicts(measured(documents, []))
    return judged(measured(documents), verdicts).where("__kept").select("__kept_row.*")


def report_sql() -> str:
    """DuckDB SQL for ``quality_report``."""
    return rf"""
WITH d AS (
  SELECT doc_id, source, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
  SELECT r, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS k
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
cov AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest(generate_series(i, i + 7)) AS p FROM rep) GROUP BY r),
ln AS (
  SELECT r, count(*) AS lines, count(*) - count(DISTINCT l) AS dup FROM (
    SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (
  SELECT w.doc_id, w.source, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lines, 0) AS lines
  FROM w LEFT JOIN cov USING (r) LEFT JOIN ln USING (r)),
g AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_SHARE} * n_words AS base_failed,
    100 * n_symbols > {SYMBOL_SHARE} * word_chars AS r1,
    100 * n_dup_lines > {LINE_SHARE} * lines AS r2,
    n_words > 0 AND NOT (word_chars / n_words BETWEEN {WORD_CHARS[0]} AND {WORD_CHARS[1]}) AS r3
  FROM f),
long AS (
  SELECT source, 0 AS rule, base_failed AS bad FROM g UNION ALL
  SELECT source, 1, r1 FROM g UNION ALL
  SELECT source, 2, r2 FROM g UNION ALL SELECT source, 3, r3 FROM g),
h AS (
  SELECT source, rule, count(*)::DOUBLE AS n, count(*) FILTER (bad) AS k
  FROM long GROUP BY ALL),
m AS (
  SELECT rule, sum(n) AS n, count(*) AS hosts, sum(k) AS k, sum(k)::DOUBLE / sum(n) AS p,
    sum(k * k / n) / sum(n) AS sq FROM h GROUP BY rule),
q AS (
  SELECT rule, n, k, p, least(greatest(((sq - p * p) / nullif(p * (1 - p), 0) - (hosts - 1) / n)
    / greatest(1 - (hosts - 1) / n, 1e-9), 1e-3), 0.999) AS rho FROM m),
ab AS (
  SELECT rule, p, CASE WHEN k = 0 THEN 0.5 WHEN k = n THEN 1.5 ELSE p * (1 / rho - 1) END AS a,
    CASE WHEN k = 0 THEN 1.5 WHEN k = n THEN 0.5 ELSE (1 - p) * (1 / rho - 1) END AS b FROM q),
u AS (
  SELECT source, h.rule, p, (h.k + a) / (h.n + a + b) AS rate, h.n + a + b AS size
  FROM h JOIN ab ON h.rule = ab.rule),
v AS (
  SELECT source, bool_or(rule = 1 AND bad) AS b1, bool_or(rule = 2 AND bad) AS b2,
    bool_or(rule = 3 AND bad) AS b3, bool_or(rule = 0 AND bad) AS b0
  FROM (SELECT source, rule, rate - {ABOVE} * sqrt(rate * (1 - rate) / (size + 1)) > p AS bad
        FROM u) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (r1 AND (b0 OR b1)) AND NOT (r2 AND (b0 OR b2))
    AND NOT (r3 AND (b0 OR b3)) AS kept
FROM g JOIN v ON g.source IS NOT DISTINCT FROM v.source
"""
