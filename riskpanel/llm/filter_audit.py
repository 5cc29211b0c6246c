"""What each of several filters removes, alone, after others and in every order.

Five filters judge a document: A too few words, B too few distinct words, C too many
capitals, D symbols, E a text that a smaller doc_id has too. One scan finds A to D and
a 128-bit digest of the text. E is an existential self-join: a row fails if a row with its
digest, exactly its text and a smaller doc_id exists. Only digests that occur twice
are joined; of the rows with one text only the one with the smallest doc_id can decide, so
the right side is one row for each text, found with a map-side combine, and repeated for
the salts of texts that many rows have. The ids that fail E are united with those that
fail another filter to one bit mask for each document, and rows are counted by part and
mask. Every order of the filters is a sum over these counts.

Defined results: a null text is empty, a null part is the empty string; a null doc_id is
neither smaller nor larger than another and has no label; repeated rows are counted one by
one (rows with the same doc_id and text never fail E by each other); of several labels of
a doc_id any one counts; empty documents give an empty result; other columns play no
part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.llm import texts

LETTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_SHARE = 50  # per cent of the words
CAPITAL_SHARE = 2  # per cent of the code points
SYMBOLS = b"#$%&*|"
COPY = 1 << LETTERS.index("E")
ORDERS = ["".join(p) for p in permutations(LETTERS)]

#: Digests (16 bytes and their row) that may be broadcast.
SMALL = 500_000
#: Bytes of one text's rows beyond which they are salted.
HOT_BYTES = 64 << 20

_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))


def failed_bits(raw: bytes) -> int:
    """Bits 0 to 3: which of the filters A to D a text (in UTF-8) fails."""
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    letters = len(raw.translate(None, _CONTINUED))
    failed = (len(words) < MIN_WORDS,
              100 * len(set(words)) < DISTINCT_SHARE * len(words),
              100 * capitals > CAPITAL_SHARE * letters,
              len(raw.translate(None, SYMBOLS)) < len(raw))
    return sum(f << i for i, f in enumerate(failed))


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in texts.parts(batches):
        raw = data.tobytes()
        bits = [failed_bits(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        size = offsets[1:] - offsets[:-1]
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(c) for c in ("doc_id", "part", "digest")),
             pa.array(bits, pa.int32()), pa.array(size)],
            names=["doc_id", "part", "digest", "bits", "size"])


def _rows(documents: DataFrame, part: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        "doc_id", F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("digest"))


def flagged(documents: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part, digest and size of the text and ``bits`` of A to D of every row (stored)."""
    texts.workers_find_package(documents.sparkSession)
    rows = _rows(documents, part)
    return texts.stored(rows.mapInArrow(_flags, texts.with_fields(
        rows.drop("text").schema, ("bits", "int"), ("size", "bigint"))))


def copies(documents: DataFrame, flags: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part and digest of every row whose text a smaller doc_id has too."""
    repeated = texts.stored(flags.groupBy("digest").agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes")).where("n > 1"))
    known, total = repeated.agg(F.count("*"), F.sum("bytes")).first()
    # at most four digests for each shuffle partition hold that many bytes
    hot_bytes = max(HOT_BYTES, (total or 0) // (4 * texts.partitions(flags.sparkSession)))
    hot = F.broadcast(repeated.where(F.col("bytes") > hot_bytes).select(
        "digest", F.ceil(F.col("bytes") / hot_bytes).cast("int").alias("salts")))
    rows = _rows(documents, part)
    if known <= SMALL:
        held = rows.join(F.broadcast(repeated.select("digest")), "digest", "left_semi")
    else:
        held = rows.join(hot, "digest", "left_semi").unionByName(
            rows.join(hot, "digest", "left_anti")
            .join(repeated.where(F.col("bytes") <= hot_bytes), "digest", "left_semi"))
    held = texts.stored(held.join(hot, "digest", "left").select(
        "doc_id", "part", "digest", "text", F.coalesce("salts", F.lit(1)).alias("salts")))
    first = held.groupBy("digest", "text").agg(
        F.min("doc_id").alias("first"), F.max("salts").alias("salts"))
    first = first.select("first", F.col("digest").alias("same"), F.col("text").alias("other"),
                         F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("lot"))
    salted = held.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    there = ((salted["digest"] == first["same"]) & (salted["salt"] == first["lot"])
             & (salted["text"] == first["other"]) & (first["first"] < salted["doc_id"]))
    return salted.join(first, there, "left_semi").select("doc_id", "part", "digest")


def combinations(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, mask (bit i: filter i fails), n, good and toxic: rows by failure combination."""
    flags = flagged(documents, part)
    key = ["doc_id", "part", "digest"]
    united = flags.where("bits <> 0").select(
        *key, "bits", F.lit(1).alias("row"), F.lit(0).alias("copy")).unionByName(
        copies(documents, flags, part).select(
            *key, F.lit(COPY).alias("bits"), F.lit(0).alias("row"), F.lit(1).alias("copy")))
    # rows of one key are the same row, repeated: all of them fail the same filters
    failing = united.groupBy(*key).agg(
        F.bit_or("bits").alias("mask"), F.greatest(F.sum("row"), F.sum("copy")).alias("n"))
    judged = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("is_good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("is_toxic"))
    known = failing.where("doc_id IS NOT NULL").join(judged, "doc_id", "left").select(
        "part", "mask", "n", (F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
        (F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"))
    zero = F.lit(0).cast("bigint")
    nameless = failing.where("doc_id IS NULL").select(
        "part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    failed = texts.stored(known.unionByName(nameless).groupBy("part", "mask").agg(
        *(F.sum(c).alias(c) for c in ("n", "good", "toxic"))))
    # mask 0: all rows of the part less the failing ones
    passed = flags.groupBy("part").agg(F.count("*").alias("n")).unionByName(
        failed.select("part", (-F.col("n")).alias("n"))).groupBy("part").agg(F.sum("n").alias("n"))
    return texts.stored(failed.unionByName(passed.select(
        "part", F.lit(0).alias("mask"), "n", zero.alias("good"), zero.alias("toxic"))))


def _roles(spark: SparkSession) -> DataFrame:
    """What a mask counts as at each step of each order: as many rows as the filters give,
    whatever the input."""
    rows = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << LETTERS.index(letter)
            for mask in range(1 << len(LETTERS)):
                own, earlier = int(mask & bit > 0), int(mask & before > 0)
                rows.append((mask, order, step, int(not mask & (before | bit)),
                             own * (1 - earlier), own * earlier, int(mask == bit),
                             own * len(ORDERS) // max(mask.bit_count(), 1)))
            before |= bit
    return spark.createDataFrame(rows, "mask int, filter_order string, step int, kept_ bigint, "
                                 "removed_ bigint, redundant_ bigint, unique_ bigint, "
                                 "shapley_ bigint")


def audit(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Per part, order of the filters and step what the step's filter does.

    ``shapley`` is the sum over all orders of what the filter removes: a document that
    fails k filters falls to each of them in one k-th of the orders.
    """
    counts = combinations(documents, labels, part)
    roles = F.broadcast(_roles(documents.sparkSession))

    def total(rows: str, role: str, name: str):
        return F.sum(F.col(rows) * F.col(role)).alias(name)

    return counts.join(roles, "mask").groupBy("part", "filter_order", "step").agg(
        total("n", "kept_", "kept"), total("n", "removed_", "removed"),
        total("n", "redundant_", "redundant"), total("n", "unique_", "unique_fails"),
        total("good", "removed_", "good_lost"), total("toxic", "removed_", "toxic_lost"),
        total("n", "shapley_", "shapley"))


def report_sql() -> str:
    """DuckDB SQL for ``audit``."""
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
firsts AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
l AS (
  SELECT doc_id, max((quality = 1)::INT) AS g, max((toxic = 1)::INT) AS x FROM labels GROUP BY 1),
f AS (
  SELECT part, CASE WHEN len(ws) < {MIN_WORDS} THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(ws)) < {DISTINCT_SHARE} * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {CAPITAL_SHARE} * length(t)
         THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN d.doc_id > least THEN 'E' ELSE '' END AS mask,
    coalesce(g, 0) AS g, coalesce(x, 0) AS x
  FROM d JOIN firsts USING (t) LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(g) AS g, sum(x) AS x FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
o AS (
  SELECT '' AS filter_order UNION ALL
  SELECT filter_order || letter FROM o, letters
  WHERE length(filter_order) < 5 AND NOT contains(filter_order, letter)),
steps AS (
  SELECT filter_order, step::INT AS step, filter_order[step] AS letter,
    left(filter_order, (step - 1)::INT) AS before
  FROM o, range(1, 6) AS r(step) WHERE length(filter_order) = 5),
j AS (
  SELECT part, filter_order, step, n, g, x, mask, contains(mask, letter) AS own, letter,
    length(translate(mask, before, '')) < length(mask) AS earlier
  FROM c, steps)
SELECT part, filter_order, step,
  coalesce(sum(n) FILTER (NOT own AND NOT earlier), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (own AND NOT earlier), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (own AND earlier), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = letter), 0)::BIGINT AS unique_fails,
  coalesce(sum(g) FILTER (own AND NOT earlier), 0)::BIGINT AS good_lost,
  coalesce(sum(x) FILTER (own AND NOT earlier), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * (120 // nullif(length(mask), 0))) FILTER (own), 0)::BIGINT AS shapley
FROM j GROUP BY ALL
"""
