"""Benchmark passages in documents, also with other numbers, names and units.

Both sides are brought to templates: numbers, units behind a number and names
(capitalised words inside a sentence) become typed placeholders, the rest lower
case. Windows of ``WINDOW`` template words are hash-joined. A first pass probes the key
of every window of all documents; only documents with a hit are compared window by
window with their slots.

Windows that match with the same shift are one alignment. Its slots have to be
consistent: one value of the item stands for one value of the document wherever
it occurs. Windows with a value that breaks this are left out unless their own values
are the item's. A document is contaminated by an item if the rest covers half of the
item's words or ``RUN`` of them in a row; for half of them, each value that an
alignment breaks counts as one word against it.

Only DataFrame functions are used. Windows of the benchmark are broadcast if
they are few, else joined by a shuffle.

Defined results: null or empty texts and items match nothing; an item with fewer
words than a window matches only a document that is this item as a whole; repeated
rows give one row for each (doc_id, item_id); null ids are ids like any other;
empty tables give an empty result; other columns are kept by ``drop_contaminated``
and play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm import texts

WINDOW = 6
SHARE = 0.5
RUN = 13
SMALL = 1_000_000  # rows of a few dozen bytes that may be broadcast

SPACES = " \t\n\x0b\x0c\r"
NAME = r"\p{Lu}(?<=[\p{Ll}\p{Nd},;] \p{Lu})[\p{L}\p{M}'-]*"
NUMBER = r"(?<![\p{L}\p{Nd}])[+-]?\p{Nd}+(?:[.,:/]\p{Nd}+)*"
# fixed values: common units
UNITS = ["km", "cm", "mm", "m", "mi", "miles", "ft", "feet", "inches", "kg", "g", "mg", "lb", "lbs",
         "pounds", "tons", "l", "ml", "liters", "litres", "s", "sec", "seconds", "min", "minutes",
         "h", "hours", "days", "weeks", "months", "years", "mph", "kmh", "km/h", "m/s", "%",
         "percent", "dollars", "cents", "euros", "usd", "eur", "degrees", "kw", "kwh", "w", "v"]
UNIT = r"(?i)(?<=<num> ?)(?:" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{Nd}])"
CURRENCY = r"[$€£](?=<num>)"


def _plain(text: F.Column) -> F.Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))


def template(text: F.Column) -> F.Column:
    """The text with placeholders, in lower case; as many words as before."""
    named = F.regexp_replace(text, NAME, "<name>")
    numbered = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        named, NUMBER, "<num>"), UNIT, "<unit>"), CURRENCY, "<unit>")
    return F.lower(F.when(text.rlike(r"\p{Nd}"), numbered).otherwise(named))


def _words(text: F.Column) -> F.Column:
    return F.split(text, "[\\x20\\x09-\\x0D]+")


def _starts(words: F.Column) -> F.Column:
    return F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW, F.lit(0)))


def _key(words: F.Column, start: F.Column) -> F.Column:
    return F.xxhash64(F.slice(words, start + 1, WINDOW))


def probes(table: DataFrame, ids: list[str], text: str) -> DataFrame:
    """The ids with the key of every window."""
    plain = table.select(*ids, _plain(table[text]).alias("t")).where("t <> ''")
    words = plain.select(*ids, _words(template(F.col("t"))).alias("w"))
    return words.select(*ids, F.explode(F.transform(
        _starts(F.col("w")), lambda i: _key(F.col("w"), i))).alias("key"))


def windows(table: DataFrame, ids: list[str], text: str) -> DataFrame:
    """The ids with every window: its place, key and the values in its slots."""
    plain = table.select(*ids, _plain(table[text]).alias("t")).where("t <> ''")
    words = plain.select(*ids, F.arrays_zip(
        _words(F.col("t")).alias("raw"), _words(template(F.col("t"))).alias("w")).alias("both"))
    # columns of their own, so that no window computes them anew
    words = words.select(*ids, "both", F.col("both.w").alias("w"))

    def one(i: F.Column) -> F.Column:
        slots = F.filter(F.slice("both", i + 1, WINDOW),
                         lambda x: x["w"].rlike("<(num|unit|name)>"))
        return F.struct(i.alias("at"), _key(F.col("w"), i).alias("key"), F.transform(
            slots, lambda x: F.regexp_replace(x["raw"], r"[^\p{L}\p{Nd}.,]|[.,]+$", "")
        ).alias("slots"))

    return words.select(*ids, F.size("w").alias("size"), F.explode(
        F.transform(_starts(F.col("both")), one)).alias("x")).select(*ids, "size", "x.*")


def _small(table: DataFrame) -> DataFrame:
    """The stored table, to be broadcast if it is small."""
    return F.broadcast(table) if table.count() <= SMALL else table


def _row(documents: DataFrame) -> F.Column:
    """Tells rows apart that share a doc_id."""
    return F.xxhash64(documents["doc_id"], documents["text"])


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched words of the item, its words and their share."""
    return contaminated_rows(documents, benchmark).groupBy(
        "doc_id", "item_id", "n_item_words").agg(F.max("n_words").alias("n_words")).withColumn(
        "share", F.col("n_words") / F.col("n_item_words"))


def contaminated_rows(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, row, item_id, n_item_words and n_words of the rows with an item's passage."""
    texts_ = documents.select("doc_id", "text")
    row = _row(documents)
    items = texts.stored(windows(benchmark.select("item_id", "text"), ["item_id"], "text"))
    keys = _small(texts.stored(items.select("key").distinct()))
    probed = probes(texts_.withColumn("row", row), ["row"], "text")
    hit = _small(texts.stored(probed.join(keys, "key", "left_semi").select("row").distinct()))
    found = windows(texts_.withColumn("row", row).join(hit, "row", "left_semi"),
                    ["doc_id", "row"], "text")
    matches = texts.stored(
        found.select("doc_id", "row", "at", "key", "slots")
        .join(_small(items.select("item_id", "key", F.col("size").alias("n_item_words"),
                                  F.col("at").alias("place"), F.col("slots").alias("given"))),
              "key")
        .select("doc_id", "row", "item_id", "n_item_words", "place",
                (F.col("at") - F.col("place")).alias("shift"), "slots", "given").distinct())
    alignment = ["doc_id", "row", "item_id", "shift"]
    values = matches.where(F.size("given") > 0).select(
        *alignment, F.explode(F.arrays_zip("given", "slots")).alias("v"))
    lower = {c: F.transform(c, F.lower) for c in ("given", "slots")}
    broken = (values.groupBy(*alignment, F.lower(F.col("v.given")).alias("value"))
              .agg(F.min(F.lower("v.slots")).alias("low"), F.max(F.lower("v.slots")).alias("high"))
              .where("low <> high").groupBy(*(F.col(c).alias(f"broken_{c}") for c in alignment))
              .agg(F.collect_set("value").alias("wrong")))
    same = [F.col(c).eqNullSafe(F.col(f"broken_{c}")) for c in alignment]
    whole = F.col("wrong").isNull()
    # level 0 has the windows of unbroken alignments alone, level 1 has all
    pair = ["doc_id", "row", "item_id", "n_item_words", "level"]
    good = (matches.join(broken, same, "left").select(*matches.columns, "wrong")
            .where(whole | (lower["given"] == lower["slots"])
                   | ~F.arrays_overlap(lower["given"], "wrong"))
            .withColumn("against", F.when(whole, 0).otherwise(F.size("wrong")))
            .withColumn("level", F.explode(F.when(whole, F.array(F.lit(0), F.lit(1)))
                                           .otherwise(F.array(F.lit(1)))))
            .groupBy(*pair, "place").agg(F.max("against").alias("against")))
    # words of the item under the windows, and the longest run of them
    own = Window.partitionBy("doc_id", "row", "item_id", "level")
    gap = F.col("place") - F.lag("place").over(own.orderBy("place"))
    steps = good.withColumn("gap", gap).withColumn(
        "run", F.count_if(F.col("gap").isNull() | (F.col("gap") > 1)).over(
            own.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
    width = F.least(F.lit(WINDOW), F.col("n_item_words"))
    runs = steps.groupBy(*pair, "run").agg(
        F.max("against").alias("against"),
        F.sum(F.least(width, F.coalesce("gap", width))).alias("words"),
        (F.count("*") - 1 + F.max(width)).alias("longest"))
    pairs = runs.groupBy(*pair).agg(
        F.max("against").alias("against"),
        F.sum("words").cast("int").alias("n_words"), F.max("longest").alias("longest"))
    return (pairs.where((F.col("n_words") - F.col("against") >= SHARE * F.col("n_item_words"))
                        | (F.col("longest") >= RUN))
            .select("doc_id", "row", "item_id", "n_item_words", "n_words"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold an item's passage, with their columns."""
    bad = _small(texts.stored(contaminated_rows(documents, benchmark).select(
        F.col("doc_id").alias("__bad_doc"), F.col("row").alias("__bad_row")).distinct()))
    same = (documents["doc_id"].eqNullSafe(bad["__bad_doc"])
            & (_row(documents) == bad["__bad_row"]))
    return documents.join(bad, same, "left_anti")
