"""Joining a table with a lookup that holds one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.functions.columns import ref, require
from riskpanel.operators.series import DuplicateKeys

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_PARTS = 4


def attach(df: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left",
           check_unique: bool = True, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Equi-join with a lookup of one row per key; ``left`` keeps every row of ``df``.

    The lookup is measured first. Up to ``broadcast_bytes`` it is broadcast. A
    larger one is joined by a shuffle in which each key that holds more than a
    quarter of a partition's share of the rows is salted, so no single key fills
    a task. Rows with a NULL key have no match and stay out of the join.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join: {how}")
    require(df, keys)
    require(lookup, keys)
    clash = (set(df.columns) & set(lookup.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    lookup = lookup.select(*[
        ref(c).cast(df.schema[c].dataType).alias(c) if c in keys else ref(c)
        for c in lookup.columns])
    if _measured_bytes(lookup, keys, check_unique) <= broadcast_bytes:
        return _ordered(df, lookup, keys, df.join(F.broadcast(lookup), keys, how))
    return _ordered(df, lookup, keys, _salted_join(df, lookup, keys, how))


def _ordered(df: DataFrame, lookup: DataFrame, keys: list[str], joined: DataFrame) -> DataFrame:
    added = [c for c in lookup.columns if c not in keys]
    return joined.select(*[ref(c) for c in [*df.columns, *added]])


def _measured_bytes(lookup: DataFrame, keys: list[str], check_unique: bool) -> int:
    """Bytes of the lookup from its row count and the real length of its text."""
    fixed, text = 0, F.lit(0).cast("long")
    for field in lookup.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            text = text + F.coalesce(F.octet_length(ref(field.name)), F.lit(0))
            fixed += 16
        elif isinstance(field.dataType, T.AtomicType):
            fixed += 16
        else:
            return 1 << 62
    sized = lookup.select(*[ref(k) for k in keys], text.alias("_text"))
    if not check_unique:
        row = sized.agg(F.count(F.lit(1)).alias("n"), F.sum("_text").alias("text")).first()
        return row["n"] * fixed + (row["text"] or 0)
    grouped = sized.groupBy(*[ref(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_text").alias("text"))
    row = grouped.agg(F.sum("n").alias("n"), F.max("n").alias("worst"),
                      F.sum("text").alias("text")).first()
    if (row["worst"] or 0) > 1:
        raise DuplicateKeys(f"a key of {keys} has {row['worst']} rows in the lookup")
    return (row["n"] or 0) * fixed + (row["text"] or 0)


def _salted_join(df: DataFrame, lookup: DataFrame, keys: list[str], how: str) -> DataFrame:
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*[ref(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    # at most HOT_PARTS * salts keys can each hold more than this
    threshold = max(total // (HOT_PARTS * salts), 1)
    # each gets salts by its own rows: all of them have a few for each partition together
    hot = counts.where(F.col("_n") > threshold).withColumn(
        "_salts", F.least(F.ceil(F.col("_n") / threshold), F.lit(salts)).cast("int"))
    hot = hot.drop("_n").collect()
    if not hot:
        return df.join(lookup, keys, how)
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField("_salts", T.IntegerType())])
    marks = F.broadcast(df.sparkSession.createDataFrame(hot, schema))
    # the row and its scan partition: the same when a task is run again, whatever the
    # partitioning of the table; equal rows of one partition share a salt
    row = [ref(c) for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)]
    # rows with a NULL key match nothing wherever they are
    incomplete = F.lit(False)
    for k in keys:
        incomplete = incomplete | ref(k).isNull()
    own = F.coalesce("_salts", F.lit(1))
    spreads = F.when(incomplete, F.lit(salts)).otherwise(own)
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *row), F.lit(salts)).cast("int")
    salted = (df.withColumn("_part", salt).join(marks, keys, "left")
              .withColumn("_salt", F.pmod("_part", spreads)).drop("_salts", "_part"))
    spread = (lookup.join(marks, keys, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), own - 1))).drop("_salts"))
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")
