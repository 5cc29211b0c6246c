"""One-hot encoding of any number of categories: one sparse vector for each row.

The categories stay in a table, with a slot each: slots follow the columns and, within a
column, the sorted categories. They are numbered by ranges, and rows find theirs by a
join that is broadcast or salted by measured size and heat. A row holds its slots alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.functions.columns import ref, require
from riskpanel.operators.attach import BROADCAST_BYTES, attach
from riskpanel.operators.encode import code_of
from riskpanel.session import kept, shared_folder

#: The form in which Spark ML writes a sparse vector.
SPARSE = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


@dataclass(frozen=True)
class Categories:
    """``table`` (feature, code, slot, n): each category's slot and its rows when fitted."""

    columns: tuple[str, ...]
    table: DataFrame
    size: int

    def names(self) -> DataFrame:
        """Rows (slot, name): the name a category's own column would have."""
        prefix = F.array(*[F.lit(f"{c}_") for c in self.columns])
        return self.table.select("slot", F.concat(prefix[F.col("feature")], "code").alias("name"))


def fit_categories(df: DataFrame, columns: list[str]) -> Categories:
    """The slots of all categories of the columns. NULL has none."""
    require(df, columns)
    if not columns:
        raise ValueError("no columns to encode")
    spark = df.sparkSession
    cells = df.select(F.stack(F.lit(len(columns)), *[
        x for i, c in enumerate(columns) for x in (F.lit(i), code_of(c))]).alias("feature", "code"))
    counted = cells.where("code IS NOT NULL").groupBy("feature", "code").agg(
        F.count("*").alias("n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = kept(counted.repartitionByRange(parts, "feature", "code")
                  .withColumn("range", F.spark_partition_id()))
    sizes = ranges.groupBy("range").agg(F.count("*").alias("held")).orderBy("range").collect()
    first, size = [], 0
    for r in sizes:  # a row for each shuffle partition
        first.append((r["range"], size))
        size += r["held"]
    starts = spark.createDataFrame(first, "range int, start long")
    within = F.row_number().over(Window.partitionBy("range").orderBy("feature", "code"))
    table = ranges.join(F.broadcast(starts), "range").select(
        "feature", "code", (F.col("start") + within - 1).cast("int").alias("slot"), "n")
    return Categories(tuple(columns), kept(table), size)


def apply_sparse(df: DataFrame, fitted: Categories, output: str = "categories",
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Replace the encoded columns by one sparse vector ``output``, as a struct of Spark's
    layout. NULL and unseen categories have no entry."""
    rest = [c for c in df.columns if c not in fitted.columns]
    if output.lower() in {c.lower() for c in rest}:
        raise ValueError(f"columns already exist: {[output]}")
    found = df.select(*[ref(c).alias(f"r{i}") for i, c in enumerate(rest)],
                      *[code_of(c).alias(f"code{i}") for i, c in enumerate(fitted.columns)])
    for i in range(len(fitted.columns)):
        own = fitted.table.where(F.col("feature") == i).select(
            F.col("code").alias(f"code{i}"), F.col("slot").alias(f"slot{i}"))
        # the table has one row for each category
        found = attach(found, own, [f"code{i}"], broadcast_bytes=broadcast_bytes,
                       check_unique=False).drop(f"code{i}")
    slots = F.array_compact(F.array(*[F.col(f"slot{i}") for i in range(len(fitted.columns))]))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(fitted.size).alias("size"),
                      slots.alias("indices"),
                      F.transform(slots, lambda _: F.lit(1.0)).alias("values"))
    return found.select(*[F.col(f"r{i}").alias(c) for i, c in enumerate(rest)],
                        vector.cast(SPARSE).alias(output))


def vector_schema(schema: T.StructType) -> T.StructType:
    """The schema with every struct of Spark ML's sparse layout as a vector."""
    layout = T._parse_datatype_string(SPARSE).simpleString()
    return T.StructType([
        T.StructField(f.name, VectorUDT()) if f.dataType.simpleString() == layout else f
        for f in schema.fields])


def as_vectors(df: DataFrame, path: str | None = None) -> DataFrame:
    """The table, written once, with its structs read back as Spark ML's vectors."""
    path = path or shared_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(vector_schema(df.schema)).parquet(path)
