"""The panel and price tables that the registered queries run on.

They are views of the star schema: orders are the panel rows, customers the
firms, and daily price series are taken from the order prices. Missing values
are set by key so that a column falls on either side of the winsorizing limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.operators.attach import attach

# Fixed values of the registered queries: split dates and the market symbol.
CUTOFF = "1996-01-01"
VAL_START = "1999-01-01"
TEST_START = "2000-07-01"
MARKET = "ALL"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_with_customer(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Orders with columns of their customer."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), *columns)
    return attach(table(spark, sf_dir, "orders"), customer, ["o_custkey"], how="inner",
                  check_unique=False)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    rows = orders_with_customer(spark, sf_dir, ["c_acctbal", "c_mktsegment", "c_nationkey"])
    return rows.select(
        key, F.col("o_custkey").alias("firm"), F.col("o_orderdate").alias("Date"),
        price.alias("x1"), F.col("c_acctbal").alias("x2"),
        F.when(key % 19 != 0, price).alias("x_many"),
        F.when(key % 25 != 0, price).alias("x_few"),
        F.when(key % 50 != 0, F.col("c_mktsegment")).alias("cat"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (key * 7919 % 1000 / F.lit(1000.0)).alias("score"),
        F.col("c_nationkey").alias("nation"))


def scored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with a hard class; ``price_score`` is a score with few ties."""
    return panel(spark, sf_dir).select(
        "*", (F.col("score") > 0.5).cast("int").alias("prediction"),
        (F.col("x1") / 1e6).alias("price_score"))


def flow_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel in the shape of the whole flow: text identifiers, features, label."""
    return panel(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("CompNo"),
        F.concat(F.lit("firm "), F.col("firm").cast("string")).alias("Company_name"),
        "Date", "x1", "x2", "x_many", "x_few", F.col("cat").alias("INDUSTRY2"),
        F.col("y").alias("Y"))


def nation_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price series per nation: the day's highest order price."""
    rows = orders_with_customer(spark, sf_dir, ["c_nationkey"])
    return rows.groupBy(F.col("c_nationkey").alias("symbol"),
                        F.col("o_orderdate").cast("date").alias("Date")).agg(
        F.max("o_totalprice").alias("Close"))


def market_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price series over all orders."""
    return table(spark, sf_dir, "orders").groupBy(
        F.lit(MARKET).alias("symbol"), F.col("o_orderdate").cast("date").alias("Date")).agg(
        F.max("o_totalprice").alias("Close"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with numeric and category features."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return labels.join(documents, "doc_id")
