"""Run registered queries next to their SQL and compare whole results.

``python -m tests.compare <sf_dir> [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.sql(sql)
    return sorted(result.columns), _sorted_rows(result.columns, result.fetchall())


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
               "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def type_differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.sql(sql)
    theirs = dict(zip(result.columns, [str(t) for t in result.types]))
    ours = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}
    return [f"{c}: {ours[c]} / {theirs.get(c)}" for c in ours if ours[c] != theirs.get(c)]


def compare(spark: SparkSession, con, sf_dir: str, build, sql: str) -> list[str]:
    """The differences found, empty when both sides agree."""
    df = build(spark, sf_dir)
    columns, rows = spark_rows(df)
    sql_columns, wanted = sql_rows(con, sql)
    if columns != sql_columns:
        return [f"columns {columns} / {sql_columns}"]
    problems = type_differences(df, con, sql)
    if len(rows) != len(wanted):
        problems.append(f"rows {len(rows)} / {len(wanted)}")
    problems += [f"{a} / {b}" for a, b in zip(rows, wanted) if a != b][:3]
    return problems


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from riskpanel.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(sf_dir), oracle_sql()
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, sf_dir, build, oracles[name])
            else:
                problems = [] if build(spark, sf_dir).collect() else ["no rows"]
        except Exception as exc:  # report and go on to the next query
            problems = [f"{type(exc).__name__}: {str(exc)[:600]}"]
        state = "ok  " if not problems else "DIFF"
        print(f"{state} {name} {time.time() - start:.2f}s "
              f"{'' if name in oracles else '(rows only) '}{problems or ''}", flush=True)


if __name__ == "__main__":
    main()
