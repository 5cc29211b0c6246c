"""Command line: ``python -m riskpanel run|profile|validate``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from riskpanel.operators.correlation import correlation_matrix
from riskpanel.operators.profile import profile_tables
from riskpanel.operators.schema import coerce, violation_report
from riskpanel.plans.job import run_job
from riskpanel.plans.prepare import CUTOFF, SYMBOL, TEST_START, VAL_START
from riskpanel.session import build_session
from riskpanel.sources.outputs import save_profile
from riskpanel.sources.panel import read_panel_csv
from riskpanel.sources.prices import read_prices


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="riskpanel", description=__doc__)
    root.add_argument("--master", help="Spark master; leave unset under spark-submit")
    commands = root.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="validate, prepare, tune, fit and evaluate")
    run.add_argument("--panel", required=True, help="panel CSV with a header row")
    run.add_argument("--prices", required=True, help="Parquet table of symbol, Date, Close")
    run.add_argument("--output", required=True, help="folder for all results")
    run.add_argument("--cutoff", default=CUTOFF)
    run.add_argument("--val-start", default=VAL_START)
    run.add_argument("--test-start", default=TEST_START)
    run.add_argument("--category", default="INDUSTRY2")
    run.add_argument("--label", default="Y")
    run.add_argument("--symbol", default=SYMBOL)
    run.add_argument("--fit-on", choices=("all", "train"), default="all")
    run.add_argument("--trials", type=int, default=30)
    run.add_argument("--parallelism", type=int, default=1)
    run.add_argument("--seed", type=int, default=42)
    for name, text in (("profile", "write every profile section"),
                       ("validate", "print the rules the panel breaks")):
        command = commands.add_parser(name, help=text)
        command.add_argument("--panel", required=True, help="panel CSV with a header row")
    commands.choices["profile"].add_argument("--output", required=True)
    return root


def _print(table: DataFrame) -> None:
    """All rows of a small table."""
    table.show(max(table.count(), 1), truncate=False)


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = build_session(options.master)
    raw = read_panel_csv(spark, options.panel)
    if options.command == "validate":
        _print(violation_report(raw).where("n_failed > 0"))
    elif options.command == "profile":
        panel = coerce(raw)
        panel.write.mode("overwrite").parquet(f"{options.output}/panel")  # the CSV is read once
        panel = spark.read.parquet(f"{options.output}/panel")
        tables = profile_tables(panel)
        tables["correlation_cells"] = correlation_matrix(panel, digits=2)
        save_profile(tables, options.output)
    else:
        done = run_job(spark, raw, read_prices(spark, options.prices),
                       category_col=options.category, cutoff=options.cutoff,
                       val_start=options.val_start, test_start=options.test_start,
                       symbol=options.symbol, label_col=options.label, fit_on=options.fit_on,
                       n_trials=options.trials, parallelism=options.parallelism,
                       seed=options.seed, output=options.output)
        for table in (done.metrics, done.confusion, done.importance):
            _print(table)


if __name__ == "__main__":
    main()
