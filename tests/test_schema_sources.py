"""Declared schema, CSV and Parquet sources, and written results."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from riskpanel.operators.describe import describe, describe_dates, describe_numbers
from riskpanel.operators.rows import with_split
from riskpanel.operators.schema import (PANEL_RULES, ColumnRule, SchemaViolation, coerce, ingest,
                                        missing_columns, validate, violation_report)
from riskpanel.operators.tuning import best_trial
from riskpanel.sources.outputs import (load_best_params, save_best_params, save_processed,
                                       save_profile, save_summary)
from riskpanel.sources.panel import ingest_panel, read_panel, read_panel_csv
from riskpanel.sources.trials import append_trial, read_trials

NUMBERS = [r.name for r in PANEL_RULES if r.dtype == "double"]


def line(**changes):
    cells = {"CompNo": "12", "Company_name": "Firm, one", "INDUSTRY2": "10008.0",
             "Date": "2001-1-31", "Y": "0", **{n: "0.5" for n in NUMBERS}}
    cells.update(changes)
    return cells


def write_csv(folder, rows, name="panel.csv"):
    columns = sorted(rows[0])  # not the declared order
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write(",".join(columns) + "\n")
        for row in rows:
            f.write(",".join(f'"{row[c]}"' if "," in row[c] else row[c] for c in columns) + "\n")
    return path


def test_csv_is_read_by_name_and_coerced(spark, folder):
    path = write_csv(folder, [line(extra="x"), line(extra="y", StkIndx="NaN", m2b="",
                                                    INDUSTRY2="NA", Date="2001-02-28", Y="1")])
    panel = validate(read_panel_csv(spark, path))
    assert set(missing_columns(panel, PANEL_RULES)) == set()
    types = dict(panel.dtypes)
    assert (types["CompNo"], types["StkIndx"], types["Date"], types["Y"], types["extra"]) == (
        "string", "double", "timestamp_ntz", "int", "string")
    first, second = panel.orderBy("Date").collect()
    assert first["Date"] == dt.datetime(2001, 1, 31) and first["Company_name"] == "Firm, one"
    assert (second["StkIndx"], second["m2b"], second["INDUSTRY2"], second["Y"]) == (
        None, None, None, 1)


def test_every_violation_is_reported(spark, folder):
    rows = [line(), line(CompNo=""), line(STInt="bad"), line(STInt=""), line(Date="31/31/01"),
            line(Y="2"), line(Y="x"), line(sigma="1e-3")]
    for row in rows:
        del row["m2b"]
    raw = read_panel_csv(spark, write_csv(folder, rows))
    report = {(r["column"], r["check"]): r["n_failed"] for r in violation_report(raw).collect()}
    failed = {k: n for k, n in report.items() if n}
    assert failed == {
        ("m2b", "present"): 1, ("CompNo", "not_null"): 1, ("STInt", "convertible"): 1,
        ("STInt", "not_null"): 2, ("Date", "convertible"): 1, ("Date", "not_null"): 1,
        ("Y", "in_domain"): 1, ("Y", "convertible"): 1, ("Y", "not_null"): 1}
    with pytest.raises(SchemaViolation, match="Y: in_domain failed on 1 rows") as caught:
        validate(raw)
    assert len(caught.value.failures) == len(failed)


def test_coerce_turns_nan_into_null(spark):
    rules = (ColumnRule("x", "double"),)
    df = spark.createDataFrame([("NaN", 1), ("1.5", 2), (None, 3)], "x string, keep int")
    assert [tuple(r) for r in coerce(df, rules).orderBy("keep").collect()] == [
        (None, 1), (1.5, 2), (None, 3)]
    assert violation_report(df, rules).where("n_failed > 0").count() == 0


def test_ingest_makes_filters_reach_the_scan(spark, folder):
    path = write_csv(folder, [line(Date=f"2001-{m}-1") for m in range(1, 13)])
    table = ingest_panel(spark, path, f"{folder}/panel")
    assert read_panel(spark, f"{folder}/panel").count() == 12
    from riskpanel.operators.rows import after_cutoff
    recent = after_cutoff(table, "2001-06-01").select("CompNo")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Date), GreaterThan(Date,2001-06-01T00:00)]" in plan
    assert "ReadSchema: struct<CompNo:string,Date:timestamp_ntz>" in plan
    assert recent.count() == 6


def test_processed_table_is_pruned_by_split(spark, folder):
    rows = [(i, dt.datetime(2020, 1, 1) + dt.timedelta(days=i)) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, Date timestamp_ntz")
    save_processed(with_split(df, "2020-01-04", "2020-01-07"), f"{folder}/processed")
    val = spark.read.parquet(f"{folder}/processed").where("indicator = 'val'")
    assert "PartitionFilters: [isnotnull(indicator" in (
        val._jdf.queryExecution().executedPlan().toString())
    assert sorted(r["id"] for r in val.collect()) == [3, 4, 5]


def test_describe_layout_and_file(spark, folder):
    rows = [(float(i) if i else None, i, dt.datetime(2020, 1, 1) + dt.timedelta(days=i))
            for i in range(5)]
    df = spark.createDataFrame(rows, "x double, n int, Date timestamp_ntz")
    numbers = {r["column"]: r for r in describe_numbers(df).collect()}
    assert tuple(numbers["x"])[1:7] == (4, 2.5, 1.0, 1.75, 2.5, 3.25)
    assert numbers["n"]["std"] == pytest.approx(1.5811388)
    dates = describe_dates(df).first()
    assert dates["mean"] == dates["50%"] == dt.datetime(2020, 1, 3)
    assert (dates["min"], dates["25%"], dates["std"]) == (
        dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2), None)
    save_summary(describe(df), f"{folder}/summary")
    stored = spark.read.option("header", True).csv(f"{folder}/summary").collect()
    assert [tuple(r) for r in stored][1] == ("mean", "2.5", "2.0", "2020-01-03 00:00:00")
    assert stored[7]["Date"] is None


def test_dates_keep_microseconds_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-03-10 02:30:00.000001'),"
                       "(TIMESTAMP_NTZ'2024-03-10 02:30:00.000004') t(ts)")
        row = describe_dates(df).first()
        assert row["min"] == dt.datetime(2024, 3, 10, 2, 30, 0, 1)
        assert row["mean"] == row["50%"] == dt.datetime(2024, 3, 10, 2, 30, 0, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_trials_table(spark, folder):
    assert read_trials(spark, folder).count() == 0
    for t, metric in ((2, 0.5), (0, 0.5), (1, 0.25), (1, 0.25)):
        append_trial(spark, folder, "first", ("s", t, {"a": float(t)}, metric, None))
    append_trial(spark, folder, "first", ("other", 0, {"a": 8.0}, 0.8, None))
    append_trial(spark, folder, "second", ("s", 0, {"a": 9.0}, 0.9, None))
    assert read_trials(spark, folder, "first").count() == 4
    trials = read_trials(spark, folder, "first", "s")
    assert sorted(r["trial_id"] for r in trials.collect()) == [0, 1, 2]
    best = best_trial(trials)
    assert tuple(best.first()) == (0, {"a": 0.0}, 0.5)  # the earliest on a tie
    save_best_params(best, f"{folder}/best")
    assert load_best_params(spark, f"{folder}/best") == {"a": 0.0}


def test_best_params_are_one_json_object(spark, folder):
    trials = spark.createDataFrame([(0, {"n": 3.0, "rate": 0.25}, 0.5)],
                                   "trial_id int, params map<string,double>, metric double")
    save_best_params(best_trial(trials), f"{folder}/best")
    import glob
    (part,) = glob.glob(f"{folder}/best/part-*.json")
    with open(part) as f:
        assert json.load(f) == {"n": 3.0, "rate": 0.25}


def test_profile_sections_are_stored(spark, folder):
    from riskpanel.operators.profile import profile_tables
    df = spark.createDataFrame([(1.0, "a", dt.date(2020, 1, 1)), (2.0, "a", None)],
                               "x double, c string, d date")
    save_profile(profile_tables(df, k=3, bins=2), f"{folder}/profile")
    assert spark.read.parquet(f"{folder}/profile/overview").first()["missing_cells"] == 1
    histogram = spark.read.parquet(f"{folder}/profile/histogram").agg(F.sum("n")).first()[0]
    assert histogram == 2


def test_trials_recorded_at_the_same_time_all_stay(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda t: append_trial(spark, folder, "e x/1", (
            "s", t, {"a": 1.0}, float(t), None)), range(24)))
    append_trial(spark, folder, "e x/1", ("s", 3, {"a": 2.0}, 3.5, None))  # again
    rows = {r["trial_id"]: r["metric"] for r in read_trials(spark, folder, "e x/1", "s").collect()}
    assert rows == {t: 3.5 if t == 3 else float(t) for t in range(24)}


def test_rows_with_other_cells_and_other_headers_are_reported(spark, folder):
    import os

    os.makedirs(f"{folder}/csv")
    with open(f"{folder}/csv/a.csv", "w") as f:
        f.write("CompNo,STInt,Y\n1,0.5,0\n2,0.6,0,extra,cells\n3,0.7\n")
    raw = read_panel_csv(spark, f"{folder}/csv")
    rules = (ColumnRule("CompNo", "string"), ColumnRule("STInt", "double"), ColumnRule("Y", "int"))
    found = {(r["column"], r["check"]): r["n_failed"] for r in violation_report(raw, rules).collect()}
    assert found["(row)", "cells"] == 2
    with pytest.raises(SchemaViolation, match="cells failed on 2 rows"):
        ingest(raw, f"{folder}/table", rules)
    with open(f"{folder}/csv/b.csv", "w") as f:
        f.write("Y,CompNo,STInt\n0,4,0.8\n")
    with pytest.raises(Exception, match="[Hh]eader"):
        read_panel_csv(spark, f"{folder}/csv").collect()


def test_ingest_keeps_what_validate_keeps(spark, folder):
    rows = spark.createDataFrame([("1", "1.0", "1/31/2000"), ("2", "0", "20000131")],
                                 "k string, Y string, Date string")
    rules = (ColumnRule("k", "string"), ColumnRule("Y", "int", False, (0, 1)),
             ColumnRule("Date", "timestamp_ntz", False))
    a, b = validate(rows, rules), ingest(rows, f"{folder}/t", rules)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert {str(r["Date"]) for r in b.collect()} == {"2000-01-31 00:00:00"}
    assert a.schema == b.schema
