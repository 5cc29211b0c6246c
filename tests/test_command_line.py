"""The whole job from a CSV file, through the command line."""

import csv
import datetime as dt

import numpy as np
import pytest

from riskpanel.__main__ import main
from riskpanel.operators.schema import PANEL_RULES
from riskpanel.operators.tuning import Range


@pytest.fixture
def files(spark, folder):
    rng = np.random.default_rng(5)
    columns = [r.name for r in PANEL_RULES]
    path = f"{folder}/panel.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(columns)
        for i in range(400):
            day = dt.date(1999, 1, 31) + dt.timedelta(days=25 * (i // 2))
            signal = rng.normal()
            row = {r.name: f"{rng.normal():.6f}" for r in PANEL_RULES if r.dtype == "double"}
            row.update(CompNo=str(i % 7), Company_name=f"Firm, {i % 7}", Date=str(day),
                       INDUSTRY2=str(rng.choice(["10008.0", "10013.0", ""])),
                       dtdlevel="" if rng.random() < 0.1 else f"{signal:.6f}",
                       Y=str(int(signal < -0.8)))
            out.writerow([row[c] for c in columns])
    prices = [("BZ=F", dt.date(1999, 1, 1) + dt.timedelta(days=3 * i), 20.0 + i % 9)
              for i in range(3_300)]
    spark.createDataFrame(prices, "symbol string, Date date, Close double").write.parquet(
        f"{folder}/prices")
    return path, f"{folder}/prices", f"{folder}/out"


def test_run_profile_validate(spark, files, monkeypatch, capsys):
    panel, prices, out = files
    from riskpanel.operators import tuning
    monkeypatch.setattr(tuning, "DEFAULT_SPACE", {
        "num_leaves": Range(4, 8, whole=True), "n_estimators": Range(2, 3, whole=True)})
    main(["run", "--panel", panel, "--prices", prices, "--output", out, "--val-start", "2004-1-1",
          "--test-start", "2008-1-1", "--trials", "2"])
    assert "roc_auc" in capsys.readouterr().out
    for part in ("summary_statistics", "processed", "study/trials", "best_params", "model"):
        assert spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
            f"{out}/{part}").count() > 0, part
    processed = spark.read.parquet(f"{out}/processed")
    assert {"INDUSTRY2_10008", "INDUSTRY2_10013", "Close", "Return", "indicator"} <= set(
        processed.columns)
    assert processed.where("Date <= '2000-01-01'").count() == 0

    main(["profile", "--panel", panel, "--output", f"{out}/profile"])
    assert spark.read.parquet(f"{out}/profile/overview").first()["n_rows"] == 400
    assert spark.read.parquet(f"{out}/profile/correlation").count() == 14 * 14

    main(["validate", "--panel", panel])
    assert "n_failed" in capsys.readouterr().out
