"""The exact rank search against sorting, through every number of steps."""

import numpy as np
import pandas as pd
import pytest

from riskpanel.operators.ranks import count_columns, values_at_ranks

N = 20_000


@pytest.fixture(scope="module")
def numbers(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "smooth": rng.normal(size=N),
        "three": rng.integers(0, 3, N).astype(float),
        "hot": np.where(rng.random(N) < 0.4, 7.0, rng.exponential(size=N) * 10),
        "gaps": np.where(rng.random(N) < 0.05, np.nan, rng.random(N)),
        "same": np.full(N, 0.1),
        "endless": rng.choice([-np.inf, np.inf, 0.0, -0.0, 1.5, 5e-324], N),
        "wild": np.where(rng.random(N) < 0.001, 1e300, rng.random(N) * 1e-300),
    })
    path = str(tmp_path_factory.mktemp("ranks") / "numbers")
    spark.createDataFrame(pdf).repartition(6).write.parquet(path)
    return spark.read.parquet(path), pdf


@pytest.mark.parametrize("gather_rows,sample_rows", [
    (1_000_000, 1_000_000), (2_000, 1_000_000), (2_000, 300), (50, 200), (1, 20)])
def test_values_equal_sorting(numbers, gather_rows, sample_rows):
    df, pdf = numbers
    columns = list(pdf.columns)
    counts = count_columns(df, columns)
    wanted = [0, 1, 777, N // 20, N // 2, int(N * 0.95) - 10, N - 1, N + 5]
    got = values_at_ranks(df, counts, {c: wanted for c in columns}, gather_rows, sample_rows)
    for c in columns:
        ordered = np.sort(pdf[c].dropna().to_numpy())
        assert counts[c].present == len(ordered)
        for rank in wanted:
            expected = ordered[rank] if rank < len(ordered) else None
            assert got[c][rank] == expected, (c, rank)


def test_empty_and_infinite(spark):
    df = spark.createDataFrame([(None, float("inf")), (None, float("-inf")), (None, 1.0)],
                               "a double, b double")
    counts = count_columns(df, ["a", "b"])
    got = values_at_ranks(df, counts, {"a": [0, 1], "b": [0, 1, 2]}, gather_rows=1)
    assert got["a"] == {0: None, 1: None}
    assert got["b"] == {0: float("-inf"), 1: 1.0, 2: float("inf")}
