"""Caps, quantiles, extremes and scales of numbers that no double holds."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskpanel.functions.digits import digits, from_digits
from riskpanel.operators import profile
from riskpanel.operators.ranks import count_columns, values_at_ranks
from riskpanel.operators.scale import apply_min_max, fit_min_max
from riskpanel.operators.winsor import apply_winsor, fit_winsor

BASE = 1 << 53
KINDS = {"bigint": st.integers(-(1 << 63), (1 << 63) - 1) | st.integers(BASE - 3, BASE + 3)}
for p, s in ((38, 0), (38, 17), (20, 5), (19, 13), (30, 14)):
    KINDS[f"decimal({p},{s})"] = st.integers(-10 ** p + 1, 10 ** p - 1).map(
        lambda n, s=s: Decimal(n).scaleb(-s)) | st.integers(-5, 5).map(
        lambda n, p=p, s=s: (Decimal(10 ** (p - 1)) + n).scaleb(-s))


@pytest.mark.parametrize("kind", sorted(KINDS))
@settings(max_examples=8, deadline=None, suppress_health_check=[
    HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(data=st.data())
def test_digits_keep_value_and_order(spark, kind, data):
    import decimal

    with decimal.localcontext() as context:
        context.prec = 60
        values = data.draw(st.lists(KINDS[kind], min_size=1, max_size=40))
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        rows = [tuple(r) for r in df.select("v", *[
            d.alias(f"d{i}") for i, d in enumerate(digits(df, "v"))]).collect()]
        for value, *found in rows:
            assert all(abs(d) < BASE for d in found)
            assert from_digits(df.schema["v"].dataType, tuple(found)) == value
        assert [r[0] for r in sorted(rows, key=lambda r: r[1:])] == sorted(r[0] for r in rows)


@pytest.mark.parametrize("gather_rows", [4, 10_000])
@pytest.mark.parametrize("kind", ["bigint", "decimal(20,2)"])
def test_values_at_ranks(spark, kind, gather_rows):
    step = 1 if kind == "bigint" else Decimal("0.01")
    base = BASE if kind == "bigint" else Decimal("123456789012345678")
    values = sorted([base + step * (i % 37) for i in range(150)] + [-base - step * i for i in range(50)])
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, f"v {kind}").repartition(3)
    counts = count_columns(df, ["v"])
    assert counts["v"].exact and (counts["v"].low, counts["v"].high) == (values[0], values[-1])
    ranks = [0, 1, 49, 50, 51, 120, 198, 199, 200]
    found = values_at_ranks(df, counts, {"v": ranks}, gather_rows=gather_rows)["v"]
    assert found == {r: values[r] if r < 200 else None for r in ranks}


def test_neighbours_of_2_53(spark):
    df = spark.createDataFrame([(BASE + i,) for i in range(40)], "v bigint")
    capped = apply_winsor(df, fit_winsor(df, ["v"]))
    assert sorted(r["v"] for r in capped.collect()) == sorted(
        min(max(BASE + i, BASE + 2), BASE + 37) for i in range(40))
    ends = profile.extremes(df, k=2, as_text=True).collect()
    assert {(r["side"], r["position"], r["value"], r["n"]) for r in ends} == {
        ("smallest", 1, str(BASE), 1), ("smallest", 2, str(BASE + 1), 1),
        ("largest", 1, str(BASE + 39), 1), ("largest", 2, str(BASE + 38), 1)}
    points = profile.quantiles(df).first()
    assert (points["range"], points["iqr"], points["mad"]) == (39.0, 19.5, 10.0)
    scaled = sorted(r["v"] for r in apply_min_max(df, fit_min_max(df)).collect())
    assert scaled == pytest.approx([i / 39 for i in range(40)])


def test_small_whole_numbers_take_the_short_way(spark):
    df = spark.createDataFrame([(i,) for i in range(30)], "v bigint")
    assert not count_columns(df, ["v"])["v"].exact
    assert fit_winsor(df, ["v"])[0].low == 1.0


def test_whole_range_and_mixed_types(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    df = spark.createDataFrame(
        [(low, 1.5, Decimal("99999999999999999999.5")), (high, -0.0, Decimal("99999999999999999999.6")),
         (0, float("nan"), None), (high - 1, None, None)],
        "a bigint, b double, c decimal(38,1)")
    ends = {(r["column"], r["side"], r["position"]): r["value"]
            for r in profile.extremes(df, k=2, as_text=True).collect()}
    assert ends["a", "smallest", 1] == str(low) and ends["a", "largest", 2] == str(high - 1)
    assert ends["b", "smallest", 1] == "0.0"
    assert ends["c", "largest", 1] == "99999999999999999999.6"
    plain = {(r["column"], r["side"], r["position"]): r["value"]
             for r in profile.extremes(df, k=1).collect()}
    assert plain["a", "largest", 1] == float(high)
    scaled = apply_min_max(df, fit_min_max(df, ["a", "c"])).orderBy("a").collect()
    assert [r["a"] for r in scaled] == pytest.approx([0.0, 0.5, 1.0, 1.0])
    assert sorted(r["c"] for r in scaled if r["c"] is not None) == [0.0, 1.0]
