import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from crivo.operators import order
from crivo.operators.score import breakdown, score
from crivo.spec import Factor


def sample(n=600, seed=0):
    rng = np.random.default_rng(seed)
    table = pd.DataFrame(
        {
            "g": rng.choice(["x", "y", "z"], n, p=[0.7, 0.2, 0.1]),
            "id": np.arange(n),
            "a": np.round(rng.normal(0, 5, n), 1),
            "P/VP": rng.random(n) * 10.0 ** rng.integers(-6, 7, n),
        }
    )
    table.loc[rng.random(n) < 0.3, "a"] = 0.0  # a hot value
    table.loc[rng.random(n) < 0.1, "a"] = np.nan
    return table


@pytest.fixture(params=[10**6, 3], ids=["one block", "split"])
def split(request, monkeypatch):
    monkeypatch.setattr(order, "SPLIT_ABOVE", request.param)


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("missing_counts", [True, False])
@pytest.mark.parametrize("small_groups", [True, False])
def test_percentiles_match_pandas(spark, split, by, missing_counts, small_groups):
    table = sample()
    got = order.percentiles(
        spark.createDataFrame(table), by, ["id"], ["a", "P/VP"], missing_counts, small_groups=small_groups
    ).toPandas().sort_values("id")
    for column in ["a", "P/VP"]:
        source = table.groupby("g")[column] if by else table[column]
        expected = source.rank(pct=True, na_option="bottom" if missing_counts else "keep") * 100
        np.testing.assert_allclose(got[f"pct_{column}"].to_numpy(float), expected.to_numpy(), rtol=1e-12)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_match_numpy(spark, split, by):
    table = sample()
    wanted = {"q1": ("a", 0.25), "q2": ("P/VP", 0.75), "q3": ("a", 0.5), "low": ("a", 0.0), "high": ("a", 1.0)}
    got = order.quantiles(spark.createDataFrame(table), by, wanted).toPandas()
    for name, (column, q) in wanted.items():
        if by:
            expected = table.groupby("g")[column].quantile(q)
            np.testing.assert_array_equal(got.set_index("g")[name].sort_index(), expected.sort_index())
        else:
            assert got[name][0] == table[column].quantile(q)


def test_close_values_share_a_block_and_are_still_told_apart(spark, monkeypatch):
    """Ids and time stamps: all values within a few steps of each other, and the extremes of double."""
    monkeypatch.setattr(order, "SPLIT_ABOVE", 3)
    values = [1.7e9 + i / 16 for i in range(300)] + [-1.7e9 - i / 16 for i in range(300)]
    values += [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1e-300, float("inf"), -float("inf"), 1.0, -1.0]
    table = pd.DataFrame({"id": range(len(values)), "v": values})
    got = order.percentiles(spark.createDataFrame(table), [], ["id"], ["v"]).toPandas().sort_values("id")
    np.testing.assert_allclose(got["pct_v"], table["v"].rank(pct=True) * 100, rtol=1e-12)


def test_constant_predictions_score_fifty(spark):
    df = spark.createDataFrame([("x", 1, 3.0), ("x", 2, 3.0), ("x", 3, None), ("y", 1, None)], "g string, id int, v double")
    for small in (True, False):
        got = order.percentiles(df, ["g"], ["id"], ["v"], missing_counts=False, small_groups=small).collect()
        assert {(r.g, r.id): r.pct_v for r in got} == {("x", 1): 50.0, ("x", 2): 50.0, ("x", 3): 50.0, ("y", 1): None}


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id int, v double")
    got = {r.id: r.pct_v for r in order.percentiles(df, [], ["id"], ["v"]).collect()}
    assert got == {1: 100.0, 2: 50.0}


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, 20), ("a", 1, 10), (None, 4, 40), (None, 3, 30)], "k string, _seq int, v int").repartition(4)
    assert {(r.k, r.v) for r in order.keep_first(df, ["k"]).collect()} == {("a", 10), (None, 30)}
    assert {(r.k, r.v) for r in order.keep_last(df, ["k"]).collect()} == {("a", 20), (None, 40)}


def test_top_n_limits_each_group_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as g", "id")
    plan = order.top_n(df, ["g"], [F.col("id").desc()], 2, "p")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


FACTORS = [Factor("a", 0.6, "max"), Factor("P/VP", 0.3, "min"), Factor("absent", 0.1, "max")]


@pytest.mark.parametrize("small_groups", [True, False])
def test_score(spark, small_groups):
    table = sample(200)
    up = table["a"].rank(pct=True, na_option="bottom") * 100
    down = 100 - table["P/VP"].rank(pct=True, na_option="bottom") * 100
    expected = ((up * 0.6 + down * 0.3) / (0.6 + 0.3)).clip(0, 100).round(1)
    got = score(spark.createDataFrame(table), FACTORS, [], ["id"], small_groups=small_groups).toPandas().sort_values("id")
    np.testing.assert_allclose(got["Score"], expected)


def test_score_does_not_depend_on_row_order(spark):
    table = sample(300)
    first = score(spark.createDataFrame(table), FACTORS, ["g"], ["id"]).toPandas().sort_values("id")["Score"]
    again = score(spark.createDataFrame(table.sample(frac=1, random_state=1)).repartition(7), FACTORS, ["g"], ["id"])
    np.testing.assert_array_equal(first, again.toPandas().sort_values("id")["Score"])


def test_score_without_factors_is_zero(spark):
    assert score(spark.range(2), FACTORS, [], ["id"]).select("Score").distinct().collect()[0][0] == 0.0


def test_breakdown(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, None, 4.0)], "id int, a double, `P/VP` double")
    rows = {(r.id, r.factor): (r.value, r.percentile, r.weight, r.direction) for r in breakdown(df, FACTORS, [], ["id"]).collect()}
    assert rows[(1, "a")] == (1.0, 50.0, 0.6, "max")
    assert rows[(2, "a")] == (None, None, 0.6, "max")
    assert rows[(1, "P/VP")] == (5.0, 0.0, 0.3, "min")


def test_a_split_group_is_ranked_in_many_tasks(spark, monkeypatch):
    """One group of distinct values on both sides of 0: its rows are dealt by leaf to the windows, not by group."""
    monkeypatch.setattr(order, "SPLIT_ABOVE", 100)
    df = spark.range(6000).selectExpr("'g' as g", "id", "(id * 7919 % 6000 - 3000) / 1000D as v")
    long = order._melted(df, ["g"], [], ["v"])
    # As for a large table: its facts are joined by a shuffle, and no small partitions are merged.
    large = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in large}
    try:
        for name, value in large.items():
            spark.conf.set(name, value)
        plan = order.value_counts(long, ["g"])._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    steps = [line for line in plan.splitlines() if any(word in line for word in (" Window ", "Exchange", "Join"))]
    first = next(i for i, line in enumerate(steps) if " Window " in line and "_leaf" in line)
    below = next(line for line in steps[first:] if " Window " not in line)
    assert "Exchange hashpartitioning" in below and "_leaf" in below, below
    wrong = order.percentiles(df, ["g"], ["id"], ["v"]).join(df, "id").where("abs(pct_v - (v * 1000 + 3001) / 60) > 1e-9")
    assert wrong.count() == 0


@pytest.mark.parametrize("missing_counts", [True, False])
def test_percentiles_beside_the_rows(spark, monkeypatch, missing_counts):
    """By windows and by lookup: the percentiles that the keyed form gives; two rows may share a key."""
    rows = [("x", 1, 3.0), ("x", 2, 1.0), ("x", 2, 3.0), ("x", 3, None), ("y", 1, 7.0), ("y", 2, 7.0), (None, 1, 2.0), ("z", 1, None)]
    df = spark.createDataFrame(rows, "g string, id int, v double").withColumn("row", F.monotonically_increasing_id())
    keyed = {r.row: r.pct_v for r in order.percentiles(df, ["g"], ["row"], ["v"], missing_counts).collect()}
    for limit in (1_000_000, 1):
        monkeypatch.setattr(order, "SPLIT_ABOVE", limit)
        got = {r.row: r.p for r in order.with_percentiles(df, ["g"], {"v": "p"}, missing_counts).collect()}
        assert got == {r: keyed.get(r) for r in got} and len(got) == len(rows)
