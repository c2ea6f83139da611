import datetime

import numpy as np

import pytest
from pyspark.sql import functions as F

from crivo.operators import features, history, report, series
from crivo.operators.asof import asof, forward_returns, probes
from crivo.spec import FUNDS

DAY = datetime.date


def prices(seed=1, ids=4, n=40):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(ids):
        days = sorted(rng.choice(300, n, replace=False))
        rows += [(f"T{i}", DAY(2026, 1, 1) + datetime.timedelta(days=int(d)), float(np.round(rng.uniform(1, 9), 2))) for d in days]
    return rows


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("one_per_day", [True, False])
def test_asof_matches_brute_force(spark, forward, one_per_day):
    seen = prices()
    questions = [(t, DAY(2026, 1, 1) + datetime.timedelta(days=k), k) for t in ("T0", "T1", "none") for k in range(-5, 320, 3)]
    if not one_per_day:
        questions = questions * 3
    q = spark.createDataFrame(questions, "t string, at date, k int")
    o = spark.createDataFrame(seen, "t string, d date, p double")
    got = asof(q, o, ["t"], "at", "d", "p", forward, one_per_day).collect()
    assert len(got) == len(questions)
    for r in got:
        known = [(d, p) for t, d, p in seen if t == r.t and (d >= r["at"] if forward else d <= r["at"])]
        best = (min(known) if forward else max(known)) if known else (None, None)
        assert (r.found_date, r.found_value) == best


def test_probes_of_both_directions_match_brute_force(spark):
    seen = prices()
    start = DAY(2025, 12, 25)
    questions = [
        (t, start + datetime.timedelta(days=k), start + datetime.timedelta(days=k + w) if w else None, k)
        for t in ("T0", "T1", "none", None) for k in range(0, 330, 7) for w in (0, 1, 30)
    ]
    q = spark.createDataFrame(questions, "t string, a date, b date, k int")
    o = spark.createDataFrame(seen, "t string, d date, p double")
    asks = {"next": ("a", True), "last": ("a", False), "ahead": ("b", True), "back": ("b", False)}
    answered = probes(q, o, ["t"], asks, "d", "p")
    got = answered.collect()
    assert sorted(map(repr, ((r.t, r.a, r.b, r.k) for r in got))) == sorted(map(repr, questions))
    for r in got:
        for name, (column, forward) in asks.items():
            at = r[column]
            known = [(d, p) for t, d, p in seen if t == r.t and at and (d >= at if forward else d <= at)]
            best = (min(known) if forward else max(known)) if known else (None, None)
            assert (r[f"{name}_date"], r[f"{name}_value"]) == best
    plain = probes(q.drop("k"), o, ["t"], {"x": ("a", True)}, "d", "p")
    assert plain.columns == ["t", "a", "b", "x_date", "x_value"]


def test_period_returns_take_one_shuffle(spark):
    windows = spark.createDataFrame([("T0", DAY(2026, 2, 1), DAY(2026, 5, 1), "w"), ("T1", DAY(2026, 2, 1), DAY(2026, 2, 2), "v")], "t string, start date, end date, note string")
    o = spark.createDataFrame(prices(), "t string, d date, p double")
    found = series.period_returns(windows, o, ["t"], "d", "p")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    for r in found.collect():
        inside = sorted((d, p) for t, d, p in prices() if t == r.t and r.start <= d <= r.end)
        wanted = inside[-1][1] / inside[0][1] - 1 if len(inside) > 1 else None
        assert (r["return"], r.note) == (pytest.approx(wanted) if wanted is not None else None, "w" if r.t == "T0" else "v")


def test_forward_returns_match_brute_force(spark):
    rows = [(t, d, 0.0 if i % 17 == 0 else p, f"n{i}") for i, (t, d, p) in enumerate(prices())]
    df = spark.createDataFrame(rows, "t string, d date, p double, note string")
    got = forward_returns(df, ["t"], "d", "p", [7, 30]).collect()
    assert len(got) == len(rows)
    notes = {(t, d): n for t, d, _, n in rows}
    for r in got:
        assert r.note == notes[(r.t, r.d)]
        for h in (7, 30):
            later = sorted((d, p) for t, d, p, _ in rows if t == r.t and d >= r.d + datetime.timedelta(days=h))
            usable = bool(later) and later[0][1] != 0 and r.p != 0
            assert r[f"Data_Futura_{h}d"] == (later[0][0] if usable else None)
            assert r[f"Preco_Futuro_{h}d"] == (later[0][1] if usable else None)
            assert r[f"Retorno_Futuro_{h}d"] == (pytest.approx(later[0][1] / r.p - 1) if usable else None)


def test_dataset(spark):
    rows = [
        (" aaa11 ", "2026-01-01", "10", 50.0, "Rank #1", 1), ("AAA11", "2026-01-01", "11", 51.0, "Aprovado (fora do Top N)", 2),
        ("AAA11", "2026-01-05", "12", 60.0, "Eliminado no quartil: x", 3), ("nan", "2026-01-05", "1", 1.0, "x", 4), ("AAA11", "2026-01-09", None, 1.0, "x", 5),
    ]
    df = spark.createDataFrame(rows, "FUNDOS string, Data_Execucao string, `PREÇO ATUAL (R$)` string, Score double, Status string, _seq int")
    got = features.dataset(df, FUNDS, [3]).orderBy("Data_Execucao").collect()
    assert [(r.FUNDOS, r["PREÇO ATUAL (R$)"], r.Aprovado_Filtro) for r in got] == [("AAA11", 11.0, 1), ("AAA11", 12.0, 0)]
    assert got[1].Preco_Anterior == 11.0 and got[1].Dias_Desde_Snapshot_Anterior == 4 and got[1].Delta_Score == 9.0
    assert got[0].Retorno_Futuro_3d == pytest.approx(12 / 11 - 1) and got[1].Retorno_Futuro_3d is None


def test_approved_text_only(spark):
    df = spark.createDataFrame([("A", DAY(2026, 1, 1), 1.0, "Rank #1")], "FUNDOS string, Data_Execucao date, `PREÇO ATUAL (R$)` double, Status string")
    assert features.features(df, FUNDS).first().Aprovado_Filtro == 1
    assert features.features(df, FUNDS, approved_text_only=True).first().Aprovado_Filtro == 0


def points(df):
    return [(r.date.day, r.value) for r in df.orderBy("date").collect()]


def line(spark, values):
    return spark.createDataFrame([("s", DAY(2026, 1, d), v) for d, v in values], "series string, date date, value double")


def test_compound_and_rebase(spark):
    got = points(series.compound(line(spark, [(1, 10.0), (2, None), (3, -50.0)]), ["series"]))
    assert got == [(1, pytest.approx(110.0)), (3, pytest.approx(55.0))]
    assert points(series.rebase(line(spark, [(1, None), (2, 4.0), (3, 5.0)]), ["series"])) == [(2, 100.0), (3, 125.0)]
    assert points(series.rebase(line(spark, [(1, 0.0), (2, 4.0)]), ["series"])) == []


@pytest.mark.parametrize(
    "values, start, expected",
    [
        ([(1, 2.0), (5, 4.0)], 1, [(1, 100.0), (5, 200.0)]),
        ([(1, 2.0), (5, 4.0)], 3, [(3, 100.0), (5, 200.0)]),
        ([(5, 4.0), (6, 5.0)], 3, [(3, 100.0), (5, 100.0), (6, 125.0)]),
        ([(1, 2.0)], 3, [(3, 100.0)]),
        ([(1, 0.0)], 3, [(3, 100.0)]),
        ([(1, 0.0), (5, 4.0)], 3, []),
        ([(1, None)], 3, []),
    ],
)
def test_rebase_from(spark, values, start, expected):
    starts = spark.createDataFrame([("s", DAY(2026, 1, start))], "series string, start date")
    assert points(series.rebase_from(line(spark, values), starts, ["series"])) == expected
    assert points(series.rebase_from(line(spark, values), starts.select("start"), [])) == expected


def test_portfolio_index(spark):
    held = [("A", 1), ("B", 1), ("A", 5), ("C", 5), ("A", 9)]
    portfolio = spark.createDataFrame([(t, DAY(2026, 1, d)) for t, d in held], "t string, d date")
    paid = [("A", 1, 10.0), ("A", 4, 11.0), ("B", 1, 20.0), ("B", 5, 18.0), ("A", 9, 22.0), ("D", 1, 1.0)]
    quoted = spark.createDataFrame([(t, DAY(2026, 1, d), p) for t, d, p in paid], "t string, d date, p double")
    got = points(series.portfolio_index(portfolio, quoted, [], "t", "d", "p"))
    # first period: A 11/10, B 18/20; second: A 22/11, C has no price and is left out
    assert got == [(1, 100.0), (5, pytest.approx(100.0)), (9, pytest.approx(200.0))]


def test_backtest(spark):
    portfolio = spark.createDataFrame([("A", DAY(2026, 1, 1)), ("A", DAY(2026, 1, 10)), ("Z", DAY(2026, 1, 20))], "t string, d date")
    quoted = spark.createDataFrame(
        [("A", DAY(2026, 1, 1), 10.0), ("A", DAY(2026, 1, 10), 11.0), ("A", DAY(2026, 1, 20), 11.0)], "t string, d date, p double"
    )
    market = spark.createDataFrame(
        [("IFIX", DAY(2026, 1, 2), 100.0), ("IFIX", DAY(2026, 1, 9), 105.0), ("IFIX", DAY(2026, 1, 25), 999.0)], "series string, d date, p double"
    )
    end = F.lit(DAY(2026, 1, 30))
    periods = series.backtest_periods(portfolio, quoted, market, ["IFIX"], "t", "d", "p", end)
    rows = {r.start.day: (r.portfolio_return, r.IFIX_return) for r in periods.collect()}
    assert rows == {1: (pytest.approx(0.1), pytest.approx(0.05)), 10: (pytest.approx(0.0), None), 20: (None, None)}
    total = series.backtest_summary(portfolio, periods, ["IFIX"], "d").first()
    assert total.available and total.rebalances == 3 and total.periods == 2 and total.beat_IFIX
    assert total.portfolio_base100 == pytest.approx(110.0) and total.IFIX_base100 == pytest.approx(105.0)
    chained = [r.portfolio_base100 for r in series.chained_backtest(periods, ["IFIX"]).orderBy("start").collect()]
    assert chained == [pytest.approx(110.0), pytest.approx(110.0)]


def test_backtest_without_data(spark):
    portfolio = spark.createDataFrame([("A", DAY(2026, 1, 1))], "t string, d date")
    none = spark.createDataFrame([], "t string, series string, d date, p double")
    periods = series.backtest_periods(portfolio, none, none, ["IFIX"], "t", "d", "p", F.lit(DAY(2026, 1, 9)))
    total = series.backtest_summary(portfolio, periods, ["IFIX"], "d").first()
    assert total.available is False and total.beat_IFIX is None


def test_upsert_and_replace(spark):
    stored = spark.createDataFrame([("A", 1, "old", 1), ("A", 1, "older", 0), ("B", 2, "kept", 2)], "k string, d int, v string, _seq int")
    new = spark.createDataFrame([("A", 1, "new", 0, 9)], "k string, d int, v string, _seq int, extra int")
    got = history.upsert(stored, new, ["k", "d", "absent"])
    assert {(r.k, r.v, r.extra) for r in got.collect()} == {("A", "new", 9), ("B", "kept", None)}
    replaced = history.replace_days(stored.withColumn("d", F.lit(1)), new, "d", ["k", "d"])
    assert {(r.k, r.v) for r in replaced.collect()} == {("A", "new")}
    plain = history.upsert(stored.drop("_seq"), stored.drop("_seq"), [])
    assert plain.count() == 3


def test_portfolio_rows_override(spark):
    top = spark.createDataFrame([(" aaa11 ", 10.0, 55.0, 1), (None, 1.0, 1.0, 2)], "FUNDOS string, `PREÇO ATUAL (R$)` double, Score double, Posicao int")
    rows = history.portfolio_rows(top, FUNDS, F.lit("2026-01-01"))
    assert [tuple(r) for r in rows.collect()] == [(DAY(2026, 1, 1), "FII", "AAA11", 10.0, 55.0, 1)]
    older = rows.withColumn("Score", F.lit(1.0))
    assert [r.Score for r in history.portfolio_history(older, rows).collect()] == [55.0]
    bare = history.portfolio_rows(spark.createDataFrame([("X",)], "FUNDOS string"), FUNDS, F.lit("2026-01-01")).first()
    assert bare.Preco_Entrada is None and bare.Posicao is None




def test_nothing_in_gives_nothing_out(spark):
    shape = "series string, start date"
    none = spark.createDataFrame([("s", None)], shape)
    assert points(series.rebase_from(line(spark, [(1, 2.0)]), none, ["series"])) == []
    assert points(series.rebase_from(line(spark, [(1, 2.0)]), none.select("start"), [])) == []
    held = spark.createDataFrame([], "t string, d date")
    quoted = spark.createDataFrame([], "t string, d date, p double")
    assert points(series.portfolio_index(held, quoted, [], "t", "d", "p")) == []


def test_a_question_without_a_date_has_no_answer(spark):
    seen = spark.createDataFrame([("a", DAY(2026, 1, 5), 1.0)], "k string, d date, v double")
    asked = spark.createDataFrame([("a", None), ("a", DAY(2026, 1, 1))], "k string, at date")
    for forward in (True, False):
        got = {r["at"]: r.found_value for r in asof(asked, seen, ["k"], "at", "d", "v", forward=forward).collect()}
        assert got == {None: None, DAY(2026, 1, 1): 1.0 if forward else None}


def test_groups_keep_their_own_history(spark):
    rows = [("x", "A", DAY(2026, 1, d), float(d)) for d in (1, 2)] + [("y", "A", DAY(2026, 1, d), 10.0 * d) for d in (1, 2)]
    df = spark.createDataFrame(rows, f"g string, `{FUNDS.id}` string, `{FUNDS.date}` date, `{FUNDS.price}` double")
    got = features.dataset(df, FUNDS, [1], by=["g"]).collect()
    assert sorted((r.g, r[FUNDS.price], r.Preco_Anterior) for r in got) == [("x", 1.0, None), ("x", 2.0, 1.0), ("y", 10.0, None), ("y", 20.0, 10.0)]


def test_a_repeated_earlier_record_does_not_repeat_today(spark):
    today = spark.createDataFrame([("A", 2.0)], "t string, v double")
    earlier = spark.createDataFrame([("A", 1.0), ("A", 3.0)], "t string, v double")
    assert report.trends(today, earlier, "t", ["v"]).count() == 1


def test_recurrence_counts_a_class_whatever_its_case(spark):
    rows = [(DAY(2026, 1, 1), "fii", "A", 1.0, 1), (DAY(2026, 1, 2), "FII", "a", 2.0, 2)]
    got = report.recurrence(spark.createDataFrame(rows, "Data_Carteira date, Tipo string, Ticker string, Score double, Posicao int"))
    assert [(r.Tipo, r.Ticker, r.aparicoes) for r in got.collect()] == [("FII", "A", 2)]


def test_probes_fold_without_another_sort(spark):
    q = spark.sql("select 'a' as t, 1L as k, date'2026-01-05' as a, date'2026-01-09' as b")
    o = spark.sql("select 'a' as t, date'2026-01-05' as d, 2.0D as p")
    found = probes(q, o, ["t"], {"x": ("a", True), "y": ("b", False)}, "d", "p")
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.select("k", "x_value", "y_value").collect()[0][:] == (1, 2.0, 2.0)
