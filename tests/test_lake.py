import os
import datetime
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from crivo.operators import models, quality
from crivo.plans import checks, daily, export, rebuild
from crivo.sources import lake, landed
from crivo.spec import FUND_ROLES, FUNDS, STOCKS, Limits, fund_rules
from tests.test_screen import funds, stocks

DAY = datetime.date


def test_a_day_is_replaced_and_others_stay(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([("A", 1)], "k string, v int")
    lake.write_day(first, root, "t", DAY(2026, 6, 29))
    lake.write_day(first.withColumn("extra", F.lit(7)), root, "t", DAY(2026, 6, 30))
    (tmp_path / "t" / "snapshot_date=junk").mkdir()
    lake.write_day(first.where("false"), root, "t", DAY(2026, 6, 29))
    rows = lake.read_days(spark, root, "t", date="d").collect()
    assert [(r.k, r.v, r.extra, r.d) for r in rows] == [("A", 1, 7, DAY(2026, 6, 30))]
    lake.write_day(first, root, "t", DAY(2026, 6, 29))
    assert [r.date for r in lake.list_days(spark, root, "t").collect()] == [DAY(2026, 6, 29), DAY(2026, 6, 30)]
    only = lake.read_days(spark, root, "t", [DAY(2026, 6, 29)])
    assert only.count() == 1
    assert "PartitionFilters: [isnotnull" in only._jdf.queryExecution().toString() or "snapshot_date" in only._jdf.queryExecution().toString()


def test_the_folder_date_overrides_a_stored_one(spark, tmp_path):
    lake.write_day(spark.createDataFrame([("A", "1999-01-01")], "k string, d string"), str(tmp_path), "t", DAY(2026, 1, 1))
    assert lake.read_days(spark, str(tmp_path), "t", date="d").first().d == DAY(2026, 1, 1)


def test_days_are_replaced_dynamically(spark, tmp_path):
    root = str(tmp_path)
    two = spark.createDataFrame([(DAY(2026, 1, 1), 1), (DAY(2026, 1, 2), 1)], "d date, v int")
    lake.write_days(two, root, "t", "d")
    lake.write_days(two.where("d = '2026-01-02'").withColumn("v", F.lit(2)), root, "t", "d")
    got = {(r.d, r.v) for r in lake.read_days(spark, root, "t", date="d").collect()}
    assert got == {(DAY(2026, 1, 1), 1), (DAY(2026, 1, 2), 2)}


def test_reading_nothing_gives_an_empty_table(spark, tmp_path):
    df = lake.read_table(spark, str(tmp_path / "absent"), "a int")
    (tmp_path / "broken.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        lake.read_table(spark, str(tmp_path / "broken.parquet"), "a int").count()
    assert df.columns == ["a"] and df.count() == 0 and not lake.exists(spark, str(tmp_path / "absent"))


def test_fingerprint_ignores_order_but_not_copies(spark):
    rows = [(DAY(2026, 1, 1), i) for i in range(20)]
    shape = "d date, v int"
    one = lake.manifest_of(spark.createDataFrame(rows, shape), "d", "t").first()
    other = lake.manifest_of(spark.createDataFrame(rows[::-1], shape).repartition(3), "d", "t").first()
    twice = lake.manifest_of(spark.createDataFrame(rows + rows[:1], shape), "d", "t").first()
    assert one == other and one.rows == 20 and one.columns == 2 and one.fingerprint != twice.fingerprint


def test_snapshots_to_history_portfolio_and_report(spark, tmp_path):
    root = str(tmp_path)
    day = DAY(2026, 6, 29)
    fund = spark.createDataFrame([("AAA11", 10.0, 55.0)], "FUNDOS string, `PREÇO ATUAL (R$)` double, Score double")
    stock = spark.createDataFrame([("ABCD3", 20.0, 60.0)], "`Ação` string, `Preço` double, Score double")
    daily.store_day(root, day, FUNDS, fund, fund.withColumn("Status", F.lit("Rank #1")))
    daily.store_day(root, day, STOCKS, stock, stock.withColumn("Status", F.lit("Rank #1")))
    rebuild.rebuild(spark, root)
    places = rebuild.Places(root)
    assert [lake.read_table(spark, p).count() for p in (places.history(FUNDS), places.history(STOCKS), places.portfolio)] == [1, 1, 2]
    assert {r.Score for r in lake.read_table(spark, places.portfolio).collect()} == {55.0, 60.0}

    export.export_day(spark, root, day)
    assert [r.date for r in export.exported_days(spark, root).collect()] == [day]
    report = checks.quality_report(spark, root, export.exported_days(spark, root))
    assert quality.overall(report).first().status == "warn"  # no training sets yet, and lists of one row
    assert not [r for r in report.collect() if r.status == "error"]


def test_quality_without_a_lake(spark, tmp_path):
    report = checks.quality_report(spark, str(tmp_path))
    assert {r.name: r.status for r in report.collect()} == {"lake_snapshots": "warn", "lake_manifest": "ok"}


@pytest.fixture(scope="module")
def two_weeks(spark, tmp_path_factory):
    """Three days of both classes, screened and stored; prices drift from day to day."""
    root = str(tmp_path_factory.mktemp("lake"))
    limits = Limits(dy=0.003, liquidity=10_000, size=10_000_000, top_n=5)
    for n, day in enumerate([DAY(2026, 1, 1), DAY(2026, 1, 5), DAY(2026, 1, 13)]):
        table = funds(30)
        table["SETOR"] = "Papel"
        table["PREÇO ATUAL (R$)"] = [10.0 + i + n * (i % 5) for i in range(30)]
        table["DIVIDEND YIELD"] += 0.001 * n
        daily.run_funds(spark.createDataFrame(table), root, day, limits)
        shares = stocks(30)
        shares["Preço"] += n
        daily.run_stocks(spark.createDataFrame(shares), root, day, limits)
    rebuild.rebuild(spark, root)
    rebuild.build_datasets(spark, root)
    quick = models.factories(trees=3, rounds=2)
    performance = rebuild.learn(spark, root, 7, factories={"score_ridge": quick["score_ridge"]})
    return root, performance


def test_raw_texts_are_screened(spark, tmp_path):
    raw = [
        ("AAA11", "R$ 1.234,56", "0,95", "1,20%", "2.000.000", "R$ 90.000.000,00", "12,5"),
        ("BBB11", "R$ 10,00", "N/A", "1,00%", "2.000.000", "R$ 90.000.000,00", "10,0"),
    ]
    names = ["FUNDOS", FUNDS.price, *[FUNDS.required[i] for i in range(5)]]
    df = spark.createDataFrame(raw, ", ".join(f"`{n}` string" for n in names))
    top, universe = daily.run_funds(df, str(tmp_path), DAY(2026, 1, 1))
    assert [(r.FUNDOS, r[FUNDS.price], r.Posicao) for r in top.collect()] == [("AAA11", 1234.56, 1)]
    assert {r.FUNDOS: r.Status for r in universe.collect()} == {"AAA11": "Rank #1", "BBB11": "Eliminado no filtro fixo: P/VP nulo ou negativo"}

    shares = stocks(6).drop(columns="_seq").astype(str)
    shares.loc[5, "Empresa"], shares.loc[4, "Preço"] = "Legenda", "N/D"
    limits = Limits(dy=0.0, liquidity=0, size=0, top_n=3)
    top, universe = daily.run_stocks(spark.createDataFrame(shares), str(tmp_path), DAY(2026, 1, 1), limits)
    assert universe.count() == 4 and top.count() == 3


def test_daily_run(spark, two_weeks):
    root, performance = two_weeks
    places = rebuild.Places(root)
    past = lake.read_table(spark, places.history(FUNDS))
    assert past.count() == 90 and past.where("Status is null or Score is null").count() == 0
    data = lake.read_table(spark, places.dataset(FUNDS))
    assert data.where("Retorno_Futuro_7d is not null").count() == 60
    stored = lake.read_days(spark, root, f"{places.predictions}_fii")
    assert stored.count() == 30 and stored.where("status_modelos = 'Ativo'").count() == 30
    assert {r.Tipo for r in performance.collect()} == {"FII", "ACAO"}


def test_document(spark, two_weeks):
    root, _ = two_weeks
    rates = [("CDI", DAY(2025, 12, 31), 100.0), ("CDI", DAY(2026, 1, 9), 101.0), ("IBOV", DAY(2026, 1, 5), 7.0)]
    benchmarks = spark.createDataFrame(rates, "series string, date date, value double")
    day = DAY(2026, 1, 13)
    economic = spark.createDataFrame([("selic", DAY(2026, 1, 2), 0.05), ("igpm", DAY(2026, 1, 1), None), ("other", day, 1.0)], "series string, date date, value double")
    quotes = spark.createDataFrame([("USD/BRL", 5.1, 0.2, "2026-01-12"), ("USD/BRL", 5.0, -0.2, "2026-01-13"), ("EUR/BRL", 6.0, None, "")], "pair string, value double, pct_change double, updated_at string")
    stored = export.export_day(spark, root, day, benchmarks, economic=economic, quotes=quotes).collect()
    assert len(stored) == 1
    found = json.loads(stored[0].text)
    assert found["data"] == "2026-01-13" and len(found["fiis"]) == 5 and len(found["acoes"]) == 5
    assert {r["DIVIDEND YIELD_tendencia"] for r in found["fiis"]} <= {"subindo", "caindo", "estavel", "neutro"}
    assert found["kpis_fiis"][0]["total_universo"] == 30 and found["kpis_fiis"][0]["total_carteira"] == 5
    own = sorted((p["date"], p["value"]) for p in found["comparativo_fiis"] if p["series"] == "carteira")
    assert own[0] == ("2026-01-01", 100.0) and len(own) == 3
    cdi = sorted((p["date"], p["value"]) for p in found["comparativo_fiis"] if p["series"] == "CDI")
    assert cdi == [("2026-01-01", 100.0), ("2026-01-09", 101.0)]
    assert [(r["series"], r.get("value")) for r in found["indicadores_series"]] == [("igpm", None), ("selic", 0.05)]
    assert [(r["pair"], r["value"]) for r in found["indicadores_cambio"]] == [("EUR/BRL", 6.0), ("USD/BRL", 5.0)]
    market = [(p["series"], p["date"], p["value"]) for p in found["mercado"]]
    assert market == [("CDI", "2025-12-31", 100.0), ("CDI", "2026-01-09", 101.0), ("IBOV", "2026-01-05", 100.0)]
    backtest = found["backtest_fiis"][0]
    assert backtest["available"] and backtest["first_date"] == "2026-01-01" and backtest["rebalances"] == 3
    assert backtest["periods"] == 2 == len(found["backtest_periodos_fiis"])
    own = [p["value"] for p in found["comparativo_fiis"] if p["series"] == "carteira"]
    chained = [p["portfolio_base100"] for p in found["backtest_periodos_fiis"]]
    assert chained == pytest.approx(sorted(own)[1:] if own == sorted(own) else own[1:], abs=1e-3)
    assert [r["Posicao"] for r in found["fiis"]] == [1, 2, 3, 4, 5]
    assert [r["rank_modelo"] for r in found["modelos_ranking"]] == [*range(1, 31)] * 2
    times = [r["aparicoes"] for r in found["recorrentes_fiis"]]
    assert times == sorted(times, reverse=True)
    assert len(found["modelos_ranking"]) == 60 and found["modelos_status"][0]["status"] == "Ativo"
    assert sum(r["aparicoes"] for r in found["recorrentes_fiis"]) == 15
    assert found["modelos"][0] == "Score Top" and found["modelos_performance"]

    # the stored document is itself a source of history rows
    back = landed.payload_rows(export.stored_documents(spark, root), "text", "fiis", FUNDS, landed.FUND_NAMES)
    assert back.count() == 5 and back.first()["PREÇO ATUAL (R$)"] is not None


def test_landed_files(spark, tmp_path):
    (tmp_path / "s.json").write_text('[{"data": "01/02/2026", "valor": "0.5"}, {"data": "02/02/2026", "valor": "x"}]')
    rows = landed.rate_series(landed.texts(spark, str(tmp_path / "s.json")), "text")
    assert [tuple(r) for r in rows.collect()] == [(DAY(2026, 2, 1), 0.5)]
    assert landed.rate_series(landed.texts(spark, str(tmp_path / "s.json")), "text", keep_missing=True).count() == 2
    (tmp_path / "q.json").write_text(
        '{"USDBRL": {"code": "USD", "codein": "BRL", "bid": "5.1", "pctChange": "-0.2", "create_date": "now"}, '
        '"BAD": {"code": "X", "codein": "BRL", "bid": "?", "pctChange": "1"}, "WORSE": {"bid": "1", "pctChange": "1"}}'
    )
    got = landed.quotes(landed.texts(spark, str(tmp_path / "q.json")), "text").collect()
    assert [tuple(r) for r in got] == [("USD/BRL", 5.1, -0.2, "now")]


def test_every_row_of_a_shuffled_raw_table_keeps_its_own_score(spark):
    table = funds(60)
    table[FUNDS.price] = 10.0
    raw = spark.createDataFrame(pd.concat([table, table])).dropDuplicates().repartition(5)
    _, universe = daily.screened_day(raw, FUNDS, FUND_ROLES, fund_rules(Limits(0.0, 0, 0, 5)), 5)
    got = {r.FUNDOS: r.Score for r in universe.collect()}
    share = 0.0
    for f in FUNDS.factors:
        place = table[f.column].rank(pct=True) * 100
        share = share + f.weight * (place if f.best == "max" else 100 - place)
    assert got == pytest.approx(dict(zip(table["FUNDOS"], share.round(1))), abs=0.051)


def test_a_day_without_rows_is_no_missing_table(spark, tmp_path):
    root = str(tmp_path)
    day = DAY(2026, 1, 1)
    for table in ("fii_universe", "fii_top", "acao_universe", "acao_top"):
        rows = spark.createDataFrame([("A", 1)], "k string, v int")
        lake.write_day(rows, root, table, DAY(2025, 12, 31))
        lake.write_day(rows.where("false") if table.startswith("acao") else rows, root, table, day)
    found = {r.name: r.status for r in checks.quality_report(spark, root).collect()}
    assert found["snapshot_2026-01-01_files"] == "ok" == found["snapshot_2025-12-31_files"]


def test_the_stored_manifest_is_held_against_the_folders(spark, tmp_path):
    root = str(tmp_path)
    table = funds(30)
    table[FUNDS.price] = 10.0
    for day in (DAY(2026, 1, 1), DAY(2026, 1, 2)):
        daily.run_funds(spark.createDataFrame(table), root, day)
    stored = checks.stored_manifest(spark, root, [FUNDS]).orderBy("date", "table").collect()
    assert [(r.date, r.table, r.rows > 0) for r in stored] == [(DAY(2026, 1, d), t, True) for d in (1, 2) for t in ("fii_top", "fii_universe")]
    status = {r.name: r.status for r in checks.quality_report(spark, root, specs=[FUNDS]).collect()}
    assert status["lake_manifest"] == "ok"
    lake.write_day(spark.createDataFrame([("X", 1)], "k string, v int"), root, "fii_universe", DAY(2026, 1, 3))
    status = {r.name: r.status for r in checks.quality_report(spark, root, specs=[FUNDS]).collect()}
    assert status["lake_manifest"] == "warn"  # a day that no plan has noted down
    empty = quality.index_filled(spark.createDataFrame([], "date date")).first()
    assert (empty.status, empty.detail) == ("warn", "0 datas no index.json")


def test_unreadable_files_are_listed_and_the_rest_is_read(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, v int"
    assert [f.count() for f in lake.read_sound(spark, path, schema)] == [0, 0]
    rows = spark.createDataFrame([(f"k{i}", i) for i in range(40)], schema)
    rows.repartition(4).write.parquet(path)
    spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)
    found, bad = lake.read_sound(spark, path, schema)
    assert found.count() == 40 and bad.count() == 0  # an empty file is sound
    files = sorted(p for p in (tmp_path / "t").glob("*.parquet") if spark.read.parquet(str(p)).count())
    held = [{r.k for r in spark.read.parquet(str(p)).collect()} for p in files]
    files[0].write_bytes(b"not parquet at all")
    raw = bytearray(files[1].read_bytes())
    raw[4:40] = b"\xff" * 36  # the footer still promises its rows
    files[1].write_bytes(bytes(raw))
    for crc in (tmp_path / "t").glob(".*.crc"):
        crc.unlink()
    found, bad = lake.read_sound(spark, path, schema)
    assert {r.k for r in found.collect()} == set().union(*held[2:])
    listed = {r.path.rsplit("/", 1)[1]: r.error for r in bad.collect()}
    assert set(listed) == {files[0].name, files[1].name} and all(listed.values())
    lake.write_table(bad, str(tmp_path / "quarantine"))
    assert lake.read_table(spark, str(tmp_path / "quarantine")).count() == 2


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="shared tables are not here")
def test_the_broken_file_does_not_hold_the_history(spark, tmp_path, monkeypatch):
    """One task writes it, so it must not grow with the history."""
    from checks import catalog

    monkeypatch.setattr(catalog, "_folder", lambda spark: str(tmp_path))
    rows = catalog.QUERIES["sound_files"](spark, "/root/testdata/sf0.001").collect()
    assert [r.left_out for r in rows] == [1] * len(rows)
    (broken,) = (tmp_path / "t" / "broken").glob("part-*")
    assert len(broken.read_text().splitlines()) == len(rows)
