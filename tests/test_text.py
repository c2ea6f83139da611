import datetime

import pytest
from pyspark.sql import functions as F

from crivo.functions import scalars, text
from crivo.operators import clean
from crivo.spec import FUND_ROLES, FUNDS

DAY = datetime.date


def values(spark, parser, inputs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(inputs)], "i int, s string")
    return [r.v for r in df.select("i", parser(F.col("s")).alias("v")).orderBy("i").collect()]


def test_percent(spark):
    got = values(spark, text.percent, ["4,5%", "10,00%", "0,89%", "1.234,56%", "0,00%", "N/A", "nan", "None", "", "​5%", None, "5d"])
    assert got[:5] == pytest.approx([0.045, 0.10, 0.0089, 12.3456, 0.0])
    assert got[5:9] == [None] * 4
    assert got[9] == pytest.approx(0.05)
    assert got[10:] == [None, None]


def test_money(spark):
    got = values(spark, text.money, ["R$ 1.234,56", "R$ 100,00", "1.548,74", "-2.623.807,00", "N/A"])
    assert got[:4] == pytest.approx([1234.56, 100.0, 1548.74, -2623807.0]) and got[4] is None


def test_plain_float(spark):
    assert values(spark, text.plain_float, ["1,05", "0,88", "285,33", "N/A"]) == [1.05, 0.88, 285.33, None]


def test_integer(spark):
    assert values(spark, text.integer, ["30.949", "1.000.000", "N/A", "", "12"]) == [30949, 1000000, None, None, 12]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("1.234,56", 1234.56), ("1,234.56", 1234.56), ("(1.234,5)", -1234.5), ("R$ 10", 10.0), ("12,5%", 12.5),
        ("1.234.567", 1234.567), ("1234.5", 1234.5), ("-", None), ("—", None), ("nan", None), ("", None), (" 7 ", 7.0),
        ("1,2,3", None), ("(-5)", 5.0), ("(R$ 3,50)", -3.5), ("(.5)", -0.5), ("--5", None), ("1.2,3.4", None), ("+8", 8.0),
        ("<NA>", None), (None, None),
    ],
)
def test_any_number(spark, given, expected):
    assert values(spark, text.any_number, [given]) == [expected]


def test_ticker_and_dates(spark):
    assert values(spark, text.ticker, [" abcd3 ", "nan", "None", "", "<NA>", None]) == ["ABCD3"] + [None] * 5
    assert values(spark, text.iso_date, ["2026-06-29", "2026-06-29 10:00:00", "x", None]) == [DAY(2026, 6, 29)] * 2 + [None] * 2
    assert values(spark, text.br_date, ["29/06/2026", "2026-06-29", "31/02/2026"]) == [DAY(2026, 6, 29), None, None]


def test_table_cleaner(spark):
    raw = spark.createDataFrame(
        [(" AAA11 ", "1,00%", "R$ 10,50", "0,95", "1.000", "12,3", "keep ")],
        "FUNDOS string, `DIVIDEND YIELD` string, `PREÇO ATUAL (R$)` string, `P/VP` string, `QUANT. ATIVOS` string, "
        "VOLATILIDADE string, SETOR string",
    )
    row = clean.clean(raw, FUND_ROLES).first()
    assert list(row) == ["AAA11", pytest.approx(0.01), 10.5, 0.95, 1000, 12.3, "keep"]


def test_numbers_pass_through(spark):
    raw = spark.createDataFrame([(0.5, 7)], "`DIVIDEND YIELD` double, `QUANT. ATIVOS` int")
    assert list(clean.clean(raw, FUND_ROLES).first()) == [0.5, 7]


def test_footer(spark):
    raw = spark.createDataFrame(
        [("ABCD3", "Alfa", "10.0"), ("Legenda", "x", None), ("EFGH3", " LEGENDA ", "1"), ("IJKL3", "Beta", "N/D"), (None, None, None), ("MNOP3", "Gama", None)],
        "`Ação` string, Empresa string, `Preço` string",
    )
    assert sorted(r[0] for r in clean.without_footer(raw).collect()) == ["ABCD3", "MNOP3"]


def test_numericise(spark):
    raw = spark.createDataFrame(
        [(" aa11 ", "2026-01-02", "R$ 10,00", "1,5", "x1", "1", 1), ("AA11", "2026-01-02", "11", "n/d", "x2", "2", 2), ("nan", "2026-01-02", "5", "1", "x", "3", 3), ("bb11", "never", "5", "1", "x", "4", 4), ("cc11", "2026-01-02", "-", "1", "x", "5", 5)],
        "FUNDOS string, Data_Execucao string, `PREÇO ATUAL (R$)` string, `DY ANO` string, SETOR string, outra string, _seq int",
    )
    out = clean.numericise(raw, "FUNDOS", "Data_Execucao", "PREÇO ATUAL (R$)")
    kinds = dict(out.dtypes)
    assert kinds["DY ANO"] == "double" and kinds["outra"] == "double" and kinds["SETOR"] == "string"
    rows = out.collect()
    assert [(r["FUNDOS"], r["PREÇO ATUAL (R$)"], r["DY ANO"]) for r in rows] == [("AA11", 11.0, None)]


def test_feature_columns(spark):
    df = spark.createDataFrame(
        [("A", "2026-01-01", 1.0, "1", "x", "5d", 0.1, 3, "s")] * 5,
        "FUNDOS string, Data_Execucao string, Score double, as_text string, words string, odd string, Retorno_Futuro_7d double, n int, SETOR string",
    )
    assert clean.feature_columns(df, FUNDS, "Retorno_Futuro_30d") == ["Score", "as_text", "n"]


def test_scalars(spark):
    df = spark.createDataFrame(
        [(1, 103.0, 100.0), (2, 97.0, 100.0), (3, 101.0, 100.0), (4, None, 1.0), (5, 1.0, 0.0), (6, -90.0, -100.0)], "i int, a double, b double"
    )
    got = [r[1] for r in df.select("i", scalars.trend(F.col("a"), F.col("b"))).orderBy("i").collect()]
    assert got == ["subindo", "caindo", "estavel", "neutro", "neutro", "subindo"]
    odd = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.23456), (4, None)], "i int, a double")
    assert [r[1] for r in odd.select("i", scalars.exportable(F.col("a"))).orderBy("i").collect()] == [None, None, 1.2346, None]
    assert [r[0] for r in odd.select(scalars.linear_scale(F.col("a"), 1.0, 2.0)).where("true").collect()][3] == 0.0
    level = spark.createDataFrame([(1, 0.0, 3), (2, 39.9, 3), (3, 40.0, 3), (4, 70.0, 3), (5, 90.0, 0)], "i int, p double, w int")
    got = [r[1] for r in level.select("i", scalars.confidence_level(F.col("p"), F.col("w"), 1)).orderBy("i").collect()]
    assert got == ["Não mensurável", "Baixa", "Média", "Alta", "Não mensurável"]


def test_numbers_that_doubles_and_json_write_with_an_exponent(spark):
    df = spark.createDataFrame([("9.0E7",), ("1e-3",), ("-2.5e+8",), ("5e",)], "v string").withColumn("n", text.any_number(F.col("v")))
    assert [r.n for r in df.collect()] == [9.0e7, 1e-3, -2.5e8, 5.0]
    typed = spark.createDataFrame([(9.0e7,)], "v double").select(text.any_number(F.col("v")).alias("n"))
    assert typed.first().n == 9.0e7


def test_typed_columns_are_numericised_as_they_are(spark):
    rows = [("A", "2026-01-01", 9.0e7, 123456789.5, "1,5"), ("B", "2026-01-01", 1.0, 2.0e12, "9.0E7")]
    df = spark.createDataFrame(rows, "id string, day string, price double, worth double, text_worth string")
    got = {r.id: (r.price, r.worth, r.text_worth) for r in clean.numericise(df, "id", "day", "price").collect()}
    assert got == {"A": (9.0e7, 123456789.5, 1.5), "B": (1.0, 2.0e12, 9.0e7)}


def test_trend_from_zero(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, -1.0, 0.0), (3, 0.0, 0.0), (4, None, 0.0), (5, 1.0, None), (6, 1.01, 1.0)], "i int, a double, b double")
    got = [r[1] for r in df.select("i", scalars.trend(F.col("a"), F.col("b"), from_zero=True)).orderBy("i").collect()]
    assert got == ["subindo", "caindo", "subindo", "neutro", "neutro", "estavel"]


def test_numericise_deals_one_file_to_many_tasks(spark):
    df = spark.range(4000).coalesce(1).selectExpr(
        "'a' || id as t", "'2026-01-01' as d", "repeat('x', 200) || id as note", "id || ',5' as price", "sha2('' || id, 512) as noise"
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize", None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    try:
        out = clean.numericise(df, "t", "d", "price")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize") if before is None else spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.minPartitionSize", before
        )
    assert len(out.inputFiles()) > 1
    assert out.agg(F.count("price"), F.sum("price")).first()[:] == (4000, sum(i + 0.5 for i in range(4000)))
