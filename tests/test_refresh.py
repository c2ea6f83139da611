import datetime
import json

from crivo.operators import features
from crivo.plans import rebuild, refresh
from crivo.sources import lake, landed
from crivo.spec import FUNDS

DAY = datetime.date
PRICE = FUNDS.price


def documents(spark):
    days = [
        (None, [{"FUNDOS": "aaa11", PRICE: "R$ 10,50", "Score": "60", "Volátil": "1,5", "nota": "x"}, {"Ticker": "BBB11", "price": "20.5"}]),
        ("2026-01-09", [{"Ticker": "AAA11", "preco_atual": 11, "volátil": 2, "nota": None}, {"Ticker": "", "price": "1"}, {"Ticker": "BBB11", "price": "?"}]),
        ("2026-01-20", [{"Ativo": "AAA11", "Preço": "12", "Volátil": "", "nota": "7"}, {"Ativo": "BBB11", "Preço": "30", "extra": "3%"}]),
    ]
    rows = [(d or "2026-01-01", json.dumps({"data": d, "fiis": r, "acoes": []})) for d, r in days] + [("2026-01-21", "no document"), ("2026-01-22", None)]
    return spark.createDataFrame(rows, "day string, text string")


def test_training_set_of_stored_documents(spark):
    found = refresh.refresh_from_documents(documents(spark), "text", "fiis", FUNDS, landed.FUND_NAMES, day="day")
    rows = {(r[FUNDS.id], r[FUNDS.date]): r for r in found.collect()}
    assert sorted(rows) == [("AAA11", DAY(2026, 1, 1)), ("AAA11", DAY(2026, 1, 9)), ("AAA11", DAY(2026, 1, 20)), ("BBB11", DAY(2026, 1, 1)), ("BBB11", DAY(2026, 1, 20))]
    first = rows["AAA11", DAY(2026, 1, 1)]
    assert (first[PRICE], first["Volátil"], first["nota"], first["Score"]) == (10.5, 1.5, "x", 60.0)
    assert abs(first["Retorno_Futuro_7d"] - (11 / 10.5 - 1)) < 1e-12 and rows["AAA11", DAY(2026, 1, 9)]["Volátil"] == 2.0
    assert rows["AAA11", DAY(2026, 1, 20)]["nota"] == "7" and rows["BBB11", DAY(2026, 1, 20)]["extra"] == 3.0
    profile = {r.key: (r.filled, r.parsed) for r in refresh.field_profile(landed.payload_rows(documents(spark), "text", "fiis", FUNDS, landed.FUND_NAMES, "day")).collect()}
    assert profile["nota"] == (2, 1) and profile["extra"] == (1, 1) and profile["Volátil"] == (1, 1)


def test_no_documents_give_an_empty_set(spark):
    none = refresh.refresh_from_documents(documents(spark).where("false"), "text", "fiis", FUNDS, landed.FUND_NAMES)
    assert none.count() == 0 and {FUNDS.id, PRICE, "Retorno_Futuro_90d"} <= set(none.columns)


def test_refresh_of_a_lake(spark, tmp_path):
    root = str(tmp_path)
    for r in documents(spark).limit(3).collect():
        spark.createDataFrame([(r.text,)], "text string").write.text(f"{root}/payload/snapshot_date={r.day}")
    refresh.refresh(spark, root, [FUNDS])
    stored = lake.read_table(spark, rebuild.Places(root).dataset(FUNDS))
    assert stored.count() == 5
    assert set(features.dataset(refresh.history_of_documents(documents(spark), "text", "fiis", FUNDS, landed.FUND_NAMES, "day"), FUNDS).columns) == set(stored.columns)
