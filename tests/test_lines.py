import datetime
import json

from crivo.plans import export
from crivo.sources import lines


def test_blocks_are_in_order_and_opened_one_by_one(spark, tmp_path):
    path = str(tmp_path / "section")
    rows = [(f"s{i % 7}", i, None if i % 5 == 0 else i / 2) for i in range(103)] + [(None, -1, 0.5)] + [("s3", 3, 1.5)] * 2
    df = spark.createDataFrame(rows, "series string, day int, value double").repartition(5)
    lines.write_lines(df, ["series", "day"], path, block=25)
    index = lines.read_index(spark, path).collect()
    assert [(r.block, r.first, r.rows) for r in index] == [(0, 0, 25), (1, 25, 25), (2, 50, 25), (3, 75, 25), (4, 100, 6)]
    wanted = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    got = []
    for r in index:
        block = [json.loads(x.value) for x in lines.read_lines(spark, path, [r.block]).collect()]
        assert json.loads(r.key) == {k: block[0][k] for k in ("series", "day")}
        assert len(lines.read_lines(spark, path, [r.block]).inputFiles()) == 1
        got += [(b["series"], b["day"], b["value"]) for b in block]
    assert [r[:2] for r in got] == [r[:2] for r in wanted] and sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert lines.read_lines(spark, path).count() == len(rows)
    lines.write_lines(df.limit(3), ["series"], path, block=25)
    assert lines.read_lines(spark, path).count() == 3 and lines.read_index(spark, path).count() == 1


def test_growing_sections_of_a_day(spark, tmp_path):
    day = datetime.date(2026, 1, 2)
    points = spark.createDataFrame([("CDI", day, 2.0), ("CDI", datetime.date(2026, 1, 1), 1.0), ("B", day, 3.0)], "series string, date date, value double")
    often = spark.createDataFrame([("A", 2, 1.0, 1), ("B", 3, None, None), ("C", 3, 5.0, 2)], "Ticker string, aparicoes int, score_medio double, melhor_posicao int")
    names = export.export_lines(spark, str(tmp_path), day, {"benchmarks": points, "recorrentes_fiis": often, "fiis": points})
    assert names == ["benchmarks", "recorrentes_fiis"]
    place = f"{tmp_path}/{export.LINES_TABLE}/snapshot_date=2026-01-02"
    listed = {n: [json.loads(r.value) for r in lines.read_lines(spark, f"{place}/{n}", [0]).collect()] for n in names}
    assert [(r["series"], r["value"]) for r in listed["benchmarks"]] == [("B", 3.0), ("CDI", 1.0), ("CDI", 2.0)]
    assert [r["Ticker"] for r in listed["recorrentes_fiis"]] == ["C", "B", "A"]
