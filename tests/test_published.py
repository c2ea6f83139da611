import datetime
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crivo.operators import features
from crivo.operators.history import prepared
from crivo.plans import incremental
from crivo.sources import lake, published
from crivo.spec import FUNDS

DAY = datetime.date
DAYS = [DAY(2026, 1, 1) + datetime.timedelta(days=d) for d in (0, 1, 4, 9, 10, 17, 30, 44, 45, 60)]


def rows_of(spark, found):
    return sorted(map(repr, found.select(sorted(found.columns)).collect()))


def universe(spark, seed=1, days=DAYS, revised=()):
    """Funds on several days; not every fund on every day."""
    rng = random.Random(seed)
    rows = []
    for d in days:
        for t in range(12):
            price, here = round(rng.uniform(5, 50), 2), rng.random() < 0.92
            if here:
                rows.append((d, f" fund{t:02d}" if t % 5 == 0 else f"FUND{t:02d}", price * (3 if d in revised else 1), float(t), "Rank #1" if t < 4 else "Eliminado"))
    return spark.createDataFrame(rows, f"`{FUNDS.date}` date, `{FUNDS.id}` string, `{FUNDS.price}` double, `{FUNDS.score}` double, `{FUNDS.status}` string")


def test_a_run_that_breaks_off_is_not_seen(spark, tmp_path, monkeypatch):
    root, day = str(tmp_path), DAYS[0]
    one, two = universe(spark, 1, DAYS[:1]), universe(spark, 2, DAYS[:1])
    tables = {"universe": one, "top": one.limit(3)}
    published.publish(spark, root, tables, FUNDS.date, [day])
    before = {t: rows_of(spark, published.read(spark, root, t)) for t in tables}

    calls = []
    whole = published.fingerprints

    def stops(df, names):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("the executor is lost")
        return whole(df, names)

    monkeypatch.setattr(published, "fingerprints", stops)
    with pytest.raises(RuntimeError):
        published.publish(spark, root, {"universe": two, "top": two.limit(3)}, FUNDS.date, [day])
    monkeypatch.setattr(published, "fingerprints", whole)
    assert len(published.stored_runs(spark, root, "universe")) == 2  # the new folder is there, and nobody looks at it
    assert {t: rows_of(spark, published.read(spark, root, t)) for t in tables} == before
    assert {r.status for r in published.verify(spark, root, ["universe"]).collect()} == {"ok", "extra"}
    published.publish(spark, root, {"universe": two, "top": two.limit(3)}, FUNDS.date, [day])
    assert rows_of(spark, published.read(spark, root, "universe")) != before["universe"]


def test_a_new_version_names_all_tables_of_its_day(spark, tmp_path):
    root = str(tmp_path)
    both = universe(spark, 1, DAYS[:2])
    published.publish(spark, root, {"a": both, "b": both}, FUNDS.date, DAYS[:2])
    published.publish(spark, root, {"a": both.where("false")}, FUNDS.date, DAYS[:1])
    assert published.days_of(spark, root, "a") == DAYS[:2] and published.days_of(spark, root, "b") == DAYS[1:2]
    found = published.read(spark, root, "a", date="d")
    assert {r.d for r in found.select("d").distinct().collect()} == {DAYS[1]}
    published.withdraw(spark, root, DAYS[:2])
    assert published.read(spark, root, "a") is None and published.days_of(spark, root, "a") == []
    assert published.read(spark, str(tmp_path / "nothing"), "a") is None
    assert published.verify(spark, str(tmp_path / "nothing"), ["a"]).count() == 0


def test_only_the_folders_of_the_wanted_days_are_opened(spark, tmp_path):
    root = str(tmp_path)
    published.publish(spark, root, {"a": universe(spark)}, FUNDS.date, DAYS)
    published.publish(spark, root, {"a": universe(spark, 4)}, FUNDS.date, DAYS[3:4])
    one = published.read(spark, root, "a", DAYS[3:4])
    assert {Path(f).parent.name for f in one.inputFiles()} == {f"snapshot_date={DAYS[3]}"}
    assert len({Path(f).parent.parent.name for f in one.inputFiles()}) == 1
    assert len({Path(f).parent for f in published.read(spark, root, "a").inputFiles()}) == len(DAYS)


def test_columns_that_drift(spark, tmp_path):
    root = str(tmp_path)
    shapes = ["k string, v int", "k string, v bigint, w string", "k string, v double", "k string, v string"]
    values = [("a", 1), ("b", 2**40, "w"), ("c", 0.5), ("d", "x")]
    for day, shape, value in zip(DAYS, shapes, values):
        published.publish(spark, root, {"t": spark.createDataFrame([(*value, day)], shape + ", d date")}, "d", [day])
        found = published.read(spark, root, "t", date="d")
        kinds = dict(found.dtypes)
        assert kinds["v"] == {0: "int", 1: "bigint", 2: "double", 3: "string"}[DAYS.index(day)]
    assert [(r.k, r.w) for r in found.orderBy("k").collect()] == [("a", None), ("b", "w"), ("c", None), ("d", None)]
    assert published.columns_of(spark, root).where("column = 'v'").count() == 4


def full(spark, history):
    return features.dataset(prepared(history, FUNDS), FUNDS)


def derived(spark, root, table):
    return incremental.derived_table(spark, root, FUNDS, table)


def stored_files(root, table):
    place = Path(root) / "derived" / "fii" / table
    return {str(p.relative_to(place)): p.stat().st_mtime_ns for p in place.rglob("*.parquet")}


@pytest.mark.parametrize("change", ["revised", "removed", "added", "withdrawn"])
def test_only_reached_days_are_rebuilt_and_equal_a_full_rebuild(spark, tmp_path, change):
    root = str(tmp_path)
    first = universe(spark, days=DAYS[:-1] if change == "added" else DAYS)
    days = DAYS[:-1] if change == "added" else DAYS
    published.publish(spark, root, {"fii_universe": first}, FUNDS.date, days)
    done = incremental.refresh_class(spark, root, FUNDS)
    assert done["history"] == done["dataset"] == days
    assert rows_of(spark, derived(spark, root, "dataset")) == rows_of(spark, full(spark, first))
    assert incremental.refresh_class(spark, root, FUNDS)["history"] == []  # nothing changed

    day = DAYS[-1] if change == "added" else DAYS[5]
    later = universe(spark, revised=[day] if change == "revised" else [])
    if change == "removed":
        later = later.where(~((F.col(FUNDS.date) == day) & (F.col(FUNDS.id) < "FUND06")))
    if change == "withdrawn":
        later = later.where(F.col(FUNDS.date) != day)
        published.withdraw(spark, root, [day])
    else:
        published.publish(spark, root, {"fii_universe": later}, FUNDS.date, [day])
    kept = stored_files(root, "dataset")
    current = {r.date: r.folder for r in published.current(spark, incremental.Derived(root, "FII").place("dataset")).collect()}
    done = incremental.refresh_class(spark, root, FUNDS)
    assert done["history"] == [day] and len(done["dataset"]) < len(DAYS)
    assert rows_of(spark, derived(spark, root, "dataset")) == rows_of(spark, full(spark, later))
    assert derived(spark, root, "history").count() == later.count()
    # files of before are as they were, and days that the change doesn't reach are still read from them
    assert kept.items() <= stored_files(root, "dataset").items()
    now = {r.date: r.folder for r in published.current(spark, incremental.Derived(root, "FII").place("dataset")).collect()}
    assert {d for d in now if now[d] != current.get(d)} == set(done["dataset"]) & set(now)


def test_first_build_asks_no_reach_and_stores_its_tables_once(spark, tmp_path, monkeypatch):
    """Where every day is a changed one nothing has to be found out; and no table is stored beside what is published."""
    root, whole = str(tmp_path), universe(spark)
    published.publish(spark, root, {"fii_universe": whole}, FUNDS.date, DAYS)
    asked, beside, reached, cut = [], [], incremental.reached, incremental.cut
    monkeypatch.setattr(incremental, "reached", lambda *a: asked.append(a) or reached(*a))
    monkeypatch.setattr(incremental, "cut", lambda df: beside.append(df.columns) or cut(df))
    done = incremental.refresh_class(spark, root, FUNDS)
    assert not asked and beside == [["date", "table", "fingerprint"]]  # what it was built from
    pairs = whole.select(F.upper(F.trim(FUNDS.id)).alias(FUNDS.id), FUNDS.date)
    assert done["dataset"] == sorted(r.date for r in reached(pairs, FUNDS, DAYS, (7, 30)).collect())
    assert rows_of(spark, derived(spark, root, "dataset")) == rows_of(spark, full(spark, whole))


def test_a_day_that_loses_its_last_row_goes_with_the_same_write(spark, tmp_path):
    root = str(tmp_path)
    published.publish(spark, root, {"a": universe(spark)}, FUNDS.date, DAYS)
    left = universe(spark, 4).where(F.col(FUNDS.date) != DAYS[2])
    published.publish(spark, root, {"a": left}, FUNDS.date, DAYS[2:5], keep_empty=False)
    assert published.days_of(spark, root, "a") == DAYS[:2] + DAYS[3:]
    assert published.current(spark, root).agg(F.count_distinct("version")).first()[0] == 2
    assert {r.status for r in published.verify(spark, root, ["a"]).collect()} == {"ok"}


def test_snapshot_day_and_portfolio(spark, tmp_path):
    root, day = str(tmp_path), DAYS[0]
    whole = universe(spark, 1, DAYS[:1])
    top = whole.where(F.col(FUNDS.status) == "Rank #1").withColumn("Posicao", F.lit(1))
    incremental.publish_day(root, day, {"FII": (FUNDS, top, whole)})
    assert {r.table for r in published.current(spark, root).collect()} == {"fii_universe", "fii_top", "carteira_fii"}
    incremental.refresh(spark, root, [FUNDS])
    held = derived(spark, root, "portfolio")
    assert held.count() == top.count() and {r.Tipo for r in held.collect()} == {"FII"}
    assert lake.names_in(spark, f"{root}/derived/fii/built_from", "version=") == ["1"]
