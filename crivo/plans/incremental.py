"""Derived tables kept up to date day by day: only days that a change of the snapshots can reach are computed again.

Snapshots and derived tables are published days (`sources/published.py`). A derived table notes which fingerprints of the
snapshots it was built from; held against the manifest of today they give the changed days. From these follow, per ticker,

* the day itself: history, prepared rows, portfolio rows and features;
* one step forwards: the ticker's next observation, whose lags look back at the changed day;
* the targets backwards: a row at t asks for the first observation at or after t + h. An observation of day d, with the
  ticker's previous one at p, answers the rows with p < t + h <= d; so these are the ones to ask again, for every horizon.

Old and new observations count both, so that a day that lost a ticker reaches the rows it used to answer. What is
recomputed reads the prepared rows of these days in full, and of the days around them only what lags and targets look
at. All other days keep their files.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date as Date
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crivo.columns import col
from crivo.operators import features
from crivo.operators.history import portfolio_history, portfolio_rows, prepared, union_all
from crivo.operators.order import keep_last_row
from crivo.plans.daily import PORTFOLIO_TABLE, list_table, universe_table
from crivo.session import cut
from crivo.sources import lake, published
from crivo.spec import FUNDS, HORIZONS, STOCKS, AssetSpec

HISTORY, PREPARED, DATASET, PORTFOLIO = "history", "prepared", "dataset", "portfolio"
BUILT_FROM = "built_from"


@dataclass(frozen=True)
class Derived:
    """Where the derived tables of one class live: each is a set of published days of its own."""

    root: str
    kind: str

    def place(self, table: str) -> str:
        return f"{self.root}/derived/{self.kind.lower()}/{table}"


def publish_day(
    root: str, day: Date, screened: dict[str, tuple[AssetSpec, DataFrame, DataFrame]], run: str | None = None
) -> str:
    """Publishes the snapshot of one day: universe, list and portfolio rows of every class (spec, list, universe), together."""
    tables: dict[str, DataFrame] = {}
    spark = None
    for spec, top, universe in screened.values():
        spark = top.sparkSession
        stamp = F.lit(day)
        tables[universe_table(spec)] = universe.drop(spec.date).withColumn("_day", stamp)
        tables[list_table(spec)] = top.drop(spec.date).withColumn("_day", stamp)
        rows = portfolio_rows(top, spec, stamp).withColumn("_day", stamp)
        tables[f"{PORTFOLIO_TABLE}_{spec.kind.lower()}"] = rows
    return published.publish(spark, root, tables, "_day", [day], run)


def changed_days(spark: SparkSession, root: str, tables: Sequence[str], place: str) -> tuple[list[Date], DataFrame]:
    """(days whose rows in `tables` differ from those that the derived table at `place` was built from, the rows to note when
    it is built). Days that are gone count as changed."""
    now = published.current(spark, root).where(F.col("table").isin(list(tables)) & (F.col("rows") > 0)).select("date", "table", "fingerprint")
    noted = f"{place}/{BUILT_FROM}"
    versions = lake.names_in(spark, noted, "version=")
    if not versions:
        return [r.date for r in now.select("date").distinct().collect()], now
    then = spark.read.schema(now.schema).parquet(f"{noted}/version={max(versions, key=int)}").withColumnRenamed("fingerprint", "then")
    both = now.join(then, ["date", "table"], "full_outer").where(~F.col("fingerprint").eqNullSafe(F.col("then")))
    return [r.date for r in both.select("date").distinct().collect()], now


def note(spark: SparkSession, place: str, built_from: DataFrame) -> None:
    """Notes what a derived table was built from; written last, so a run that broke off is made up for by the next one."""
    versions = lake.names_in(spark, f"{place}/{BUILT_FROM}", "version=")
    latest = max((int(v) for v in versions), default=0)
    built_from.coalesce(1).write.parquet(f"{place}/{BUILT_FROM}/version={latest + 1}")


def _republish(spark: SparkSession, place: str, table: str, rows: DataFrame | None, date: str, days: Iterable[Date]) -> None:
    """Replaces the given days of a derived table; days that `rows` has none for are withdrawn. `rows` is computed once."""
    days = sorted(set(days))
    if rows is None:
        published.withdraw(spark, place, set(days) & set(published.days_of(spark, place, table)))
    elif days:
        published.publish(spark, place, {table: rows}, date, days, keep_empty=False)


def reached(observed: DataFrame, spec: AssetSpec, changed: Sequence[Date], horizons: Sequence[int]) -> DataFrame:
    """(date): the days with rows that a change of the days `changed` can reach. `observed` has every (ticker, date), old and new."""
    order = Window.partitionBy("id").orderBy("date")
    # Dealt by ticker first, so that one shuffle serves the distinct rows and the windows.
    pairs = observed.select(col(spec.id).alias("id"), col(spec.date).alias("date"))
    steps = pairs.repartition("id").distinct().withColumns({"before": F.lag("date").over(order), "next": F.lead("date").over(order)})
    hit = cut(steps.where(F.col("date").isin(list(changed))))
    ahead = hit.where("next is not null").select(F.col("next").alias("date"))
    # Rows t with before < t + h <= date, of the same ticker: a span of days per horizon. A first observation answers none.
    asked = hit.where("before is not null").select("id", "before", "date", F.explode(F.array(*[F.lit(h) for h in horizons])).alias("h"))
    spans = asked.select("id", F.expr("date_add(before, 1 - h)").alias("low"), F.expr("date_sub(date, h)").alias("high"))
    low, high = spans.agg(F.min("low"), F.max("high")).first()
    dates = pairs.where(F.col("date").between(F.lit(low), F.lit(high))).select("id", F.col("date").alias("t"))  # repeated ones do no harm
    # One sorted pass per ticker: a row is reached if a span that began at or before it ends at or after it.
    events = spans.select("id", F.col("low").alias("at"), F.lit(0).alias("kind"), F.col("high").alias("until")).unionByName(
        dates.select("id", F.col("t").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("date").alias("until"))
    )
    open_until = F.max("until").over(
        Window.partitionBy("id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    back = events.withColumn("open", open_until).where("kind = 1 and open >= at").select(F.col("at").alias("date"))
    return hit.select("date").unionByName(ahead).unionByName(back).distinct()


def _window(base: DataFrame, spec: AssetSpec, dirty: Sequence[Date], horizons: Sequence[int]) -> DataFrame:
    """What the rows of the days `dirty` need: their own rows in full, and of other days ticker, date, price and score: those
    between, each ticker's last one before, and the first one after the longest horizon."""
    low, high = min(dirty), max(dirty) + timedelta(days=max(horizons))
    thin = [c for c in (spec.id, spec.date, spec.price, spec.score) if c in base.columns]
    day = col(spec.date)
    around = base.select(*[col(c) for c in thin])
    between = around.where((day >= F.lit(low)) & (day <= F.lit(high)) & ~day.isin(list(dirty)))
    # Column by column: numbers and dates are kept in a hash table, a struct would be sorted for.
    values = [c for c in thin if c not in (spec.id, spec.date)]
    last = around.where(day < F.lit(low)).groupBy(col(spec.id)).agg(
        F.max(day).alias(spec.date), *[F.max_by(col(c), day).alias(c) for c in values]
    )
    first = around.where(day > F.lit(high)).groupBy(col(spec.id)).agg(
        F.min(day).alias(spec.date), *[F.min_by(col(c), day).alias(c) for c in values]
    )
    return union_all(base.where(day.isin(list(dirty))), between, last, first)


def refresh_class(
    spark: SparkSession, root: str, spec: AssetSpec, horizons: Sequence[int] = HORIZONS
) -> dict[str, list[Date]]:
    """Brings history, prepared rows, training set and portfolio rows of one class up to date; returns the days that were
    computed again, by table."""
    derived = Derived(root, spec.kind)
    sources = [universe_table(spec), list_table(spec), f"{PORTFOLIO_TABLE}_{spec.kind.lower()}"]
    done: dict[str, list[Date]] = {HISTORY: [], PREPARED: [], DATASET: [], PORTFOLIO: []}
    mark = f"{root}/derived/{spec.kind.lower()}"
    changed, built_from = changed_days(spark, root, sources, mark)
    if not changed:
        return done
    built_from = cut(built_from)
    # Published folders stay as they are, so what was published is read back where it is needed next.
    rows = published.read(spark, root, universe_table(spec), changed, spec.date)
    history = None if rows is None else keep_last_row(rows, [spec.date, spec.id]).drop("_seq")
    _republish(spark, derived.place(HISTORY), HISTORY, history, spec.date, changed)
    done[HISTORY] = sorted(changed)

    before = published.read(spark, derived.place(PREPARED), PREPARED, changed, spec.date)
    days = set(published.days_of(spark, derived.place(PREPARED), PREPARED))
    stored = published.read(spark, derived.place(HISTORY), HISTORY, changed, spec.date)
    base = None
    if stored is not None and {spec.id, spec.date, spec.price} <= set(stored.columns):
        base = prepared(stored, spec)
    _republish(spark, derived.place(PREPARED), PREPARED, base, spec.date, changed)
    done[PREPARED] = sorted(changed)

    days |= set(published.days_of(spark, derived.place(PREPARED), PREPARED))  # old and new ones
    whole = published.read(spark, derived.place(PREPARED), PREPARED, None, spec.date)
    pairs = [d.select(col(spec.id), col(spec.date)) for d in (whole, before) if d is not None]
    if pairs:
        if days <= set(changed):  # as in the first build: every day is a changed one
            dirty = sorted(days)
        else:
            dirty = sorted(r.date for r in reached(union_all(*pairs), spec, changed, horizons).collect())
        data = None
        if whole is not None and dirty:
            data = features.dataset_of_prepared(_window(whole, spec, dirty, horizons), spec, horizons).where(col(spec.date).isin(dirty))
        _republish(spark, derived.place(DATASET), DATASET, data, spec.date, dirty)
        done[DATASET] = dirty

    lists = published.read(spark, root, list_table(spec), changed, "_day")
    direct = published.read(spark, root, f"{PORTFOLIO_TABLE}_{spec.kind.lower()}", changed, "_day")
    parts = [] if direct is None else [direct.drop("_day")]
    if lists is not None:
        parts.append(portfolio_rows(lists, spec, F.col("_day")))
    held = portfolio_history(*parts) if parts else None
    _republish(spark, derived.place(PORTFOLIO), PORTFOLIO, held, "Data_Carteira", changed)
    done[PORTFOLIO] = sorted(changed)
    note(spark, mark, built_from)
    return done


def refresh(
    spark: SparkSession, root: str, specs: Sequence[AssetSpec] = (FUNDS, STOCKS), horizons: Sequence[int] = HORIZONS
) -> dict[str, dict[str, list[Date]]]:
    """`refresh_class` for every class."""
    return {spec.kind: refresh_class(spark, root, spec, horizons) for spec in specs}


def derived_table(spark: SparkSession, root: str, spec: AssetSpec, table: str) -> DataFrame | None:
    """A derived table over all its days."""
    date = "Data_Carteira" if table == PORTFOLIO else spec.date
    return published.read(spark, Derived(root, spec.kind).place(table), table, None, date)
