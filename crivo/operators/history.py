"""Histories keyed by entity and date: upserts, replaced days, latest slice, portfolio rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.columns import attach, col, filled, first_present, number
from crivo.functions.text import iso_date, ticker
from crivo.operators.order import keep_last, keep_last_row, positions
from crivo.spec import AssetSpec

# Names a price or a date may have in stored lists.
PRICE_NAMES = ("PREÇO ATUAL (R$)", "Preço", "Preco", "Preço Atual")
DATE_NAMES = ("Data Preco", "Data Preço", "data_preco", "Data_Execucao")
PORTFOLIO_KEYS = ("Data_Carteira", "Tipo", "Ticker")


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; a column absent from a frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _ranked_union(frames: Sequence[DataFrame]) -> DataFrame:
    marked = [
        (f if "_seq" in f.columns else f.withColumn("_seq", F.lit(0).cast("bigint"))).withColumn(
            "_source", F.lit(i)
        )
        for i, f in enumerate(frames)
    ]
    return union_all(*marked)


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both, one per key: the incoming row wins, and within a source the latest `_seq`.

    Keys that neither table has are ignored; with none left, whole rows are deduplicated.
    """
    both = _ranked_union([stored, incoming])
    usable = [k for k in keys if k in both.columns]
    if not usable:
        return both.drop("_source", "_seq").dropDuplicates()
    kept = keep_last(both, usable, ["_source", "_seq"]).drop("_source")
    return kept if "_seq" in stored.columns or "_seq" in incoming.columns else kept.drop("_seq")


def replace_days(stored: DataFrame, incoming: DataFrame, date: str, keys: Sequence[str]) -> DataFrame:
    """Every date present in `incoming` is replaced as a whole; other dates stay. One row per key."""
    days = incoming.select(col(date)).distinct()
    return upsert(stored.join(days, date, "left_anti"), incoming, keys)


def latest(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows of the newest date (of each `by` group)."""
    newest = df.groupBy(*[col(b) for b in by]).agg(F.max(col(date)).alias("_newest"))
    return attach(df, newest, by).where(col(date) == F.col("_newest")).drop("_newest")


def before_day(df: DataFrame, date: str, day: Column) -> DataFrame:
    """Rows of the newest date strictly before `day`."""
    return latest(df.where(col(date) < day), date)


def dates_of(df: DataFrame, date: str) -> DataFrame:
    """Distinct valid dates, newest first."""
    return (
        df.select(iso_date(col(date)).alias("date"))
        .where(F.col("date").isNotNull())
        .distinct()
        .orderBy(F.col("date").desc())
    )


def prepared(df: DataFrame, spec: AssetSpec, by: Sequence[str] = ()) -> DataFrame:
    """History ready for time operators: normalised ticker, date and price, none of them missing, and one
    row per (`by`, ticker, date), the last by `_seq`. From here on a ticker has at most one row per day, which
    bounds every per-ticker window by the length of the calendar."""
    typed = filled(df.select(
        *[
            {
                spec.id: ticker(col(spec.id)).alias(spec.id),
                spec.date: iso_date(col(spec.date)).alias(spec.date),
                spec.price: number(df, spec.price).alias(spec.price),
            }.get(c, col(c))
            for c in df.columns
        ]
    ), [spec.id, spec.date, spec.price])
    return keep_last_row(typed, [*by, spec.id, spec.date]).drop("_seq")


def portfolio_rows(top: DataFrame, spec: AssetSpec, date: Column, place: str = "Posicao") -> DataFrame:
    """Portfolio rows of a top list: date, class, ticker, entry price, score, position."""
    price = spec.price if spec.price in top.columns else first_present(top, PRICE_NAMES)
    nothing = F.lit(None).cast("double")
    return top.select(
        date.cast("date").alias("Data_Carteira"),
        F.lit(spec.kind).alias("Tipo"),
        ticker(col(spec.id)).alias("Ticker"),
        (number(top, price) if price else nothing).alias("Preco_Entrada"),
        (number(top, spec.score) if spec.score in top.columns else nothing).alias("Score"),
        (col(place) if place in top.columns else F.lit(None)).cast("int").alias("Posicao"),
    ).where(F.col("Ticker").isNotNull())


def portfolio_history(*sources: DataFrame) -> DataFrame:
    """One portfolio history from several sources; a later source overrides an earlier one."""
    both = _ranked_union(sources)
    return keep_last(both, PORTFOLIO_KEYS, ["_source", "_seq"]).drop("_source", "_seq")


def holdings(portfolio: DataFrame, date: str, id: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per (date, `by`) of a portfolio history: its distinct tickers in order, and how many they are. Rows without
    a ticker or a date are left out. A list is as long as the day's portfolio."""
    named = portfolio.select(col(date), *[col(b) for b in by], ticker(col(id)).alias("_id"))
    counted = filled(named, [date, "_id"]).groupBy(col(date), *[col(b) for b in by]).agg(F.array_sort(F.collect_set("_id")).alias("tickers"))
    return counted.withColumn("holdings", F.size("tickers"))


def portfolio_listing(portfolio: DataFrame, place: str = "place") -> DataFrame:
    """A portfolio history with each row's place, from 0, in the order of date, class, position and ticker, missing ones last."""
    keys = ["Data_Carteira", "Tipo", "Posicao", "Ticker"]
    order = {f"_{part}{i}": flag for i, k in enumerate(keys) for part, flag in (("missing", col(k).isNull()), ("value", col(k)))}
    return positions(portfolio.withColumns(order), list(order), name=place).drop(*order)
