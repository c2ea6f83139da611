"""Index series: compounding rates, rebasing, equal-weight portfolio indexes, backtests.

A series has one value per date; windows over a series are therefore as long as its calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crivo.columns import attach, col, rounded
from crivo.operators.asof import asof, probes


def compound(df: DataFrame, by: Sequence[str], date: str = "date", rate_pct: str = "value") -> DataFrame:
    """Percent rates to an index: 100 times the running product of (1 + rate / 100). Missing rates are
    left out."""
    ordered = (
        Window.partitionBy(*[col(b) for b in by])
        .orderBy(col(date))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    growth = F.product(F.lit(1.0) + col(rate_pct) / F.lit(100.0)).over(ordered)
    return df.where(col(rate_pct).isNotNull()).select(
        *[col(b) for b in by], col(date), (growth * F.lit(100.0)).alias("value")
    )


def rebase(df: DataFrame, by: Sequence[str], date: str = "date", value: str = "value", digits: int = 4) -> DataFrame:
    """Every series as a percentage of its first non-missing value; a series that starts at 0 is dropped."""
    filled = df.where(col(value).isNotNull())
    first = filled.groupBy(*[col(b) for b in by]).agg(F.min_by(col(value), col(date)).alias("_base"))
    return attach(filled, first, by).where(F.col("_base") != 0).select(
        *[col(b) for b in by], col(date), rounded(col(value) / F.col("_base") * 100, digits).alias("value")
    )


def rebase_from(
    df: DataFrame, starts: DataFrame, by: Sequence[str], date: str = "date", value: str = "value", digits: int = 4
) -> DataFrame:
    """Every series as a percentage of its value at its start date, which `starts` (by, start) gives.

    The base is the last value not after the start, else the first one after it. The series begins exactly
    on the start date with 100; with nothing later, that point is all there is. A base of 0 drops the series
    unless it has no later point.
    """
    keys = [col(b) for b in by]
    filled = df.where(col(value).isNotNull())
    dated = filled.join(starts, list(by)) if by else attach(filled, starts, by)
    facts = dated.groupBy(*keys).agg(
        F.coalesce(
            F.max_by(F.when(col(date) <= F.col("start"), col(value)), F.when(col(date) <= F.col("start"), col(date))),
            F.min_by(col(value), F.when(col(date) >= F.col("start"), col(date))),
        ).alias("_base"),
        F.first("start").alias("start"),
        F.min(F.when(col(date) >= F.col("start"), col(date))).alias("_next"),
    )
    points = attach(filled, facts, by).where((col(date) >= F.col("start")) & (F.col("_base") != 0)).select(
        *keys, col(date).alias("date"), rounded(col(value) / F.col("_base") * 100, digits).alias("value")
    )
    # Without a value or without a start there is nothing to open with.
    opening = facts.where(F.col("_base").isNotNull() & F.col("start").isNotNull()).where(
        F.col("_next").isNull() | ((F.col("_next") > F.col("start")) & (F.col("_base") != 0))
    ).select(*keys, F.col("start").alias("date"), F.lit(100.0).alias("value"))
    return points.unionByName(opening)


def holding_periods(portfolio: DataFrame, by: Sequence[str], date: str, last_end: Column | None = None) -> DataFrame:
    """Rows (by, start, end): from each portfolio date to the next. `last_end` closes the last period; empty
    periods are left out."""
    ordered = Window.partitionBy(*[col(b) for b in by]).orderBy("start")
    dates = portfolio.select(*[col(b) for b in by], col(date).alias("start")).distinct()
    end = F.lead("start").over(ordered)
    if last_end is not None:
        end = F.coalesce(end, last_end)
    return dates.withColumn("end", end).where(F.col("end") > F.col("start"))


def portfolio_index(
    portfolio: DataFrame, prices: DataFrame, by: Sequence[str], id: str, date: str, price: str, digits: int = 4
) -> DataFrame:
    """Equal-weight index of a rebalanced portfolio: rows (by, date, value), 100 at the first date.

    A period's return is the mean of end / start - 1 over its holdings with both prices, taken from the
    last price not after each date; without any, the index stays flat. `portfolio` has one row per (by,
    date, id) and `prices` one per (by, id, date), as `history` leaves them.
    """
    periods = holding_periods(portfolio, by, date)
    holdings = portfolio.select(*[col(b) for b in by], col(id), col(date).alias("start"))
    held = holdings.join(periods, [*by, "start"])
    asked = held.select(
        *[col(b) for b in by], col(id), "start", F.explode(F.array("start", "end")).alias("at")
    )
    # At most two questions per holding and day: the end of one period and the start of the next.
    valid = prices.where(col(price) > 0)
    priced = asof(asked, valid, [*by, id], "at", date, price, one_per_day=True)

    # Both answers of a holding lie in its own partition, so folding them moves no rows.
    pairs = priced.groupBy(*[col(b) for b in by], col(id), "start").agg(
        F.max(F.when(F.col("at") == F.col("start"), F.col("found_value"))).alias("_p0"),
        F.max(F.when(F.col("at") > F.col("start"), F.col("found_value"))).alias("_p1"),
    )
    returns = pairs.groupBy(*[col(b) for b in by], "start").agg(
        F.avg(F.col("_p1") / F.col("_p0") - 1).alias("_return")
    )
    ordered = (
        Window.partitionBy(*[col(b) for b in by])
        .orderBy("start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    growth = F.product(F.lit(1.0) + F.coalesce(F.col("_return"), F.lit(0.0))).over(ordered)
    chained = periods.join(returns, [*by, "start"], "left").select(
        *[col(b) for b in by], F.col("end").alias("date"), rounded(growth * 100, digits).alias("value")
    )
    opening = portfolio.groupBy(*[col(b) for b in by]).agg(F.min(col(date)).alias("date")).withColumn(
        "value", F.lit(100.0)
    ).where(F.col("date").isNotNull())
    return opening.unionByName(chained)


def period_returns(
    windows: DataFrame, prices: DataFrame, keys: Sequence[str], date: str, price: str
) -> DataFrame:
    """Adds `return` to rows (keys, start, end, ...): last over first close within the period, minus 1.

    Null with fewer than two closes in the period or a first close of 0. Both ends are asked in one as-of pass; no close
    inside the period is joined. `windows` has one row per (keys, start, end).
    """
    closes = prices.where(col(price).isNotNull())
    both = probes(windows, closes, keys, {"_first": ("start", True), "_last": ("end", False)}, date, price)
    measured = (F.col("_first_date") < F.col("_last_date")) & (F.col("_first_value") != 0)
    return both.withColumn(
        "return", F.when(measured, F.try_divide(F.col("_last_value"), F.col("_first_value")) - 1)
    ).drop("_first_date", "_first_value", "_last_date", "_last_value")


def backtest_periods(
    portfolio: DataFrame,
    prices: DataFrame,
    benchmarks: DataFrame,
    names: Sequence[str],
    id: str,
    date: str,
    price: str,
    last_end: Column,
) -> DataFrame:
    """One row per holding period: start, end, holdings, mean return of the holdings that have one, and the
    return of each benchmark (`<name>_return`). `benchmarks` has rows (series, date, price)."""
    periods = holding_periods(portfolio, [], date, last_end)
    holdings = portfolio.select(col(id), col(date).alias("start")).distinct().join(periods, "start")
    own = (
        period_returns(holdings, prices, [id], date, price)
        .groupBy("start", "end")
        .agg(F.count(F.lit(1)).alias("holdings"), F.avg("return").alias("portfolio_return"))
    )
    asked = periods.withColumn("series", F.explode(F.array(*[F.lit(n) for n in names])))
    others = (
        period_returns(asked, benchmarks, ["series"], date, price)
        .groupBy("start")
        .agg(*[F.max(F.when(F.col("series") == n, F.col("return"))).alias(f"{n}_return") for n in names])
    )
    return own.join(others, "start", "left")


def chained_backtest(periods: DataFrame, names: Sequence[str]) -> DataFrame:
    """Base-100 indexes along the periods that have a portfolio return. A period without one is skipped for
    the benchmarks too; a benchmark without a return stays where it was."""
    ordered = Window.orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = periods.where(F.col("portfolio_return").isNotNull())
    for name in ["portfolio", *names]:
        growth = F.product(F.lit(1.0) + F.coalesce(F.col(f"{name}_return"), F.lit(0.0))).over(ordered)
        kept = kept.withColumn(f"{name}_base100", growth * 100)
    return kept


def backtest_summary(portfolio: DataFrame, periods: DataFrame, names: Sequence[str], date: str) -> DataFrame:
    """One row: rebalances, periods with data, final base-100 of the portfolio and each benchmark, and
    whether the portfolio beat it. `available` is false when no period has a portfolio return."""
    kept = periods.where(F.col("portfolio_return").isNotNull())

    def final(name: str) -> Column:
        rate = F.coalesce(F.col(f"{name}_return"), F.lit(0.0))
        return F.coalesce(F.product(F.lit(1.0) + rate), F.lit(1.0)) * 100

    ends = kept.agg(
        F.count(F.lit(1)).alias("periods"),
        *[final(n).alias(f"{n}_base100") for n in ["portfolio", *names]],
    )
    dates = portfolio.agg(F.count_distinct(col(date)).alias("rebalances"), F.min(col(date)).alias("first_date"))
    both = attach(ends, dates, [])
    return both.select(
        (F.col("periods") > 0).alias("available"),
        "first_date",
        "rebalances",
        "periods",
        *[f"{n}_base100" for n in ["portfolio", *names]],
        *[
            F.when(F.col("periods") > 0, F.col("portfolio_base100") > F.col(f"{n}_base100")).alias(f"beat_{n}")
            for n in names
        ],
    )
