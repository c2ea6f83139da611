"""Figures of the daily report, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.columns import attach, col, number
from crivo.functions.scalars import exportable, trend
from crivo.functions.text import ticker
from crivo.operators.order import keep_last_row, top_n
from crivo.spec import BASELINE, AssetSpec

# Report histograms, (upper edges after the lowest edge, labels).
DY_BINS = ([0, 0.02, 0.04, 0.06, 0.08, 0.10, 1.0], ["0-2%", "2-4%", "4-6%", "6-8%", "8-10%", "10%+"])
MULTIPLE_BINS = ([0, 0.5, 1.0, 1.5, 2.0, 3.0, 100], ["0-0,5", "0,5-1,0", "1,0-1,5", "1,5-2,0", "2,0-3,0", "3,0+"])
# Section states, the strongest first, and the note of rows shown without trained models.
STATES = ("Ativo", "Baseline", "Aquecendo", "Sem dados")
BASELINE_NOTE = "Parquet de previsões ainda não disponível; exibindo Score Top como baseline da aba ML."


def records(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns that exist, with numbers made exportable."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            exportable(col(n)).alias(n) if kinds[n] in ("double", "float") else col(n)
            for n in names
            if n in kinds
        ]
    )


def trends(
    today: DataFrame, previous: DataFrame, id: str, names: Sequence[str], by: Sequence[str] = (), from_zero: bool = False
) -> DataFrame:
    """Adds `<name>_tendencia` for each indicator: its direction against the previous day's record (`from_zero`: see `trend`)."""
    shown = [n for n in names if n in today.columns]
    known = [n for n in shown if n in previous.columns]
    keys = [*by, id]
    last = keep_last_row(previous, keys)  # a repeated record must not repeat today's row
    before = last.select(*[col(k) for k in keys], *[col(n).alias(f"_prev_{n}") for n in known])
    joined = today.join(before, keys, "left")
    labels = [
        trend(col(n), col(f"_prev_{n}") if n in known else F.lit(None).cast("double"), from_zero=from_zero).alias(f"{n}_tendencia")
        for n in shown
    ]
    return joined.select(*[col(c) for c in today.columns], *labels)


def kpis(universe: DataFrame, in_top: Column, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per group: mean of each indicator over the list (`<name>_carteira`) and over all rows
    (`<name>_mercado`, also as `<name>_geral`), and the sizes of both. One pass."""
    means = []
    for n in names:
        value = number(universe, n)
        means += [
            F.avg(F.when(in_top, value)).alias(f"{n}_carteira"),
            F.avg(value).alias(f"{n}_mercado"),
            F.avg(value).alias(f"{n}_geral"),
        ]
    return universe.groupBy(*[col(b) for b in by]).agg(
        *means, F.count(F.lit(1)).alias("total_universo"), F.count_if(in_top).alias("total_carteira")
    )


def recurrence(portfolio: DataFrame, top: int | None = None) -> DataFrame:
    """Per class and ticker of a portfolio history: appearances, mean score, best position, last date, and
    its place in the class (`ordem`) by these."""
    named = portfolio.withColumns({"Ticker": ticker(F.col("Ticker")), "Tipo": F.upper(F.trim("Tipo"))})
    named = named.where(F.col("Ticker").isNotNull())
    counted = named.groupBy("Tipo", "Ticker").agg(
        F.count(F.lit(1)).alias("aparicoes"),
        F.avg("Score").alias("score_medio"),
        F.min("Posicao").alias("melhor_posicao"),
        F.max("Data_Carteira").alias("ultima_aparicao"),
    )
    if top is None:
        return counted
    return top_n(counted, ["Tipo"], recurrence_order(), top, "ordem")


def recurrence_order() -> list[Column]:
    return [
        F.col("aparicoes").desc(),
        F.col("score_medio").desc_nulls_last(),
        F.col("melhor_posicao").asc_nulls_last(),
        F.col("Ticker").asc(),
    ]


def with_current(df: DataFrame, current: DataFrame, keys: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Adds today's indicators (`fields`: new name -> column of `current`) by key; unknown keys get null.
    `current` has one row per key (`history.upsert` of universe and list gives that)."""
    chosen = current.select(
        *[col(k) for k in keys], *[col(c).alias(new) for new, c in fields.items() if c in current.columns]
    )
    absent = [new for new, c in fields.items() if c not in current.columns]
    out = df.join(chosen, list(keys), "left")
    return out.select("*", *[F.lit(None).cast("double").alias(new) for new in absent])


def histogram(
    df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Rows (by, faixa, quantidade): values counted per interval, right edge included, the lowest edge too;
    values outside are left out and empty intervals show 0. One aggregate, no join."""
    number_ = number(df, value)
    counts = []
    for i, label in enumerate(labels):
        low, high = float(edges[i]), float(edges[i + 1])
        above = number_ >= low if i == 0 else number_ > low
        counts.append(F.count_if(above & (number_ <= high)).alias(label))
    table = df.groupBy(*[col(b) for b in by]).agg(*counts)
    return table.unpivot([col(b) for b in by], [col(label) for label in labels], "faixa", "quantidade")


def baseline_board(top: DataFrame, spec: AssetSpec, date: Column, n: int = 50) -> DataFrame:
    """The leaderboard shown until models are trained: the current list by score."""
    absent = F.lit(None).cast("double")

    def role(name: str | None) -> Column:
        return number(top, name) if name and name in top.columns else absent

    named = top.select(
        date.cast("date").alias("Data_Execucao"),
        F.lit(spec.kind).alias("Tipo"),
        ticker(col(spec.id)).alias("Ticker"),
        (col(spec.name) if spec.name in top.columns else F.lit(None).cast("string")).alias("Nome"),
        role(spec.price).alias("preco_atual"),
        role(spec.dy).alias("dy_atual"),
        role(spec.multiple).alias("multiplo_atual"),
        role(spec.score).alias("score_top"),
        F.lit(BASELINE).alias("modelo_lider"),
        F.lit(STATES[1]).alias("status_modelos"),
        F.lit(BASELINE_NOTE).alias("motivo_status"),
    ).where(F.col("Ticker").isNotNull())
    order = [F.col("score_top").desc_nulls_last(), F.col("Ticker").asc()]
    return top_n(named, ["Tipo"], order, n, "rank_modelo")


def section_state(boards: DataFrame, has_performance: Column, by: Sequence[str] = ()) -> DataFrame:
    """One row, `status`, or one per value of `by`: the strongest state among the leaderboard rows; with rows or performance
    but no known state the section is warming up."""
    state = F.lower(F.col("status_modelos"))
    facts = boards.groupBy(*[col(b) for b in by]).agg(
        F.max((state == "ativo").cast("int")).alias("_active"),
        F.max((state == "baseline").cast("int")).alias("_baseline"),
        F.count(F.lit(1)).alias("_rows"),
    )
    return facts.select(
        *[col(b) for b in by],
        F.when(F.col("_active") == 1, STATES[0])
        .when(F.col("_baseline") == 1, STATES[1])
        .when((F.col("_rows") > 0) | has_performance, STATES[2])
        .otherwise(STATES[3])
        .alias("status")
    )


def summary_block(top: DataFrame, spec: AssetSpec) -> DataFrame:
    """One row: size of the list and its mean yield and multiple."""
    means = [
        exportable(F.avg(number(top, c))).alias(name)
        for name, c in (("dy_medio", spec.dy), ("multiplo_medio", spec.multiple))
        if c in top.columns
    ]
    return top.agg(F.count(F.lit(1)).alias("total"), *means)


def profile(df: DataFrame, date: str, measured: Sequence[str], states: str | None = None) -> DataFrame:
    """One row: rows, period, distinct dates, and how many values each measured column has; with `states`,
    also a map of state -> rows (as many entries as there are states)."""
    facts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(col(date)).alias("first_date"),
        F.max(col(date)).alias("last_date"),
        F.count_distinct(col(date)).alias("dates"),
        *[F.count(number(df, m)).alias(f"{m}_valid") for m in measured if m in df.columns],
    )
    if states is None:
        return facts
    counts = df.groupBy(col(states).alias("state")).agg(F.count(F.lit(1)).alias("n"))
    by_state = counts.agg(
        F.map_from_entries(F.collect_list(F.struct(F.coalesce("state", F.lit("")), "n"))).alias("by_state")
    )
    return attach(facts, by_state, [])
