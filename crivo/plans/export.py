"""The daily report: every section as a table, and all of them as one JSON document per day.

Sections that grow with the data (recurring tickers, index, market and benchmark points, backtest periods) can also be stored as ordered blocks of
JSON lines with an index (`export_lines`), which no task holds whole; the document lists them in one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.columns import col
from crivo.functions.text import ticker
from crivo.operators import confidence, evaluate, report, series
from crivo.operators.history import before_day, dates_of
from crivo.operators.order import keep_last_row
from crivo.plans.daily import list_table, universe_table
from crivo.plans.rebuild import Places, stored_days
from crivo.session import cut
from crivo.sources import lake
from crivo.sources.lines import write_lines
from crivo.spec import FUNDS, MODELS, STOCKS, AssetSpec

# Benchmark names each class is compared with, and section names of the document.
COMPARED = {"FII": ("IFIX", "IMOB", "CDI"), "ACAO": ("IBOV", "IPCA", "CDI")}
SECTION = {"FII": "fiis", "ACAO": "acoes"}
# Market series that are shown on their own, and economic series among the indicators.
MARKET = ("IBOV", "IFIX", "IMOB", "CDI", "IPCA")
ECONOMIC = ("ipca_12m", "selic", "igpm")
PAYLOAD_TABLE, LINES_TABLE = "payload", "payload_lines"
GROWING = ("recorrentes", "comparativo", "benchmarks", "mercado", "indicadores_series", "backtest_periodos", "modelos_ranking")


def list_section(spark: SparkSession, root: str, day: Date, spec: AssetSpec) -> DataFrame | None:
    """The day's list as records, with each indicator's trend against the previous stored list."""
    days = stored_days(spark, root, list_table(spec), "_day")
    if days is None:
        return None
    today = days.where(F.col("_day") == F.lit(day))
    before = before_day(days, "_day", F.lit(day))
    shown = [*spec.shown, spec.score, "Posicao"]
    out = report.trends(report.records(today, shown), report.records(before, shown), spec.id, spec.trends)
    return out.withColumnRenamed(spec.score, "score") if spec.score in out.columns else out


def kpi_section(spark: SparkSession, root: str, day: Date, spec: AssetSpec) -> DataFrame | None:
    days = stored_days(spark, root, universe_table(spec), "_day")
    if days is None:
        return None
    today = days.where(F.col("_day") == F.lit(day))
    in_list = F.coalesce(col(spec.status).startswith("Rank #"), F.lit(False))
    names = [n for n in (spec.dy, spec.multiple, spec.score) if n in today.columns]
    return report.kpis(today, in_list, names)


def recurrence_section(
    spark: SparkSession, root: str, day: Date, spec: AssetSpec, portfolio: DataFrame
) -> DataFrame:
    """Recurring tickers of a class with today's indicators."""
    counted = report.recurrence(portfolio.where(F.col("Tipo") == spec.kind))
    universe = stored_days(spark, root, universe_table(spec), "_day")
    if universe is None:
        return counted
    named = universe.where(F.col("_day") == F.lit(day)).withColumn(spec.id, ticker(col(spec.id)))
    today = keep_last_row(named, [spec.id]).withColumnRenamed(spec.id, "Ticker")
    fields = {
        n: c
        for n, c in {"nome": spec.name, "preco_atual": spec.price, "dy_atual": spec.dy, "multiplo_atual": spec.multiple}.items()
        if c
    }
    out = report.with_current(counted, today, ["Ticker"], fields)
    return out.withColumn("multiplo_label", F.lit(spec.multiple))


def comparison_section(portfolio: DataFrame, prices: DataFrame, spec: AssetSpec, benchmarks: DataFrame) -> DataFrame:
    """Rows (series, date, value): the class's portfolio index and its benchmarks, all 100 on its first date.
    `benchmarks` has rows (series, date, value)."""
    rows = portfolio.where(F.col("Tipo") == spec.kind).select(
        F.col("Ticker").alias(spec.id), F.col("Data_Carteira").alias(spec.date)
    )
    index = series.portfolio_index(rows, prices, [], spec.id, spec.date, spec.price)
    start = rows.agg(F.min(col(spec.date)).alias("start"))
    compared = benchmarks.where(F.col("series").isin(*COMPARED.get(spec.kind, ())))
    starts = compared.select("series").distinct().withColumn("start", start.select("start").scalar())
    own = index.select(F.lit("carteira").alias("series"), F.col("date"), F.col("value"))
    return own.unionByName(series.rebase_from(compared, starts, ["series"]))


def market_section(benchmarks: DataFrame, start: Date | None = None) -> DataFrame:
    """Rows (series, date, value): each market series as a percentage of its own first value, or of its value at `start`.
    No portfolio is needed. `benchmarks` has rows (series, date, value)."""
    shown = benchmarks.where(F.col("series").isin(*MARKET))
    if start is None:
        return series.rebase(shown, ["series"])
    starts = shown.select("series").distinct().withColumn("start", F.lit(start))
    return series.rebase_from(shown, starts, ["series"])


def indicator_sections(economic: DataFrame | None, quotes: DataFrame | None) -> dict[str, DataFrame]:
    """The economic series, rows (series, date, value), as they were landed, a missing value kept as null; and the newest
    quote of each currency pair, rows (pair, value, pct_change, updated_at)."""
    out: dict[str, DataFrame] = {}
    if economic is not None:
        out["indicadores_series"] = economic.where(F.col("series").isin(*ECONOMIC)).select("series", "date", "value")
    if quotes is not None:
        newest = F.max_by(F.struct("value", "pct_change"), F.struct("updated_at", "value", "pct_change"))
        found = quotes.groupBy("pair").agg(newest.alias("q"), F.max("updated_at").alias("updated_at"))
        out["indicadores_cambio"] = found.select("pair", "q.*", "updated_at")
    return out


def backtest_sections(
    portfolio: DataFrame, prices: DataFrame, spec: AssetSpec, benchmarks: DataFrame, day: Date
) -> dict[str, DataFrame]:
    """The class's portfolio held from each of its dates to the next, the last period up to `day`, against its benchmarks:
    the summary in one row, and the chained periods."""
    names = list(COMPARED.get(spec.kind, ()))
    rows = portfolio.where((F.col("Tipo") == spec.kind) & (F.col("Data_Carteira") <= F.lit(day))).select(
        F.col("Ticker").alias(spec.id), F.col("Data_Carteira").alias(spec.date)
    )
    market = benchmarks.where(F.col("series").isin(*names)).select(
        "series", F.col("date").alias(spec.date), F.col("value").alias(spec.price)
    )
    until = prices.where(col(spec.date) <= F.lit(day))
    periods = cut(
        series.backtest_periods(rows, until, market, names, spec.id, spec.date, spec.price, F.lit(day))
    )
    return {
        "backtest": series.backtest_summary(rows, periods, names, spec.date),
        "backtest_periodos": series.chained_backtest(periods, names),
    }


def model_section(spark: SparkSession, root: str, day: Date, specs: Sequence[AssetSpec]) -> dict[str, DataFrame]:
    """Leaderboards (the trained models', or the day's list until there are any), performance with confidence,
    its summary, and the state of the section."""
    places = Places(root)
    boards = []
    for spec in specs:
        stored = stored_days(spark, root, f"{places.predictions}_{spec.kind.lower()}", "Data_Execucao")
        if stored is not None:
            boards.append(evaluate.leaderboard(stored))
            continue
        lists = stored_days(spark, root, list_table(spec), "_day")
        if lists is not None:
            boards.append(report.baseline_board(lists.where(F.col("_day") == F.lit(day)), spec, F.lit(day)))
    out: dict[str, DataFrame] = {}
    table = lake.read_table(spark, places.performance)
    measured = "Modelo" in table.columns
    if measured:
        trusted = confidence.with_confidence(table)
        dates = stored_days(spark, root, universe_table(specs[0]), "date")
        out["performance"] = confidence.enriched(table, trusted)
        if dates is not None:
            out["confiabilidade"] = confidence.summary(trusted, dates_of(dates, "date"), models_horizon(table))
    if boards:
        ranking = boards[0]
        for board in boards[1:]:
            ranking = ranking.unionByName(board, allowMissingColumns=True)
        out["ranking"] = ranking
        out["status"] = report.section_state(ranking, F.lit(measured))
    return out


def models_horizon(table: DataFrame, default: int = 7) -> int:
    """Horizon in days of a performance table (it has one row per class and model)."""
    first = table.select("Horizonte").first()
    return int(first[0].rstrip("d")) if first else default


def sections(
    spark: SparkSession,
    root: str,
    day: Date,
    benchmarks: DataFrame | None = None,
    specs: Sequence[AssetSpec] = (FUNDS, STOCKS),
    economic: DataFrame | None = None,
    quotes: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every section of the report that has data, as tables."""
    places = Places(root)
    portfolio = lake.read_table(spark, places.portfolio)
    have_portfolio = "Ticker" in portfolio.columns
    out: dict[str, DataFrame] = {}
    for spec in specs:
        name = SECTION[spec.kind]
        records = list_section(spark, root, day, spec)
        if records is not None:
            out[name] = records
            out[f"resumo_{name}"] = report.summary_block(records, spec)
        means = kpi_section(spark, root, day, spec)
        if means is not None:
            out[f"kpis_{name}"] = means
        if have_portfolio:
            out[f"recorrentes_{name}"] = recurrence_section(spark, root, day, spec, portfolio)
            prices = lake.read_table(spark, places.history(spec))
            if benchmarks is not None and spec.price in prices.columns:
                out[f"comparativo_{name}"] = comparison_section(portfolio, prices, spec, benchmarks)
                backtest = backtest_sections(portfolio, prices, spec, benchmarks, day)
                out.update({f"{part}_{name}": rows for part, rows in backtest.items()})
    out.update({f"modelos_{k}": v for k, v in model_section(spark, root, day, specs).items()})
    if benchmarks is not None:
        out["benchmarks"] = benchmarks
        out["mercado"] = market_section(benchmarks)
    out.update(indicator_sections(economic, quotes))
    return out


def _order(name: str, df: DataFrame) -> list[Column]:
    """Ascending keys by which a section is listed."""
    if name in SECTION.values() and "Posicao" in df.columns:
        return [F.col("Posicao")]
    if name.startswith("recorrentes"):
        missing_last = (F.lit(-1.0), F.lit(2**31 - 1))
        return [
            -F.col("aparicoes"),
            -F.coalesce("score_medio", missing_last[0]),
            F.coalesce("melhor_posicao", missing_last[1]),
            F.col("Ticker"),
        ]
    if name.startswith("backtest_periodos"):
        return [F.col("start")]
    if name == "indicadores_cambio":
        return [F.col("pair")]
    if name.startswith("comparativo") or name in ("benchmarks", "mercado", "indicadores_series"):
        return [F.col("series"), F.col("date")]
    if name == "modelos_ranking":
        return [F.col("Tipo"), F.col("rank_modelo")]
    if name == "modelos_performance":
        return evaluate.performance_order()
    return [F.lit(0)]


def document(parts: dict[str, DataFrame], day: Date, spark: SparkSession) -> DataFrame:
    """One row: `day` and `text`, the JSON of all sections, each an ordered list of records."""
    fields: list[Column] = [F.lit(day.isoformat()).alias("data")]
    for name, df in parts.items():
        keys = [k.alias(f"k{i}") for i, k in enumerate(_order(name, df))]
        record = F.struct(*[col(c) for c in df.columns])
        entries = df.select(F.struct(*keys).alias("k"), record.alias("r")).agg(
            F.collect_list(F.struct("k", "r")).alias("rows")
        )
        by_key = F.array_sort(
            "rows", lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)
        )
        listed = entries.select(F.transform(by_key, lambda e: e["r"]).alias("rows"))
        fields.append(listed.select("rows").scalar().alias(name))
    fields.append(F.array(*[F.lit(m) for m in MODELS.values()]).alias("modelos"))
    return spark.range(1).select(F.lit(day).alias("day"), F.to_json(F.struct(*fields)).alias("text"))


def export_day(
    spark: SparkSession,
    root: str,
    day: Date,
    benchmarks: DataFrame | None = None,
    specs: Sequence[AssetSpec] = (FUNDS, STOCKS),
    economic: DataFrame | None = None,
    quotes: DataFrame | None = None,
) -> DataFrame:
    """Stores the day's document in place of an earlier one and returns it."""
    text = document(sections(spark, root, day, benchmarks, specs, economic, quotes), day, spark).select("text")
    path = f"{root}/{PAYLOAD_TABLE}/{lake.DAY}={day.isoformat()}"
    text.write.mode("overwrite").text(path)
    return spark.read.text(path, wholetext=False).select(F.col("value").alias("text"))


def export_lines(spark: SparkSession, root: str, day: Date, parts: dict[str, DataFrame]) -> list[str]:
    """Stores the day's growing sections as ordered JSON lines under LINES_TABLE; returns their names."""
    names = sorted(n for n in parts if n.startswith(GROWING))
    for name in names:
        write_lines(parts[name], _order(name, parts[name]), f"{root}/{LINES_TABLE}/{lake.DAY}={day.isoformat()}/{name}")
    return names


def stored_documents(spark: SparkSession, root: str) -> DataFrame:
    """All stored documents: rows (snapshot_date, text)."""
    return spark.read.text(f"{root}/{PAYLOAD_TABLE}").select(lake.DAY, F.col("value").alias("text"))


def exported_days(spark: SparkSession, root: str) -> DataFrame:
    """Dates of the stored documents, newest first: rows (date)."""
    return dates_of(stored_documents(spark, root), lake.DAY)


__all__ = ["document", "export_day", "export_lines", "exported_days", "sections"]
