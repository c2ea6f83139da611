"""Data-quality checks: each gives rows (name, status, detail); the worst status is the overall one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.columns import attach, col
from crivo.operators.history import union_all

OK, WARN, ERROR = "ok", "warn", "error"
# Expected size of a stored list.
LIST_SIZE = (15, 25)


def _check(name: Column | str, good: Column, detail: Column, bad: str) -> list[Column]:
    label = F.lit(name) if isinstance(name, str) else name
    return [
        label.alias("name"),
        F.when(good, OK).otherwise(bad).alias("status"),
        detail.alias("detail"),
    ]


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row, `duplicates`: rows beyond the first of their key. Counted through partial sums per key, so
    one heavily repeated key costs no more than any other."""
    per_key = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def snapshots_exist(dates: DataFrame) -> DataFrame:
    n = F.col("_n")
    text = F.when(n > 0, F.format_string("%d snapshots encontrados", n)).otherwise(
        F.lit("nenhum snapshot incremental encontrado")
    )
    return dates.agg(F.count_distinct("date").alias("_n")).select(*_check("lake_snapshots", n > 0, text, WARN))


def manifest_agrees(dates: DataFrame, manifest: DataFrame) -> DataFrame:
    listed = manifest.agg(F.count_distinct("date").alias("_m"), F.max("date").alias("_latest"))
    both = attach(dates.agg(F.count_distinct("date").alias("_n")), listed, [])
    text = F.concat(F.lit("latest="), F.coalesce(F.col("_latest").cast("string"), F.lit("None")))
    return both.select(*_check("lake_manifest", F.col("_n") == F.col("_m"), text, WARN))


def tables_present(manifest: DataFrame, required: Sequence[str], newest: int = 5) -> DataFrame:
    """One check per newest date: every required table is in its manifest."""
    dates = manifest.select("date").distinct().orderBy(F.col("date").desc()).limit(newest)
    have = manifest.groupBy("date").agg(F.collect_set("table").alias("_have"))
    wanted = F.array(*[F.lit(r) for r in required])
    missing = F.array_except(wanted, F.coalesce("_have", F.array().cast("array<string>")))
    joined = dates.join(have, "date", "left").withColumn("_missing", missing)
    name = F.concat(F.lit("snapshot_"), F.col("date").cast("string"), F.lit("_files"))
    text = F.when(F.size("_missing") == 0, F.lit("ok")).otherwise(
        F.concat(F.lit("faltando: "), F.array_join("_missing", ", "))
    )
    return joined.select(*_check(name, F.size("_missing") == 0, text, ERROR))


def not_empty(df: DataFrame, table: str) -> DataFrame:
    n = F.col("_n")
    return df.agg(F.count(F.lit(1)).alias("_n")).select(
        *_check(table, n > 0, F.format_string("%d linhas", n), WARN)
    )


def unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    absent = sorted(set(keys) - set(df.columns))
    if absent:
        return fixed_result(df, f"colunas_{table}", ERROR, f"faltam colunas: {absent}")
    n = F.col("duplicates")
    text = F.format_string(f"%d duplicatas em {list(keys)}", n)
    return duplicate_count(df, keys).select(*_check(f"duplicatas_{table}", n == 0, text, ERROR))


def list_sizes(portfolio: DataFrame, limits: tuple[int, int] = LIST_SIZE) -> DataFrame:
    """Rows (date, class, size) of stored lists outside the expected size."""
    sizes = portfolio.groupBy("Data_Carteira", "Tipo").agg(F.count(F.lit(1)).alias("size"))
    return sizes.where(~F.col("size").between(*limits))


def list_size_check(portfolio: DataFrame, limits: tuple[int, int] = LIST_SIZE) -> DataFrame:
    n = F.col("_n")
    text = F.when(n == 0, F.lit("tamanhos dentro do esperado")).otherwise(
        F.format_string("%d listas fora do esperado", n)
    )
    return list_sizes(portfolio, limits).agg(F.count(F.lit(1)).alias("_n")).select(
        *_check("carteira_tamanho_top", n == 0, text, WARN)
    )


def index_filled(exported: DataFrame) -> DataFrame:
    """There are exported documents to list."""
    n = F.col("_n")
    return exported.agg(F.count_distinct("date").alias("_n")).select(
        *_check("dashboard_index", n > 0, F.format_string("%d datas no index.json", n), WARN)
    )


def fresh(exported: DataFrame, stored: DataFrame) -> DataFrame:
    """The newest export is not older than the newest snapshot."""
    both = attach(exported.agg(F.max("date").alias("_e")), stored.agg(F.max("date").alias("_s")), [])
    text = F.concat(
        F.lit("dashboard_latest="), F.coalesce(F.col("_e").cast("string"), F.lit("None")),
        F.lit(", lake_latest="), F.coalesce(F.col("_s").cast("string"), F.lit("None")),
    )
    good = F.coalesce(F.col("_e") >= F.col("_s"), F.lit(False))
    return both.select(*_check("dashboard_latest_vs_lake", good, text, WARN))


def fixed_result(df: DataFrame, name: str, status: str, detail: str) -> DataFrame:
    """A check whose result is known without reading data."""
    return df.sparkSession.createDataFrame([(name, status, detail)], "name string, status string, detail string")


def report(*checks: DataFrame) -> DataFrame:
    return union_all(*checks)


def overall(checks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`status`: error over warn over ok. One row, or one for each `by` group."""
    severity = F.when(F.col("status") == ERROR, 2).when(F.col("status") == WARN, 1).otherwise(0)
    worst = F.coalesce(F.max(severity), F.lit(0))
    named = F.element_at(F.array(F.lit(OK), F.lit(WARN), F.lit(ERROR)), worst + 1).alias("status")
    return checks.groupBy(*[col(b) for b in by]).agg(named) if by else checks.agg(named)
