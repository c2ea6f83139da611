"""The data-quality report of one lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.operators import quality
from crivo.operators.history import union_all
from crivo.plans.daily import list_table, manifest_table, universe_table
from crivo.plans.rebuild import CLASSES, Places
from crivo.sources import lake
from crivo.spec import AssetSpec


def manifest(spark: SparkSession, root: str, specs: Sequence[AssetSpec] = CLASSES) -> DataFrame | None:
    """Rows (date, table, rows, columns, fingerprint) over all snapshot tables."""
    parts = []
    for table in [t for s in specs for t in (universe_table(s), list_table(s))]:
        if lake.exists(spark, f"{root}/{table}"):
            filled = lake.manifest_of(lake.read_days(spark, root, table), lake.DAY, table)
            # A day stored without rows is there all the same.
            listed = lake.list_days(spark, root, table)
            parts.append(
                listed.join(filled, "date", "left").select(
                    "date", F.lit(table).alias("table"), F.coalesce("rows", F.lit(0)).alias("rows"), "columns", "fingerprint"
                )
            )
    return union_all(*parts) if parts else None


def stored_manifest(spark: SparkSession, root: str, specs: Sequence[AssetSpec] = CLASSES) -> DataFrame | None:
    """What the daily plans noted down when they stored their tables, if they did."""
    kept = [manifest_table(s) for s in specs if lake.days_of(spark, root, manifest_table(s))]
    return union_all(*[lake.read_days(spark, root, t).drop(lake.DAY) for t in kept]) if kept else None


def quality_report(
    spark: SparkSession, root: str, exported: DataFrame | None = None, specs: Sequence[AssetSpec] = CLASSES
) -> DataFrame:
    """Rows (name, status, detail). `exported` has the dates of the stored documents."""
    places = Places(root)
    noted, found = stored_manifest(spark, root, specs), manifest(spark, root, specs)
    listed = found if noted is None else noted
    if found is None:
        empty = spark.createDataFrame([], "date date, table string")
        return quality.report(quality.snapshots_exist(empty), quality.manifest_agrees(empty, empty))
    dates = found.select("date").distinct()
    required = [t for s in specs for t in (universe_table(s), list_table(s))]
    checks = [
        quality.snapshots_exist(dates),
        quality.manifest_agrees(dates, listed),
        quality.tables_present(listed, required),
    ]
    keyed = [(places.history(s), [s.date, s.id]) for s in specs]
    keyed.append((places.portfolio, ["Data_Carteira", "Tipo", "Ticker"]))
    plain = [places.dataset(s) for s in specs] + [f"{root}/{places.predictions}_{s.kind.lower()}" for s in specs]
    plain.append(places.performance)
    for path, keys in keyed + [(p, []) for p in plain]:
        name = path.removeprefix(f"{root}/")
        if not lake.exists(spark, path):
            checks.append(quality.fixed_result(listed, name, quality.WARN, "arquivo não encontrado"))
            continue
        df = lake.read_table(spark, path)
        checks.append(quality.not_empty(df, name))
        if keys:
            checks.append(quality.unique(df, name, keys))
        if path == places.portfolio:
            checks.append(quality.list_size_check(df))
    if exported is not None:
        checks += [quality.index_filled(exported), quality.fresh(exported, dates)]
    return quality.report(*checks)
