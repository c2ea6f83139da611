"""Derived tables rebuilt from the daily snapshots: histories, portfolio history, training sets, models."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.columns import col
from crivo.operators import evaluate, features, models
from crivo.operators.history import portfolio_history, portfolio_rows, union_all
from crivo.operators.order import keep_last_row
from crivo.plans.daily import PORTFOLIO_TABLE, list_table, universe_table
from crivo.sources import lake
from crivo.spec import FUNDS, HORIZONS, STOCKS, AssetSpec

log = logging.getLogger(__name__)
CLASSES = (FUNDS, STOCKS)
MODEL_HORIZON = 7


@dataclass(frozen=True)
class Places:
    """Where the derived tables of one lake live."""

    root: str

    def history(self, spec: AssetSpec) -> str:
        return f"{self.root}/derived/historico_{spec.kind.lower()}"

    def dataset(self, spec: AssetSpec) -> str:
        return f"{self.root}/derived/dataset_{spec.kind.lower()}"

    @property
    def portfolio(self) -> str:
        return f"{self.root}/derived/carteiras_historicas"

    @property
    def predictions(self) -> str:
        return "derived/model_predictions"

    @property
    def performance(self) -> str:
        return f"{self.root}/derived/model_performance"


def stored_days(spark: SparkSession, root: str, table: str, date: str) -> DataFrame | None:
    """All days of a snapshot table, or None while there is none."""
    try:
        return lake.read_days(spark, root, table, date=date).drop(lake.DAY)
    except AnalysisException as error:
        log.warning("no snapshots of %s: %s", table, error)
        return None


def history_of(spark: SparkSession, root: str, spec: AssetSpec) -> DataFrame | None:
    """All days of a class, one row per (date, ticker): the last as ingested."""
    rows = stored_days(spark, root, universe_table(spec), spec.date)
    if rows is None:
        return None
    return keep_last_row(rows, [spec.date, spec.id]).drop("_seq")


def portfolio_of(spark: SparkSession, root: str, specs: Sequence[AssetSpec] = CLASSES) -> DataFrame | None:
    """Portfolio history: stored portfolio rows, overridden by the lists they came from."""
    direct, derived = [], []
    for spec in specs:
        rows = stored_days(spark, root, f"{PORTFOLIO_TABLE}_{spec.kind.lower()}", "_day")
        if rows is not None:
            direct.append(rows.drop("_day"))
        lists = stored_days(spark, root, list_table(spec), "_day")
        if lists is not None:
            derived.append(portfolio_rows(lists, spec, F.col("_day")))
    sources = [union_all(*group) for group in (direct, derived) if group]
    return portfolio_history(*sources) if sources else None


def rebuild(spark: SparkSession, root: str, specs: Sequence[AssetSpec] = CLASSES) -> None:
    """Writes histories and portfolio history."""
    places = Places(root)
    for spec in specs:
        rows = history_of(spark, root, spec)
        if rows is not None:
            lake.write_table(rows, places.history(spec))
    portfolio = portfolio_of(spark, root, specs)
    if portfolio is not None:
        lake.write_table(portfolio, places.portfolio)


def build_datasets(
    spark: SparkSession, root: str, specs: Sequence[AssetSpec] = CLASSES, horizons: Sequence[int] = HORIZONS
) -> None:
    """Writes the training set of each class that has a history."""
    places = Places(root)
    for spec in specs:
        past = lake.read_table(spark, places.history(spec))
        if {spec.id, spec.date, spec.price} <= set(past.columns):
            lake.write_table(features.dataset(past, spec, horizons), places.dataset(spec))


def learn(
    spark: SparkSession,
    root: str,
    horizon: int = MODEL_HORIZON,
    specs: Sequence[AssetSpec] = CLASSES,
    factories: dict | None = None,
) -> DataFrame:
    """Trains and predicts in shadow mode, stores the newest date's predictions in place of earlier ones of
    that date, and rewrites the performance table, which it returns. The official list is not touched."""
    places, target = Places(root), f"Retorno_Futuro_{horizon}d"
    tables = []
    for spec in specs:
        name = f"{places.predictions}_{spec.kind.lower()}"
        data = lake.read_table(spark, places.dataset(spec))
        if target not in data.columns:
            tables.append(evaluate.with_warm_up(_no_performance(spark), [spec.kind], f"{horizon}d"))
            continue
        lake.write_days(models.shadow_run(data, spec, horizon, factories), root, name, "Data_Execucao")
        stored = lake.read_days(spark, root, name, date="Data_Execucao")
        real = data.select(
            col(spec.date).alias("Data_Execucao"), F.lit(spec.kind).alias("Tipo"), col(spec.id).alias("Ticker"), target
        )
        tables.append(
            evaluate.evaluate(models.long_form(stored), real, target, f"{horizon}d", classes=[spec.kind])
        )
    table = union_all(*tables)
    lake.write_table(table, places.performance)
    return lake.read_table(spark, places.performance)


def _no_performance(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [],
        "Tipo string, Modelo string, Horizonte string, Janelas_Validas bigint, Retorno_Medio_Top20 double, "
        "Hit_Rate_Top20 double, Spearman_IC double, Alpha_vs_Score_Top double, Status string",
    )
