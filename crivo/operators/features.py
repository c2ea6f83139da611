"""Lagged features and forward-return targets of a history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crivo.columns import col, number, require
from crivo.operators.asof import forward_returns
from crivo.operators.history import prepared
from crivo.spec import HORIZONS, AssetSpec


def features(df: DataFrame, spec: AssetSpec, by: Sequence[str] = (), approved_text_only: bool = False) -> DataFrame:
    """Adds, per ticker in date order: previous price, return and days since it, score change, and whether
    the row passed the screen. Ranked rows count as passed; `approved_text_only` accepts only statuses that
    say so."""
    ordered = Window.partitionBy(*[col(b) for b in by], col(spec.id)).orderBy(col(spec.date))
    price = col(spec.price)
    out = df.withColumn("Preco_Anterior", F.lag(price).over(ordered))
    out = out.withColumn(
        "Dias_Desde_Snapshot_Anterior",
        F.datediff(col(spec.date), F.lag(col(spec.date)).over(ordered)),
    ).withColumn(
        "Retorno_Desde_Snapshot_Anterior", F.try_divide(price, F.col("Preco_Anterior")) - 1
    )
    if spec.score in df.columns:
        value = number(df, spec.score)
        out = out.withColumn("Score_Anterior", F.lag(value).over(ordered))
        out = out.withColumn("Delta_Score", value - F.col("Score_Anterior"))
    if spec.status in df.columns:
        status = F.upper(col(spec.status))
        passed = status.contains("APROV")
        if not approved_text_only:
            passed = passed | status.startswith("RANK #")
        out = out.withColumn("Aprovado_Filtro", F.coalesce(passed, F.lit(False)).cast("int"))
    return out


def dataset(
    df: DataFrame, spec: AssetSpec, horizons: Sequence[int] = HORIZONS, by: Sequence[str] = ()
) -> DataFrame:
    """Training set of one class: prepared history, features, targets. One shuffle by ticker serves the
    lags, the as-of pass and the fold."""
    require(df, [spec.id, spec.date, spec.price], f"{spec.kind} history")
    return dataset_of_prepared(prepared(df, spec, by), spec, horizons, by)


def dataset_of_prepared(
    df: DataFrame, spec: AssetSpec, horizons: Sequence[int] = HORIZONS, by: Sequence[str] = ()
) -> DataFrame:
    """`dataset` of a history that went through `prepared` before: it is neither parsed nor deduplicated again."""
    return forward_returns(features(df, spec, by), [*by, spec.id], spec.date, spec.price, horizons)
