"""Model evaluation in long form: one row per (date, class, ticker, model)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.columns import col
from crivo.functions.scalars import place_in
from crivo.operators.order import keep_last, top_n, with_percentiles
from crivo.session import cut
from crivo.spec import BASELINE, ENSEMBLE, MODELS

KEYS = ("Data_Execucao", "Tipo", "Ticker")
GROUP = ("Tipo", "Modelo", "Data_Execucao")
ACTIVE, WARMING = "Ativo", "Aquecendo"
MEASURES = ("Retorno_Medio_Top20", "Hit_Rate_Top20", "Spearman_IC", "Alpha_vs_Score_Top")


MIN_ROWS = 5


def with_realised(predictions: DataFrame, realised: DataFrame, target: str) -> DataFrame:
    """Predictions with their realised return, stored: everything that measures them reads them several times.

    `realised` has rows (date, class, ticker, target), one per key (the last by `_seq` is taken if it has
    one). Predictions without score and returns that are missing are left out before counting.
    """
    real = realised.where(col(target).isNotNull())
    if "_seq" in real.columns:
        real = keep_last(real, KEYS)
    both = predictions.where(F.col("score").isNotNull()).join(
        real.select(*KEYS, col(target).alias("realised")), list(KEYS)
    )
    return cut(both.select(*KEYS, "Modelo", "score", "realised"))


def paired(predictions: DataFrame, realised: DataFrame, target: str, min_rows: int = MIN_ROWS) -> DataFrame:
    """The pairs of the (model, date) windows that have `min_rows` of them."""
    both = with_realised(predictions, realised, target)
    sizes = both.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= min_rows)
    return both.join(sizes.drop("_rows"), list(GROUP), "left_semi")


def window_measures(pairs: DataFrame, n: int = 20, min_rows: int = MIN_ROWS) -> DataFrame:
    """Per (class, model, date) with `min_rows` pairs: mean return and hit rate of the `n` best scores (ties by ticker),
    and the rank correlation of score and return over all rows (null when either is constant)."""
    best = top_n(pairs, GROUP, [F.col("score").desc(), F.col("Ticker").asc()], n, "_place")
    tops = best.groupBy(*GROUP).agg(
        F.avg("realised").alias("top_return"),
        F.avg((F.col("realised") > 0).cast("int")).alias("hit_rate"),
    )
    ranks = with_percentiles(
        pairs.select(*GROUP, "score", "realised"), GROUP, {v: f"pct_{v}" for v in ("score", "realised")}
    )
    correlation = ranks.groupBy(*GROUP).agg(
        F.try_divide(
            F.covar_pop("pct_score", "pct_realised"),
            F.stddev_pop("pct_score") * F.stddev_pop("pct_realised"),
        ).alias("rank_ic"),
        F.count(F.lit(1)).alias("_rows"),
    ).where(F.col("_rows") >= min_rows).drop("_rows")
    return tops.join(correlation, list(GROUP))


def performance(measures: DataFrame, horizon: str, baseline: str = BASELINE) -> DataFrame:
    """One row per (class, model) from its windows. Alpha is the mean over the shared dates of its top
    return minus the baseline's; the baseline's own is 0."""
    base = measures.where(F.col("Modelo") == baseline).select(
        "Tipo", "Data_Execucao", F.col("top_return").alias("_base")
    )
    compared = measures.join(base, ["Tipo", "Data_Execucao"], "left")
    return compared.groupBy("Tipo", "Modelo").agg(
        F.count(F.lit(1)).alias("Janelas_Validas"),
        F.avg("top_return").alias("Retorno_Medio_Top20"),
        F.avg("hit_rate").alias("Hit_Rate_Top20"),
        F.avg("rank_ic").alias("Spearman_IC"),
        F.avg(F.col("top_return") - F.col("_base")).alias("_alpha"),
    ).select(
        "Tipo",
        "Modelo",
        F.lit(horizon).alias("Horizonte"),
        "Janelas_Validas",
        "Retorno_Medio_Top20",
        "Hit_Rate_Top20",
        "Spearman_IC",
        F.when(F.col("Modelo") == baseline, F.lit(0.0)).otherwise(F.col("_alpha")).alias("Alpha_vs_Score_Top"),
        F.lit(ACTIVE).alias("Status"),
    )


def with_warm_up(measured: DataFrame, classes: Sequence[str], horizon: str) -> DataFrame:
    """Adds, for each class without any measured model, one row of zero windows per known model."""
    names = [(c, m, horizon) for c in classes for m in MODELS.values()]
    expected = measured.sparkSession.createDataFrame(names, "Tipo string, Modelo string, Horizonte string")
    idle = expected.join(measured.select("Tipo").distinct(), "Tipo", "left_anti").select(
        "*",
        F.lit(0).cast("bigint").alias("Janelas_Validas"),
        *[F.lit(None).cast("double").alias(m) for m in MEASURES[:-1]],
        F.when(F.col("Modelo") == BASELINE, F.lit(0.0)).alias(MEASURES[-1]),
        F.lit(WARMING).alias("Status"),
    )
    return measured.unionByName(idle)


def evaluate(
    predictions: DataFrame, realised: DataFrame, target: str, horizon: str, classes: Sequence[str] = (), n: int = 20
) -> DataFrame:
    """Performance table of all models. Lists, ranks and the baseline's lists all read the stored pairs."""
    pairs = with_realised(predictions, realised, target)
    table = performance(window_measures(pairs, n), horizon)
    return with_warm_up(table, classes, horizon) if classes else table


def performance_order() -> list:
    """How performance rows are listed: class, horizon, known models in their fixed order, others by name."""
    return [F.col("Tipo"), F.col("Horizonte"), place_in(F.col("Modelo"), list(MODELS.values())), F.col("Modelo")]


def scored(predictions: DataFrame, value: str) -> DataFrame:
    """Adds `score`: the percentile of a model's predicted value within its class and date. Missing values
    stay missing and are not counted; a constant prediction scores 50."""
    return with_percentiles(cut(predictions), GROUP, {value: "score"}, missing_counts=False)


def ensemble(predictions: DataFrame, baseline: str = BASELINE) -> DataFrame:
    """Per (date, class, ticker): mean score and mean predicted return of the trained models, missing ones
    left out, and the leading model (highest score, the earlier in the fixed order on a tie; the baseline
    when no model has a score)."""
    trained = ~F.col("Modelo").isin(baseline, ENSEMBLE)
    order = place_in(F.col("Modelo"), list(MODELS.values()))
    leader = F.max_by(
        F.when(trained, F.col("Modelo")),
        F.when(trained & F.col("score").isNotNull(), F.struct(F.col("score"), -order)),
    )
    return predictions.groupBy(*KEYS).agg(
        F.avg(F.when(trained, F.col("score"))).alias("score_ensemble"),
        F.avg(F.when(trained, F.col("predicted_return"))).alias("retorno_esperado"),
        F.coalesce(leader, F.lit(baseline)).alias("modelo_lider"),
    )


def leaderboard(predictions: DataFrame, n: int = 50, baseline: str = BASELINE) -> DataFrame:
    """Newest date of each class, best first, numbered: by ensemble score if any row of the date has one,
    else by the baseline's. `predictions` has `score_ensemble` and `score_top`, one row per (date, class,
    ticker)."""
    newest = predictions.groupBy("Tipo").agg(F.max("Data_Execucao").alias("Data_Execucao"))
    current = predictions.join(newest, ["Tipo", "Data_Execucao"])
    some = current.groupBy("Tipo").agg(F.count("score_ensemble").alias("_some"))
    chosen = F.when(F.col("_some") > 0, F.col("score_ensemble")).otherwise(F.col("score_top"))
    ranked = current.join(some, "Tipo").withColumn("_chosen", chosen)
    order = [F.col("_chosen").desc_nulls_last(), F.col("Ticker").asc()]
    return top_n(ranked, ["Tipo"], order, n, "rank_modelo").drop("_some", "_chosen")


def wide(predictions: DataFrame, value: str = "score", name: str = "{}") -> DataFrame:
    """One column per known model, for export: rows (date, class, ticker). `name` holds `{}` where the model's
    score column is named."""
    return predictions.groupBy(*KEYS).agg(
        *[F.max(F.when(F.col("Modelo") == m, col(value))).alias(name.format(c)) for c, m in MODELS.items()]
    )


__all__ = [
    "ensemble", "evaluate", "leaderboard", "paired", "performance", "performance_order", "scored",
    "wide", "window_measures", "with_warm_up",
]
