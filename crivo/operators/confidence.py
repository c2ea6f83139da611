"""How far a model's measured performance can be trusted, and how mature the data are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.columns import attach, rounded
from crivo.functions.scalars import NOT_MEASURABLE, clamp, confidence_level, linear_scale, place_in
from crivo.spec import BASELINE, MODELS

# Weights of the components and the ranges over which they go from 0 to 1.
WEIGHTS = {"coverage": 0.40, "hit": 0.25, "ic": 0.25, "alpha": 0.10}
HIT_RANGE, IC_RANGE, ALPHA_RANGE = (0.50, 0.65), (0.00, 0.30), (0.00, 0.03)
BASELINE_ALPHA = 0.50
MIN_WINDOWS, TARGET_WINDOWS, HORIZON_DAYS = 1, 5, 30


def with_confidence(table: DataFrame, min_windows: int = MIN_WINDOWS, target_windows: int = TARGET_WINDOWS) -> DataFrame:
    """Adds confidence in percent, its level and its components to a performance table."""
    windows = F.col("Janelas_Validas")
    enough = windows >= min_windows
    coverage = clamp(windows / F.lit(float(max(target_windows, 1))))
    hit = linear_scale(F.col("Hit_Rate_Top20"), *HIT_RANGE)
    ic = linear_scale(F.col("Spearman_IC"), *IC_RANGE)
    alpha = F.when(F.col("Modelo") == BASELINE, F.lit(BASELINE_ALPHA)).otherwise(
        linear_scale(F.col("Alpha_vs_Score_Top"), *ALPHA_RANGE)
    )
    total = (
        F.lit(WEIGHTS["coverage"]) * coverage
        + F.lit(WEIGHTS["hit"]) * hit
        + F.lit(WEIGHTS["ic"]) * ic
        + F.lit(WEIGHTS["alpha"]) * alpha
    )
    pct = F.when(enough, rounded(clamp(total) * 100, 2)).otherwise(F.lit(0.0))

    def component(value: Column) -> Column:
        return F.when(enough, rounded(value * 100, 2))

    warming = windows / F.lit(float(max(min_windows, 1)))
    return table.withColumn("Confiabilidade_Pct", pct).select(
        "*",
        F.when(enough, confidence_level(F.col("Confiabilidade_Pct"), windows, min_windows))
        .otherwise(F.lit(NOT_MEASURABLE))
        .alias("Nivel_Confiabilidade"),
        F.struct(
            rounded(F.when(enough, coverage).otherwise(warming) * 100, 2).alias("cobertura_historica"),
            component(hit).alias("hit_rate"),
            component(ic).alias("spearman_ic"),
            component(alpha).alias("alpha_vs_score_top"),
        ).alias("Componentes_Confiabilidade"),
    )


def enriched(table: DataFrame, confidence: DataFrame) -> DataFrame:
    """A performance table with the confidence of the same (class, model, horizon)."""
    keys = ["Tipo", "Modelo", "Horizonte"]
    return table.join(
        confidence.select(*keys, "Confiabilidade_Pct", "Nivel_Confiabilidade").dropDuplicates(keys), keys, "left"
    )


def maturity(dates: DataFrame, date: str = "date", horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """One row: first and last snapshot, days between, number of snapshots, share of the horizon covered."""
    facts = dates.agg(
        F.min(date).alias("primeiro_snapshot"),
        F.max(date).alias("ultimo_snapshot"),
        F.count_distinct(date).alias("qtd_snapshots"),
    )
    days = F.coalesce(F.datediff("ultimo_snapshot", "primeiro_snapshot"), F.lit(0))
    return facts.withColumn("dias_historico", days).withColumn(
        "maturidade_dados_pct",
        rounded(clamp(F.col("dias_historico") / F.lit(float(max(horizon_days, 1)))) * 100, 2),
    )


def summary(
    confidence: DataFrame, dates: DataFrame, horizon_days: int = HORIZON_DAYS, min_windows: int = MIN_WINDOWS,
    target_windows: int = TARGET_WINDOWS,
) -> DataFrame:
    """One row: the most trusted model among those measurable (the earlier listed on a tie), overall
    confidence and level, status, data maturity. The list of models is as long as the performance table:
    one entry per class, model and horizon."""
    measurable = F.col("Janelas_Validas") >= min_windows
    listed = place_in(F.col("Modelo"), list(MODELS.values()))
    earlier = F.struct(F.col("Tipo").alias("a"), F.col("Horizonte").alias("b"), listed.alias("c"), F.col("Modelo").alias("d"))
    entry = F.struct("Tipo", "Modelo", "Horizonte", "Confiabilidade_Pct", "Janelas_Validas")
    best = confidence.where(measurable).agg(F.max("Confiabilidade_Pct").alias("_best"))
    marked = attach(confidence, best, [])
    leading = F.when(measurable & (F.col("Confiabilidade_Pct") == F.col("_best")), earlier)
    facts = marked.agg(
        F.min_by(entry, leading).alias("modelo_mais_confiavel"),
        F.coalesce(F.max("Janelas_Validas"), F.lit(0)).alias("janelas_validas_max"),
        F.sort_array(F.collect_list(F.struct(
            F.col("Tipo").alias("Tipo"),
            (-F.col("Confiabilidade_Pct")).alias("_order"),
            *[F.col(c) for c in confidence.columns if c != "Tipo"],
        ))).alias("_models"),
    )
    leader = F.col("modelo_mais_confiavel")
    predictive = F.coalesce(leader["Confiabilidade_Pct"], F.lit(0.0))
    waiting = (
        f"Aguardando pelo menos {min_windows} janelas válidas de {horizon_days} dias. "
        "Até lá, a confiança permanece inicial para evitar falso positivo."
    )
    message = F.format_string(
        "Confiabilidade calculada com base em %d janelas válidas. Modelo mais confiável no momento: %s (%s).",
        leader["Janelas_Validas"], leader["Modelo"], leader["Tipo"],
    )
    shown = [c for c in confidence.columns]
    models = F.transform("_models", lambda m: F.struct(*[m[c].alias(c) for c in shown]))
    return attach(facts, maturity(dates, horizon_days=horizon_days), []).select(
        F.when(leader.isNotNull(), F.lit("Ativo")).otherwise(F.lit("Aquecendo")).alias("status"),
        F.lit(horizon_days).alias("horizonte_dias"),
        "maturidade_dados_pct",
        predictive.alias("confiabilidade_preditiva_pct"),
        confidence_level(predictive, F.col("janelas_validas_max"), min_windows).alias("nivel_confiabilidade"),
        leader.dropFields("Janelas_Validas").alias("modelo_mais_confiavel"),
        "janelas_validas_max",
        F.lit(min_windows).alias("min_janelas_validas"),
        F.lit(target_windows).alias("target_janelas_validas"),
        "primeiro_snapshot",
        "ultimo_snapshot",
        "dias_historico",
        "qtd_snapshots",
        F.when(leader.isNotNull(), message).otherwise(F.lit(waiting)).alias("mensagem"),
        models.alias("por_modelo"),
    )
