"""Return models in shadow mode: trained on past dates, predicting the latest one.

Data stay distributed throughout; the driver sees only counts, medians, moments and fitted models. Forests, randomly
split trees and boosted trees are those of `trees.py`: `score_xgboost`, `score_lightgbm` and `score_catboost` are three settings of
the same boosting, trained together, so their numbers differ from what three outside libraries would give.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.columns import col, number
from crivo.functions.text import ticker
from crivo.operators.clean import as_features, feature_columns
from crivo.operators.evaluate import ensemble, scored, wide
from crivo.operators.history import latest, prepared
from crivo.operators.order import quantiles
from crivo.operators.trees import Boosting, extra_trees, mean_of, random_forest, sum_of
from crivo.operators.trees import boosted as boosted_together
from crivo.session import cut, ship
from crivo.spec import BASELINE, MODELS, AssetSpec

log = logging.getLogger(__name__)

# Gates and model settings.
MIN_TRAIN_ROWS, MIN_TRAIN_DATES = 20, 1
RIDGE_ALPHA = 1.0
TREES, TREE_DEPTH, MIN_LEAF, SEED = 250, 7, 5, 42
ROUNDS, RATE, SUBSAMPLE = 250, 0.04, 0.85
PRESETS = {
    "score_xgboost": Boosting(ROUNDS, RATE, leaves=16, depth=4, rows=SUBSAMPLE, features=SUBSAMPLE, seed=SEED),
    "score_lightgbm": Boosting(ROUNDS, RATE, leaves=31, depth=31, min_leaf=10, rows=SUBSAMPLE, features=SUBSAMPLE, seed=SEED),
    "score_catboost": Boosting(ROUNDS, RATE, leaves=32, depth=5, seed=SEED),
}
TRAINED = [m for m in MODELS if m not in ("score_top", "score_ensemble")]
WAITING = "Aguardando histórico suficiente para o horizonte selecionado."
NO_FEATURES = "Nenhuma feature numérica disponível para treinamento."
NO_MODEL = "Nenhum modelo supervisionado disponível; usando Score Top como baseline."


@dataclass(frozen=True)
class Training:
    """What a model is fitted on. `train` and `today` have `id`, `date`, `target` and one double column without
    gaps per feature, named `f0`, `f1`, ... (`inputs`); `features` are the names these have in the data."""

    train: DataFrame
    today: DataFrame
    features: list[str]
    inputs: list[str]
    rows: int
    target_spread: float
    means: dict[str, float]
    spreads: dict[str, float]
    boosted: dict[int, dict] = field(default_factory=dict)  # by rounds: all presets are trained by the first one asked for


def latest_base(data: DataFrame, spec: AssetSpec) -> DataFrame:
    """Rows of the newest date by role, with the baseline score, before any model is trained."""
    newest = latest(data, spec.date)
    absent = F.lit(None).cast("double")

    def role(name: str | None):
        return number(newest, name) if name and name in newest.columns else absent

    return newest.select(
        col(spec.date).cast("date").alias("Data_Execucao"),
        F.lit(spec.kind).alias("Tipo"),
        ticker(col(spec.id)).alias("Ticker"),
        (col(spec.name).cast("string") if spec.name in newest.columns else F.lit(None).cast("string")).alias("Nome"),
        role(spec.price).alias("preco_atual"),
        role(spec.dy).alias("dy_atual"),
        role(spec.multiple).alias("multiplo_atual"),
        role(spec.score).alias("score_top"),
    )


def training(
    data: DataFrame, spec: AssetSpec, target: str, features: Sequence[str] | None = None
) -> tuple[Training | None, str]:
    """(training set, note). None, with the reason in the note, while there is too little to train on."""
    names = list(features) if features is not None else feature_columns(data, spec, target)
    if not names:
        return None, NO_FEATURES
    codes = {f"f{i}": n for i, n in enumerate(names)}
    typed = as_features(data, [*names, target]).select(
        col(spec.id).alias("id"),
        col(spec.date).alias("date"),
        col(target).alias("target"),
        *[col(n).alias(f) for f, n in codes.items()],
    )
    typed = _spread(cut(typed))  # read by the split, the medians, the moments and every model
    newest = typed.agg(F.max("date")).first()[0]
    known = typed.where((F.col("date") < F.lit(newest)) & F.col("target").isNotNull())
    facts = known.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("date").alias("dates")).first()
    if facts["rows"] < MIN_TRAIN_ROWS or facts["dates"] < MIN_TRAIN_DATES:
        return None, (
            f"Aguardando dados: {facts['rows']} linhas treináveis e {facts['dates']} datas com target {target}. "
            f"Mínimo: {MIN_TRAIN_ROWS} linhas e {MIN_TRAIN_DATES} datas."
        )

    medians = quantiles(known, [], {f: (f, 0.5) for f in codes}).first().asDict()
    medians = {f: m for f, m in medians.items() if m is not None}
    if not medians:
        return None, NO_FEATURES
    train, inputs = known.fillna(medians), list(medians)
    moments = train.agg(
        F.stddev_pop("target").alias("target"),
        *[F.avg(f).alias(f"m_{f}") for f in inputs],
        *[F.stddev_pop(f).alias(f"s_{f}") for f in inputs],
    ).first()
    note = f"Modelos treinados com {facts['rows']} linhas e {facts['dates']} datas."
    return Training(
        train=train,
        today=typed.where(F.col("date") == F.lit(newest)).fillna(medians),
        features=[codes[f] for f in inputs],
        inputs=inputs,
        rows=facts["rows"],
        target_spread=moments["target"],
        means={f: moments[f"m_{f}"] for f in inputs},
        spreads={f: moments[f"s_{f}"] or 1.0 for f in inputs},
    ), note


def _spread(stored: DataFrame) -> DataFrame:
    """A stored table in one file for every core at least: training a small one is still a lot of work."""
    cores = stored.sparkSession.sparkContext.defaultParallelism
    return stored if len(stored.inputFiles()) >= cores else cut(stored.repartition(cores))


def _standardised(df: DataFrame, t: Training) -> DataFrame:
    return df.select("id", "date", "target", *[((F.col(f) - t.means[f]) / t.spreads[f]).alias(f) for f in t.inputs])


def _predicted(df: DataFrame) -> DataFrame:
    return df.select("id", "date", F.col("prediction").alias("predicted_return"))


def _fit(estimator, t: Training, standardise: bool = False) -> DataFrame:
    train, today = t.train, t.today
    if standardise:
        train, today = _standardised(train, t), _standardised(today, t)
    stages = [VectorAssembler(inputCols=t.inputs, outputCol="features"), estimator]
    return _predicted(Pipeline(stages=stages).fit(train).transform(today))


def ridge(t: Training, alpha: float = RIDGE_ALPHA) -> DataFrame:
    """Ridge on population-standardised features. Spark scales the penalty by the spread of the target
    and averages over rows, hence the regularisation given here."""
    penalty = alpha * t.target_spread / t.rows
    model = LinearRegression(
        labelCol="target", elasticNetParam=0.0, regParam=penalty, solver="normal", standardization=False
    )
    return _fit(model, t, standardise=True)


def forest(t: Training, trees: int = TREES) -> DataFrame:
    """Random forest: samples with replacement, every feature at every node."""
    ship(t.train.sparkSession)
    model = random_forest(t.train, t.inputs, trees, TREE_DEPTH, MIN_LEAF, SEED)
    return mean_of(model, t.today, t.inputs, TREE_DEPTH)


def random_splits(t: Training, trees: int = TREES) -> DataFrame:
    """Extra trees: all rows, one drawn threshold per feature and node."""
    ship(t.train.sparkSession)
    model = extra_trees(t.train, t.inputs, trees, TREE_DEPTH, MIN_LEAF, SEED)
    return mean_of(model, t.today, t.inputs, TREE_DEPTH)


def boosted(t: Training, rounds: int, preset: str) -> DataFrame:
    """One setting of the boosted trees. All settings share the job that the first of them starts."""
    ship(t.train.sparkSession)
    if rounds not in t.boosted:
        t.boosted[rounds] = boosted_together(t.train, t.inputs, {n: replace(p, rounds=rounds) for n, p in PRESETS.items()})
    base, trees = t.boosted[rounds][preset]
    return sum_of(base, trees, t.today, t.inputs, PRESETS[preset].depth)


def factories(trees: int = TREES, rounds: int = ROUNDS) -> dict[str, Callable[[Training], DataFrame]]:
    """Score column -> training function, in the fixed order of the models."""
    return {
        "score_ridge": ridge,
        "score_random_forest": lambda t: forest(t, trees),
        "score_extra_trees": lambda t: random_splits(t, trees),
        **{name: lambda t, name=name: boosted(t, rounds, name) for name in PRESETS},
    }


def predict(t: Training, spec: AssetSpec, models: dict[str, Callable[[Training], DataFrame]]) -> DataFrame | None:
    """Long predictions (date, class, ticker, model, score, predicted_return) of the models that could be
    fitted; a model that fails is left out."""
    parts = []
    for column, fit in models.items():
        try:
            out = fit(t)
        except Exception as error:  # noqa: BLE001 - one failing model must not stop the others
            log.warning("model %s failed for %s: %s", column, spec.kind, error)
            continue
        parts.append(
            out.select(
                F.col("date").alias("Data_Execucao"), F.lit(spec.kind).alias("Tipo"), F.col("id").alias("Ticker"),
                F.lit(MODELS[column]).alias("Modelo"), "predicted_return",
            )
        )
    if not parts:
        return None
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return scored(together, "predicted_return")


def shadow_run(
    data: DataFrame,
    spec: AssetSpec,
    horizon: int,
    models: dict[str, Callable[[Training], DataFrame]] | None = None,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Predictions for the newest date of a training set, one row per ticker: roles, one score per model,
    their mean, each model's predicted return and their mean, leading model, and the state of the section."""
    target = f"Retorno_Futuro_{horizon}d"
    ready = prepared(data, spec)
    base = latest_base(ready, spec)
    found, note = training(ready, spec, target, features)
    long = predict(found, spec, factories() if models is None else models) if found else None
    expected = f"retorno_esperado_{horizon}d"
    if long is None:
        idle = [F.lit(None).cast("double").alias(c) for c in MODELS if c != "score_top"]
        return base.select(
            "*", *idle, F.lit(None).cast("double").alias(expected), F.lit(BASELINE).alias("modelo_lider"),
            F.lit("Aquecendo").alias("status_modelos"), F.lit(NO_MODEL if found else note).alias("motivo_status"),
        )
    keys = ["Data_Execucao", "Tipo", "Ticker"]
    long = cut(long)  # read by the scores, the single predictions and their means
    scores = wide(long).drop("score_top", "score_ensemble")
    named = f"retorno_previsto_{{}}_{horizon}d"
    single = wide(long, "predicted_return", named).drop(named.format("score_top"), named.format("score_ensemble"))
    means = ensemble(long).withColumnRenamed("retorno_esperado", expected)
    return (
        base.join(scores, keys, "left")
        .join(single, keys, "left")
        .join(means, keys, "left")
        .withColumn("modelo_lider", F.coalesce("modelo_lider", F.lit(BASELINE)))
        .withColumn("status_modelos", F.lit("Ativo"))
        .withColumn("motivo_status", F.lit(note))
    )


def long_form(predictions: DataFrame) -> DataFrame:
    """Stored wide predictions as rows (date, class, ticker, model, score) for evaluation."""
    present = [c for c in MODELS if c in predictions.columns]
    rows = predictions.unpivot(["Data_Execucao", "Tipo", "Ticker"], present, "_column", "score")
    name = F.create_map(*[part for c in present for part in (F.lit(c), F.lit(MODELS[c]))])
    return rows.select("Data_Execucao", "Tipo", "Ticker", name[F.col("_column")].alias("Modelo"), "score")
