"""Fixed and adaptive-quartile screening with the reason for every rejected row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crivo.columns import attach, col, filled, number, require, without_nan
from crivo.operators.order import keep_first, quantiles, top_n
from crivo.spec import AssetSpec, QuartileRule, Rule

# Status texts.
FIXED_PREFIX = "Eliminado no filtro fixo: "
QUARTILE_PREFIX = "Eliminado no quartil: "
NOTHING_LEFT = "dados insuficientes"
RANK_PREFIX = "Rank #"
APPROVED = "Aprovado (fora do Top N)"


def first_failure(rules: Sequence[Rule]) -> Column:
    """Label of the first rule a row does not pass (unknown counts as not passed); null if it passes all."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(
        *[F.when(~F.coalesce(F.expr(r.passes), F.lit(False)), F.lit(r.label)) for r in rules]
    )


def _quartile_failure(rules: Sequence[QuartileRule]) -> Column:
    if not rules:
        return F.lit(None).cast("string")
    found = []
    for i, rule in enumerate(rules):
        limit = F.col(f"_q{i}")
        passes = col(rule.column) <= limit if rule.keep == "low" else col(rule.column) >= limit
        shown = F.call_function("format_number", limit * F.lit(float(rule.scale)), F.lit(rule.pattern))
        before, after = rule.label.split("{}")
        label = F.concat(F.lit(before), shown, F.lit(after))
        found.append(F.when(~F.coalesce(passes, F.lit(False)), label))
    return F.coalesce(*found)


def quartile_limits(
    df: DataFrame, rules: Sequence[QuartileRule], by: Sequence[str]
) -> DataFrame:
    """One row per group: the quantile each rule compares with, as `_q0`, `_q1`, ..."""
    return quantiles(df, by, {f"_q{i}": (r.column, r.q) for i, r in enumerate(rules)})


def judged(
    df: DataFrame, fixed: Sequence[Rule], quartile: Sequence[QuartileRule], by: Sequence[str]
) -> DataFrame:
    """Adds `_fixed` and `_quartile`: the first failing rule of each layer, or null. Quartiles are those
    of the rows that passed the fixed rules, and only such rows are held against them."""
    marked = df.withColumn("_fixed", first_failure(fixed))
    if not quartile:
        return marked.withColumn("_quartile", F.lit(None).cast("string"))
    limits = quartile_limits(marked.where(F.col("_fixed").isNull()), quartile, by)
    marked = attach(marked, limits, by)
    failed = F.when(F.col("_fixed").isNull(), _quartile_failure(quartile))
    return marked.withColumn("_quartile", failed).drop(*limits.columns[len(by):])


def screen(
    df: DataFrame,
    fixed: Sequence[Rule],
    quartile: Sequence[QuartileRule],
    order: Sequence[tuple[str, str]],
    id: str,
    by: Sequence[str] = (),
    top_n_rows: int = 20,
    status: str = "Status",
    place: str = "Posicao",
) -> tuple[DataFrame, DataFrame]:
    """(top list with its position, all rows with their status), per `by` group.

    Ties in `order` are broken by `id`, so the list does not depend on how the rows are stored. `df` is
    read three times (quantiles, list, statuses): pass a stored table, or `session.cut` it first.
    """
    named = [r.column for r in quartile] + [c for c, _ in order]
    require(df, [*by, id, *named], "screen")
    marked = judged(without_nan(df, df.columns), fixed, quartile, by)

    # Rows passing both layers come first, so the first n rows of a group also tell whether it has any.
    ordered = [_order_key(marked, c, direction) for c, direction in order]
    both = F.col("_quartile").isNull()
    first = top_n(
        marked.where(F.col("_fixed").isNull()), by, [both.desc(), *ordered, col(id).asc()], top_n_rows, place
    )
    some = F.bool_or(both).over(Window.partitionBy(*[col(b) for b in by]))
    top = first.withColumn("_some", some).where(both | ~F.col("_some"))

    # At most n (id, place) pairs per group travel to the group's rows.
    facts = top.groupBy(*[col(b) for b in by]).agg(
        F.bool_or("_some").alias("_some"),
        F.collect_list(F.struct(col(id).alias("id"), F.col(place).alias("place"))).alias("_list"),
    )
    mine = F.filter(F.col("_list"), lambda entry: entry["id"] == col(id))
    rank = F.array_min(F.transform(mine, lambda entry: entry["place"]))
    nothing_left = F.coalesce(F.size("_list"), F.lit(0)) <= 0
    label = F.when(nothing_left, F.lit(FIXED_PREFIX + NOTHING_LEFT)).otherwise(
        F.coalesce(
            F.concat(F.lit(FIXED_PREFIX), F.col("_fixed")),
            F.when(F.col("_some"), F.concat(F.lit(QUARTILE_PREFIX), F.col("_quartile"))),
            F.concat(F.lit(RANK_PREFIX), rank.cast("string")),
            F.lit(APPROVED),
        )
    )
    audited = attach(marked, facts, by).withColumn(status, label)
    columns = [c for c in df.columns if c != status]
    return top.drop("_fixed", "_quartile", "_some"), audited.select(*[col(c) for c in columns], status)


def _order_key(df: DataFrame, name: str, direction: str) -> Column:
    value = number(df, name)
    return value.desc_nulls_last() if direction == "desc" else value.asc_nulls_last()


def screen_assets(
    df: DataFrame,
    spec: AssetSpec,
    rules: tuple[Sequence[Rule], Sequence[QuartileRule]],
    by: Sequence[str] = (),
    top_n_rows: int = 20,
) -> tuple[DataFrame, DataFrame]:
    """Screens one asset class by its description: validation, mandatory values, one row per company
    (first in ingest order), then the rules."""
    require(df, spec.required, f"{spec.kind} universe")
    df = filled(without_nan(df, spec.mandatory), spec.mandatory)
    if spec.unique_by:
        df = keep_first(df, [*by, *spec.unique_by])
    order = [(c, d) for c, d in spec.order if c in df.columns]
    fixed, quartile = rules
    return screen(df, fixed, quartile, order, spec.id, by, top_n_rows, status=spec.status)
