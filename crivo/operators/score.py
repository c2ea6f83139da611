"""Weighted percentile score of a cross-section, and its breakdown."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.columns import col, rounded
from crivo.functions.scalars import clamp
from crivo.operators.order import percentiles, percentiles_long
from crivo.spec import Factor


def _oriented(percentile: Column, best: str) -> Column:
    value = F.lit(100.0) - percentile if best == "min" else percentile
    return clamp(value, 0.0, 100.0)


def score(
    df: DataFrame,
    factors: Sequence[Factor],
    by: Sequence[str],
    key: Sequence[str],
    out: str = "Score",
    small_groups: bool = False,
    digits: int | None = 1,
) -> DataFrame:
    """Adds a 0-100 score: weighted mean of the factor percentiles within each `by` group.

    Weights are renormalised over the factor columns the table has. A missing value ranks last and is
    counted, so it scores best for "max" factors and worst for "min" ones.
    """
    present = [f for f in factors if f.column in df.columns]
    if not present:
        return df.withColumn(out, F.lit(0.0))
    pct = percentiles(df, by, key, [f.column for f in present], small_groups=small_groups, prefix="_pct_")
    weighted = [_oriented(col(f"_pct_{f.column}"), f.best) * F.lit(f.weight) for f in present]
    total = reduce(add, weighted) / F.lit(sum(f.weight for f in present))
    total = clamp(total, 0.0, 100.0)
    if digits is not None:
        total = rounded(total, digits)
    narrow = pct.select(*[col(k) for k in [*by, *key]], total.alias(out))
    return df.drop(out).join(narrow, [*by, *key], "left")


def breakdown(df: DataFrame, factors: Sequence[Factor], by: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Rows (by, key, factor, value, percentile, weight, direction): what each score is made of."""
    present = [f for f in factors if f.column in df.columns]
    long = percentiles_long(df, by, key, [f.column for f in present])
    weight = _lookup({f.column: f.weight for f in present})
    best = _lookup({f.column: f.best for f in present})
    oriented = F.when(best == "min", _oriented(F.col("percentile"), "min")).otherwise(
        _oriented(F.col("percentile"), "max")
    )
    return long.select(
        *[col(k) for k in [*by, *key]],
        "factor",
        "value",
        F.when(F.col("value").isNotNull(), rounded(oriented, 1)).alias("percentile"),
        weight.alias("weight"),
        best.alias("direction"),
    )


def _lookup(values: dict[str, object]) -> Column:
    found = F.lit(None)
    for name, value in values.items():
        found = F.when(F.col("factor") == name, F.lit(value)).otherwise(found)
    return found
