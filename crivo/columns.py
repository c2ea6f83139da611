"""Small column helpers shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a number looks like once locale marks are gone. Guards the cast: Spark reads "5d" as 5.0.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def col(name: str) -> Column:
    """Column by its literal name, whatever dots, spaces or slashes it holds."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def to_number(value: Column) -> Column:
    """Text or number to double; null when it is not a finite-looking number."""
    return F.regexp_extract(F.trim(value.cast("string")), NUMBER, 0).try_cast("double")


def number(df: DataFrame, name: str) -> Column:
    """`name` as double: numeric columns keep their value, NaN becomes null, text is parsed."""
    kind = dict(df.dtypes)[name]
    if kind in ("double", "float"):
        return F.nullif(col(name).cast("double"), F.lit(float("nan")))
    if kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal"):
        return col(name).cast("double")
    return to_number(col(name))


def without_nan(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The same table with NaN turned into null in the named floating columns."""
    floats = {n for n, t in df.dtypes if t in ("double", "float")} & set(names)
    if not floats:
        return df
    return df.select(
        *[F.nullif(col(n), F.lit(float("nan"))).alias(n) if n in floats else col(n) for n in df.columns]
    )


def filled(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows in which none of the named columns is null, as plain predicates that reach the scan."""
    for name in names:
        df = df.where(col(name).isNotNull())
    return df


def rounded(value: Column, digits: int) -> Column:
    """Round half to even after scaling, the rule the reported figures follow."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def require(df: DataFrame, names: Sequence[str], what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def first_present(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """First candidate name the table has, or None."""
    return next((n for n in candidates if n in df.columns), None)


def attach(df: DataFrame, facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add one-row-per-group facts to every row of the group.

    With no grouping the single row of facts becomes a scalar subquery, so no join runs at all. With
    grouping it is a plain left join: Spark broadcasts `facts` only if its measured size allows it and
    otherwise splits a hot group on the left side.
    """
    if by:
        return df.join(facts, list(by), "left")
    names = facts.columns
    row = facts.select(F.struct(*[col(n) for n in names]).alias("row")).scalar()
    return (
        df.withColumn("_facts", row)
        .select(*[col(n) for n in df.columns], *[F.col("_facts")[n].alias(n) for n in names])
    )
