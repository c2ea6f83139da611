"""Exact ranks, percentiles, quantiles and top-n that never put one whole large group in one task.

A cross-section may be a single group, or one group may hold a third of all rows, so nothing here opens
a window over "all rows of a group" without knowing its size. Instead:

1. equal values are counted first (a plain aggregate, combined before its shuffle, so a hot value is cheap);
2. groups with many distinct values are cut into blocks, and these into leaves, by a monotone function of the
   value: neighbouring values share a leaf, and which leaf a value falls into depends on nothing but the
   value, so re-runs agree; a group with few distinct values is one leaf;
3. a window inside each leaf counts the rows before a value, and the totals of leaves and blocks give each
   leaf its offset.

`small_groups=True` is for callers who know that every group fits one task (a daily universe of a few
thousand assets): one shuffle and two sorts instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crivo.columns import attach, col, filled, number, quoted, require
from crivo.session import cut

# Groups with more distinct values than this are cut into blocks and leaves.
SPLIT_ABOVE = 1_000_000
# Where a value stands on a scale of 4,096 steps for each factor e in magnitude, from the smallest double up.
_STEPS = "((ln(abs(value)) + 746D) * 4096D)"
# Its step is its block, and a 1,048,576th of a step its leaf; both grow with the value. So a window over the
# blocks of a group sees as many rows as there are steps in the range of the data (some 2,800 per factor 2),
# a window over the leaves of a block at most 1,048,576, and a leaf holds values equal to ten digits.
_BLOCK = f"""case when value is null then {2**62}L when value = 0 then 0L
  else cast(signum(value) as bigint) * least(floor({_STEPS}), {2**61}L) end"""
_LEAF = f"""case when value is null or value = 0 or abs(value) = double('infinity') then 0L
  else cast(signum(value) as bigint) * floor(({_STEPS} - floor({_STEPS})) * 1048576D) end"""


def _melted(df: DataFrame, by: Sequence[str], key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows (by, key, factor, value): all factors are ranked by one job instead of one job each.

    Rows without a group have no rank. Saying so here, before the table is used twice, keeps both uses
    identical, so that Spark computes the shared part once.
    """
    keys = [*by, *key]
    numeric = df.select(*[col(k) for k in keys], *[number(df, v).alias(v) for v in values])
    return filled(numeric, by).unpivot([col(k) for k in keys], [col(v) for v in values], "factor", "value")


def value_counts(long: DataFrame, by: Sequence[str], split_above: int | None = None) -> DataFrame:
    """Per group and distinct value: its `count`, the rows `before` it, and the group's `filled` and
    `missing` rows and number of `distinct` filled values. Missing values sort last, as one value."""
    limit = SPLIT_ABOVE if split_above is None else split_above
    groups = [*by, "factor"]
    named = ", ".join(quoted(g) for g in groups)
    counts = long.groupBy(*groups, "value").agg(F.expr("count(1) as count"))
    # Only groups to be split are joined: one row for every million of the input at most, so it can be broadcast. A join
    # by group would bring each whole group to one task, and Spark would leave it there for the windows below.
    split = counts.groupBy(*groups).agg(
        F.expr("sum(if(value is null, 0, count)) as _filled"),
        F.expr("sum(if(value is null, count, 0)) as _missing"),
        F.expr("count(value) as _distinct"),
    ).where(f"_distinct > {limit}")
    blocked = counts.join(F.broadcast(split), groups, "left").selectExpr(
        "*", f"if(_distinct is null, 0L, {_BLOCK}) as _block", f"if(_distinct is null, 0L, {_LEAF}) as _leaf"
    )

    # Offsets exist only for split groups; without any, Spark drops this branch while the query runs. The shuffles by
    # every key keep a split group in many tasks: one by some of the keys would do for Spark, and hold a group together.
    leaves = blocked.where("_distinct is not null").groupBy(*groups, "_block", "_leaf").agg(F.expr("sum(count) as _rows"))
    blocks = leaves.groupBy(*groups, "_block").agg(F.expr("sum(_rows) as _all"))
    kept = [quoted(g) for g in groups]
    before_block = blocks.selectExpr(
        *kept, "_block", f"sum(_all) over (partition by {named} order by _block) - _all as _a"
    ).repartition(*groups, "_block")
    before_leaf = leaves.selectExpr(
        *kept, "_block", "_leaf", f"sum(_rows) over (partition by {named}, _block order by _leaf) - _rows as _b"
    )
    offsets = before_leaf.join(before_block, [*groups, "_block"]).selectExpr(
        *kept, "_block", "_leaf", "_a + _b as _offset"
    ).repartition(*groups, "_block", "_leaf")
    # A group that is not split is one leaf: sums over the leaf are sums over the group.
    leaf = f"partition by {named}, _block, _leaf"
    local = blocked.selectExpr(
        "*",
        f"sum(count) over ({leaf} order by value nulls last) - count as _local",
        f"sum(if(value is null, 0, count)) over ({leaf}) as _leaf_filled",
        f"sum(if(value is null, count, 0)) over ({leaf}) as _leaf_missing",
        f"count(value) over ({leaf}) as _leaf_distinct",
    )
    return local.join(offsets, [*groups, "_block", "_leaf"], "left").selectExpr(
        *kept,
        "value",
        "count",
        "coalesce(_offset, 0L) + _local as before",
        "coalesce(_filled, _leaf_filled) as filled",
        "coalesce(_missing, _leaf_missing) as missing",
        "coalesce(_distinct, _leaf_distinct) as distinct",
    )


# Average-tie rank as a percentage, from the columns of `value_counts`.
_RANK = "(before + (count + 1) / 2D)"
_MISSING_LAST = f"{_RANK} / (filled + missing) * 100"
_MISSING_OUT = f"if(filled = 0, null, if(distinct <= 1, 50D, if(value is null, null, {_RANK} / filled * 100)))"


def percentiles_long(
    df: DataFrame, by: Sequence[str], key: Sequence[str], values: Sequence[str], missing_counts: bool = True
) -> DataFrame:
    """Rows (by, key, factor, value, percentile), 0-100, average ties.

    With `missing_counts` a missing value ranks last and is counted; otherwise it is left out, stays
    null, and a group with one distinct value gets 50 throughout.
    """
    require(df, [*by, *key, *values], "percentiles")
    long = _melted(df, by, key, values)
    scores = value_counts(long, by).selectExpr(
        *[quoted(b) for b in by],
        "factor",
        "value",
        f"{_MISSING_LAST if missing_counts else _MISSING_OUT} as percentile",
    )
    same = " and ".join([*[f"l.{quoted(g)} = r.{quoted(g)}" for g in [*by, "factor"]], "l.value <=> r.value"])
    return long.alias("l").join(scores.alias("r"), F.expr(same), "left").selectExpr("l.*", "r.percentile")


def percentiles(
    df: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    values: Sequence[str],
    missing_counts: bool = True,
    small_groups: bool = False,
    prefix: str = "pct_",
) -> DataFrame:
    """One row per (by, key) with a percentile column `pct_<name>` for each of `values`.

    `key` must identify a row within its group (use `keep_last` first when it may not).
    """
    if small_groups:
        return _windowed(df, by, key, values, missing_counts, prefix)
    long = percentiles_long(df, by, key, values, missing_counts)
    return long.groupBy(*[quoted(k) for k in [*by, *key]]).agg(
        *[F.expr(f"max(if(factor = {_text(v)}, percentile, null))").alias(f"{prefix}{v}") for v in values]
    )


def with_percentiles(df: DataFrame, by: Sequence[str], values: dict[str, str], missing_counts: bool = True) -> DataFrame:
    """`df` with the percentile of each of `values` (column -> new column) within `by`; rules as in `percentiles_long`. Rows
    without a group get none, and rows need no key.

    Counts the rows of every group at once, so `df` should be stored. While none has more than `SPLIT_ABOVE`, one shuffle
    by group and a sort for each value do; otherwise ranks are looked up by value.
    """
    require(df, [*by, *values], "with_percentiles")
    groups = [col(b) for b in by]
    most = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("rows")).agg(F.max("rows")).first()[0]
    if (most or 0) <= SPLIT_ABOVE:
        grouped = F.lit(True)
        for g in groups:
            grouped = grouped & g.isNotNull()
        for value, out in values.items():
            share = _share(number(df, value), groups or [F.lit(0)], missing_counts)
            df = df.withColumn(out, F.when(grouped, share))
        return df
    for value, out in values.items():
        scores = value_counts(_melted(df, by, [], [value]), by).selectExpr(
            *[f"{quoted(b)} as _by{i}" for i, b in enumerate(by)],
            "value as _value",
            f"{_MISSING_LAST if missing_counts else _MISSING_OUT} as _percentile",
        )
        same = number(df, value).eqNullSafe(F.col("_value"))
        for i, b in enumerate(by):
            same = same & (col(b) == F.col(f"_by{i}"))
        df = df.join(scores, same, "left").select(*[col(c) for c in df.columns], F.col("_percentile").alias(out))
    return df


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _windowed(df, by, key, values, missing_counts, prefix) -> DataFrame:
    out = df.select(*[col(k) for k in [*by, *key]], *[number(df, v).alias(v) for v in values])
    groups = [col(b) for b in by] or [F.lit(0)]
    shown = [_share(col(v), groups, missing_counts).alias(f"{prefix}{v}") for v in values]
    return out.select(*[col(k) for k in [*by, *key]], *shown)


def _share(value: Column, groups: Sequence[Column], missing_counts: bool) -> Column:
    """Percentile of a value by windows over its group."""
    whole = Window.partitionBy(*groups)
    rank = F.rank().over(whole.orderBy(value.asc_nulls_last()))
    ties = F.count(F.lit(1)).over(Window.partitionBy(*groups, value))
    average = rank + (ties - F.lit(1)) / F.lit(2.0)
    if missing_counts:
        return average / F.count(F.lit(1)).over(whole) * 100
    low, high = F.min(value).over(whole), F.max(value).over(whole)
    return F.when(low == high, F.lit(50.0)).when(value.isNotNull(), average / F.count(value).over(whole) * 100)


def quantiles(df: DataFrame, by: Sequence[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """Exact linear-interpolation quantiles: one row per group, one column per entry of `wanted`
    (output name -> (column, q)). Missing values are left out."""
    values = list(dict.fromkeys(column for column, _ in wanted.values()))
    require(df, [*by, *values], "quantiles")
    counts = value_counts(_melted(df, by, [], values), by).where(F.col("value").isNotNull())

    picks, used, results = [], [], []
    for i, (name, (column, q)) in enumerate(wanted.items()):
        place = f"{float(q)}D * (filled - 1)"
        mine = f"factor = {_text(column)} and before"
        low = f"({mine} <= floor({place}) and floor({place}) < before + count)"
        high = f"({mine} <= ceil({place}) and ceil({place}) < before + count)"
        used += [low, high]
        picks += [
            F.expr(f"max(if({low}, value, null)) as _low{i}"),
            F.expr(f"max(if({high}, value, null)) as _high{i}"),
            F.expr(f"max(if({low}, {place} - floor({place}), null)) as _part{i}"),
        ]
        step = f"(_high{i} - _low{i})"
        results.append(
            F.expr(f"if(_part{i} >= 0.5D, _high{i} - {step} * (1D - _part{i}), _low{i} + {step} * _part{i})").alias(name)
        )
    grouped = counts.where(" or ".join(used)).groupBy(*[quoted(b) for b in by]).agg(*picks)
    return grouped.select(*[col(b) for b in by], *results)


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, place: str) -> DataFrame:
    """First `n` rows of each group, numbered from 1 in `place`.

    Spark limits each group before the shuffle as well, so a hot group moves at most n rows per task.
    """
    if by:
        numbered = F.row_number().over(Window.partitionBy(*[col(b) for b in by]).orderBy(*order))
        return df.withColumn(place, numbered).where(F.col(place) <= n)
    few = df.orderBy(*order).limit(n)
    return few.withColumn(place, F.row_number().over(Window.orderBy(*order)))


def keep_first(df: DataFrame, keys: Sequence[str], order: str | Sequence[str] = "_seq") -> DataFrame:
    """One row per key: the earliest by `order`."""
    return _keep(df, keys, [col(o).asc() for o in _names(order)])


def keep_last(df: DataFrame, keys: Sequence[str], order: str | Sequence[str] = "_seq") -> DataFrame:
    """One row per key: the latest by `order`."""
    return _keep(df, keys, [col(o).desc() for o in _names(order)])


def keep_last_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the latest by `_seq`; rows without one, or that share one, are told apart by what they hold, so
    that reruns keep the same row."""
    kinds = {n: t for n, t in df.dtypes if not t.startswith("map") and "map<" not in t}
    first = ["_seq"] if "_seq" in kinds else []
    return keep_last(df, keys, [*first, *[n for n in kinds if n not in {*keys, *first}]] or list(keys))


def _names(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def _keep(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    return top_n(df, keys, order, 1, "_place").drop("_place")


def positions(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "position", size: str | None = None
) -> DataFrame:
    """Numbers the rows from 0 without gaps in the order of the columns `order`, nulls first, within each `by` group; with
    `size`, adds the group's rows.

    The table is range-partitioned and sorted once; each partition numbers its own rows, and the totals of the partitions
    before it give its offset. So a whole history, or one group that holds most of it, is numbered without a window over
    all its rows. Rows that are equal in `by` and `order` stand next to each other in any order. The numbers are stored
    with the rows, so that every reader sees the same ones.
    """
    require(df, [*by, *order], "positions")
    keys = [col(c) for c in [*by, *order]]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))})
    )
    groups = [col(b) for b in by]
    runs = placed.groupBy(*groups, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*groups)
    before = F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = runs.select(
        *[col(b).alias(f"_by{i}") for i, b in enumerate(by)],
        F.col("_part").alias("_of"),
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_offset"),
        F.sum("_rows").over(whole).alias("_size"),
    )
    same = F.col("_part") == F.col("_of")
    for i, b in enumerate(by):
        same = same & col(b).eqNullSafe(F.col(f"_by{i}"))
    shown = [(F.col("_row") + F.col("_offset")).alias(name), *([F.col("_size").alias(size)] if size else [])]
    return placed.join(offsets, same).select(*[col(c) for c in df.columns], *shown)


def with_sequence(df: DataFrame, name: str = "_seq") -> DataFrame:
    """Stamps the ingest order. Do it once, when a file is landed, and store the column."""
    return df.withColumn(name, F.monotonically_increasing_id())


__all__ = [
    "attach", "keep_first", "keep_last", "keep_last_row", "percentiles", "percentiles_long", "positions", "quantiles", "top_n",
    "value_counts", "with_percentiles", "with_sequence",
]
