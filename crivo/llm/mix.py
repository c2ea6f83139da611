"""Mixing sources to target weights.

Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ...; together they share the words of the whole corpus.
A source gives at most three times its own words; what it can't give goes to the others by weight. That is one
water level L with target = min(weight * L, 3 * size); `water_level` raises it until the targets add up.

Which documents are taken is a matter of a hash: within a source documents stand in the order of md5(id), range
partitions sort them, and the prefix sums of their words come from partition totals plus a running sum inside each
partition. A source whose target is e whole epochs and r words more takes every document e times, and once more those
whose words all lie within the first r; the one document across that point gives the words up to it, so every
source takes its target rounded to whole words. Keys hang on ids alone: reruns agree, however rows are partitioned.

A source may hold any share of the rows: its key range spans partitions, no window holds a whole source, and only
per-source rows are joined to documents (Spark broadcasts them where it measured them to be small).

Null and empty texts have size 0 and are never taken. A null id has the first place. Rows that repeat a source and id
stand together; at the cut they share the words in proportion to their sizes, rounded. No rows: no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crivo.llm.base import col, cut, text_of, word_count

WEIGHTS = (1, 2, 3)
MOST = 3

_SOURCE = ("_none", "_source")


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, out: str) -> DataFrame:
    """Adds the sum of `value` over the rows of the same `by` that stand earlier in `order`.

    Range partitions hold neighbouring rows; windows run inside one partition or over one row per partition.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("_value", value).repartitionByRange(parts, *[F.col(c) for c in [*by, *order]])
    placed = cut(ranged.withColumn("_part", F.spark_partition_id()))
    keys = [F.col(c) for c in by]
    totals = placed.groupBy(*keys, "_part").agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    summed = local.join(offsets, [*by, "_part"])
    return summed.withColumn(out, (F.col("_offset") + F.col("_local")).cast("bigint")).drop(
        "_offset", "_local", "_part", "_value"
    )


def water_level(sources: DataFrame, most: int = MOST) -> float:
    """The level L at which min(weight * L, most * size) adds up to all sizes. Each round fetches one row."""
    total, weights = sources.agg(F.sum("source_size"), F.sum("_weight")).first()
    if not total:
        return 0.0
    level = total / weights
    while True:
        full = F.col("source_size") * most <= F.col("_weight") * F.lit(level)
        capped, open_weights = sources.agg(
            F.sum(F.when(full, F.col("source_size") * most).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("_weight")))
        ).first()
        raised = (total - capped) / open_weights
        if raised <= level:
            return level
        level = raised


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: its size, target, whole epochs and the words beyond them."""
    sums = sized.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    ranked = running(sums, [], _SOURCE, F.lit(1).cast("bigint"), "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighed = cut(ranked.withColumn("_weight", weight))
    level = water_level(weighed, most)
    target = F.least((F.col("source_size") * most).cast("double"), F.col("_weight") * F.lit(level))
    budget = F.floor(F.col("target") + 0.5)
    size = F.nullif(F.col("source_size"), F.lit(0))
    return weighed.withColumn("target", target).select(
        *_SOURCE,
        "source_size",
        "target",
        F.coalesce(F.floor(budget / size), F.lit(0)).cast("bigint").alias("_epochs"),
        F.coalesce(budget % size, F.lit(0)).cast("bigint").alias("_rest"),
    )


def _sized(docs: DataFrame, id: str, text: str, source: str) -> list[Column]:
    return [
        col(id).alias("_id"),
        F.coalesce(F.md5(col(id).cast("string").cast("binary")), F.lit("")).alias("_key"),
        col(source).isNull().alias("_none"),
        F.coalesce(col(source).cast("string"), F.lit("")).alias("_source"),
        word_count(text_of(text)).alias("size"),
    ]


def plan(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(sized documents, one row per source with its target and the place of its cut)."""
    sized = cut(docs.select(*_sized(docs, id, text, source)))
    wanted = cut(targets(sized))
    units = sized.groupBy(*_SOURCE, "_key").agg(F.sum("size").alias("_words"))
    placed = running(units, _SOURCE, ["_key"], F.col("_words"), "_before").join(wanted.select(*_SOURCE, "_rest"), [*_SOURCE])
    across = (F.col("_before") < F.col("_rest")) & (F.col("_rest") <= F.col("_before") + F.col("_words"))
    cuts = placed.where(across).select(
        *_SOURCE, F.col("_key").alias("_cut"), (F.col("_rest") - F.col("_before")).alias("_part"), F.col("_words").alias("_all")
    )
    return sized, cut(wanted.join(cuts, [*_SOURCE], "left"))


def _extra() -> Column:
    """Words taken beyond the whole epochs."""
    share = F.round(F.col("size") * F.col("_part") / F.col("_all")).cast("bigint")
    return (
        F.when(F.col("_cut").isNull() | (F.col("_key") > F.col("_cut")), F.lit(0))
        .when(F.col("_key") < F.col("_cut"), F.col("size"))
        .otherwise(share)
    ).cast("bigint")


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target (its source's), taken."""
    sized, places = plan(docs, id, text, source)
    taken = F.col("size") * F.col("_epochs") + _extra()
    return sized.join(places, [*_SOURCE]).select(
        F.col("_id").alias(id), "size", "source_size", F.round("target", 6).alias("target"), taken.cast("bigint").alias("taken")
    )


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of the mix, with the columns of `docs`: a document stands there as often as it is taken. The document
    across a source's cut comes whole if at least half of it lies before the cut."""
    _, places = plan(docs, id, text, source)
    packed = docs.select(F.struct("*").alias("_row"), *_sized(docs, id, text, source))
    times = F.col("_epochs") + F.when(F.col("size") == 0, 0).otherwise(F.floor(_extra() * 2 / F.col("size"))).cast("int").cast(
        "boolean"
    ).cast("int")
    repeated = packed.join(places, [*_SOURCE]).where(times > 0)
    return repeated.select("_row", F.explode(F.sequence(F.lit(1), times.cast("int")))).select("_row.*")
