"""Sharding by vector bin packing: bytes, tokens (words) and rows of every shard in balance at once.

Groups of equal texts stay together. A group that outweighs a part of a shard is split into pieces by its ids, because
one group may hold a third of all rows; the many light groups are gathered by hash into a fixed number of items. So
the items to pack are few whatever the corpus: `LIGHT` light ones, and pieces of groups that each hold at least
1 / (shards * SPLIT) of some dimension. The driver packs them, heaviest first: each goes to the shard with the highest dot
product of the item's vector and the shard's residual capacity, all measured in shares of a shard. Slots count the
rows of a shard item by item and need windows over single items only.

Law: `bytes` (sizes near equal; a single text that outweighs a shard can't be split).

Null texts have size 1 (no bytes, plus 1), no words and the checksum of no bytes; they are a group apart from empty
texts. Rows that repeat an id and text share a piece. No rows: no result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crivo.llm.base import col, cut, text_of, word_count

SHARDS = 16
#: Light groups make at most so many items.
LIGHT = 4096
#: Heavier than this part of a shard, in any dimension, a group is split.
SPLIT = 16

_DIMENSIONS = ("size", "tokens", "rows")


def measured(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(
        col(id).alias("_id"),
        (F.octet_length(text_of(text)) + 1).cast("bigint").alias("size"),
        word_count(text_of(text)).alias("tokens"),
        F.lit(1).cast("bigint").alias("rows"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
        F.xxhash64(col(text).isNull(), text_of(text)).alias("_group"),
    )


def heavy_groups(rows: DataFrame, totals: Sequence[int], shards: int) -> DataFrame:
    """(group, pieces) of the groups that are split; at most 3 * shards * SPLIT rows, as each holds a share of all."""
    sums = rows.groupBy("_group").agg(*[F.sum(d).alias(d) for d in _DIMENSIONS])
    share = F.greatest(*[F.col(d) / F.lit(float(max(1, t))) for d, t in zip(_DIMENSIONS, totals, strict=True)])
    pieces = F.ceil(share * shards * SPLIT).cast("bigint")
    return sums.where((pieces > 1) & (F.col("rows") > 1)).select("_group", pieces.alias("_pieces"))


def itemised(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Adds the item of each row: a piece of its heavy group, or the light item that its hash picks."""
    piece = F.pmod(F.xxhash64("_id"), F.col("_pieces"))
    light = F.format_string("%d", F.pmod(F.col("_group"), F.lit(LIGHT)))
    item = F.when(F.col("_pieces").isNull(), light).otherwise(F.format_string("%d/%d", F.col("_group"), piece))
    return rows.join(F.broadcast(heavy), "_group", "left").withColumn("_item", item).drop("_pieces")


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item, by dot product with the residual capacity. Items are few: see the head of the module."""
    capacity = np.maximum(vectors.sum(axis=0), 1) / shards
    shares = vectors / capacity
    residual = np.ones((shards, vectors.shape[1]))
    where = np.zeros(len(vectors), dtype=np.int32)
    for i in np.lexsort((np.arange(len(vectors)), -shares.max(axis=1))):
        best = int(np.argmax(residual @ shares[i]))
        where[i] = best
        residual[best] -= shares[i]
    return where


def shard(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    rows = cut(measured(docs, id, text))
    totals = rows.agg(*[F.sum(d) for d in _DIMENSIONS]).first()
    placed = cut(itemised(rows, heavy_groups(rows, [t or 0 for t in totals], shards)))
    items = placed.groupBy("_item").agg(*[F.sum(d).alias(d) for d in _DIMENSIONS]).orderBy("_item").collect()
    vectors = np.array([[i[d] for d in _DIMENSIONS] for i in items], dtype=np.float64).reshape(-1, len(_DIMENSIONS))
    filled = [0] * shards
    found = []
    for item, where in zip(items, pack(vectors, shards).tolist(), strict=True):
        found.append((item["_item"], where, filled[where]))
        filled[where] += item["rows"]
    map_of = spark.createDataFrame(found, "_item string, shard int, _offset bigint")
    inside = Window.partitionBy("_item").orderBy("_id", "_group")
    return placed.join(F.broadcast(map_of), "_item").select(
        F.col("_id").alias(id),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_offset") + F.row_number().over(inside) - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
