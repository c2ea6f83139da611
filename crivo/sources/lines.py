"""Ordered JSON lines for lists that grow with the data: blocks of lines in order, and an index that says where each starts.

The rows are numbered through one range sort, dealt into blocks of equal length by their number, and each block is one
folder with one file, written by one task. A reader that wants the rows from some key on finds its block in the index and
opens that one; no list is ever gathered in a row or a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.columns import col
from crivo.operators.order import positions
from crivo.sources import lake

LINES, INDEX = "lines", "index"
BLOCK = 100_000


def write_lines(df: DataFrame, order: Sequence[str | Column], path: str, block: int = BLOCK) -> None:
    """Writes the records of `df` in ascending order of the columns `order`, nulls first, in place of what is there: `path`/lines
    holds the lines, `path`/index (block, first, rows, key): number of the first line, lines, and its order columns as JSON,
    under their names, or k0, k1, ... where they are expressions."""
    keys = [col(o) if isinstance(o, str) else o for o in order]
    names = [o if isinstance(o, str) else f"k{i}" for i, o in enumerate(order)]
    whole = {"ignoreNullFields": "false"}
    held = df.select(
        *[k.alias(f"_k{i}") for i, k in enumerate(keys)],
        F.to_json(F.struct(*[col(c) for c in df.columns]), whole).alias("value"),
        F.to_json(F.struct(*[k.alias(n) for k, n in zip(keys, names)]), whole).alias("key"),
    )
    numbered = positions(held, [*[f"_k{i}" for i in range(len(keys))], "value"], name="place")
    placed = numbered.withColumn("block", F.expr(f"place div {block}"))
    index = placed.groupBy("block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"), F.min_by("key", "place").alias("key"))
    dealt = placed.repartition("block").sortWithinPartitions("block", "place")
    dealt.select("block", "value").write.mode("overwrite").partitionBy("block").text(f"{path}/{LINES}")
    lake.write_table(index.coalesce(1), f"{path}/{INDEX}")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(block, first, rows, key) of every block, in order."""
    return lake.read_table(spark, f"{path}/{INDEX}").orderBy("block")


def read_lines(spark: SparkSession, path: str, blocks: Iterable[int] | None = None) -> DataFrame:
    """(block, value): the lines of all blocks or of the given ones, which alone are opened."""
    if blocks is None:
        return spark.read.text(f"{path}/{LINES}").select(F.col("block").cast("bigint").alias("block"), "value")
    folders = [f"{path}/{LINES}/block={b}" for b in sorted(set(blocks))]
    found = spark.read.option("basePath", f"{path}/{LINES}").text(folders)
    return found.select(F.col("block").cast("bigint").alias("block"), "value")
