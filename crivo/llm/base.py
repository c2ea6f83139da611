"""What the corpus operators share: inputs, code shipping, numbered partitions."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import crivo
from crivo.columns import col
from crivo.session import cut

# The letters that normalised texts lower, and the white space between words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

_SHIPPED = "_crivo_shipped"
#: What this worker remembers from task to task: one thing at most.
_HELD: dict[Hashable, Any] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(col(name), F.lit(""))


def normalised(text: Column) -> Column:
    """A-Z lowered, all else as it is. Without other than ASCII characters `lower` does just that, and faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of words, as a bigint."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def ship(spark: SparkSession) -> None:
    """Gives executors this package's code, wherever the driver found it. Spark's file server hands it out."""
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.abspath(crivo.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    target = os.path.join(tempfile.mkdtemp(prefix="spark-"), "crivo-code.zip")
    with open(target, "wb") as out:
        out.write(packed.getvalue())
    context.addPyFile(target)
    setattr(context, _SHIPPED, True)


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """What the worker remembers under `key`. Workers outlive tasks and serve the stages of a job in turn, so what earlier
    stages remembered would add up: it is let go first."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def power_of_two(least: int) -> int:
    """The smallest power of two that is not below `least`."""
    return 1 << max(0, int(least) - 1).bit_length()


__all__ = [
    "LOWER", "UPPER", "WORD", "cut", "col", "held", "normalised", "power_of_two", "ship", "table", "text_of", "word_count",
]
