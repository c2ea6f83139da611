"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose every partition turns out this small need no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # plans here have many columns; saves driver time
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Adds what every job here expects; cores, memory and partition counts stay the cluster's choice."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints: what the session names, or a fresh local one in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="spark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows as a table written to the shared folder.

    For a table that several later jobs read: they neither recompute it nor lose it with an executor, and
    they read only the columns they need. The folder is the caller's to empty.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED = "_crivo_shipped"


def ship(spark: SparkSession) -> None:
    """Gives executors this package's code, wherever the driver found it. Spark's file server hands it out."""
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
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
