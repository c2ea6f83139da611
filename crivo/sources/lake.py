"""Dated snapshots: one folder per table, one partition per day."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date as Date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.columns import col

DAY = "snapshot_date"
log = logging.getLogger(__name__)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str = "") -> DataFrame:
    """A parquet table, or an empty one with the given schema if there is none. Whatever else goes wrong is raised: an
    unreadable table is not an empty one, and its successor would replace it."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no table at %s", path)
        return spark.createDataFrame([], schema or T.StructType([]))
    return conform(found, schema) if schema else found


def read_sound(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """The rows of a parquet table's sound files, and the quarantine: rows (path, error) of the files that can't be read.

    A file counts as a whole: if its footer promises more rows than can be decoded, or has a column of another type than
    `schema`, none of its rows are returned. One job counts what footers promise and one decodes the columns of `schema`,
    both per file where the files are; only files that gave no row at all, broken or empty, are opened one by one from the
    driver to tell the two apart and to learn the error. A missing path is an empty table with nothing in quarantine.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    listed = "path string, error string"
    try:
        files = spark.read.schema(wanted).parquet(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], wanted), spark.createDataFrame([], listed)
    if not files:
        return spark.createDataFrame([], wanted), spark.createDataFrame([], listed)

    def tolerant() -> DataFrame:
        return spark.read.option("ignoreCorruptFiles", "true").schema(wanted).parquet(path)

    place = F.col("_metadata.file_path").alias("path")
    promised = tolerant().select(place).groupBy("path").agg(F.count(F.lit(1)).alias("promised"))
    # A hash of all columns makes every page be decoded. A plain count of it would be planned as a count of rows.
    odd = F.xxhash64(*[col(c) for c in wanted.names]) % 2 != 0
    decoded = tolerant().select(place, odd.alias("odd")).groupBy("path").agg(
        (F.count_if("odd") + F.count_if(~F.col("odd"))).alias("decoded")
    )
    both = promised.join(decoded, "path", "left").withColumn("decoded", F.coalesce("decoded", F.lit(0)))
    lost = both.where("decoded < promised").select(
        "path", F.format_string("%d of %d rows can be decoded", "decoded", "promised").alias("error")
    )
    every = spark.createDataFrame([(f,) for f in files], "path string")
    silent = [r.path for r in every.join(promised, "path", "left_anti").collect()]

    def problem(file: str) -> tuple[str, str] | None:
        try:
            spark.read.parquet(file)
        except Exception as error:  # noqa: BLE001  whatever it is, it belongs in the list
            raised = getattr(error, "java_exception", None)
            return file, (raised.getMessage() if raised else str(error) or type(error).__name__).splitlines()[0]
        return None

    with ThreadPoolExecutor(8) as pool:
        broken = [p for p in pool.map(problem, silent) if p]
    bad = spark.createDataFrame(broken, listed).unionByName(lost)
    for file, why in broken:
        log.warning("left out %s: %s", file, why)
    named = tolerant().withColumn("_file", F.col("_metadata.file_path"))
    sound = named.join(bad.select(F.col("path").alias("_file")), "_file", "left_anti").select(*[col(c) for c in wanted.names])
    return sound, bad


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The columns of a declared schema, in its types: values that do not fit and absent columns are null,
    other columns are dropped."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(
        *[
            (col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a parquet table to read."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_day(df: DataFrame, root: str, table: str, day: Date) -> None:
    """Replaces exactly this day's partition of a table (also by nothing, if `df` is empty)."""
    df.drop(DAY).write.mode("overwrite").parquet(f"{root}/{table}/{DAY}={day.isoformat()}")


def write_days(df: DataFrame, root: str, table: str, date: str) -> None:
    """Replaces every day that `df` holds; other days are not touched. Rows of a day are brought together
    first, several files per day where they are many (`REBALANCE` splits hot days)."""
    out = df.withColumn(DAY, col(date).cast("date")) if date != DAY else df
    (
        out.hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(f"{root}/{table}")
    )


def read_days(
    spark: SparkSession,
    root: str,
    table: str,
    days: Iterable[Date] | None = None,
    date: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A table over the chosen days, or all. The day of the folder overrides a stored date column of the
    name `date`. Columns that only some days have are null elsewhere; give `schema` to spare Spark from
    merging the file schemas."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    df = reader.parquet(f"{root}/{table}").withColumn(DAY, F.col(DAY).cast("string").try_cast("date"))
    df = df.where(F.col(DAY).isNotNull())
    if days is not None:
        df = df.where(F.col(DAY).isin(list(days)))
    return df.withColumn(date, F.col(DAY)) if date else df


def _listed(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(folder)] if system.exists(folder) else []


def names_in(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows `prefix` in the names of a folder's entries that start with it; nothing if there is no such folder."""
    return sorted(n.removeprefix(prefix) for n in _listed(spark, path) if n.startswith(prefix))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds files of a committed write."""
    return any(n.endswith(".parquet") for n in _listed(spark, path))


def days_of(spark: SparkSession, root: str, table: str) -> list[Date]:
    """Days that a table has a folder for, oldest first, from the file system's listing; no data is read. A day that was
    stored without rows is one of them."""
    names = names_in(spark, f"{root}/{table}", f"{DAY}=")
    return sorted(Date.fromisoformat(n) for n in names if re.fullmatch(r"\d{4}-\d\d-\d\d", n))


def list_days(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Dates that a table has, oldest first."""
    return spark.createDataFrame([(d,) for d in days_of(spark, root, table)], "date date").orderBy("date")


def manifest_of(df: DataFrame, date: str, table: str) -> DataFrame:
    """Rows (date, table, rows, columns, fingerprint) of a dated table. The fingerprint is a sum of row
    hashes: the same rows give the same value in any order, and repeated rows count."""
    names = [c for c in df.columns if c != date]
    hashed = F.xxhash64(*[col(c) for c in names]).cast("decimal(38,0)")
    return df.groupBy(col(date).cast("date").alias("date")).agg(
        F.lit(table).alias("table"),
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.sum(hashed).cast("string").alias("fingerprint"),
    )


def day_manifest(spark: SparkSession, root: str, table: str, day: Date) -> DataFrame:
    """The manifest row of one stored day, read back from its folder; a day without rows has one too."""
    stored = spark.read.parquet(f"{root}/{table}/{DAY}={day.isoformat()}")
    hashed = F.xxhash64(*[col(c) for c in stored.columns]).cast("decimal(38,0)")
    return stored.agg(
        F.lit(day).alias("date"),
        F.lit(table).alias("table"),
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(stored.columns) + 1).alias("columns"),
        F.sum(hashed).cast("string").alias("fingerprint"),
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Rows (date, total_rows) over all tables of a day."""
    return manifest.groupBy("date").agg(F.sum("rows").alias("total_rows"))
