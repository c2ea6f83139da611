"""Published days: what a run stored becomes visible in one step, and readers never look at a half-written day.

A run writes its tables under a folder of its own and then adds rows to the manifest, one for each (day, table): run,
version, folder, rows, columns with their types, and a fingerprint of the rows. The manifest is written last and by one
committed write, so all tables of the run's days appear together; until then readers see the days as they were. The
newest version of a day names all its tables.

The manifest also spares readers the files: days are opened by their folders with the columns that it names, so no footer
is read to find a schema, no folder of another day is listed, and a day replaced later is never opened.

A manifest has one row per day and table: it is as long as the calendar, which is what comes to the driver.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Sequence
from datetime import date as Date

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.columns import col
from crivo.operators.history import union_all
from crivo.sources import lake
from crivo.sources.lake import DAY

MANIFEST = "published"
ROWS = (
    "date date, table string, run string, version bigint, folder string, rows bigint, "
    "columns array<struct<name: string, type: string>>, fingerprint string"
)
OK, MISSING, EXTRA, ALTERED = "ok", "missing", "extra", "altered"


def fingerprints(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(date, rows, fingerprint) of each day: a sum of row hashes over the named columns, whatever the order of rows."""
    hashed = F.xxhash64(*[col(c) for c in sorted(names)]).cast("decimal(38,0)")
    return df.groupBy(F.col(DAY).alias("date")).agg(F.count(F.lit(1)).alias("rows"), F.sum(hashed).cast("string").alias("fingerprint"))


def _folder(table: str, run: str, day: Date) -> str:
    return f"{table}/run={run}/{DAY}={day.isoformat()}"


def _fields(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name != DAY]


def publish(
    spark: SparkSession,
    root: str,
    tables: dict[str, DataFrame],
    date: str,
    days: Iterable[Date],
    run: str | None = None,
    keep_empty: bool = True,
) -> str:
    """Stores `tables`, each with the rows of `days` under the column `date`, and publishes these days as a whole: a day that a
    table has no rows for is published as empty, or without `keep_empty` as one that the table is gone from. Returns the run.
    Rows of other days are not stored."""
    run, days = run or f"r{uuid.uuid4().hex}", sorted(set(days))
    version = 1 + (manifest(spark, root).agg(F.max("version")).first()[0] or 0)
    listed = []
    wanted = spark.createDataFrame([(d,) for d in days], "date date")
    for table, df in tables.items():
        dated = df.withColumn(DAY, col(date).cast("date")).where(F.col(DAY).isin(days))
        plain = dated if date == DAY else dated.drop(date)
        plain.hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{root}/{table}/run={run}")
        shape = T.StructType([f for f in plain.schema.fields if f.name != DAY])
        named = T.StructType([*shape.fields, T.StructField(DAY, T.DateType())])
        stored = spark.read.schema(named).parquet(f"{root}/{table}/run={run}")
        fields = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in _fields(plain)])
        found = fingerprints(stored, [f.name for f in shape.fields])
        day = F.col("date").cast("string")
        folder = F.when(F.col("rows") > 0, F.concat(F.lit(f"{table}/run={run}/{DAY}="), day))
        name = F.lit(table) if keep_empty else F.when(F.col("rows") > 0, table)
        listed.append(
            wanted.join(found, "date", "left").select(
                "date", name.alias("table"), F.lit(run).alias("run"), F.lit(version).cast("bigint").alias("version"),
                folder.alias("folder"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), fields.alias("columns"), "fingerprint",
            )
        )
    if listed and days:
        union_all(*listed).coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST}")
    return run


def withdraw(spark: SparkSession, root: str, days: Iterable[Date]) -> None:
    """Publishes days without tables: they are gone for every reader."""
    version = 1 + (manifest(spark, root).agg(F.max("version")).first()[0] or 0)
    gone = [(d, None, f"r{uuid.uuid4().hex}", version, None, 0, [], None) for d in sorted(set(days))]
    if gone:
        spark.createDataFrame(gone, ROWS).coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST}")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Every row ever published, replaced days too."""
    return lake.read_table(spark, f"{root}/{MANIFEST}", ROWS) if lake.has_files(spark, f"{root}/{MANIFEST}") else spark.createDataFrame([], ROWS)


def current(spark: SparkSession, root: str) -> DataFrame:
    """The rows that count: of each day those of its newest version."""
    rows = manifest(spark, root)
    newest = rows.groupBy("date").agg(F.max(F.struct("version", "run")).alias("newest"))
    return rows.join(newest, "date").where(F.struct("version", "run") == F.col("newest")).where("table is not null").drop("newest")


def days_of(spark: SparkSession, root: str, table: str) -> list[Date]:
    """Published days of a table, oldest first, empty ones too."""
    return sorted(r.date for r in current(spark, root).where(F.col("table") == table).select("date").collect())


def _opened(spark: SparkSession, root: str, rows: Iterable[Row]) -> list[tuple[list[tuple[str, str]], DataFrame]]:
    """(columns, rows with DAY) for each set of columns that days were stored with; days of one shape are read together."""
    shapes: dict[tuple, list[Row]] = defaultdict(list)
    for row in rows:
        shapes[tuple((c.name, c.type) for c in row.columns)].append(row)
    out = []
    for fields, days in sorted(shapes.items()):
        shape = T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in fields])
        paths = [f"{root}/{r.folder}" for r in sorted(days, key=lambda r: r.date) if r.folder]
        if paths:
            named = T.StructType([*shape.fields, T.StructField("run", T.StringType()), T.StructField(DAY, T.DateType())])
            out.append((list(fields), spark.read.schema(named).option("basePath", f"{root}/{days[0].table}").parquet(*paths)))
        else:
            out.append((list(fields), spark.createDataFrame([], T.StructType([*shape.fields, T.StructField(DAY, T.DateType())]))))
    return out


_WIDTH = ("tinyint", "smallint", "int", "bigint", "float", "double")


def common_type(types: Iterable[str]) -> str:
    """The type that a column has over days that stored it differently: the widest number, or text."""
    found = sorted(set(types))
    if len(found) == 1:
        return found[0]
    if all(t in _WIDTH for t in found):
        return "double" if any(t in ("float", "double") for t in found) else max(found, key=_WIDTH.index)
    return "string"


def read(
    spark: SparkSession, root: str, table: str, days: Iterable[Date] | None = None, date: str | None = None
) -> DataFrame | None:
    """A table over the published days, or the given ones among them; None if no day has it. Columns that only some of these
    days have are null elsewhere, and of differing types they take the common one. The day comes as DAY, or as `date`."""
    named = current(spark, root).where(F.col("table") == table)
    if days is not None:
        named = named.where(F.col("date").isin(list(days)))
    rows = named.collect()
    if not rows:
        return None
    kinds: dict[str, set[str]] = defaultdict(set)
    for row in rows:
        for c in row.columns:
            kinds[c.name].add(c.type)
    whole = {n: common_type(t) for n, t in sorted(kinds.items())}
    parts = []
    for fields, df in _opened(spark, root, rows):
        have = dict(fields)
        parts.append(
            df.select(
                *[(col(n).cast(t) if have[n] != t else col(n)) if n in have else F.lit(None).cast(t).alias(n) for n, t in whole.items()],
                F.col(DAY).alias(date or DAY),
            )
        )
    return union_all(*parts)


def columns_of(spark: SparkSession, root: str) -> DataFrame:
    """(table, column, type, days): the columns of the current days, from the manifest alone."""
    each = current(spark, root).select("table", "date", F.explode("columns").alias("c"))
    return each.groupBy("table", F.col("c.name").alias("column"), F.col("c.type").alias("type")).agg(F.count_distinct("date").alias("days"))


def stored_runs(spark: SparkSession, root: str, table: str) -> list[tuple[str, Date]]:
    """(run, day) of every stored folder of a table, published or not, from the file system's listing."""
    out = []
    for run in lake.names_in(spark, f"{root}/{table}", "run="):
        out += [(run, Date.fromisoformat(d)) for d in lake.names_in(spark, f"{root}/{table}/run={run}", f"{DAY}=")]
    return out


def verify(spark: SparkSession, root: str, tables: Sequence[str]) -> DataFrame:
    """What is stored against what was published, as a full outer join: (date, table, run, status, rows, found_rows). `missing`: a
    published folder that isn't there; `altered`: its rows are not those that were published; `extra`: a folder of a run that
    published nothing of that day, such as one that broke off."""
    every = manifest(spark, root).where("folder is not null")
    live = current(spark, root)
    parts = []
    for table in tables:
        there = {(r, d) for r, d in stored_runs(spark, root, table)}
        rows = live.where(F.col("table") == table).collect()
        kept = [r for r in rows if r.folder and (r.run, r.date) in there]
        found = [
            fingerprints(df, [n for n, _ in fields]).select("date", F.col("rows").alias("found_rows"), F.col("fingerprint").alias("found"))
            for fields, df in _opened(spark, root, kept)
        ]
        empty = spark.createDataFrame([], "date date, found_rows bigint, found string")
        seen = union_all(empty, *found)
        noted = live.where(F.col("table") == table).where("rows > 0").select("date", "table", "run", "rows", "fingerprint")
        status = (
            F.when(F.col("found").isNull(), MISSING)
            .when((F.col("rows") != F.col("found_rows")) | (F.col("fingerprint") != F.col("found")), ALTERED)
            .otherwise(OK)
        )
        parts.append(noted.join(seen, "date", "full_outer").select("date", "table", "run", status.alias("status"), "rows", "found_rows"))
        listed = spark.createDataFrame([(d, r) for r, d in sorted(there)], "date date, run string")
        known = every.where(F.col("table") == table).select("date", "run")
        parts.append(
            listed.join(known, ["date", "run"], "left_anti").select(
                "date", F.lit(table).alias("table"), "run", F.lit(EXTRA).alias("status"), F.lit(None).cast("bigint").alias("rows"),
                F.lit(None).cast("bigint").alias("found_rows"),
            )
        )
    return union_all(*parts)
