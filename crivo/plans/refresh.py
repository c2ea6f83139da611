"""Training sets rebuilt from the stored daily documents, where the snapshots they came from are gone.

Records of documents are maps of texts whose keys differ from day to day. One aggregate over all entries finds the keys and,
for each, how many values are filled and how many of them read as numbers; keys become columns, double or text, and
from there the path is that of a history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.columns import col, filled
from crivo.functions.text import any_number
from crivo.operators import features
from crivo.operators.clean import ALWAYS_TEXT, NUMERIC_NAMES
from crivo.operators.order import keep_last_row
from crivo.plans.export import SECTION, stored_documents
from crivo.plans.rebuild import CLASSES, Places
from crivo.session import cut
from crivo.sources import lake, landed
from crivo.spec import FUNDS, HORIZONS, AssetSpec

NUMERIC_SHARE = 0.85  # fixed value: filled cells that must read as numbers


def field_profile(rows: DataFrame, fields: str = "fields") -> DataFrame:
    """(key, filled, parsed): every key of the maps, with its filled values and those that read as numbers."""
    entries = rows.select(F.explode(col(fields)).alias("key", "value"))
    text = F.nullif("value", F.lit(""))
    return entries.groupBy("key").agg(F.count(text).alias("filled"), F.count(any_number(text)).alias("parsed"))


def spread(rows: DataFrame, spec: AssetSpec, fields: str = "fields", share: float = NUMERIC_SHARE) -> DataFrame:
    """The entries of `fields` as columns next to the roles of the class, which come first: a column is a number if its name says
    so or `share` of its filled values do, else text. Keys that differ in nothing but case are one column; the first in
    code-point order that is filled counts. The keys are the table's columns, so they come to the driver."""
    roles = [spec.date, spec.id, spec.price, spec.score]
    found = field_profile(rows, fields).orderBy("key").collect()
    groups: dict[str, list] = {}
    for row in found:
        if row["key"].lower() not in {r.lower() for r in roles}:
            groups.setdefault(row["key"].lower(), []).append(row)

    def value(rows_: list) -> Column:
        return F.coalesce(*[F.nullif(col(fields)[r["key"]], F.lit("")) for r in rows_])

    def typed(rows_: list) -> Column:
        name, seen = rows_[0]["key"], sum(r["filled"] for r in rows_)
        numeric = any(part in name.lower() for part in NUMERIC_NAMES) or (seen and sum(r["parsed"] for r in rows_) / seen >= share)
        text = name in ALWAYS_TEXT or name in (spec.name, spec.status)
        return (any_number(value(rows_)) if numeric and not text else value(rows_)).alias(name)

    return rows.select(*[col(r) for r in roles], *[typed(g) for g in groups.values()])


def history_of_documents(
    documents: DataFrame, text: str, section: str, spec: AssetSpec, names: dict[str, Sequence[str]], day: str | None = None
) -> DataFrame:
    """The typed history of one section of stored documents: one row per (date, ticker) with a price. `day`: the column of
    `documents` that dates those which don't say their date themselves."""
    rows = cut(landed.payload_rows(documents, text, section, spec, names, day))
    wide = filled(spread(rows, spec), [spec.id, spec.date, spec.price])
    return keep_last_row(wide, [spec.date, spec.id])


def refresh_from_documents(
    documents: DataFrame, text: str, section: str, spec: AssetSpec, names: dict[str, Sequence[str]],
    horizons: Sequence[int] = HORIZONS, day: str | None = None,
) -> DataFrame:
    """The training set of one class from stored documents."""
    return features.dataset(history_of_documents(documents, text, section, spec, names, day), spec, horizons)


def refresh(spark: SparkSession, root: str, specs: Sequence[AssetSpec] = CLASSES, horizons: Sequence[int] = HORIZONS) -> None:
    """Writes the training set of every class from the documents of a lake, in place of the ones there are."""
    documents = stored_documents(spark, root).withColumn("day", col(lake.DAY).cast("string"))
    for spec in specs:
        names = landed.FUND_NAMES if spec.kind == FUNDS.kind else landed.STOCK_NAMES
        data = refresh_from_documents(documents, "text", SECTION[spec.kind], spec, names, horizons, "day")
        lake.write_table(data, Places(root).dataset(spec))
