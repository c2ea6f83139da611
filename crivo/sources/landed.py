"""Landed files of outside services to tidy tables. Fetching them is not this package's work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.columns import col, filled, to_number
from crivo.functions.text import any_number, br_date, iso_date, ticker
from crivo.spec import AssetSpec

# Record shapes of the landed files.
SERIES_SHAPE = "array<struct<data:string,valor:string>>"
QUOTE_SHAPE = "map<string,struct<code:string,codein:string,bid:string,pctChange:string,create_date:string>>"
PAYLOAD_SHAPE = "struct<data:string,fiis:array<map<string,string>>,acoes:array<map<string,string>>>"
# Names under which payload records keep ticker, price and score, by preference.
FUND_NAMES = {
    "ticker": ("FUNDOS", "Ticker", "ticker", "Ativo", "Código", "Codigo"),
    "price": ("PREÇO ATUAL (R$)", "Preço", "PRECO", "Preço Atual", "preco_atual", "price"),
    "score": ("Score", "score", "score_top"),
}
STOCK_NAMES = {
    "ticker": ("Ação", "Acao", "Ticker", "ticker", "Ativo", "Código", "Codigo", "Papel"),
    "price": ("Preço", "PREÇO", "PRECO", "Preço Atual", "PREÇO ATUAL (R$)", "preco_atual", "price"),
    "score": ("Score", "score", "score_top"),
}


def texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole files, one row each: `path` and `text`. For landed responses, which are small documents."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def rate_series(df: DataFrame, text: str, by: Sequence[str] = (), keep_missing: bool = False) -> DataFrame:
    """Rows (by, date, value) of JSON lists of dated values. Values that are no numbers are dropped unless
    `keep_missing`."""
    rows = df.select(*[col(b) for b in by], F.explode(F.from_json(col(text), SERIES_SHAPE)).alias("r"))
    parsed = rows.select(
        *[col(b) for b in by], br_date(F.col("r.data")).alias("date"), to_number(F.col("r.valor")).alias("value")
    )
    return parsed if keep_missing else parsed.where(F.col("value").isNotNull())


def close_series(df: DataFrame, date: str, close: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, date, value) of a price table; rows without a numeric close are dropped."""
    return df.select(
        *[col(b) for b in by], iso_date(col(date)).alias("date"), to_number(col(close)).alias("value")
    ).where(F.col("value").isNotNull())


def typed_fields(df: DataFrame, text: str, shape: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, fields of `shape`) of JSON documents; a field that is absent or doesn't fit is null."""
    return df.select(*[col(b) for b in by], F.from_json(col(text), f"struct<{_ddl(shape)}>").alias("_f")).select(*by, "_f.*")


def _ddl(shape: str) -> str:
    return ",".join(":".join(field.split()) for field in shape.split(","))


def quotes(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, pair, value, pct_change, updated_at) of JSON quote documents; entries without codes or
    numbers are skipped."""
    rows = df.select(
        *[col(b) for b in by], F.explode(F.from_json(col(text), QUOTE_SHAPE)).alias("name", "q")
    )
    parsed = rows.select(
        *[col(b) for b in by],
        F.concat("q.code", F.lit("/"), "q.codein").alias("pair"),
        to_number(F.col("q.bid")).alias("value"),
        to_number(F.col("q.pctChange")).alias("pct_change"),
        F.coalesce("q.create_date", F.lit("")).alias("updated_at"),
    )
    return filled(parsed, ["pair", "value", "pct_change"])


def payload_rows(
    df: DataFrame, text: str, section: str, spec: AssetSpec, names: dict[str, Sequence[str]], day: str | None = None
) -> DataFrame:
    """History rows of stored daily payloads: date, ticker, price, score and the record itself (`fields`, a
    map of texts). A role is read from the first of its names that is filled. Records without ticker are
    dropped. A payload without a date takes that of the column `day`."""
    stored = F.lit(None).cast("string") if day is None else col(day).cast("string")
    documents = df.select(F.from_json(col(text), PAYLOAD_SHAPE).alias("p"), stored.alias("day"))
    date = F.coalesce(F.nullif(F.col("p.data"), F.lit("")), F.col("day"))
    rows = documents.select(date.alias("data"), F.explode(f"p.{section}").alias("fields"))

    def role(name: str) -> Column:
        return F.coalesce(*[F.nullif(F.col("fields")[n], F.lit("")) for n in names[name]])

    return rows.select(
        iso_date(F.col("data")).alias(spec.date),
        ticker(role("ticker")).alias(spec.id),
        any_number(role("price")).alias(spec.price),
        any_number(role("score")).alias(spec.score),
        "fields",
    ).where(col(spec.id).isNotNull())


__all__ = [
    "FUND_NAMES", "STOCK_NAMES", "close_series", "payload_rows", "quotes", "rate_series", "texts", "typed_fields",
]
