"""Table cleaning: one projection built from column roles, footer removal, numeric discovery."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.columns import col, filled, number, to_number
from crivo.functions import text
from crivo.operators.order import keep_last_row
from crivo.session import cut
from crivo.spec import AssetSpec, CleanRoles

# Footer word of the stock table, and name parts that mark a numeric column.
FOOTER_WORD = "legenda"
NUMERIC_NAMES = (
    "preço", "preco", "price", "score", "yield", "dy", "p/vp", "p/vpa", "volume", "liquidez", "patrim",
    "market", "ev/", "margem", "roa", "rpl", "vpa", "volatil", "cotistas", "lucro", "retorno", "delta",
)
# Columns that always stay text.
ALWAYS_TEXT = ("Empresa", "SETOR", "Nome", "Status", "modelo_lider", "motivo_status", "tendencias")
# What a model must never see as a feature.
TARGET_PREFIXES = ("Retorno_Futuro_", "Preco_Futuro_", "Data_Futura_")
NON_FEATURES = ("Ticker", "Ticker_norm", "Tipo", "Status")


def clean(df: DataFrame, roles: CleanRoles) -> DataFrame:
    """Trims text cells and parses the columns named by `roles`; absent columns are skipped and columns
    that already are numbers pass through unchanged."""
    parsers: dict[str, Callable[[Column], Column]] = {}
    for names, parser in [
        (roles.percent, text.percent),
        (roles.money, text.money),
        (roles.integer, text.integer),
        (roles.money_like, text.money),
        (roles.plain_float, text.plain_float),
    ]:
        parsers.update({n: parser for n in names})

    def cell(name: str, kind: str) -> Column:
        if kind != "string":
            return col(name)
        if name in parsers:
            return parsers[name](col(name)).alias(name)
        return F.trim(col(name)).alias(name)

    return df.select(*[cell(n, t) for n, t in df.dtypes])


def without_footer(df: DataFrame, names: Sequence[str] = ("Ação", "Empresa"), price: str = "Preço") -> DataFrame:
    """Drops empty rows, rows whose name says it is the legend, and rows whose price is text."""
    kept = df.dropna("all", subset=[c for c in df.columns if c != "_seq"])
    for name in names:
        if name in df.columns:
            kept = kept.where(~F.coalesce(F.lower(F.trim(col(name))) == FOOTER_WORD, F.lit(False)))
    if price in df.columns:
        kept = kept.where(col(price).isNull() | number(df, price).isNotNull())
    return kept


def numeric_profile(df: DataFrame, parser: Callable[[Column], Column] = text.any_number) -> DataFrame:
    """Rows (column, filled, parsed, total): how much of every column reads as a number. One pass."""
    counts = df.select(F.count(F.lit(1)).alias("total"), *[
        F.struct(
            F.count(col(n)).alias("filled"),
            F.count(parser(col(n).cast("string"))).alias("parsed"),
        ).alias(n)
        for n in df.columns
    ])
    return counts.select("total", F.explode(F.create_map(*[
        part for n in df.columns for part in (F.lit(n), col(n))
    ])).alias("column", "_c")).select("column", "_c.filled", "_c.parsed", "total")


def numericise(df: DataFrame, id: str, date: str, price: str, share: float = 0.85) -> DataFrame:
    """Types a table of texts: columns with a numeric name, or of which at least `share` of the filled
    cells parse, become double; the rest text. Keeps rows with id, date and price, the last per (date, id)
    by `_seq`. Looks at the data once, because the result's schema depends on it.

    Parsing texts of unknown locale is most of the work, and a small file is a single task to Spark: the table is dealt by
    (date, id) and stored first, so that all cores parse it, and look at it."""
    df = cut(df.repartition(col(date), col(id)))
    kinds = dict(df.dtypes)
    candidates = [c for c in df.columns if c not in {id, date, price, "_seq", *ALWAYS_TEXT}]
    numeric = {c for c in candidates if any(part in c.lower() for part in NUMERIC_NAMES)}
    unsure = [c for c in candidates if c not in numeric]
    if unsure:
        seen = numeric_profile(df.select(*[col(c) for c in unsure])).collect()  # one row per column
        numeric |= {r["column"] for r in seen if r["filled"] and r["parsed"] / r["filled"] >= share}

    def cell(name: str) -> Column:
        if name == "_seq":
            return col(name)
        if name == id:
            return text.ticker(col(name)).alias(name)
        if name == date:
            return text.iso_date(col(name)).alias(name)
        if name == price or name in numeric:
            parsed = text.any_number(col(name)) if kinds[name] == "string" else number(df, name)
            return parsed.alias(name)
        return col(name).cast("string").alias(name)

    typed = filled(df.select(*[cell(c) for c in df.columns]), [id, date, price])
    return keep_last_row(typed, [date, id])


def feature_columns(df: DataFrame, spec: AssetSpec, target: str, share: float = 0.80) -> list[str]:
    """Columns a model may use: numeric ones, and text ones of which at least `share` of all rows parse."""
    excluded = {spec.id, spec.date, spec.name, target, "_seq", *NON_FEATURES}
    names = [
        (n, t) for n, t in df.dtypes if n not in excluded and not n.startswith(TARGET_PREFIXES)
    ]
    numeric_kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    features = {n for n, t in names if t in numeric_kinds or t.startswith("decimal")}
    unsure = [n for n, t in names if t == "string"]
    if unsure:
        seen = numeric_profile(df.select(*[col(n) for n in unsure]), to_number).collect()
        features |= {r["column"] for r in seen if r["total"] and r["parsed"] / r["total"] >= share}
    return [n for n in df.columns if n in features]


def as_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns as double, all others unchanged."""
    chosen = set(names)
    return df.select(*[number(df, c).alias(c) if c in chosen else col(c) for c in df.columns])
