"""The daily screen of one asset class: land, clean, score, screen, store."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crivo.operators.clean import as_features, clean, without_footer
from crivo.operators.history import portfolio_rows, union_all
from crivo.operators.order import with_sequence
from crivo.operators.score import score
from crivo.operators.screen import screen_assets
from crivo.session import cut
from crivo.sources import lake
from crivo.spec import (
    FUND_LIMITS, FUND_ROLES, FUNDS, STOCK_LIMITS, STOCKS, AssetSpec, CleanRoles, Limits, QuartileRule, Rule,
    fund_rules, stock_rules,
)

Rules = tuple[Sequence[Rule], Sequence[QuartileRule]]


def universe_table(spec: AssetSpec) -> str:
    return f"{spec.kind.lower()}_universe"


def list_table(spec: AssetSpec) -> str:
    return f"{spec.kind.lower()}_top"


PORTFOLIO_TABLE = "carteira"
MANIFEST_TABLE = "manifest"


def screened_day(
    raw: DataFrame, spec: AssetSpec, roles: CleanRoles, rules: Rules, top_n: int
) -> tuple[DataFrame, DataFrame]:
    """(list with positions, scored universe with statuses) of one day's raw table. Whatever the roles leave as
    text in a numeric column of the class is read as a plain number."""
    # Stored first: scores are joined back on `_seq`, which must be the same number whenever it is read.
    landed = cut(raw if "_seq" in raw.columns else with_sequence(raw))
    typed = clean(landed, roles)
    numbers = [spec.price, *spec.required, *[f.column for f in spec.factors]]
    typed = as_features(typed, [n for n in numbers if n in typed.columns])
    scored = cut(score(typed, spec.factors, [], ["_seq"], out=spec.score))
    return screen_assets(scored, spec, rules, top_n_rows=top_n)


def manifest_table(spec: AssetSpec) -> str:
    return f"{MANIFEST_TABLE}_{spec.kind.lower()}"


def store_day(root: str, day: Date, spec: AssetSpec, top: DataFrame, universe: DataFrame) -> None:
    """Replaces the day's snapshot of this class: universe, list and portfolio rows, and last its manifest, read back from
    what was stored."""
    lake.write_day(universe.drop(spec.date), root, universe_table(spec), day)
    lake.write_day(top.drop(spec.date), root, list_table(spec), day)
    rows = portfolio_rows(top, spec, F.lit(day))
    lake.write_day(rows, root, f"{PORTFOLIO_TABLE}_{spec.kind.lower()}", day)
    spark = top.sparkSession
    listed = [lake.day_manifest(spark, root, table, day) for table in (universe_table(spec), list_table(spec))]
    lake.write_day(union_all(*listed).coalesce(1), root, manifest_table(spec), day)


def run_funds(raw: DataFrame, root: str, day: Date, limits: Limits = FUND_LIMITS) -> tuple[DataFrame, DataFrame]:
    top, universe = screened_day(raw, FUNDS, FUND_ROLES, fund_rules(limits), limits.top_n)
    store_day(root, day, FUNDS, top, universe)
    return top, universe


def run_stocks(raw: DataFrame, root: str, day: Date, limits: Limits = STOCK_LIMITS) -> tuple[DataFrame, DataFrame]:
    listed = without_footer(raw, (STOCKS.id, STOCKS.name), STOCKS.price)
    top, universe = screened_day(listed, STOCKS, CleanRoles(), stock_rules(limits), limits.top_n)
    store_day(root, day, STOCKS, top, universe)
    return top, universe
