"""Descriptions that the operators take: column roles, factors, rules. No data, no session."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from crivo.columns import quoted


@dataclass(frozen=True)
class Factor:
    """One scored indicator. `best` is "max" or "min"."""

    column: str
    weight: float
    best: str


@dataclass(frozen=True)
class Rule:
    """A row passes when the SQL predicate is true; otherwise `label` says why not."""

    label: str
    passes: str


@dataclass(frozen=True)
class QuartileRule:
    """Keep rows at or beyond a quantile of the rows that passed the fixed rules.

    `keep` is "low" (value <= quantile) or "high" (value >= quantile). `label` holds `{}` where the
    quantile is shown, multiplied by `scale` and written with the number pattern `pattern`.
    """

    column: str
    q: float
    keep: str
    label: str
    pattern: str = "0.00"
    scale: float = 1.0


@dataclass(frozen=True)
class AssetSpec:
    """Which column plays which role for one asset class."""

    kind: str
    id: str
    price: str
    date: str = "Data_Execucao"
    score: str = "Score"
    status: str = "Status"
    name: str | None = None
    dy: str | None = None
    multiple: str | None = None
    factors: Sequence[Factor] = ()
    required: Sequence[str] = ()
    order: Sequence[tuple[str, str]] = ()
    unique_by: Sequence[str] = ()
    mandatory: Sequence[str] = ()
    trends: Sequence[str] = ()
    shown: Sequence[str] = ()


@dataclass(frozen=True)
class CleanRoles:
    """Which text columns hold which kind of number."""

    percent: Sequence[str] = ()
    money: Sequence[str] = ()
    integer: Sequence[str] = ()
    money_like: Sequence[str] = ()
    plain_float: Sequence[str] = ()


@dataclass(frozen=True)
class Limits:
    """Absolute minima of the fixed rules and the size of the list."""

    dy: float
    liquidity: float
    size: float
    top_n: int = 20


# --- Fixed values: column names, weights, minima and label texts of the two asset classes -------------

FUND_LIMITS = Limits(dy=0.003, liquidity=100_000, size=50_000_000)
STOCK_LIMITS = Limits(dy=0.02, liquidity=500_000, size=200_000_000)

FUND_ROLES = CleanRoles(
    percent=(
        "DIVIDEND YIELD", "DY (3M) ACUMULADO", "DY (6M) ACUMULADO", "DY (12M) ACUMULADO",
        "DY (3M) MÉDIA", "DY (6M) MÉDIA", "DY (12M) MÉDIA", "DY ANO", "DY PATRIMONIAL",
    ),
    money=("PREÇO ATUAL (R$)", "LIQUIDEZ DIÁRIA (R$)", "PATRIMÔNIO LÍQUIDO", "VPA"),
    integer=("QUANT. ATIVOS", "NUM. COTISTAS"),
    money_like=("VOLATILIDADE",),
    plain_float=("P/VP",),
)

FUNDS = AssetSpec(
    kind="FII",
    id="FUNDOS",
    price="PREÇO ATUAL (R$)",
    name="SETOR",
    dy="DIVIDEND YIELD",
    multiple="P/VP",
    factors=(
        Factor("DIVIDEND YIELD", 0.30, "max"),
        Factor("P/VP", 0.25, "min"),
        Factor("LIQUIDEZ DIÁRIA (R$)", 0.20, "max"),
        Factor("PATRIMÔNIO LÍQUIDO", 0.15, "max"),
        Factor("VOLATILIDADE", 0.10, "min"),
    ),
    required=("P/VP", "DIVIDEND YIELD", "LIQUIDEZ DIÁRIA (R$)", "PATRIMÔNIO LÍQUIDO", "VOLATILIDADE"),
    order=(("DIVIDEND YIELD", "desc"), ("P/VP", "asc"), ("LIQUIDEZ DIÁRIA (R$)", "desc")),
    trends=("DIVIDEND YIELD", "P/VP", "LIQUIDEZ DIÁRIA (R$)", "VOLATILIDADE"),
    shown=(
        "FUNDOS", "SETOR", "PREÇO ATUAL (R$)", "DIVIDEND YIELD", "P/VP", "LIQUIDEZ DIÁRIA (R$)",
        "PATRIMÔNIO LÍQUIDO", "VOLATILIDADE", "VPA", "ÚLTIMO DIVIDENDO", "NUM. COTISTAS",
    ),
)

STOCKS = AssetSpec(
    kind="ACAO",
    id="Ação",
    price="Preço",
    name="Empresa",
    dy="Dividend Yield",
    multiple="Preço/VPA",
    factors=(
        Factor("Dividend Yield", 0.20, "max"),
        Factor("Preço/VPA", 0.20, "min"),
        Factor("Preço/Lucro", 0.15, "min"),
        Factor("ROA", 0.15, "max"),
        Factor("Margem Líquida", 0.15, "max"),
        Factor("EV/EBITDA", 0.15, "min"),
    ),
    required=(
        "Preço/VPA", "Preço/Lucro", "EV/EBIT", "EV/EBITDA", "Margem Líquida", "ROA", "RPL", "ROInvC",
        "Passivo/Patrimônio Líquido", "Alavancagem Financeira", "Dividend Yield",
        "Volume Diário Médio (3 meses)", "Market Cap Empresa",
    ),
    order=(("Score", "desc"),),
    unique_by=("Empresa",),
    mandatory=("Ação", "Preço"),
    trends=("Dividend Yield", "Preço/VPA", "ROA", "Margem Líquida"),
    shown=(
        "Ação", "Empresa", "Preço", "Preço/VPA", "Preço/Lucro", "Dividend Yield", "ROA",
        "Margem Líquida", "Market Cap Empresa", "Market CapEmpresa", "EV/EBITDA", "RPL", "EV/EBIT",
    ),
)


def fund_rules(limits: Limits = FUND_LIMITS) -> tuple[list[Rule], list[QuartileRule]]:
    pvp, dy, liquidity, equity, vol = FUNDS.required
    fixed = [
        Rule("P/VP nulo ou negativo", f"{quoted(pvp)} > 0"),
        Rule("DIVIDEND YIELD nulo", f"{quoted(dy)} is not null"),
        Rule("LIQUIDEZ DIÁRIA nula", f"{quoted(liquidity)} is not null"),
        Rule("PATRIMÔNIO LÍQUIDO nulo", f"{quoted(equity)} is not null"),
        Rule("VOLATILIDADE nula", f"{quoted(vol)} is not null"),
        Rule(f"DY <= {limits.dy * 100:.2f}%", f"{quoted(dy)} > {limits.dy}D"),
        Rule(f"Liquidez <= {limits.liquidity:,.0f}", f"{quoted(liquidity)} > {limits.liquidity}D"),
        Rule(f"Patrimônio <= {limits.size:,.0f}", f"{quoted(equity)} > {limits.size}D"),
    ]
    quartile = [
        QuartileRule(pvp, 0.25, "low", "P/VP > Q25 ({})"),
        QuartileRule(dy, 0.75, "high", "DY < Q75 ({}%)", scale=100),
        QuartileRule(liquidity, 0.75, "high", "Liquidez < Q75 ({})", "#,##0"),
        QuartileRule(equity, 0.75, "high", "Patrimônio < Q75 ({})", "#,##0"),
        QuartileRule(vol, 0.75, "low", "Volatilidade > Q75 ({})"),
    ]
    return fixed, quartile


def stock_rules(limits: Limits = STOCK_LIMITS) -> tuple[list[Rule], list[QuartileRule]]:
    volume, cap = "Volume Diário Médio (3 meses)", "Market Cap Empresa"
    fixed = [
        Rule("Preço/VPA nulo", "`Preço/VPA` is not null"),
        Rule("Margem Líquida nula", "`Margem Líquida` is not null"),
        Rule("Dividend Yield nulo", "`Dividend Yield` is not null"),
        Rule(f"Volume <= {limits.liquidity:,.0f}", f"{quoted(volume)} > {limits.liquidity}D"),
        Rule(f"Market Cap <= {limits.size:,.0f}", f"{quoted(cap)} > {limits.size}D"),
        Rule("Margem Líquida <= 0", "`Margem Líquida` > 0"),
        Rule("ROA <= 0", "`ROA` > 0"),
        Rule(f"DY <= {limits.dy * 100:.2f}%", f"`Dividend Yield` > {limits.dy}D"),
    ]
    quartile = [
        QuartileRule("Preço/VPA", 0.25, "low", "Preço/VPA > Q25 ({})"),
        QuartileRule("Preço/Lucro", 0.25, "low", "Preço/Lucro > Q25 ({})"),
        QuartileRule("EV/EBIT", 0.25, "low", "EV/EBIT > Q25 ({})"),
        QuartileRule("EV/EBITDA", 0.25, "low", "EV/EBITDA > Q25 ({})"),
        QuartileRule("Margem Líquida", 0.75, "high", "Margem < Q75 ({}%)", scale=100),
        QuartileRule("ROA", 0.75, "high", "ROA < Q75 ({}%)", scale=100),
        QuartileRule("RPL", 0.75, "high", "RPL < Q75 ({}%)", scale=100),
        QuartileRule("Dividend Yield", 0.75, "high", "DY < Q75 ({}%)", scale=100),
    ]
    return fixed, quartile


# Horizons in days, and the score columns of the stored schema. The names say which model ran: what Spark
# trains in the place of outside libraries is named for itself.
HORIZONS = (7, 30, 60, 90)

# Model score column -> model name, in the order in which models are shown.
MODELS = {
    "score_top": "Score Top",
    "score_ridge": "Ridge",
    "score_random_forest": "Random Forest",
    "score_extra_trees": "Extra Trees",
    "score_xgboost": "Boosted Trees, depth 4",
    "score_lightgbm": "Boosted Trees, 31 leaves",
    "score_catboost": "Boosted Trees, depth 5",
    "score_ensemble": "Ensemble",
}
BASELINE = "Score Top"
ENSEMBLE = "Ensemble"

__all__ = [
    "AssetSpec", "BASELINE", "CleanRoles", "ENSEMBLE", "Factor", "FUNDS", "FUND_LIMITS", "FUND_ROLES",
    "HORIZONS", "Limits", "MODELS", "QuartileRule", "Rule", "STOCKS", "STOCK_LIMITS",
    "fund_rules", "stock_rules",
]
