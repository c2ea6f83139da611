"""Registered queries with the SQL that must give the same rows. See `views` for their inputs."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import views as v
from crivo.functions import scalars, text
from crivo.operators import (
    clean, confidence, evaluate, features, history, models, order, quality, report, score, screen, series, trees,
)
from crivo.operators.asof import probes
from crivo.plans import daily, export, incremental, refresh
from crivo.session import checkpoint_folder, cut, ship
from crivo.sources import lake, landed, lines, published
from crivo.spec import BASELINE, FUNDS, AssetSpec, CleanRoles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def r6(value):
    """Six decimals: sums of fractions may differ in their last bits between engines."""
    return F.round(value, 6)


# === cleaning ===========================================================================================

BALANCE = "cents / 100.0::double"


@query("clean_money", f"with {v.BR_TEXT_SQL} select c_custkey as id, case when c_custkey % 11 <> 0 then {BALANCE} end as value from cents")
def clean_money(spark, folder):
    return v.br_text(spark, folder).select("id", text.money(F.col("money")).alias("value"))


@query("clean_percent", f"with {v.BR_TEXT_SQL} select c_custkey as id, case when c_custkey % 11 <> 1 then {BALANCE} / 100 end as value from cents")
def clean_percent(spark, folder):
    return v.br_text(spark, folder).select("id", text.percent(F.col("percent")).alias("value"))


@query("clean_float", f"with {v.BR_TEXT_SQL} select c_custkey as id, case when c_custkey % 11 <> 2 then {BALANCE} end as value from cents")
def clean_float(spark, folder):
    return v.br_text(spark, folder).select("id", text.plain_float(F.col("ratio")).alias("value"))


@query("clean_integer", f"with {v.BR_TEXT_SQL} select c_custkey as id, case when c_custkey % 11 <> 3 then counted end as value from cents")
def clean_integer(spark, folder):
    return v.br_text(spark, folder).select("id", text.integer(F.col("holders")).alias("value"))


MIXED_SQL = """case c_custkey % 5 when 0 then -abs(cents) / 100.0::double when 1 then cents / 100.0::double
  when 2 then case when counted < 1000 then counted::double else counted / 1000.0::double end
  when 4 then abs(cents) / 100.0::double end"""


@query("locale_parse", f"with {v.BR_TEXT_SQL} select c_custkey as id, {MIXED_SQL} as value from cents")
def locale_parse(spark, folder):
    return v.br_text(spark, folder).select("id", text.any_number(F.col("mixed")).alias("value"))


BR_ROLES = CleanRoles(percent=("percent",), money=("money",), integer=("holders",), plain_float=("ratio", "absent"))


@query("clean_table", f"""with {v.BR_TEXT_SQL}
  select c_custkey as id, c_acctbal as balance,
    case when c_custkey % 10 = 0 then 'Legenda' else c_name end as company,
    case when c_custkey % 13 = 0 then 'N/D' else printf('%s%d.%02d', case when cents < 0 then '-' else '' end, abs(cents) // 100, abs(cents) % 100) end as price,
    case when c_custkey % 11 <> 0 then {BALANCE} end as money,
    case when c_custkey % 11 <> 1 then {BALANCE} / 100 end as percent,
    case when c_custkey % 11 <> 2 then {BALANCE} end as ratio,
    case when c_custkey % 11 <> 3 then counted end as holders
  from cents""")
def clean_table(spark, folder):
    return clean.clean(v.br_text(spark, folder), BR_ROLES).drop("mixed")


@query("footer_removal", f"with {v.BR_TEXT_SQL} select c_custkey as id from cents where c_custkey % 10 <> 0 and c_custkey % 13 <> 0")
def footer_removal(spark, folder):
    return clean.without_footer(v.br_text(spark, folder), ("company",), "price").select("id")


@query("numericise_profile", f"""with {v.BR_TEXT_SQL}
  select 'mixed' as "column", count(*) as filled, count(*) filter (c_custkey % 5 <> 3) as parsed from cents
  union all select 'money', count(*), count(*) filter (c_custkey % 11 <> 0) from cents
  union all select 'holders', count(*), count(*) from cents
  union all select 'company', count(*), count(*) filter (c_custkey % 10 <> 0) from cents""")
def numericise_profile(spark, folder):
    shown = v.br_text(spark, folder).select("mixed", "money", "holders", "company")
    return clean.numeric_profile(shown).select("column", "filled", "parsed")


@query("numericise_table", f"""with {v.BR_TEXT_SQL}
  select 'CUSTOMER' || c_custkey as ticker, date '2024-01-01' + cast(c_custkey % 30 as integer) as day,
    cents / 100.0::double as price, case when c_custkey % 11 <> 0 then {BALANCE} end as money,
    {MIXED_SQL.replace("case c_custkey % 5", "case c_custkey % 5 when 3 then null")} as mixed_score, c_mktsegment as segment
  from cents where c_custkey % 13 <> 0""")
def numericise_table(spark, folder):
    raw = v.br_text(spark, folder).join(
        v.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment"), "id"
    )
    landed_rows = raw.select(
        F.concat(F.lit(" customer"), F.col("id")).alias("ticker"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).cast("string").alias("day"),
        "price",
        "money",
        F.col("mixed").alias("mixed_score"),
        F.col("c_mktsegment").alias("segment"),
    )
    return clean.numericise(landed_rows, "ticker", "day", "price")


@query("feature_profile", """
  select 'c_acctbal' as feature from customer having count(*) > 0
  union all select 'as_text' from customer having avg(case when c_custkey % 11 <> 0 then 1.0 else 0.0 end) >= 0.8
  union all select 'half_text' from customer having avg(case when c_custkey % 2 = 0 then 1.0 else 0.0 end) >= 0.8""")
def feature_profile(spark, folder):
    source = v.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        "c_acctbal",
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal").cast("string")).otherwise("x").alias("as_text"),
        F.when(F.col("c_custkey") % 2 == 0, "1").otherwise("x").alias("half_text"),
        F.lit(1.0).alias("Retorno_Futuro_7d"),
    )
    found = clean.feature_columns(source, v.HISTORY, "Retorno_Futuro_30d")
    flags = source.agg(F.count(F.lit(1)).alias("n"))
    return flags.where("n > 0").select(F.explode(F.array(*[F.lit(f) for f in found])).alias("feature"))


@query("normalise_keys", f"""with {v.BR_TEXT_SQL}
  select c_custkey as id,
    case when c_custkey % 7 <> 0 then upper(trim(c_name)) end as ticker,
    case when c_custkey % 9 <> 0 then date '2024-01-01' + cast(c_custkey % 30 as integer) end as day,
    case when c_custkey % 9 <> 0 then date '2024-01-01' + cast(c_custkey % 30 as integer) end as br_day
  from cents""")
def normalise_keys(spark, folder):
    key = F.col("c_custkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int"))
    raw = v.table(spark, folder, "customer").select(
        key.alias("id"),
        F.when(key % 7 == 0, F.when(key % 2 == 0, " nan ").otherwise("None"))
        .otherwise(F.concat(F.lit(" "), F.lower("c_name"), F.lit(" "))).alias("t"),
        F.when(key % 9 == 0, "soon").otherwise(day.cast("string")).alias("d"),
        F.when(key % 9 == 0, "31/31/2024").otherwise(F.date_format(day, "dd/MM/yyyy")).alias("b"),
    )
    return raw.select(
        "id",
        text.ticker(F.col("t")).alias("ticker"),
        text.iso_date(F.col("d")).alias("day"),
        text.br_date(F.col("b")).alias("br_day"),
    )


@query("exportable_values", f"""with {v.UNIVERSE_SQL}
  select id, round_even(case when id % 23 <> 0 and id % 29 <> 0 then multiple end * 10000, 0) / 10000 as multiple,
    least(1.0::double, greatest(0.0::double, coalesce((dy - 0.04::double) / (0.06::double - 0.04::double), 0))) as yield_scale
  from universe""")
def exportable_values(spark, folder):
    broken = (
        F.when(F.col("id") % 23 == 0, F.lit(float("nan")))
        .when(F.col("id") % 29 == 0, F.lit(float("inf")))
        .otherwise(F.col("multiple"))
    )
    return v.universe(spark, folder).select(
        "id",
        scalars.exportable(broken).alias("multiple"),
        scalars.linear_scale(F.col("dy"), 0.04, 0.06).alias("yield_scale"),
    )


# === scores and screens =================================================================================

UNIVERSE_COLUMNS = [f.column for f in v.UNIVERSE_FACTORS]


@query("universe_percentiles", f"""with {v.UNIVERSE_SQL}
  select id, {', '.join(f'round({v.percentile_sql(c, "")}, 6) as pct_{c}' for c in UNIVERSE_COLUMNS)} from universe""")
def universe_percentiles(spark, folder):
    pct = order.percentiles(v.universe(spark, folder), [], ["id"], UNIVERSE_COLUMNS)
    return pct.select("id", *[r6(F.col(f"pct_{c}")).alias(f"pct_{c}") for c in UNIVERSE_COLUMNS])


@query("group_quantiles", f"""with {v.UNIVERSE_SQL}
  select sector, round(quantile_cont(multiple, 0.25), 6) as q25_multiple, round(quantile_cont(dy, 0.75), 6) as q75_dy,
    round(quantile_cont(vol, 0.5), 6) as median_vol
  from universe group by sector""")
def group_quantiles(spark, folder):
    wanted = {"q25_multiple": ("multiple", 0.25), "q75_dy": ("dy", 0.75), "median_vol": ("vol", 0.5)}
    q = order.quantiles(v.universe(spark, folder), ["sector"], wanted)
    return q.select("sector", *[r6(F.col(n)).alias(n) for n in wanted])


SCORED_SQL = f"{v.UNIVERSE_SQL}, scored as (select *, {v.score_sql(v.UNIVERSE_FACTORS, '')} as score from universe)"


def scored_universe(spark, folder):
    return score.score(v.universe(spark, folder), v.UNIVERSE_FACTORS, [], ["id"], out="score")


@query("composite_score", f"with {SCORED_SQL} select id, score from scored")
def composite_score(spark, folder):
    return scored_universe(spark, folder).select("id", "score")


@query("score_by_sector", f"""with {v.UNIVERSE_SQL}
  select sector, id, {v.score_sql(v.UNIVERSE_FACTORS, 'sector')} as score from universe""")
def score_by_sector(spark, folder):
    scored = score.score(v.universe(spark, folder), v.UNIVERSE_FACTORS, ["sector"], ["id"], out="score")
    return scored.select("sector", "id", "score")


def _breakdown_sql() -> str:
    parts = []
    for f in v.UNIVERSE_FACTORS:
        pct = ("100 - " if f.best == "min" else "") + v.percentile_sql(f.column, "")
        parts.append(
            f"select id, '{f.column}' as factor, {f.column} as value, case when {f.column} is not null then "
            f"round_even(({pct}) * 10, 0) / 10 end as percentile, {f.weight}::double as weight, "
            f"'{f.best}' as direction from universe"
        )
    return f"with {v.UNIVERSE_SQL} " + " union all ".join(parts)


@query("score_breakdown", _breakdown_sql())
def score_breakdown(spark, folder):
    return score.breakdown(v.universe(spark, folder), v.UNIVERSE_FACTORS, [], ["id"])


FIXED_SQL = """case when not coalesce(multiple > 0, false) then 'multiple missing or negative'
  when vol is null then 'vol missing'
  when not coalesce(dy > 0.045, false) then 'DY <= 4.50%'
  when not coalesce(liquidity > 1200000, false) then 'liquidity <= 1,200,000'
  when not coalesce(equity > 600, false) then 'equity <= 600' end"""
LIMITS_SQL = """limits as (select quantile_cont(multiple, 0.25) as q_multiple, quantile_cont(dy, 0.75) as q_dy,
  quantile_cont(liquidity, 0.75) as q_liquidity, quantile_cont(equity, 0.75) as q_equity,
  quantile_cont(vol, 0.75) as q_vol from marked where failed is null)"""
QUARTILE_SQL = """case when failed is null then case
  when not multiple <= q_multiple then format('multiple > Q25 ({:.2f})', q_multiple)
  when not dy >= q_dy then format('DY < Q75 ({:.2f}%)', q_dy * 100)
  when not liquidity >= q_liquidity then format('liquidity < Q75 ({:,.0f})', q_liquidity)
  when not equity >= q_equity then format('equity < Q75 ({:,.0f})', q_equity)
  when not vol <= q_vol then format('vol > Q75 ({:.2f})', q_vol) end end"""
JUDGED_SQL = f"""{v.UNIVERSE_SQL}, marked as (select *, {FIXED_SQL} as failed from universe), {LIMITS_SQL},
  judged as (select marked.*, {QUARTILE_SQL} as quartile from marked cross join limits)"""
SCREENED_SQL = f"""{JUDGED_SQL},
  eligible as (select * from judged where failed is null and
    (quartile is null or not (select bool_or(failed is null and quartile is null) from judged))),
  top as (select *, row_number() over (order by dy desc, multiple, liquidity desc, id) as pos from eligible
    qualify pos <= 20)"""


@query("screen_fixed", f"with {v.UNIVERSE_SQL} select id, {FIXED_SQL} as reason from universe")
def screen_fixed(spark, folder):
    return v.universe(spark, folder).select("id", screen.first_failure(v.UNIVERSE_FIXED).alias("reason"))


@query("screen_quartile", f"with {JUDGED_SQL} select id, failed, quartile from judged")
def screen_quartile(spark, folder):
    marked = screen.judged(v.universe(spark, folder), v.UNIVERSE_FIXED, v.UNIVERSE_QUARTILES, [])
    return marked.select("id", F.col("_fixed").alias("failed"), F.col("_quartile").alias("quartile"))


def _screened(spark, folder, fixed=v.UNIVERSE_FIXED, quartiles=v.UNIVERSE_QUARTILES):
    stored = cut(v.universe(spark, folder))  # screening reads it three times
    return screen.screen(stored, fixed, quartiles, v.UNIVERSE_ORDER, "id", place="pos", status="status")


@query("screen_top", f"with {SCREENED_SQL} select id, company, sector, dy, multiple, liquidity, pos from top")
def screen_top(spark, folder):
    return _screened(spark, folder)[0].select("id", "company", "sector", "dy", "multiple", "liquidity", "pos")


@query("screen_status", f"""with {SCREENED_SQL}
  select j.id, coalesce('Eliminado no filtro fixo: ' || failed, 'Eliminado no quartil: ' || quartile,
    'Rank #' || (select min(pos) from top where top.id = j.id), 'Aprovado (fora do Top N)') as status
  from judged j""")
def screen_status(spark, folder):
    return _screened(spark, folder)[1].select("id", "status")


FALLBACK_SQL = f"""{v.UNIVERSE_SQL}, marked as (select *, {FIXED_SQL} as failed from universe),
  top as (select *, row_number() over (order by dy desc, multiple, liquidity desc, id) as pos from marked
    where failed is null qualify pos <= 20)"""


@query("screen_fallback", f"""with {FALLBACK_SQL}
  select m.id, coalesce('Eliminado no filtro fixo: ' || failed, 'Rank #' || pos, 'Aprovado (fora do Top N)') as status
  from marked m left join (select id, pos from top) t on m.id = t.id""")
def screen_fallback(spark, folder):
    """No row can be at or below the lowest quantile of one column and at or above the highest of it."""
    impossible = [
        v.QuartileRule("liquidity", 0.25, "low", "liquidity > Q25 ({})"),
        v.QuartileRule("liquidity", 0.75, "high", "liquidity < Q75 ({})"),
    ]
    return _screened(spark, folder, quartiles=impossible)[1].select("id", "status")


@query("screen_nothing_left", f"""with {v.UNIVERSE_SQL}
  select id, 'Eliminado no filtro fixo: dados insuficientes' as status from universe""")
def screen_nothing_left(spark, folder):
    return _screened(spark, folder, fixed=[v.Rule("never", "equity < 0")])[1].select("id", "status")


DAILY = AssetSpec(
    kind="PART", id="id", price="price", score="score", status="status",
    factors=v.UNIVERSE_FACTORS, required=("multiple", "dy", "liquidity", "equity", "vol"), order=v.UNIVERSE_ORDER,
)


@query("daily_screen", f"""with scored as ({ORACLES['composite_score']}), screened as ({ORACLES['screen_status']})
  select id, score, status from scored join screened using (id)""")
def daily_screen(spark, folder):
    """The daily plan on the derived universe: stored, scored, screened."""
    rules = v.UNIVERSE_FIXED, v.UNIVERSE_QUARTILES
    _, audited = daily.screened_day(v.universe(spark, folder), DAILY, CleanRoles(), rules, 20)
    return audited.select("id", "score", "status")


@query("screen_by_sector", f"""with {v.UNIVERSE_SQL}, marked as (select * from universe where {FIXED_SQL} is null),
  limits as (select sector, quantile_cont(multiple, 0.25) as q1, quantile_cont(dy, 0.75) as q2, quantile_cont(liquidity, 0.75) as q3,
    quantile_cont(equity, 0.75) as q4, quantile_cont(vol, 0.75) as q5 from marked group by sector),
  judged as (select m.*, multiple <= q1 and dy >= q2 and liquidity >= q3 and equity >= q4 and vol <= q5 as good
    from marked m join limits using (sector)),
  eligible as (select *, bool_or(good) over (partition by sector) as any_good from judged)
  select sector, id, pos from (select *, row_number() over (partition by sector order by dy desc, multiple, liquidity desc, id) as pos
    from eligible where good or not any_good) where pos <= 20""")
def screen_by_sector(spark, folder):
    top, _ = screen.screen(
        v.universe(spark, folder), v.UNIVERSE_FIXED, v.UNIVERSE_QUARTILES, v.UNIVERSE_ORDER, "id", by=["sector"], place="pos"
    )
    return top.select("sector", "id", "pos")


@query("dedupe_first_company", f"""with {v.UNIVERSE_SQL}
  select company, id, price from universe qualify row_number() over (partition by company order by id) = 1""")
def dedupe_first_company(spark, folder):
    return order.keep_first(v.universe(spark, folder), ["company"], "id").select("company", "id", "price")


@query("dedupe_last_company", f"""with {v.UNIVERSE_SQL}
  select company, id, price from universe qualify row_number() over (partition by company order by id desc) = 1""")
def dedupe_last_company(spark, folder):
    return order.keep_last(v.universe(spark, folder), ["company"], "id").select("company", "id", "price")


@query("top_by_score", f"""with {SCORED_SQL}
  select id, score, pos from (select *, row_number() over (order by score desc nulls last, id) as pos from scored) where pos <= 20""")
def top_by_score(spark, folder):
    ordering = [F.col("score").desc_nulls_last(), F.col("id").asc()]
    return order.top_n(scored_universe(spark, folder), [], ordering, 20, "pos").select("id", "score", "pos")


@query("records", f"""with {v.UNIVERSE_SQL}
  select id, round_even(dy * 10000, 0) / 10000 as dy, round_even(multiple * 10000, 0) / 10000 as multiple from universe""")
def records(spark, folder):
    return report.records(v.universe(spark, folder), ["id", "dy", "absent", "multiple"])


# === history ============================================================================================

HALF = "date '1998-06-01'"


def scored_history(spark, folder):
    return score.score(v.history(spark, folder), v.HISTORY_FACTORS, ["d", "cls"], ["id"], out="score")


def portfolio(spark, folder):
    ordering = [F.col("score").desc(), F.col("id").asc()]
    top = order.top_n(scored_history(spark, folder), ["d", "cls"], ordering, 20, "pos")
    return top.select("d", "cls", "id", "price", "score", "pos")


@query("history_score", f"with {v.HISTORY_SCORED_SQL} select d, cls, id, score from scored")
def history_score(spark, folder):
    return scored_history(spark, folder).select("d", "cls", "id", "score")


@query("history_portfolio", f"with {v.PORTFOLIO_SQL} select d, cls, id, price, score, pos from portfolio")
def history_portfolio(spark, folder):
    return portfolio(spark, folder)


@query("history_asof_date", f"with {v.HISTORY_SQL} select d, cls, id, price from history where d in (date '1996-01-01', date '1997-05-01')")
def history_asof_date(spark, folder):
    return v.history(spark, folder).where(F.col("d").isin("1996-01-01", "1997-05-01")).select("d", "cls", "id", "price")


@query("latest_slice", f"""with {v.HISTORY_SQL}
  select d, cls, id, price from history h where d = (select max(d) from history x where x.cls = h.cls)""")
def latest_slice(spark, folder):
    return history.latest(v.history(spark, folder), "d", ["cls"]).select("d", "cls", "id", "price")


@query("previous_day", f"""with {v.HISTORY_SQL}
  select d, cls, id, price from history where d = (select max(d) from history where d < {HALF})""")
def previous_day(spark, folder):
    return history.before_day(v.history(spark, folder), "d", F.lit("1998-06-01").cast("date")).select("d", "cls", "id", "price")


@query("snapshot_dates", f"with {v.HISTORY_SQL} select distinct d as date from history")
def snapshot_dates(spark, folder):
    return history.dates_of(v.history(spark, folder), "d")


def _revised(spark, folder):
    """Second source: suppliers of class A from mid-1998 on with a doubled price, and a new column."""
    return v.history(spark, folder).where((F.col("d") >= F.lit("1998-06-01")) & (F.col("cls") == "A")).select(
        "d", "cls", "id", (F.col("price") * 2).alias("price"), F.lit("revised").alias("note")
    )


@query("upsert_last_wins", f"""with {v.HISTORY_SQL}
  select d, cls, id, case when d >= {HALF} and cls = 'A' then price * 2 else price end as price,
    case when not (d >= {HALF} and cls = 'A') then dy end as dy,
    case when d >= {HALF} and cls = 'A' then 'revised' end as note from history""")
def upsert_last_wins(spark, folder):
    both = history.upsert(v.history(spark, folder), _revised(spark, folder), ["d", "cls", "id"])
    return both.select("d", "cls", "id", "price", "dy", "note")


@query("replace_day", f"""with {v.HISTORY_SQL}
  select d, cls, id, case when d >= {HALF} then price * 2 else price end as price
  from history where d < {HALF} or cls = 'A'
    or d not in (select d from history where d >= {HALF} and cls = 'A')""")
def replace_day(spark, folder):
    both = history.replace_days(v.history(spark, folder), _revised(spark, folder), "d", ["d", "cls", "id"])
    return both.select("d", "cls", "id", "price")


@query("union_with_drift", f"""with {v.HISTORY_SQL}
  select d, id, price, dy, cast(null as varchar) as note from history
  union all select d, id, price * 2, null, 'revised' from history where d >= {HALF} and cls = 'A'""")
def union_with_drift(spark, folder):
    both = history.union_all(v.history(spark, folder), _revised(spark, folder))
    return both.select("d", "id", "price", "dy", "note")


@query("portfolio_rows", f"""with {v.PORTFOLIO_SQL}
  select d as "Data_Carteira", 'SUP' as "Tipo", cast(id as varchar) as "Ticker", price as "Preco_Entrada",
    score as "Score", pos as "Posicao" from portfolio""")
def portfolio_rows(spark, folder):
    return history.portfolio_rows(portfolio(spark, folder), v.HISTORY, F.col("d"), "pos")


@query("manifest", f"""with {v.HISTORY_SQL} select d as date, 'history' as "table", count(*) as rows, 6 as columns from history group by d""")
def manifest(spark, folder):
    from crivo.sources import lake

    return lake.manifest_of(v.history(spark, folder), "d", "history").select("date", "table", "rows", "columns")


@query("prepared_history", f"""with {v.HISTORY_SQL}
  select d, cast(id as varchar) as id, 2 * price as price from history where id % 7 <> 0""")
def prepared_history(spark, folder):
    """Each row stored twice, the later copy revised; some ids are missing."""
    base = v.history(spark, folder).withColumn(
        "id", F.when(F.col("id") % 7 == 0, F.lit("nan")).otherwise(F.concat(F.lit(" "), F.col("id")))
    )
    twice = base.withColumn("_seq", F.lit(1)).union(
        base.withColumn("price", F.col("price") * 2).withColumn("_seq", F.lit(2))
    )
    return history.prepared(twice, v.HISTORY).select("d", "id", "price")


# === features and targets ===============================================================================

LAG_SQL = "window w as (partition by cls, id order by d)"


@query("lag_features", f"""with {v.HISTORY_SCORED_SQL}
  select d, cls, id, lag(price) over w as "Preco_Anterior", price / lag(price) over w - 1 as "Retorno_Desde_Snapshot_Anterior",
    d - lag(d) over w as "Dias_Desde_Snapshot_Anterior", lag(score) over w as "Score_Anterior",
    round(score - lag(score) over w, 6) as "Delta_Score",
    case when score >= 50 then 1 else 0 end as "Aprovado_Filtro"
  from scored {LAG_SQL}""")
def lag_features(spark, folder):
    with_status = scored_history(spark, folder).withColumn(
        "status", F.when(F.col("score") >= 80, "Rank #1").when(F.col("score") >= 50, "Aprovado (fora do Top N)")
    )
    out = features.features(with_status, v.HISTORY, ["cls"])
    return out.select(
        "d", "cls", "id", "Preco_Anterior", "Retorno_Desde_Snapshot_Anterior", "Dias_Desde_Snapshot_Anterior",
        "Score_Anterior", r6(F.col("Delta_Score")).alias("Delta_Score"), "Aprovado_Filtro",
    )


def _forward_sql(h: int) -> str:
    return f"""with {v.HISTORY_SQL}, {v.FORWARD_SQL}
      select d, cls, id, p{h} as "Preco_Futuro_{h}d", d{h} as "Data_Futura_{h}d",
        p{h} / price - 1 as "Retorno_Futuro_{h}d" from forward"""


def _register_forward(h: int) -> None:
    @query(f"forward_returns_{h}", _forward_sql(h))
    def forward(spark, folder):
        from crivo.operators.asof import forward_returns

        out = forward_returns(v.history(spark, folder), ["cls", "id"], "d", "price", [h])
        return out.select("d", "cls", "id", f"Preco_Futuro_{h}d", f"Data_Futura_{h}d", f"Retorno_Futuro_{h}d")


for _h in (7, 30, 60, 90):
    _register_forward(_h)


@query("training_dataset", f"""with {v.HISTORY_SQL}, {v.FORWARD_SQL}
  select d, cls, cast(id as varchar) as id, price, dy, volume, price / lag(price) over w - 1 as "Retorno_Desde_Snapshot_Anterior",
    p7 / price - 1 as "Retorno_Futuro_7d", p30 / price - 1 as "Retorno_Futuro_30d",
    p60 / price - 1 as "Retorno_Futuro_60d", p90 / price - 1 as "Retorno_Futuro_90d"
  from forward {LAG_SQL}""")
def training_dataset(spark, folder):
    out = features.dataset(v.history(spark, folder), v.HISTORY, by=[])
    return out.select(
        "d", "cls", "id", "price", "dy", "volume", "Retorno_Desde_Snapshot_Anterior",
        *[f"Retorno_Futuro_{h}d" for h in (7, 30, 60, 90)],
    )


@query("asof_price", f"""with {v.PORTFOLIO_SQL},
  asked as (select d, cls, id, pos, d + 45 as at from portfolio)
  select q.d, q.cls, q.id, q.pos, h.d as found_date, h.price as found_value
  from asked q asof left join history h on q.cls = h.cls and q.id = h.id and h.d <= q.at""")
def asof_price(spark, folder):
    from crivo.operators.asof import asof

    asked = cut(portfolio(spark, folder)).select("d", "cls", "id", "pos", F.date_add("d", 45).alias("at"))
    return asof(asked, v.history(spark, folder), ["cls", "id"], "at", "d", "price").drop("at")


# === series and portfolios ==============================================================================


@query("compound_index", f"""with {v.SERIES_SQL}
  select series, date, round(100 * product(1 + value / 100) over (partition by series order by date), 6) as value from series""")
def compound_index(spark, folder):
    out = series.compound(v.series(spark, folder), ["series"])
    return out.select("series", "date", r6(F.col("value")).alias("value"))


@query("rebase_first", f"""with {v.SERIES_SQL}
  select series, date, round(value / first_value(value) over (partition by series order by date) * 100, 4) as value from series""")
def rebase_first(spark, folder):
    return series.rebase(v.series(spark, folder), ["series"])


REBASE_SQL = f"""{v.SERIES_SQL}, kept as (select * from series),
  starts as (select series, min(date) + 9 as start from kept group by series),
  bases as (select s.series, s.start, b.value as base from starts s
    asof left join kept b on s.series = b.series and b.date <= s.start)"""


@query("rebase_from_date", f"""with {REBASE_SQL}
  select k.series, k.date, round(value / base * 100, 4) as value from kept k join bases b on k.series = b.series and k.date >= b.start
  union all
  select b.series, b.start, 100.0 from bases b where not exists (select 1 from kept k where k.series = b.series and k.date = b.start)""")
def rebase_from_date(spark, folder):
    kept = v.series(spark, folder)
    starts = kept.groupBy("series").agg(F.date_add(F.min("date"), 9).alias("start"))
    return series.rebase_from(kept, starts, ["series"])


INDEX_SQL = f"""{v.PORTFOLIO_SQL},
  dates as (select distinct cls, d from portfolio),
  periods as (select cls, d as b, lead(d) over (partition by cls order by d) as e from dates qualify e is not null),
  held as (select p.cls, p.id, b, e from portfolio p join periods on p.cls = periods.cls and p.d = b),
  priced as (select h.*, p0.price as v0, p1.price as v1 from held h
    asof left join history p0 on h.cls = p0.cls and h.id = p0.id and p0.d <= h.b
    asof left join history p1 on h.cls = p1.cls and h.id = p1.id and p1.d <= h.e),
  returns as (select cls, b, e, avg(v1 / v0 - 1) as ret from priced group by all),
  idx as (
    select cls, e as date, 100 * product(1 + coalesce(ret, 0)) over (partition by cls order by b) as value from returns
    union all select cls, min(d), 100.0 from dates group by cls)"""


def portfolio_index_of(spark, folder):
    return series.portfolio_index(cut(portfolio(spark, folder)), v.history(spark, folder), ["cls"], "id", "d", "price")


@query("portfolio_index", f"with {INDEX_SQL} select cls, date, round(value, 4) as value from idx")
def portfolio_index(spark, folder):
    return portfolio_index_of(spark, folder)


@query("portfolio_vs_series", f"""with {INDEX_SQL},
  market as (select d as date, case when cls = 'A' then 'market_a' else 'market_b' end as series, sum(volume) as value
    from history group by all),
  starts as (select min(d) as start from dates),
  bases as (select m.series, s.start, arg_max(m.value, m.date) as base from market m, starts s where m.date <= s.start group by all)
  select 'portfolio_' || cls as series, date, round(value, 4) as value from idx
  union all select m.series, m.date, round(m.value / base * 100, 4) from market m join bases b on m.series = b.series and m.date >= b.start""")
def portfolio_vs_series(spark, folder):
    index = portfolio_index_of(spark, folder)
    market = (
        v.history(spark, folder)
        .groupBy(F.concat(F.lit("market_"), F.lower("cls")).alias("series"), F.col("d").alias("date"))
        .agg((F.sum(F.rint(F.col("volume") * 100).cast("bigint")) / 100).alias("value"))
    )
    start = v.history(spark, folder).agg(F.min("d").alias("start"))
    names = market.select("series").distinct().withColumn("start", start.select("start").scalar())
    rebased = series.rebase_from(market, names, ["series"])
    own = index.select(F.concat(F.lit("portfolio_"), "cls").alias("series"), "date", "value")
    return own.unionByName(rebased)


WINDOW_SQL = f"""{v.PORTFOLIO_SQL},
  picks as (select * from portfolio),
  dates as (select distinct d from picks),
  periods as (select d as b, coalesce(lead(d) over (order by d), date '2001-11-01') as e from dates qualify e > b),
  held as (select id, b, e from picks join periods on d = b),
  closes as (select h.id, b, e, arg_min(price, d) as v0, arg_max(price, d) as v1, count(*) as n
    from held h join history x on x.id = h.id and x.d between b and e group by all),
  own as (select h.b, h.e, count(*) as holdings, avg(case when n >= 2 then v1 / v0 - 1 end) as ret
    from held h left join closes c on h.id = c.id and h.b = c.b and h.e = c.e group by all),
  market as (select cls, d, cast(sum(cast(round_even(volume * 100, 0) as bigint)) as double) / 100 as price from history group by all),
  bench as (select p.b, cls, case when count(*) >= 2 then arg_max(price, d) / arg_min(price, d) - 1 end as ret
    from periods p join market on d between b and e group by all),
  rows as (select o.b, o.e, o.holdings, o.ret as portfolio_return,
    (select ret from bench where bench.b = o.b and cls = 'A') as market_a_return,
    (select ret from bench where bench.b = o.b and cls = 'B') as market_b_return from own o)"""

BENCHMARKS = ["market_a", "market_b"]


def _backtest(spark, folder):
    """Both classes as one portfolio (an id belongs to one class), rebalanced at every date."""
    picks = cut(portfolio(spark, folder))
    past = cut(v.history(spark, folder))
    market = past.groupBy(F.concat(F.lit("market_"), F.lower("cls")).alias("series"), "d").agg(
        (F.sum(F.rint(F.col("volume") * 100).cast("bigint")) / 100).alias("price")
    )
    periods = series.backtest_periods(
        picks, past, market, BENCHMARKS, "id", "d", "price",
        F.lit("2001-11-01").cast("date"),
    )
    return picks, periods


@query("backtest_periods", f"""with {WINDOW_SQL}
  select b as start, e as "end", holdings, round(portfolio_return, 6) as portfolio_return,
    round(market_a_return, 6) as market_a_return, round(market_b_return, 6) as market_b_return from rows""")
def backtest_periods(spark, folder):
    _, periods = _backtest(spark, folder)
    return periods.select(
        "start", "end", "holdings", *[r6(F.col(f"{n}_return")).alias(f"{n}_return") for n in ["portfolio", *BENCHMARKS]]
    )


@query("backtest_chain", f"""with {WINDOW_SQL}
  select b as start, {', '.join(f"round(100 * product(1 + coalesce({n}_return, 0)) over (order by b), 6) as {n}_base100" for n in ["portfolio", "market_a", "market_b"])}
  from rows where portfolio_return is not null""")
def backtest_chain(spark, folder):
    chained = series.chained_backtest(_backtest(spark, folder)[1], BENCHMARKS)
    return chained.select("start", *[r6(F.col(f"{n}_base100")).alias(f"{n}_base100") for n in ["portfolio", *BENCHMARKS]])


@query("backtest_summary", f"""with {WINDOW_SQL},
  ends as (select count(*) as periods, 100 * product(1 + portfolio_return) as p, 100 * product(1 + coalesce(market_a_return, 0)) as a,
    100 * product(1 + coalesce(market_b_return, 0)) as b from rows where portfolio_return is not null)
  select periods > 0 as available, (select min(d) from dates) as first_date, (select count(*) from dates) as rebalances, periods,
    round(p, 6) as portfolio_base100, round(a, 6) as market_a_base100, round(b, 6) as market_b_base100,
    p > a as beat_market_a, p > b as beat_market_b from ends""")
def backtest_summary(spark, folder):
    picks, periods = _backtest(spark, folder)
    out = series.backtest_summary(picks, periods, BENCHMARKS, "d")
    names = [f"{n}_base100" for n in ["portfolio", *BENCHMARKS]]
    return out.select(*[r6(F.col(c)).alias(c) if c in names else F.col(c) for c in out.columns])


EXPORTED = datetime.date(1997, 6, 1)
# The benchmark names that the two classes' volumes stand in for; no CDI is given.
STAND_INS = {"A": "IFIX", "B": "IMOB"}
FUND_WINDOW_SQL = WINDOW_SQL.replace(
    "picks as (select * from portfolio)", f"picks as (select * from portfolio where cls = 'A' and d <= date '{EXPORTED}')"
).replace("2001-11-01", str(EXPORTED))


def _market(past: DataFrame) -> DataFrame:
    name = F.create_map(*[F.lit(x) for pair in STAND_INS.items() for x in pair])[F.col("cls")]
    return past.groupBy(name.alias("series"), F.col("d").alias("date")).agg(
        (F.sum(F.rint(F.col("volume") * 100).cast("bigint")) / 100).alias("value")
    )


@query("exported_backtest", f"""with {FUND_WINDOW_SQL}
  select b as start, holdings,
    {', '.join(f"round(100 * product(1 + coalesce({n}_return, 0)) over (order by b), 6) as {m}" for n, m in (("portfolio", "portfolio_base100"), ("market_a", "ifix_base100"), ("market_b", "imob_base100")))},
    100.0::double as cdi_base100
  from rows where portfolio_return is not null""")
def exported_backtest(spark, folder):
    """The backtest section of a day's document: one class, up to that day; a benchmark without a series stays flat."""
    past = cut(v.history(spark, folder))
    picks = cut(portfolio(spark, folder)).select(
        F.when(F.col("cls") == "A", "FII").otherwise("ACAO").alias("Tipo"), F.col("id").alias("Ticker"), F.col("d").alias("Data_Carteira")
    )
    prices = past.select(F.col("id").alias(FUNDS.id), F.col("d").alias(FUNDS.date), F.col("price").alias(FUNDS.price))
    found = export.backtest_sections(picks, prices, FUNDS, _market(past), EXPORTED)["backtest_periodos"]
    names = [("portfolio", "portfolio_base100"), ("IFIX", "ifix_base100"), ("IMOB", "imob_base100"), ("CDI", "cdi_base100")]
    return found.select("start", "holdings", *[r6(F.col(f"{n}_base100")).alias(alias) for n, alias in names])


@query("market_sections", f"""with {v.HISTORY_SQL},
  market as (select case cls when 'A' then 'IFIX' else 'IMOB' end as series, d as date,
    cast(sum(cast(round_even(volume * 100, 0) as bigint)) as double) / 100 as value from history group by all)
  select 'all' as since, series, date, round(value / first_value(value) over (partition by series order by date) * 100, 4) as value from market
  union all
  select 'day', m.series, m.date, round(m.value / b.base * 100, 4) from market m
    join (select series, value as base from market where date = date '{EXPORTED}') b on m.series = b.series and m.date >= date '{EXPORTED}'""")
def market_sections(spark, folder):
    """Market series of the document, which need no portfolio: from their own first value, and from a given day."""
    market = cut(_market(v.history(spark, folder)))
    whole = export.market_section(market).select(F.lit("all").alias("since"), "series", "date", "value")
    return whole.unionByName(export.market_section(market, EXPORTED).select(F.lit("day").alias("since"), "series", "date", "value"))


@query("nearest_both_ways", f"""with {v.HISTORY_SQL}
  select q.cls, q.id, q.d, l.d as last_date, round(l.price, 6) as last_price, n.d as next_date, round(n.price, 6) as next_price,
    s.d as since_date from history q
  asof left join history l on q.cls = l.cls and q.id = l.id and l.d <= q.d - 45
  asof left join history n on q.cls = n.cls and q.id = n.id and n.d >= q.d + 45
  asof left join history s on q.cls = s.cls and q.id = s.id and s.d >= q.d - 45""")
def nearest_both_ways(spark, folder):
    """Of every row, the neighbours 45 days before and after: three questions of both directions in one shuffle."""
    past = v.history(spark, folder)
    asked = past.select("cls", "id", "d", F.date_add("d", -45).alias("low"), F.date_add("d", 45).alias("high"))
    asks = {"last": ("low", False), "next": ("high", True), "since": ("low", True)}
    found = probes(asked, past, ["cls", "id"], asks, "d", "price")
    return found.select(
        "cls", "id", "d", "last_date", r6(F.col("last_value")).alias("last_price"), "next_date",
        r6(F.col("next_value")).alias("next_price"), "since_date",
    )


@query("sound_files", f"""with {v.HISTORY_SQL}
  select cls, count(*) as n, min(d) as first_day, round(max(volume), 2) as top, 1::bigint as left_out from history group by cls""")
def sound_files(spark, folder):
    """The history read from a folder that also holds a file which is no table: it is listed, the rest is read."""
    root, past = _folder(spark), v.history(spark, folder)
    past.write.parquet(f"{root}/t/sound")
    counted = spark.read.schema(past.schema).parquet(f"{root}/t/sound").groupBy("cls").count()  # a line for each class: one file
    counted.select(F.to_json(F.struct("cls", "count")).alias("text")).coalesce(1).write.text(f"{root}/t/broken")
    rows, bad = lake.read_sound(spark, f"{root}/t/*", past.schema)
    left_out = bad.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return rows.groupBy("cls").agg(
        F.count(F.lit(1)).alias("n"), F.min("d").alias("first_day"), F.round(F.max("volume"), 2).alias("top")
    ).withColumn("left_out", left_out)


@query("portfolio_snapshots", f"with {v.PORTFOLIO_SQL} select d, cls, count(distinct id) as n, min(cast(id as varchar)) as first_id from portfolio group by d, cls")
def portfolio_snapshots(spark, folder):
    found = history.holdings(portfolio(spark, folder), "d", "id", ["cls"])
    return found.select("d", "cls", F.col("holdings").alias("n"), F.element_at("tickers", 1).alias("first_id"))


# === models and their evaluation ========================================================================


def predictions(spark, folder, past=None):
    """Deterministic stand-ins for model outputs, in long form and scored."""
    lagged = features.features(v.history(spark, folder) if past is None else past, v.HISTORY, ["cls"])
    w = Window.partitionBy("cls", "id").orderBy("d")
    flow = F.try_divide(F.col("volume"), F.lag("volume").over(w)) - 1
    long = lagged.withColumn("flow", flow).select(
        F.col("d").alias("Data_Execucao"), F.col("cls").alias("Tipo"), F.col("id").alias("Ticker"),
        F.col("dy").alias(BASELINE), F.col("Retorno_Desde_Snapshot_Anterior").alias("Ridge"),
        F.col("flow").alias("Random Forest"),
    ).unpivot(["Data_Execucao", "Tipo", "Ticker"], [BASELINE, "Ridge", "Random Forest"], "Modelo", "predicted_return")
    return evaluate.scored(long, "predicted_return")


RANKED_SQL = f"{v.HISTORY_SQL}, {v.PREDICTED_SQL}"


@query("model_percentile", f"""with {RANKED_SQL}
  select d as "Data_Execucao", cls as "Tipo", id as "Ticker", model as "Modelo", round(score, 6) as score from ranked""")
def model_percentile(spark, folder):
    return predictions(spark, folder).select("Data_Execucao", "Tipo", "Ticker", "Modelo", r6(F.col("score")).alias("score"))


ENSEMBLE_SQL = f"""{RANKED_SQL},
  ens as (select d, cls, id, avg(score) filter (model <> 'Score Top') as score_ensemble,
    avg(predicted) filter (model <> 'Score Top') as retorno_esperado,
    coalesce(arg_max(model, score * 1000 + case when model = 'Ridge' then 1e-7 else 0 end) filter (model <> 'Score Top'), 'Score Top') as modelo_lider,
    max(score) filter (model = 'Score Top') as score_top
    from ranked group by all)"""


@query("ensemble", f"""with {ENSEMBLE_SQL}
  select d as "Data_Execucao", cls as "Tipo", id as "Ticker", round(score_ensemble, 6) as score_ensemble,
    round(retorno_esperado, 6) as retorno_esperado, modelo_lider from ens""")
def ensemble(spark, folder):
    out = evaluate.ensemble(predictions(spark, folder))
    return out.select(
        "Data_Execucao", "Tipo", "Ticker", r6(F.col("score_ensemble")).alias("score_ensemble"),
        r6(F.col("retorno_esperado")).alias("retorno_esperado"), "modelo_lider",
    )


@query("wide_predictions", f"""with {RANKED_SQL}
  select d as "Data_Execucao", cls as "Tipo", id as "Ticker", round(max(score) filter (model = 'Score Top'), 6) as score_top,
    round(max(score) filter (model = 'Ridge'), 6) as score_ridge,
    round(max(score) filter (model = 'Random Forest'), 6) as score_random_forest from ranked group by all""")
def wide_predictions(spark, folder):
    out = evaluate.wide(predictions(spark, folder))
    shown = ["score_top", "score_ridge", "score_random_forest"]
    return out.select("Data_Execucao", "Tipo", "Ticker", *[r6(F.col(c)).alias(c) for c in shown])


@query("leaderboard", f"""with {ENSEMBLE_SQL},
  latest as (select * from ens e where d = (select max(d) from ens x where x.cls = e.cls))
  select d as "Data_Execucao", cls as "Tipo", id as "Ticker", round(score_ensemble, 6) as score_ensemble,
    row_number() over (partition by cls order by round(score_ensemble, 6) desc nulls last, id) as rank_modelo
  from latest qualify rank_modelo <= 50""")
def leaderboard(spark, folder):
    scores = cut(predictions(spark, folder))
    top = scores.where(F.col("Modelo") == BASELINE).select(*evaluate.KEYS, F.col("score").alias("score_top"))
    rows = evaluate.ensemble(scores).join(top, list(evaluate.KEYS))
    rows = rows.withColumn("score_ensemble", r6(F.col("score_ensemble")))
    return evaluate.leaderboard(cut(rows)).select("Data_Execucao", "Tipo", "Ticker", "score_ensemble", "rank_modelo")


def realised(past):
    from crivo.operators.asof import forward_returns

    out = forward_returns(past.select("d", "cls", "id", "price"), ["cls", "id"], "d", "price", [30])
    return out.select(
        F.col("d").alias("Data_Execucao"), F.col("cls").alias("Tipo"), F.col("id").alias("Ticker"), "Retorno_Futuro_30d"
    )


def _pairs(spark, folder):
    past = cut(v.history(spark, folder))  # read by the predictions and the returns
    return evaluate.paired(predictions(spark, folder, past), realised(past), "Retorno_Futuro_30d")


WINDOW_KEYS_SQL = 'model as "Modelo", cls as "Tipo", d as "Data_Execucao"'


@query("eval_pairs", f"""with {v.EVALUATION_SQL} select {WINDOW_KEYS_SQL}, id as "Ticker", round(score, 6) as score, realised from pairs""")
def eval_pairs(spark, folder):
    return _pairs(spark, folder).select(*evaluate.GROUP, "Ticker", r6(F.col("score")).alias("score"), "realised")


@query("eval_windows", f"""with {v.EVALUATION_SQL} select {WINDOW_KEYS_SQL}, round(top_return, 6) as top_return,
  round(hit_rate, 6) as hit_rate, round(rank_ic, 6) as rank_ic from measures""")
def eval_windows(spark, folder):
    out = evaluate.window_measures(_pairs(spark, folder))
    return out.select(*evaluate.GROUP, *[r6(F.col(c)).alias(c) for c in ("top_return", "hit_rate", "rank_ic")])


PERF_SQL = """cls as "Tipo", model as "Modelo", '30d' as "Horizonte", windows as "Janelas_Validas",
  round(ret, 6) as "Retorno_Medio_Top20", round(hit, 6) as "Hit_Rate_Top20", round(ic, 6) as "Spearman_IC",
  round(alpha, 6) as "Alpha_vs_Score_Top" """


def performance(spark, folder, classes=()):
    past = cut(v.history(spark, folder))  # read by the predictions and the returns
    table = evaluate.evaluate(predictions(spark, folder, past), realised(past), "Retorno_Futuro_30d", "30d", classes)
    return table.select(*[r6(F.col(c)).alias(c) if c in evaluate.MEASURES else F.col(c) for c in table.columns])


@query("eval_table", f"""with {v.EVALUATION_SQL} select {PERF_SQL}, 'Ativo' as "Status" from perf""")
def eval_table(spark, folder):
    return performance(spark, folder)


@query("eval_warm_up", f"""with {v.EVALUATION_SQL} select {PERF_SQL}, 'Ativo' as "Status" from perf
  union all select 'C', m, '30d', 0, null, null, null, case when m = 'Score Top' then 0.0 end, 'Aquecendo'
  from (values ('Score Top'), ('Ridge'), ('Random Forest'), ('Extra Trees'), ('Boosted Trees, depth 4'), ('Boosted Trees, 31 leaves'), ('Boosted Trees, depth 5'), ('Ensemble')) t(m)""")
def eval_warm_up(spark, folder):
    return performance(spark, folder, ["A", "B", "C"])


def _scale_sql(value: str, low: float, high: float) -> str:
    return f"coalesce(least(1.0, greatest(0.0, ({value} - {low}) / ({high} - {low}))), 0.0)"


CONFIDENCE_SQL = f"""{v.EVALUATION_SQL},
  rounded as (select {PERF_SQL} from perf),
  conf as (select "Tipo", "Modelo", "Horizonte", "Janelas_Validas", 100 * (0.40 * least(1.0, "Janelas_Validas" / 5.0)
    + 0.25 * {_scale_sql('"Hit_Rate_Top20"', 0.5, 0.65)} + 0.25 * {_scale_sql('"Spearman_IC"', 0.0, 0.3)}
    + 0.10 * case when "Modelo" = 'Score Top' then 0.5 else {_scale_sql('"Alpha_vs_Score_Top"', 0.0, 0.03)} end) as pct from rounded)"""


def _confidence(spark, folder):
    return confidence.with_confidence(performance(spark, folder))


@query("confidence", f"""with {CONFIDENCE_SQL} select "Tipo", "Modelo", "Horizonte", round(pct, 2) as "Confiabilidade_Pct",
  case when pct <= 0 then 'Não mensurável' when pct < 40 then 'Baixa' when pct < 70 then 'Média' else 'Alta' end as "Nivel_Confiabilidade" from conf""")
def confidence_table(spark, folder):
    table = cut(performance(spark, folder))
    out = confidence.enriched(table, confidence.with_confidence(table))
    return out.select("Tipo", "Modelo", "Horizonte", "Confiabilidade_Pct", "Nivel_Confiabilidade")


@query("confidence_summary", f"""with {CONFIDENCE_SQL}, {v.SERIES_SQL}
  select 'Ativo' as status, round(max(pct), 2) as confiabilidade_preditiva_pct, max("Janelas_Validas") as janelas_validas_max,
    (select date_diff('day', min(date), max(date)) from series) as dias_historico,
    (select count(distinct date) from series) as qtd_snapshots, count(*) as modelos from conf""")
def confidence_summary(spark, folder):
    out = confidence.summary(cut(_confidence(spark, folder)), v.series(spark, folder))
    return out.select(
        "status", "confiabilidade_preditiva_pct", "janelas_validas_max", "dias_historico", "qtd_snapshots",
        F.size("por_modelo").cast("bigint").alias("modelos"),
    )


@query("confidence_leader", f"""with {CONFIDENCE_SQL},
  shown as (select *, round(pct, 2) as p, list_position(['Score Top', 'Ridge', 'Random Forest'], "Modelo") as place from conf),
  leader as (select * from shown where "Janelas_Validas" >= {confidence.MIN_WINDOWS} order by p desc, "Tipo", "Horizonte", place, "Modelo" limit 1)
  select "Tipo" as leader_class, "Modelo" as leader, p as leader_pct,
    case when p <= 0 then 'Não mensurável' when p < 40 then 'Baixa' when p < 70 then 'Média' else 'Alta' end as nivel_confiabilidade,
    'Confiabilidade calculada com base em ' || "Janelas_Validas" || ' janelas válidas. Modelo mais confiável no momento: ' || "Modelo"
      || ' (' || "Tipo" || ').' as mensagem,
    (select string_agg("Tipo" || '/' || "Modelo", ', ' order by "Tipo", p desc, "Modelo") from shown) as models from leader""")
def confidence_leader(spark, folder):
    out = confidence.summary(cut(_confidence(spark, folder)), v.series(spark, folder))
    leader = F.col("modelo_mais_confiavel")
    named = F.transform("por_modelo", lambda m: F.concat_ws("/", m["Tipo"], m["Modelo"]))
    return out.select(
        leader["Tipo"].alias("leader_class"), leader["Modelo"].alias("leader"), leader["Confiabilidade_Pct"].alias("leader_pct"),
        "nivel_confiabilidade", "mensagem", F.array_join(named, ", ").alias("models"),
    )


@query("maturity", f"""with {v.SERIES_SQL}
  select min(date) as primeiro_snapshot, max(date) as ultimo_snapshot, count(distinct date) as qtd_snapshots,
    date_diff('day', min(date), max(date)) as dias_historico,
    round(least(1.0, date_diff('day', min(date), max(date)) / 90.0) * 100, 2) as maturidade_dados_pct from series""")
def maturity(spark, folder):
    return confidence.maturity(v.series(spark, folder), horizon_days=90)


@query("performance_listing", f"""with {v.EVALUATION_SQL}
  select cls as "Tipo", model as "Modelo", row_number() over (partition by cls order by
    list_position(['Score Top', 'Ridge', 'Random Forest'], model)) as place from perf""")
def performance_listing(spark, folder):
    table = performance(spark, folder)
    within_class = Window.partitionBy("Tipo").orderBy(*evaluate.performance_order())
    return table.select("Tipo", "Modelo", F.row_number().over(within_class).alias("place"))


# --- trained models: suppliers of both classes ---------------------------------------------------------

RIDGE_FEATURES = ["dy", "Retorno_Desde_Snapshot_Anterior"]


def training_set(spark, folder):
    return cut(features.dataset(v.history(spark, folder), v.HISTORY, horizons=[30], by=["cls"]))


@query("ridge_predictions", f"""with {v.HISTORY_SQL},
  rows as (select q.d, q.id, q.dy as x1, q.price / lag(q.price) over (partition by q.id order by q.d) - 1 as x2, f.price / q.price - 1 as y
    from history q asof left join history f on q.cls = f.cls and q.id = f.id and f.d >= q.d + 30),
  past as (select * from rows where d < (select max(d) from rows) and y is not null),
  med as (select quantile_cont(x1, 0.5) as m1, quantile_cont(x2, 0.5) as m2 from past),
  filled as (select coalesce(x1, m1) as x1, coalesce(x2, m2) as x2, y from past cross join med),
  mom as (select avg(x1) as a1, stddev_pop(x1) as s1, avg(x2) as a2, stddev_pop(x2) as s2, avg(y) as ay from filled),
  z as (select (x1 - a1) / s1 as z1, (x2 - a2) / s2 as z2, y - ay as y from filled cross join mom),
  g as (select sum(z1 * z1) + 1 as g11, sum(z1 * z2) as g12, sum(z2 * z2) + 1 as g22, sum(z1 * y) as b1, sum(z2 * y) as b2 from z),
  w as (select (g22 * b1 - g12 * b2) / (g11 * g22 - g12 * g12) as w1, (g11 * b2 - g12 * b1) / (g11 * g22 - g12 * g12) as w2 from g)
  select d as date, cast(id as varchar) as id,
    round(ay + w1 * (coalesce(x1, m1) - a1) / s1 + w2 * (coalesce(x2, m2) - a2) / s2, 6) as predicted_return
  from rows cross join med cross join mom cross join w where d = (select max(d) from rows)""")
def ridge_predictions(spark, folder):
    found, _ = models.training(training_set(spark, folder), v.HISTORY, "Retorno_Futuro_30d", RIDGE_FEATURES)
    out = models.ridge(found)
    return out.select("date", "id", r6(F.col("predicted_return")).alias("predicted_return"))


@query("ml_shadow", f"""with {v.HISTORY_SQL}
  select d as "Data_Execucao", 'SUP' as "Tipo", cast(id as varchar) as "Ticker", round(price, 6) as preco_atual,
    'Ativo' as status_modelos, 6 as models, true as in_bounds, true as means_agree
  from history where d = (select max(d) from history)""")
def ml_shadow(spark, folder):
    """All models with the settings of the operator. Of what they predict: how many did, whether every score is a percentile
    of its model, and whether the ensemble is the mean of its parts."""
    out = models.shadow_run(training_set(spark, folder), v.HISTORY, 30, models.factories())
    return _agreement(out)


def _agreement(out):
    trained = [c for c in models.TRAINED if c in out.columns]
    returns = [F.col(f"retorno_previsto_{c}_30d") for c in trained]
    there = [F.when(F.col(c).isNotNull() & r.isNotNull(), 1).otherwise(0) for c, r in zip(trained, returns)]
    mean = sum(returns) / len(returns)
    score = sum(F.col(c) for c in trained) / len(trained)
    bounds = [(F.col(c) > 0) & (F.col(c) <= 100) for c in trained]
    agree = (F.abs(F.col("retorno_esperado_30d") - mean) < 1e-9) & (F.abs(F.col("score_ensemble") - score) < 1e-9)
    in_bounds = bounds[0]
    for b in bounds[1:]:
        in_bounds = in_bounds & b
    return out.select(
        "Data_Execucao", "Tipo", "Ticker", r6(F.col("preco_atual")).alias("preco_atual"), "status_modelos",
        sum(there).alias("models"), in_bounds.alias("in_bounds"), agree.alias("means_agree"),
    )


UNIFORM_SQL = "('0x' || substr(md5('42-' || tree || '-0-' || feature), 1, 8))::bigint / 4294967296.0::double"


@query("extra_trees_splits", f"""with {v.HISTORY_SQL},
  rows as (select q.d, q.dy as x1, q.volume as x2, f.price / q.price - 1 as y
    from history q asof left join history f on q.cls = f.cls and q.id = f.id and f.d >= q.d + 30),
  train as (select * from rows where d < (select max(d) from rows) and y is not null),
  long as (select 0 as feature, x1 as x, y from train union all select 1, x2, y from train),
  ranges as (select feature, min(x) as low, max(x) as high from long group by feature),
  drawn as (select tree, feature, low + {UNIFORM_SQL} * (high - low) as threshold from ranges cross join range(250) t(tree))
  select d.tree, d.feature, round(threshold, 6) as threshold, count(*) as rows_below, round(sum(y), 6) as total_below
  from drawn d join long l on l.feature = d.feature and l.x <= d.threshold group by all""")
def extra_trees_splits(spark, folder):
    """The thresholds that 250 trees draw at their roots, with what lies below them."""
    ship(spark)
    found, _ = models.training(training_set(spark, folder), v.HISTORY, "Retorno_Futuro_30d", ["dy", "volume"])
    level = trees.first_level(models.TREES)
    trees.with_thresholds(found.train, level, found.inputs, models.SEED)
    drawn = [(t, f, float(level.threshold[t, 0, f])) for t in range(models.TREES) for f in range(len(found.inputs))]
    sums = trees.split_sums(found.train, level, found.inputs)
    return spark.createDataFrame(drawn, "tree bigint, feature bigint, threshold double").join(sums, ["tree", "feature"]).select(
        "tree", "feature", r6(F.col("threshold")).alias("threshold"), F.col("rows").cast("bigint").alias("rows_below"),
        r6(F.col("total")).alias("total_below"),
    )


@query("extra_trees")
def extra_trees(spark, folder):
    """Predictions of 250 randomly split trees of depth 7."""
    found, _ = models.training(training_set(spark, folder), v.HISTORY, "Retorno_Futuro_30d")
    return models.random_splits(found)


# --- published days and what is derived from them --------------------------------------------------------

CHANGED, THINNED = "date '1995-06-01'", "date '1996-03-01'"


def _altered(history: DataFrame) -> DataFrame:
    """A later state of the history: one day revised, one day without a third of its rows."""
    price = F.when(F.expr(f"d = {CHANGED}"), F.col("price") * 2).otherwise(F.col("price"))
    return history.withColumn("price", price).where(F.expr(f"d <> {THINNED} or id % 3 <> 0"))


def _lake(spark, history: DataFrame, root: str) -> list:
    days = sorted(r.d for r in history.select("d").distinct().collect())
    published.publish(spark, root, {"sup_universe": history}, "d", days)
    return days


def _folder(spark) -> str:
    return f"{checkpoint_folder(spark)}/lake-{uuid.uuid4().hex}"


@query("incremental_rebuild", f"""with {v.HISTORY_SQL},
  later as (select d, cls, id, dy, volume, case when d = {CHANGED} then price * 2 else price end as price from history
    where d <> {THINNED} or id % 3 <> 0)
  select q.d, cast(q.id as varchar) as id, round(q.price, 6) as price, q.cls, round(q.dy, 6) as dy,
    round(q.price / lag(q.price) over (partition by q.id order by q.d) - 1, 6) as last_return,
    round(f.price / q.price - 1, 6) as return_30, round(g.price / q.price - 1, 6) as return_90
  from later q asof left join later f on q.id = f.id and f.d >= q.d + 30
    asof left join later g on q.id = g.id and g.d >= q.d + 90""")
def incremental_rebuild(spark, folder):
    """The training set of a lake after two of its days were replaced: built in full, then only where the change reaches."""
    root, past = _folder(spark), cut(v.history(spark, folder))
    _lake(spark, past, root)
    incremental.refresh_class(spark, root, v.HISTORY, (30, 90))
    days = [r.d for r in past.select("d").distinct().where(f"d in ({CHANGED}, {THINNED})").collect()]
    published.publish(spark, root, {"sup_universe": _altered(past)}, "d", days)
    incremental.refresh_class(spark, root, v.HISTORY, (30, 90))
    out = incremental.derived_table(spark, root, v.HISTORY, incremental.DATASET)
    return out.select(
        "d", "id", r6(F.col("price")).alias("price"), "cls", r6(F.col("dy")).alias("dy"),
        r6(F.col("Retorno_Desde_Snapshot_Anterior")).alias("last_return"),
        *[r6(F.col(f"Retorno_Futuro_{h}d")).alias(f"return_{h}") for h in (30, 90)],
    )


@query("published_days", f"""with {v.HISTORY_SQL}
  select d as date, case when d = {CHANGED} then 2 else 1 end as version,
    count(*) filter (d <> {THINNED} or id % 3 <> 0) as rows, 5 as columns from history group by d""")
def published_days(spark, folder):
    """Manifest of a lake in which one day was replaced; a run that broke off before it published is not seen."""
    root, past = _folder(spark), cut(v.history(spark, folder))
    _lake(spark, _altered(past), root)
    day = [r.d for r in past.select("d").distinct().where(f"d = {CHANGED}").collect()]
    published.publish(spark, root, {"sup_universe": past}, "d", day)
    past.where("id % 2 = 0").withColumn("snapshot_date", F.col("d")).drop("d").write.partitionBy("snapshot_date").parquet(
        f"{root}/sup_universe/run=broken"
    )
    rows = published.current(spark, root)
    return rows.select("date", "version", "rows", F.size("columns").alias("columns"))


@query("columns_that_drift", f"""with {v.HISTORY_SQL}
  select d, id, price, case when d >= {CHANGED} then volume end as volume,
    case when d < {CHANGED} then cast(cast(round_even(dy * 1000, 0) as bigint) as double) else dy end as dy from history""")
def columns_that_drift(spark, folder):
    """Days stored with and without a column, and with a number in two types."""
    root, past = _folder(spark), cut(v.history(spark, folder))
    days = sorted(r.d for r in past.select("d").distinct().collect())
    old = past.drop("volume").withColumn("dy", F.rint(F.col("dy") * 1000).cast("bigint"))
    edge = datetime.date(1995, 6, 1)
    published.publish(spark, root, {"t": old}, "d", [d for d in days if d < edge])
    published.publish(spark, root, {"t": past}, "d", [d for d in days if d >= edge])
    return published.read(spark, root, "t", None, "d").select("d", "id", "price", "volume", "dy")


@query("lake_verification", f"""with {v.HISTORY_SQL}
  select d as date, case when d = {CHANGED} then 'altered' when d = {THINNED} then 'missing' else 'ok' end as status,
    count(*) as rows, case when d <> {THINNED} then count(*) + (d = {CHANGED})::int * count(*) end as found_rows from history group by d
  union all select date '2031-01-01', 'extra', null, null""")
def lake_verification(spark, folder):
    """A lake in which one day's rows were doubled, one day's folder is gone, and one folder was never published."""
    root, past = _folder(spark), cut(v.history(spark, folder))
    _lake(spark, past, root)
    run = published.current(spark, root).first().run
    day = past.where(f"d = {CHANGED}").drop("d")
    place = f"{root}/sup_universe/run={run}/snapshot_date="
    day.write.mode("append").parquet(f"{place}1995-06-01")
    day.write.parquet(f"{place}2031-01-01")
    gone = spark._jvm.org.apache.hadoop.fs.Path(f"{place}1996-03-01")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return published.verify(spark, root, ["sup_universe"]).select("date", "status", "rows", "found_rows")


# === reports ============================================================================================


@query("kpis", f"""with {SCREENED_SQL.replace("universe as (", "universe as (", 1)}
  select {', '.join(f"round(avg({c}) filter (id in (select id from top)), 6) as {c}_carteira, round(avg({c}), 6) as {c}_mercado, round(avg({c}), 6) as {c}_geral" for c in ("dy", "multiple"))},
    count(*) as total_universo, count(*) filter (id in (select id from top)) as total_carteira from universe""")
def kpis(spark, folder):
    audited = _screened(spark, folder)[1]
    out = report.kpis(audited, F.col("status").startswith(screen.RANK_PREFIX), ["dy", "multiple"])
    return out.select(*[F.col(c) if c.startswith("total") else r6(F.col(c)).alias(c) for c in out.columns])


@query("recurrence", f"""with {v.PORTFOLIO_SQL}
  select cls as "Tipo", cast(id as varchar) as "Ticker", count(*) as aparicoes, round(avg(score), 6) as score_medio,
    min(pos) as melhor_posicao, max(d) as ultima_aparicao from portfolio group by cls, id""")
def recurrence(spark, folder):
    out = report.recurrence(_portfolio_named(spark, folder))
    return out.withColumn("score_medio", r6(F.col("score_medio")))


def _portfolio_named(spark, folder):
    return portfolio(spark, folder).select(
        F.col("d").alias("Data_Carteira"), F.col("cls").alias("Tipo"), F.col("id").cast("string").alias("Ticker"),
        F.col("score").alias("Score"), F.col("pos").alias("Posicao"),
    )


@query("recurrence_top", f"""with {v.PORTFOLIO_SQL}, counted as (select cls, cast(id as varchar) as id, count(*) as n,
    cast(sum(cast(round_even(score * 10, 0) as bigint)) as double) / count(*) as s, min(pos) as p from portfolio group by all)
  select cls as "Tipo", id as "Ticker", n as aparicoes, row_number() over (partition by cls order by n desc, s desc, p, id) as ordem
  from counted qualify ordem <= 10""")
def recurrence_top(spark, folder):
    """Scores are counted in tenths, so that their mean is the same in any order of summing."""
    tenths = _portfolio_named(spark, folder).withColumn("Score", F.rint(F.col("Score") * 10).cast("bigint"))
    return report.recurrence(tenths, top=10).select("Tipo", "Ticker", "aparicoes", "ordem")


@query("recurrence_current", f"""with {v.PORTFOLIO_SQL}, counted as (select cls, id, count(*) as n from portfolio group by all),
  now as (select * from history h qualify row_number() over (partition by cls, id order by d desc) = 1)
  select c.cls as "Tipo", cast(c.id as varchar) as "Ticker", n as aparicoes, price as preco_atual, dy as dy_atual,
    cast(null as double) as setor from counted c left join now on c.cls = now.cls and c.id = now.id""")
def recurrence_current(spark, folder):
    current = order.keep_last(v.history(spark, folder), ["cls", "id"], "d").select(
        F.col("cls").alias("Tipo"), F.col("id").cast("string").alias("Ticker"), "price", "dy"
    )
    fields = {"preco_atual": "price", "dy_atual": "dy", "setor": "absent"}
    out = report.with_current(report.recurrence(_portfolio_named(spark, folder)), current, ["Tipo", "Ticker"], fields)
    return out.select("Tipo", "Ticker", "aparicoes", "preco_atual", "dy_atual", "setor")


def _trend_sql(column: str) -> str:
    change = f"(a.{column} - b.{column}) / abs(b.{column}) * 100"
    return (
        f"case when {change} > 2 then 'subindo' when {change} < -2 then 'caindo' "
        f"when {change} is not null then 'estavel' else 'neutro' end as {column}_tendencia"
    )


@query("trends", f"""with {v.HISTORY_SQL},
  today as (select * from history where d = (select max(d) from history)),
  before as (select * from history where d = (select max(d) from history where d < (select max(d) from today)))
  select a.cls, a.id, {_trend_sql('dy')}, {_trend_sql('price')} from today a left join before b on a.cls = b.cls and a.id = b.id""")
def trends(spark, folder):
    past = v.history(spark, folder)
    today = history.latest(past, "d")
    newest = past.agg(F.max("d").alias("newest"))
    before = history.before_day(past, "d", newest.select("newest").scalar())
    return report.trends(today, before, "id", ["dy", "price", "absent"], ["cls"], from_zero=True).select(
        "cls", "id", "dy_tendencia", "price_tendencia"
    )


def _histogram_sql(column: str, bins) -> str:
    edges, labels = bins
    parts = []
    for i, label in enumerate(labels):
        low = f"{column} >= {edges[i]}" if i == 0 else f"{column} > {edges[i]}::double"
        parts.append(
            f"select '{label}' as faixa, count(*) filter ({low} and {column} <= {edges[i + 1]}::double) as quantidade from universe"
        )
    return " union all ".join(parts)


@query("histogram", f"with {v.UNIVERSE_SQL} {_histogram_sql('dy', report.DY_BINS)}")
def histogram(spark, folder):
    return report.histogram(v.universe(spark, folder), "dy", *report.DY_BINS)


@query("histogram_multiple", f"with {v.UNIVERSE_SQL} {_histogram_sql('multiple', report.MULTIPLE_BINS)}")
def histogram_multiple(spark, folder):
    return report.histogram(v.universe(spark, folder), "multiple", *report.MULTIPLE_BINS)


BOARD = v.AssetSpec(kind="PART", id="id", price="price", score="score", name="sector", dy="dy", multiple="multiple")


@query("baseline_board", f"""with {SCORED_SQL}
  select 'PART' as "Tipo", cast(id as varchar) as "Ticker", sector as "Nome", price as preco_atual, dy as dy_atual, score as score_top,
    'Score Top' as modelo_lider, row_number() over (order by score desc, cast(id as varchar)) as rank_modelo from scored qualify rank_modelo <= 50""")
def baseline_board(spark, folder):
    board = report.baseline_board(scored_universe(spark, folder), BOARD, F.lit("2024-01-01"))
    return board.select("Tipo", "Ticker", "Nome", "preco_atual", "dy_atual", "score_top", "modelo_lider", "rank_modelo")


@query("section_state", "select case when count(*) > 0 then 'Baseline' else 'Aquecendo' end as status from part")
def section_state(spark, folder):
    board = report.baseline_board(v.universe(spark, folder), BOARD, F.lit("2024-01-01"))
    return report.section_state(board, F.lit(True))


@query("section_states", f"""select p_size, p_brand,
    case when count(*) filter (p_partkey % 50 = 0) > 0 then '{report.STATES[0]}' when count(*) filter (p_partkey % 7 = 0) > 0 then '{report.STATES[1]}'
      else '{report.STATES[2]}' end as status from part group by all""")
def section_states(spark, folder):
    """State per group of leaderboard rows, of which some are active, some a baseline, and most without a known state."""
    key = F.col("p_partkey")
    state = F.when(key % 50 == 0, "ATIVO").when(key % 7 == 0, "Baseline").when(key % 3 == 0, "?")
    boards = v.table(spark, folder, "part").select("p_size", "p_brand", state.alias("status_modelos"))
    return report.section_state(boards, F.lit(False), ["p_size", "p_brand"])


@query("summary_block", f"""with {SCREENED_SQL}
  select count(*) as total, round_even(avg(dy) * 10000, 0) / 10000 as dy_medio, round_even(avg(multiple) * 10000, 0) / 10000 as multiplo_medio from top""")
def summary_block(spark, folder):
    return report.summary_block(_screened(spark, folder)[0], BOARD)


@query("dataset_profile", f"""with {v.HISTORY_SQL}, {v.FORWARD_SQL}
  select count(*) as rows, min(d) as first_date, max(d) as last_date, count(distinct d) as dates,
    count(p30 / price - 1) as "Retorno_Futuro_30d_valid" from forward""")
def dataset_profile(spark, folder):
    from crivo.operators.asof import forward_returns

    out = forward_returns(v.history(spark, folder), ["cls", "id"], "d", "price", [30])
    return report.profile(out, "d", ["Retorno_Futuro_30d", "absent"])


@query("state_counts", f"""with {JUDGED_SQL}
  select count(*) as rows, count(*) filter (failed is null) as passed from judged""")
def state_counts(spark, folder):
    marked = screen.judged(v.universe(spark, folder), v.UNIVERSE_FIXED, v.UNIVERSE_QUARTILES, [])
    stated = marked.withColumn("d", F.lit("2024-01-01").cast("date")).withColumn(
        "state", F.when(F.col("_fixed").isNull(), "passed").otherwise("failed")
    )
    out = report.profile(stated, "d", [], "state")
    return out.select("rows", F.col("by_state")["passed"].alias("passed"))


# === quality ============================================================================================


@query("duplicate_keys", "select count(*) - (select count(*) from (select distinct l_partkey, l_suppkey from lineitem)) as duplicates from lineitem")
def duplicate_keys(spark, folder):
    return quality.duplicate_count(v.table(spark, folder, "lineitem"), ["l_partkey", "l_suppkey"])


@query("list_sizes", f"""with {v.HISTORY_SQL}
  select d as "Data_Carteira", cls as "Tipo", count(*) as size from history group by d, cls having count(*) not between 15 and 25""")
def list_sizes(spark, folder):
    """Each month's suppliers as a list."""
    return quality.list_sizes(v.history(spark, folder).withColumnsRenamed({"d": "Data_Carteira", "cls": "Tipo"}))


def _checks(spark, folder):
    from crivo.sources import lake

    past = v.history(spark, folder)
    lists = portfolio(spark, folder).withColumnsRenamed({"d": "Data_Carteira", "cls": "Tipo", "id": "Ticker"})
    dates = history.dates_of(past, "d")
    listed = lake.manifest_of(past, "d", "history")
    exported = v.series(spark, folder)
    return quality.report(
        quality.snapshots_exist(dates),
        quality.manifest_agrees(dates, listed),
        quality.tables_present(listed, ["history", "portfolio"]),
        quality.not_empty(past, "history"),
        quality.unique(past, "history", ["d", "cls", "id"]),
        quality.unique(past, "history", ["d", "cls", "absent"]),
        quality.list_size_check(lists),
        quality.fresh(exported, dates),
    )


@query("quality_report", f"""with {v.PORTFOLIO_SQL}, {v.SERIES_SQL},
  odd as (select d, cls from portfolio group by d, cls having count(*) not between 15 and 25)
  select 'lake_snapshots' as name, 'ok' as status, (select count(distinct d) from history) || ' snapshots encontrados' as detail
  union all select 'lake_manifest', 'ok', 'latest=' || (select max(d) from history)
  union all select * from (select 'snapshot_' || d || '_files', 'error', 'faltando: portfolio' from (select distinct d from history order by d desc limit 5))
  union all select 'history', 'ok', (select count(*) from history) || ' linhas'
  union all select 'duplicatas_history', 'ok', '0 duplicatas em [''d'', ''cls'', ''id'']'
  union all select 'colunas_history', 'error', 'faltam colunas: [''absent'']'
  union all select 'carteira_tamanho_top', case when count(*) = 0 then 'ok' else 'warn' end,
    case when count(*) = 0 then 'tamanhos dentro do esperado' else count(*) || ' listas fora do esperado' end from odd
  union all select 'dashboard_latest_vs_lake', case when (select max(date) from series) >= (select max(d) from history) then 'ok' else 'warn' end,
    'dashboard_latest=' || (select max(date) from series) || ', lake_latest=' || (select max(d) from history)""")
def quality_report(spark, folder):
    return _checks(spark, folder)


@query("quality_overall", "select 'error' as status")
def quality_overall(spark, folder):
    return quality.overall(_checks(spark, folder))


@query("section_index", f"""with {v.SERIES_SQL},
  placed as (select *, row_number() over (order by series, date) - 1 as place from series)
  select place // 100 as block, min(place) as first, count(*) as rows, arg_min(series, place) as series, arg_min(date, place) as date
  from placed group by all""")
def section_index(spark, folder):
    """Where the blocks of an ordered section begin that is as long as its series."""
    path = _folder(spark)
    lines.write_lines(v.series(spark, folder), ["series", "date"], path, block=100)
    key = F.from_json("key", "struct<series: string, date: date>")
    return lines.read_index(spark, path).select("block", "first", "rows", key["series"].alias("series"), key["date"].alias("date"))


@query("section_lines", f"""with {v.SERIES_SQL},
  placed as (select *, row_number() over (order by series, date) - 1 as place from series)
  select place // 100 as block, series, date, round(value, 6) as value from placed""")
def section_lines(spark, folder):
    """The lines of an ordered section, read back."""
    path = _folder(spark)
    lines.write_lines(v.series(spark, folder), ["series", "date"], path, block=100)
    record = F.from_json("value", "struct<series: string, date: date, value: double>")
    return lines.read_lines(spark, path).select("block", record.alias("r")).select("block", "r.series", "r.date", r6(F.col("r.value")).alias("value"))


@query("quality_by_day", f"""with {v.HISTORY_SQL},
  sized as (select d, count(*) as n, count(*) filter (dy < 0.04) as low, min(price) as least from history group by d)
  select d, case when least < 900 then 'error' when low > n / 4 then 'warn' else 'ok' end as status from sized""")
def quality_by_day(spark, folder):
    """Checks of every day of the history, folded to the worst of each day."""
    days = v.history(spark, folder).groupBy("d").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("dy") < 0.04).alias("low"), F.min("price").alias("least")
    )
    rules = [("preço", F.col("least") < 900, quality.ERROR), ("dy", F.col("low") > F.col("n") / 4, quality.WARN)]
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.when(bad, s).otherwise(quality.OK).alias("status")) for n, bad, s in rules])
    return quality.overall(days.select("d", F.explode(rows).alias("c")).select("d", "c.*"), ["d"])


# === landed sources =====================================================================================


@query("landed_series", f"with {v.SERIES_SQL} select series, date, round(value, 6) as value from series where extract(day from date) <> 5")
def landed_series(spark, folder):
    day = F.col("date")
    record = F.struct(
        F.date_format(day, "dd/MM/yyyy").alias("data"),
        F.when(F.dayofmonth(day) == 5, "n/d").otherwise(F.round("value", 6).cast("string")).alias("valor"),
    )
    documents = v.series(spark, folder).groupBy("series").agg(F.to_json(F.collect_list(record)).alias("text"))
    return landed.rate_series(documents, "text", ["series"])


@query("landed_closes", f"with {v.SERIES_SQL} select series, date, round(value, 6) as value from series where extract(day from date) <> 5")
def landed_closes(spark, folder):
    raw = v.series(spark, folder).select(
        "series", F.col("date").cast("string").alias("Date"),
        F.when(F.dayofmonth("date") == 5, "").otherwise(F.round("value", 6).cast("string")).alias("Close"),
    )
    return landed.close_series(raw, "Date", "Close", ["series"])


@query("fx_quotes", f"""with {v.SERIES_SQL}
  select date, upper(series) || '/BRL' as pair, round(value, 6) as value, round(value * 2, 6) as pct_change, '' as updated_at
  from series where series <> 'click'""")
def fx_quotes(spark, folder):
    entry = F.struct(
        F.upper("series").alias("code"), F.lit("BRL").alias("codein"),
        F.when(F.col("series") == "click", "?").otherwise(F.round("value", 6).cast("string")).alias("bid"),
        F.round(F.col("value") * 2, 6).cast("string").alias("pctChange"),
    )
    documents = v.series(spark, folder).groupBy("date").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("series", entry)))).alias("text")
    )
    return landed.quotes(documents, "text", ["date"])


@query("payload_explode", f"""with {v.PORTFOLIO_SQL}
  select d, cls, cast(id as varchar) as id, round(price, 6) as price, score from portfolio
  union all select d, 'large', cast(id as varchar), round(price, 6) * 10000000, score from portfolio""")
def payload_explode(spark, folder):
    """Daily payloads of the lists of both classes (at most 20 records each) as funds, once more as stocks whose prices are too
    large for a double to be written without an exponent, read back as history rows."""

    def record(price):
        return F.struct(
            F.lit("").alias("Ativo"), F.concat("cls", F.lit("-"), F.col("id").cast("string")).alias("Ticker"),
            price.alias("preco_atual"), F.col("score").alias("Score"),
        )

    small = F.round("price", 6)
    documents = portfolio(spark, folder).groupBy("d").agg(
        F.collect_list(record(small)).alias("fiis"), F.collect_list(record(small * 10000000)).alias("acoes")
    ).select(F.to_json(F.struct(F.col("d").cast("string").alias("data"), "fiis", "acoes")).alias("text"))
    funds = landed.payload_rows(documents, "text", "fiis", v.HISTORY, landed.FUND_NAMES)
    stocks = landed.payload_rows(documents, "text", "acoes", v.HISTORY, landed.STOCK_NAMES)
    ticker = F.split("id", "-")
    both = funds.withColumn("cls", ticker[0]).unionByName(stocks.withColumn("cls", F.lit("large")))
    return both.select("d", "cls", ticker[1].alias("id"), "price", "score")


def _documents(spark, folder):
    """One document a day with the records of both classes' lists. Keys differ from record to record, numbers are written in
    several ways, and every seventh document doesn't say its date."""
    id_text = F.col("id").cast("string")
    record = F.map_filter(
        F.create_map(
            F.lit("Ticker"), F.concat("cls", F.lit("-"), id_text),
            F.lit("preco_atual"), F.round("price", 6).cast("decimal(20,6)").cast("string"),
            F.lit("Score"), F.col("score").cast("string"),
            F.when(F.col("pos") % 2 == 0, "Margem").otherwise("margem"), F.concat(F.col("pos").cast("string"), F.lit(",5%")),
            F.lit("Faixa"), F.when(F.col("pos") % 5 == 0, F.col("pos").cast("string")).otherwise(F.translate(F.col("pos").cast("string"), "0123456789", "abcdefghij")),
            F.lit("Lugar"), F.when(F.col("pos") % 10 == 0, "?").otherwise(F.col("pos").cast("string")),
        ),
        lambda k, x: x.isNotNull(),
    )
    day = F.col("d").cast("string")
    said = F.when(F.dayofyear("d") % 7 != 0, day)
    listed = portfolio(spark, folder).groupBy("d").agg(F.collect_list(record).alias("fiis"))
    return listed.select(day.alias("day"), F.to_json(F.struct(said.alias("data"), "fiis")).alias("text"))


@query("refresh_from_documents", f"""with {v.PORTFOLIO_SQL},
  documents as (select d, to_json({{'data': case when dayofyear(d) % 7 <> 0 then d::varchar end, 'fiis': list({{'Ticker': cls || '-' || id,
      'preco_atual': round(price, 6)::decimal(20,6)::varchar, 'Score': score::varchar, 'margem': pos || '.5', 'Faixa':
      case when pos % 5 = 0 then pos::varchar else translate(pos::varchar, '0123456789', 'abcdefghij') end, 'Lugar': case when pos % 10 = 0 then '?' else pos::varchar end}})}}) as doc
    from portfolio group by d),
  records as (select coalesce(doc ->> '$.data', d::varchar)::date as d, unnest(from_json(doc -> '$.fiis', '["json"]')) as r from documents),
  past as (select d, r ->> '$.Ticker' as id, (r ->> '$.preco_atual')::double as price, (r ->> '$.Score')::double as score,
    (r ->> '$.margem')::double as margem, r ->> '$.Faixa' as faixa, try_cast(r ->> '$.Lugar' as double) as lugar from records)
  select q.d, q.id, round(q.price, 6) as price, q.score, q.margem, q.faixa, q.lugar,
    round(q.price / lag(q.price) over (partition by q.id order by q.d) - 1, 6) as last_return, round(f.price / q.price - 1, 6) as return_30
  from past q asof left join past f on q.id = f.id and f.d >= q.d + 30""")
def refresh_from_documents(spark, folder):
    data = refresh.refresh_from_documents(_documents(spark, folder), "text", "fiis", v.HISTORY, landed.FUND_NAMES, (30,), "day")
    return data.select(
        "d", "id", r6(F.col("price")).alias("price"), "score", F.col("Margem").alias("margem"), F.col("Faixa").alias("faixa"),
        F.col("Lugar").alias("lugar"), r6(F.col("Retorno_Desde_Snapshot_Anterior")).alias("last_return"), r6(F.col("Retorno_Futuro_30d")).alias("return_30"),
    )


@query("portfolio_listing", f"""with {v.PORTFOLIO_SQL}
  select row_number() over (order by d nulls last, cls nulls last, pos nulls last, cast(id as varchar) nulls last) - 1 as place,
    d as "Data_Carteira", cls as "Tipo", pos as "Posicao", cast(id as varchar) as "Ticker" from portfolio""")
def portfolio_listing(spark, folder):
    """The whole portfolio history in its order, numbered without a window over all of it."""
    rows = portfolio(spark, folder).select(
        F.col("d").alias("Data_Carteira"), F.col("cls").alias("Tipo"), F.col("pos").alias("Posicao"), F.col("id").cast("string").alias("Ticker")
    )
    return history.portfolio_listing(rows, "place")


@query("conform_schema", f"""with {v.BR_TEXT_SQL}
  select c_custkey as id, case when c_custkey % 13 <> 0 then {BALANCE} end as price, cast(null as bigint) as absent,
    cast(c_custkey as varchar) as code from cents""")
def conform_schema(spark, folder):
    from crivo.sources import lake

    raw = v.br_text(spark, folder).select("id", "price", F.col("id").alias("code"), "mixed")
    return lake.conform(raw, "id bigint, price double, absent bigint, code string")


@query("event_props", """select event_id, cast(json_extract(props, '$.k') as bigint) as k from events""")
def event_props(spark, folder):
    return landed.typed_fields(v.table(spark, folder, "events"), "props", "k bigint", ["event_id"])


__all__ = ["ORACLES", "QUERIES"]
