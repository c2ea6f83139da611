"""Input views over the shared tables, in Spark and as SQL text with the same definition.

Sums are taken over whole hundredths: they are exact, so both engines and every re-run get the same bits and ranks
never depend on the order in which rows were added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.spec import AssetSpec, Factor, QuartileRule, Rule



def cents(name: str) -> Column:
    """Hundredths as a whole number."""
    return F.rint(F.col(name) * 100).cast("bigint")


def cents_sql(name: str) -> str:
    return f"cast(round_even({name} * 100, 0) as bigint)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- universe: one row per part ------------------------------------------------------------------------

UNIVERSE_FACTORS = [
    Factor("dy", 0.30, "max"),
    Factor("multiple", 0.25, "min"),
    Factor("liquidity", 0.20, "max"),
    Factor("equity", 0.15, "max"),
    Factor("vol", 0.10, "min"),
]
UNIVERSE_FIXED = [
    Rule("multiple missing or negative", "multiple > 0"),
    Rule("vol missing", "vol is not null"),
    Rule("DY <= 4.50%", "dy > 0.045D"),
    Rule("liquidity <= 1,200,000", "liquidity > 1200000D"),
    Rule("equity <= 600", "equity > 600D"),
]
UNIVERSE_QUARTILES = [
    QuartileRule("multiple", 0.25, "low", "multiple > Q25 ({})"),
    QuartileRule("dy", 0.75, "high", "DY < Q75 ({}%)", scale=100),
    QuartileRule("liquidity", 0.75, "high", "liquidity < Q75 ({})", "#,##0"),
    QuartileRule("equity", 0.75, "high", "equity < Q75 ({})", "#,##0"),
    QuartileRule("vol", 0.75, "low", "vol > Q75 ({})"),
]
UNIVERSE_ORDER = [("dy", "desc"), ("multiple", "asc"), ("liquidity", "desc")]


def universe(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    totals = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.sum(cents("l_discount")) / 100).alias("disc"),
            (F.sum(cents("l_extendedprice")) / 100).alias("ext"),
            F.sum(quantity).cast("double").alias("qty"),
            F.sum(quantity * quantity).cast("double").alias("qty2"),
        )
    )
    joined = table(spark, folder, "part").join(totals, F.col("p_partkey") == F.col("l_partkey"), "left")
    return joined.select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("company"),
        F.col("p_type").alias("sector"),
        F.col("p_retailprice").alias("price"),
        F.when(F.col("p_partkey") % 17 != 0, F.col("disc") / F.col("n")).alias("dy"),
        F.when(F.col("p_partkey") % 19 != 0, F.col("p_retailprice") / (F.col("ext") / F.col("qty"))).alias(
            "multiple"
        ),
        F.col("ext").alias("liquidity"),
        F.col("qty").alias("equity"),
        F.when(
            F.col("n") > 1,
            F.sqrt((F.col("qty2") - F.col("qty") * F.col("qty") / F.col("n")) / (F.col("n") - 1)),
        ).alias("vol"),
    )


UNIVERSE_SQL = f"""
part_totals as (
  select l_partkey, count(*) as n,
         cast(sum({cents_sql("l_discount")}) as double) / 100 as disc,
         cast(sum({cents_sql("l_extendedprice")}) as double) / 100 as ext,
         cast(sum(cast(l_quantity as bigint)) as double) as qty,
         cast(sum(cast(l_quantity as bigint) * cast(l_quantity as bigint)) as double) as qty2
  from lineitem group by l_partkey),
universe as (
  select p_partkey as id, p_brand as company, p_type as sector, p_retailprice as price,
         case when p_partkey % 17 <> 0 then disc / n end as dy,
         case when p_partkey % 19 <> 0 then p_retailprice / (ext / qty) end as multiple,
         ext as liquidity, qty as equity,
         case when n > 1 then sqrt((qty2 - qty * qty / n) / (n - 1)) end as vol
  from part left join part_totals on p_partkey = l_partkey)"""

# --- history: one row per supplier and month -----------------------------------------------------------

HISTORY = AssetSpec(
    kind="SUP", id="id", price="price", date="d", score="score", status="status", name=None, dy="dy",
    multiple="price", trends=("dy", "price"),
)
HISTORY_FACTORS = [Factor("dy", 0.5, "max"), Factor("price", 0.3, "min"), Factor("volume", 0.2, "max")]


def history(spark: SparkSession, folder: str) -> DataFrame:
    monthly = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey"), F.trunc(F.col("l_shipdate").cast("date"), "month").alias("d"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.sum(cents("l_discount")) / 100).alias("disc"),
            (F.sum(cents("l_extendedprice")) / 100).alias("ext"),
            F.sum(F.col("l_quantity").cast("bigint")).cast("double").alias("qty"),
        )
    )
    suppliers = table(spark, folder, "supplier").select(
        "s_suppkey", F.when(F.col("s_nationkey") % 2 == 0, "A").otherwise("B").alias("cls")
    )
    return monthly.where(F.col("d").isNotNull()).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "d",
        "cls",
        F.col("l_suppkey").alias("id"),
        (F.col("ext") / F.col("qty")).alias("price"),
        (F.col("disc") / F.col("n")).alias("dy"),
        F.col("ext").alias("volume"),
    )


HISTORY_SQL = f"""
history as (
  select m.d, case when s_nationkey % 2 = 0 then 'A' else 'B' end as cls, l_suppkey as id,
         ext / qty as price, disc / n as dy, ext as volume
  from (select l_suppkey, cast(date_trunc('month', l_shipdate) as date) as d, count(*) as n,
               cast(sum({cents_sql("l_discount")}) as double) / 100 as disc,
               cast(sum({cents_sql("l_extendedprice")}) as double) / 100 as ext,
               cast(sum(cast(l_quantity as bigint)) as double) as qty
        from lineitem where l_shipdate is not null group by all) m
  join supplier on l_suppkey = s_suppkey)"""

# --- series: daily mean of each event type as a percent rate -------------------------------------------


def series(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("series"), F.col("ts").cast("date").alias("date"))
        .agg((F.sum(cents("value")) / 100 / F.count("value") / 100).alias("value"))
    )


SERIES_SQL = f"""
series as (
  select event_type as series, cast(ts as date) as date,
         cast(sum({cents_sql("value")}) as double) / 100 / count(value) / 100 as value
  from events group by all)"""

# --- br_text: customers written the way the scraped tables are -----------------------------------------


def br_text(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    balance = cents("c_acctbal")
    sign = F.when(balance < 0, "-").otherwise("")
    whole, rest = F.expr("abs(cents) div 100"), F.lpad((F.abs(F.col("cents")) % 100).cast("string"), 2, "0")

    def dotted(value):
        return F.replace(F.format_number(value, 0), F.lit(","), F.lit("."))

    base = table(spark, folder, "customer").withColumn("cents", balance)
    number = F.concat(sign, dotted(whole), F.lit(","), rest)
    counted = (key * 1000 + 7).cast("bigint")
    return base.select(
        key.alias("id"),
        F.col("c_acctbal").alias("balance"),
        F.when(key % 10 == 0, " Legenda ").otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit(" "))).alias("company"),
        F.when(key % 13 == 0, "N/D").otherwise(F.concat(sign, whole.cast("string"), F.lit("."), rest)).alias("price"),
        F.when(key % 11 == 0, "N/A").otherwise(F.concat(F.lit("R$ "), number)).alias("money"),
        F.when(key % 11 == 1, "").otherwise(F.concat(number, F.lit("%\u200b"))).alias("percent"),
        F.when(key % 11 == 2, "None").otherwise(F.concat(sign, whole.cast("string"), F.lit(","), rest)).alias("ratio"),
        F.when(key % 11 == 3, "5d").otherwise(dotted(counted)).alias("holders"),
        F.when(key % 5 == 0, F.concat(F.lit("("), F.format_number(whole, 0), F.lit("."), rest, F.lit(")")))
        .when(key % 5 == 1, F.concat(F.lit("R$ "), number))
        .when(key % 5 == 2, dotted(counted))
        .when(key % 5 == 3, "—")
        .otherwise(F.concat(F.lit(" "), whole.cast("string"), F.lit("."), rest))
        .alias("mixed"),
    )


BR_TEXT_SQL = f"""
cents as (select *, {cents_sql("c_acctbal")} as cents,
                 c_custkey * 1000 + 7 as counted from customer)"""

# --- scored history and the lists drawn from it --------------------------------------------------------


def percentile_sql(value: str, over: str) -> str:
    """Average-tie percentile, missing values last and counted, as a SQL expression."""
    by = f"partition by {over}" if over else ""
    ties = f"partition by {over}, {value}" if over else f"partition by {value}"
    return (
        f"(rank() over ({by} order by {value} nulls last) + (count(*) over ({ties}) - 1) / 2.0::double)"
        f" / count(*) over ({by}) * 100"
    )


def score_sql(factors, over: str) -> str:
    parts = []
    for f in factors:
        pct = percentile_sql(f.column, over)
        parts.append(f"({'100 - ' if f.best == 'min' else ''}{pct}) * {f.weight}::double")
    total = sum(f.weight for f in factors)
    return f"round_even(({' + '.join(parts)}) / {total!r}::double * 10, 0) / 10"


HISTORY_SCORED_SQL = f"""{HISTORY_SQL},
scored as (select *, {score_sql(HISTORY_FACTORS, 'd, cls')} as score from history)"""

PORTFOLIO_SQL = f"""{HISTORY_SCORED_SQL},
portfolio as (
  select d, cls, id, price, score, pos from (
    select *, row_number() over (partition by d, cls order by score desc, id) as pos from scored)
  where pos <= 20)"""

FORWARD_SQL = """
forward as (
  select q.*, f7.price as p7, f7.d as d7, f30.price as p30, f30.d as d30, f60.price as p60, f60.d as d60,
         f90.price as p90, f90.d as d90
  from history q
  asof left join history f7 on q.cls = f7.cls and q.id = f7.id and f7.d >= q.d + 7
  asof left join history f30 on q.cls = f30.cls and q.id = f30.id and f30.d >= q.d + 30
  asof left join history f60 on q.cls = f60.cls and q.id = f60.id and f60.d >= q.d + 60
  asof left join history f90 on q.cls = f90.cls and q.id = f90.id and f90.d >= q.d + 90)"""

# Deterministic stand-ins for model outputs: yield, price momentum, volume momentum.
PREDICTED_SQL = """
lagged as (
  select *, price / lag(price) over w - 1 as momentum, volume / lag(volume) over w - 1 as flow
  from history window w as (partition by cls, id order by d)),
predicted as (
  select d, cls, id, 'Score Top' as model, dy as predicted from lagged
  union all select d, cls, id, 'Ridge', momentum from lagged
  union all select d, cls, id, 'Random Forest', flow from lagged),
ranked as (
  select *, case when min(predicted) over g = max(predicted) over g then 50.0
       when predicted is null then null
       else (rank() over (partition by model, cls, d order by predicted nulls last)
             + (count(*) over (partition by model, cls, d, predicted) - 1) / 2.0::double)
            / count(predicted) over g * 100 end as score
  from predicted window g as (partition by model, cls, d))"""

EVALUATION_SQL = f"""{HISTORY_SQL}, {FORWARD_SQL}, {PREDICTED_SQL},
joined as (
  select r.model, r.cls, r.d, r.id, r.score, f.p30 / f.price - 1 as realised
  from ranked r join forward f on r.d = f.d and r.cls = f.cls and r.id = f.id
  where r.score is not null and f.p30 / f.price - 1 is not null),
pairs as (select * from joined qualify count(*) over (partition by model, cls, d) >= 5),
tops as (
  select model, cls, d, avg(realised) as top_return, avg(case when realised > 0 then 1.0 else 0.0 end) as hit_rate
  from (select *, row_number() over (partition by model, cls, d order by score desc, id) as p from pairs)
  where p <= 20 group by all),
ranks as (
  select model, cls, d,
    rank() over (partition by model, cls, d order by score)
      + (count(*) over (partition by model, cls, d, score) - 1) / 2.0::double as rs,
    rank() over (partition by model, cls, d order by realised)
      + (count(*) over (partition by model, cls, d, realised) - 1) / 2.0::double as rr
  from pairs),
ics as (
  select model, cls, d,
    case when stddev_pop(rs) > 0 and stddev_pop(rr) > 0
         then covar_pop(rs, rr) / (stddev_pop(rs) * stddev_pop(rr)) end as rank_ic
  from ranks group by all),
measures as (select * from tops join ics using (model, cls, d)),
perf as (
  select m.cls, m.model, count(*) as windows, avg(m.top_return) as ret, avg(m.hit_rate) as hit,
         avg(m.rank_ic) as ic,
         case when m.model = 'Score Top' then 0.0 else avg(m.top_return - b.top_return) end as alpha
  from measures m left join (select * from measures where model = 'Score Top') b
    on m.cls = b.cls and m.d = b.d
  group by m.cls, m.model)"""
