"""Rolling means, signals, returns, risk, correlation, portfolios and user-defined forms of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables import accumulate, aggregates, analytics
from flowtables.ordered import positions
from flowtables.queries.base import query
from flowtables.streams import as_of, replay
from flowtables.tables import read_table

LAST = lambda: [F.desc("ts"), F.desc("event_id")]


def placed(spark, sf_dir):
    """The events with their place among those of their type, values in whole cents."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return positions(ev, ["event_type"], ["ts", "event_id"], F.date_trunc("hour", "ts"))


CENTS = "select event_id, event_type, ts, value, cast(round(value * 100) as bigint) as cents, row_number() over w - 1 as pos from events window w as (partition by event_type order by ts, event_id)"


@query(f"""select event_id, case when pos >= 9 then round(sum(cents) over (partition by event_type order by pos rows 9 preceding) / 10, 4) end as short_mean,
  case when pos >= 29 then round(sum(cents) over (partition by event_type order by pos rows 29 preceding) / 30, 4) end as long_mean from ({CENTS})""")
def rolling_mean(spark, sf_dir):
    rows = analytics.rolling_mean(placed(spark, sf_dir), "event_type", "cents")
    return rows.select("event_id", F.round("short_mean", 4).alias("short_mean"), F.round("long_mean", 4).alias("long_mean"))


@query(f"""with s as (select event_id, event_type, pos, 3 * sum(cents) over (partition by event_type order by pos rows 9 preceding) - sum(cents) over (partition by event_type order by pos rows 29 preceding) as d from ({CENTS})),
p as (select *, lag(d) over (partition by event_type order by pos) as was from s)
select event_id, case when pos < 29 then null when pos = 29 then 'HOLD' when was <= 0 and d > 0 then 'BUY' when was >= 0 and d < 0 then 'SELL' else 'HOLD' end as signal from p""")
def ma_crossover(spark, sf_dir):
    return analytics.crossover(placed(spark, sf_dir), "event_type", "cents").select("event_id", "signal")


@query("""select event_id, round((value - p) / p, 8) as ret from (select event_id, value, lag(value) over (partition by event_type order by ts, event_id) as p from events)""")
def returns(spark, sf_dir):
    return analytics.returns(placed(spark, sf_dir), "event_type", "value").select("event_id", F.round("ret", 8).alias("ret"))


RETS = "select event_type, back, (value - p) / p as ret from (select *, row_number() over (partition by event_type order by ts desc, event_id desc) as back, lag(value) over (partition by event_type order by ts, event_id) as p from events) where back < {n} and p is not null"


VAR = f"select event_type, quantile_cont(ret, 0.05) as v from ({RETS.format(n=200)}) group by event_type having count(*) >= 19"


@query(f"select event_type, round(v, 8) as var from ({VAR})")
def var_95(spark, sf_dir):
    return analytics.value_at_risk(read_table(spark, sf_dir, "events"), "event_type", "value", LAST()).select("event_type", F.round("var", 8).alias("var"))


CORR = f"""select x.event_type as a, y.event_type as b, corr(x.ret, y.ret) as corr from ({RETS.format(n=30)}) x join ({RETS.format(n=30)}) y on x.back = y.back and x.event_type < y.event_type
where x.event_type in (select event_type from events group by 1 having count(*) >= 30) and y.event_type in (select event_type from events group by 1 having count(*) >= 30) group by 1, 2"""


def correlated(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return analytics.correlations(events, analytics.key_pairs(events, "event_type"), "event_type", "value", LAST())


@query(f"select a, b, round(corr, 8) as corr from ({CORR})")
def corr_matrix(spark, sf_dir):
    return correlated(spark, sf_dir).select("a", "b", F.round("corr", 8).alias("corr"))


@query(f"select a, b, round(corr, 8) as corr from ({CORR}) where abs(corr) > 0.5")
def corr_pairs(spark, sf_dir):
    return analytics.high_correlations(correlated(spark, sf_dir)).select("a", "b", F.round("corr", 8).alias("corr"))


def prices(spark, sf_dir):
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber")
    return read_table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.max_by("l_extendedprice", order).alias("price"))


PRICES = "select l_partkey, last(l_extendedprice order by l_shipdate, l_orderkey, l_linenumber) as price from lineitem group by l_partkey"


@query(PRICES)
def latest_price(spark, sf_dir):
    return prices(spark, sf_dir)


HELD = "select l_suppkey, l_partkey, sum(l_quantity) as quantity, avg(l_extendedprice) as avg_cost from lineitem group by l_suppkey, l_partkey"
PORTFOLIO = f"""select l_suppkey, count(*) as positions, coalesce(sum(quantity * price), 0) as exposure, coalesce(sum(quantity * price - quantity * avg_cost), 0) as pnl
from ({HELD}) h left join (select * from ({PRICES}) where l_partkey % 10 != 0) p using (l_partkey) group by l_suppkey"""


def portfolios(spark, sf_dir):
    held = read_table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("quantity"), F.avg("l_extendedprice").alias("avg_cost"))
    return analytics.portfolio(held, prices(spark, sf_dir).where("l_partkey % 10 != 0"), "l_suppkey", "l_partkey")


@query(f"select l_suppkey, positions, round(pnl, 2) as pnl from ({PORTFOLIO})")
def portfolio_pnl(spark, sf_dir):
    return portfolios(spark, sf_dir).select("l_suppkey", "positions", F.round("pnl", 2).alias("pnl"))


@query(f"select l_suppkey, round(exposure, 2) as exposure from ({PORTFOLIO})")
def portfolio_exposure(spark, sf_dir):
    return portfolios(spark, sf_dir).select("l_suppkey", F.round("exposure", 2).alias("exposure"))


KIND = "case l_suppkey % 2 when 0 then 'click' else 'view' end"


@query(f"""select l_suppkey, case when exposure > 500000000 + s_acctbal * 10000 or abs(v) > 0.9 then 'BREACH' when s_acctbal is null or v is null then 'UNKNOWN' else 'OK' end as status
from ({PORTFOLIO}) left join supplier on l_suppkey = s_suppkey left join ({VAR}) on event_type = {KIND}""")
def limit_breach(spark, sf_dir):
    risk = analytics.value_at_risk(read_table(spark, sf_dir, "events"), "event_type", "value", LAST())
    limits = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), (500_000_000 + F.col("s_acctbal") * 10_000).alias("max_notional"), F.lit(0.9).alias("max_var"))
    exposed = portfolios(spark, sf_dir).withColumn("event_type", F.when(F.col("l_suppkey") % 2 == 0, "click").otherwise("view")).join(risk, "event_type", "left")
    return analytics.breaches(exposed, limits, "l_suppkey").select("l_suppkey", "status")


@query("select event_type, last(value order by ts, event_id) as last, min(value) as low, max(value) as high, count(*) as ticks from events group by event_type")
def price_summary(spark, sf_dir):
    return read_table(spark, sf_dir, "events").groupBy("event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("last"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("ticks"))


@query("select event_id, round((value - m) / nullif(s, 0), 6) as z from events join (select event_type, avg(value) as m, stddev_samp(value) as s from events group by event_type) using (event_type)")
def udf_zscore(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    stats = ev.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))
    return ev.join(stats, "event_type").select("event_id", F.round(F.try_divide(F.col("value") - F.col("m"), F.col("s")), 6).alias("z"))


@query("select event_type, round(list_reduce(list(value order by ts, event_id), lambda e, v: 0.1 * v + 0.9 * e), 6) as ema from events group by event_type")
def udaf_ema(spark, sf_dir):
    rows = aggregates.ema(read_table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value"), "event_type", "value", ["ts", "event_id"], F.date_trunc("hour", "ts"), 0.1)
    return rows.select("event_type", F.round("ema", 6).alias("ema"))


GROWTH = "ln(1.01 / 0.99)"


@query(f"""with b as (select event_type, ceil(ln(value) / {GROWTH}) as i, count(*) as n from events group by 1, 2),
q as (select event_type, i, sum(n) over (partition by event_type order by i) as upto, sum(n) over (partition by event_type) as total from b),
m as (select event_type, min(i) as i from q where upto > 0.5 * (total - 1) group by event_type)
select event_type, round(avg(value), 6) as mean, round(any_value(exp(i * {GROWTH}) * 0.99), 6) as median,
  round(list_reduce(list(value order by ts, event_id), lambda e, v: 0.1 * v + 0.9 * e), 6) as ema from events join m using (event_type) group by event_type""")
def udaf_custom(spark, sf_dir):
    # three aggregates written against accumulate, merge and evaluate, in one pass over the ordered rows
    rows = read_table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    aggs = {"mean": accumulate.mean("value"), "median": accumulate.quantile("value", 0.5), "ema": accumulate.ema("value", 0.1)}
    out = accumulate.aggregate(rows, ["event_type"], aggs, order=["ts", "event_id"], slot=F.date_trunc("hour", "ts"))
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in aggs])


@query("select event_id, ts, value from events where ts <= timestamp '2024-01-10 12:00:00'")
def as_of_time(spark, sf_dir):
    return as_of(read_table(spark, sf_dir, "events"), "ts", "2024-01-10 12:00:00").select("event_id", "ts", "value")


@query("select event_id, ts, value from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-08'")
def replay_range(spark, sf_dir):
    return replay(read_table(spark, sf_dir, "events"), "ts", "2024-01-05", "2024-01-08").select("event_id", "ts", "value")
