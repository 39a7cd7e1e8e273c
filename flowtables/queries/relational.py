"""Projections, filters, joins, aggregates, ordering and functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables import aggregates, named, sinks
from flowtables.analytics import alerts as alert_rows
from flowtables.analytics import last_rows
from flowtables.cdc import apply_changes
from flowtables.queries.base import query
from flowtables.tables import read_table, work_dir

EV = ["event_id", "ts", "user_id", "event_type", "value"]


@query("select event_id, ts, user_id, event_type, value, props from events")
def proj_star(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("*")


@query("select event_id as id, event_type as symbol, value as price from events")
def proj_alias(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("symbol"), F.col("value").alias("price"))


@query("select l_orderkey, l_linenumber, round(l_extendedprice * l_quantity, 4) as notional from lineitem where l_extendedprice * l_quantity > 1000000")
def notional_filter(spark, sf_dir):
    notional = F.col("l_extendedprice") * F.col("l_quantity")
    return read_table(spark, sf_dir, "lineitem").where(notional > 1_000_000).select("l_orderkey", "l_linenumber", F.round(notional, 4).alias("notional"))


@query("""select l_orderkey, l_linenumber, round((ask - bid) / ((ask + bid) / 2) * 10000, 6) as spread_bps
from (select *, l_extendedprice * (1 - l_discount) as bid, l_extendedprice * (1 + l_tax) as ask from lineitem)
where bid > 0 and ask > 0 and (ask - bid) / ((ask + bid) / 2) * 10000 > 50""")
def spread_bps(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("bid"), (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("ask"))
    bps = (F.col("ask") - F.col("bid")) / ((F.col("ask") + F.col("bid")) / 2) * 10000
    return li.where("bid > 0 and ask > 0").withColumn("s", bps).where("s > 50").select("l_orderkey", "l_linenumber", F.round("s", 6).alias("spread_bps"))


@query("select event_id, event_type, value from events where value > 43.0 and event_type = 'purchase'")
def filter_cmp(spark, sf_dir):
    return read_table(spark, sf_dir, "events").where((F.col("value") > 43.0) & (F.col("event_type") == "purchase")).select("event_id", "event_type", "value")


@query("select event_id, event_type, value from events where (event_type = 'error' or event_type = 'click') and (value < 5 or value > 100)")
def filter_bool(spark, sf_dir):
    kind, v = F.col("event_type"), F.col("value")
    return read_table(spark, sf_dir, "events").where(((kind == "error") | (kind == "click")) & ((v < 5) | (v > 100))).select("event_id", "event_type", "value")


@query("""select user_id, round(avg(value), 6) as avg_value, case when avg(value) > 52 then 'BUY' when avg(value) < 48 then 'SELL' else 'HOLD' end as signal
from events group by user_id""")
def signal_case(spark, sf_dir):
    rows = read_table(spark, sf_dir, "events").groupBy("user_id").agg(F.avg("value").alias("a"))
    return rows.select("user_id", F.round("a", 6).alias("avg_value"), F.when(F.col("a") > 52, "BUY").when(F.col("a") < 48, "SELL").otherwise("HOLD").alias("signal"))


@query("select * from (select event_id, upper(event_type) as kind, value * 2 as twice from events) sub where twice > 200")
def derived_filter(spark, sf_dir):
    sub = read_table(spark, sf_dir, "events").select("event_id", F.upper("event_type").alias("kind"), (F.col("value") * 2).alias("twice"))
    return sub.where("twice > 200")


@query("select event_id, upper(event_type) as kind from events")
def fn_upper(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("event_id", F.upper("event_type").alias("kind"))


@query("select o_orderkey, c_name, o_totalprice from orders join customer on o_custkey = c_custkey")
def join_inner(spark, sf_dir):
    orders, customers = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("select l_orderkey, l_linenumber, p_name, p_brand, l_quantity from lineitem join part on l_partkey = p_partkey")
def join_lookup(spark, sf_dir):
    li, part = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part")
    return li.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_name", "p_brand", "l_quantity")


@query("select event_id, event_type, c_name, c_mktsegment from events left join customer on user_id = c_custkey")
def lookup_enrich(spark, sf_dir):
    ev, cu = read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "customer")
    return ev.join(cu, F.col("user_id") == F.col("c_custkey"), "left").select("event_id", "event_type", "c_name", "c_mktsegment")


@query("select o_orderkey, c_name, o_totalprice from orders join customer on o_custkey = c_custkey where o_totalprice > 100000 and c_mktsegment = 'BUILDING'")
def join_then_filter(spark, sf_dir):
    orders, customers = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.where((F.col("o_totalprice") > 100_000) & (F.col("c_mktsegment") == "BUILDING")).select("o_orderkey", "c_name", "o_totalprice")


def change_log(customers):
    """Every customer created, each third renamed, each seventh deleted, as rows of op, position and values."""
    made = customers.select(F.lit("I").alias("op"), F.col("c_custkey").alias("lsn"), "c_custkey", "c_name", "c_acctbal")
    renamed = customers.where("c_custkey % 3 = 0").select(F.lit("U"), F.col("c_custkey") + 10_000_000_000, "c_custkey", F.concat("c_name", F.lit("*")), "c_acctbal")
    gone = customers.where("c_custkey % 7 = 0").select(F.lit("D"), F.col("c_custkey") + 20_000_000_000, "c_custkey", "c_name", "c_acctbal")
    return made.union(renamed).union(gone)


@query("""select o_orderkey, c_custkey, case when c_custkey % 3 = 0 then c_name || '*' else c_name end as c_name,
  case when o_orderkey % 5 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice
from orders join customer on o_custkey = c_custkey where c_custkey % 7 != 0""")
def join_cdc(spark, sf_dir):
    customers = apply_changes(change_log(read_table(spark, sf_dir, "customer")), "c_custkey", "lsn")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    log = orders.select(F.lit("I").alias("op"), F.lit(1).alias("lsn"), "*").union(orders.where("o_orderkey % 5 = 0").select(F.lit("U"), F.lit(2), "o_orderkey", "o_custkey", F.col("o_totalprice") + 1))
    current = apply_changes(log, "o_orderkey", "lsn")
    return current.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_custkey", "c_name", "o_totalprice")


@query("select event_type, count(*) as n from events group by event_type")
def agg_count(spark, sf_dir):
    return read_table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("""select event_type, count(*) as n, round(avg(value), 6) as avg_value, min(value) as low, max(value) as high, round(sum(value), 4) as total,
  round(sum(value) / count(value), 6) as by_hand from events group by event_type""")
def agg_stats(spark, sf_dir):
    return read_table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("avg_value"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.round(F.sum("value"), 4).alias("total"), F.round(F.sum("value") / F.count("value"), 6).alias("by_hand"))


@query("select count(*) as n, round(avg(value), 6) as avg_value, max(ts) as last_ts from events")
def agg_global(spark, sf_dir):
    return read_table(spark, sf_dir, "events").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("avg_value"), F.max("ts").alias("last_ts"))


@query("select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem group by l_returnflag, l_linestatus")
def agg_multi_key(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("select l_partkey, round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), 4) as vwap from lineitem group by l_partkey")
def vwap(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.round(aggregates.vwap("l_extendedprice", "l_quantity"), 4).alias("vwap"))


@query("""select event_type, first(value order by ts, event_id) as open, max(value) as high, min(value) as low, last(value order by ts, event_id) as close
from events group by event_type""")
def ohlc(spark, sf_dir):
    return read_table(spark, sf_dir, "events").groupBy("event_type").agg(*aggregates.ohlc("value", ["ts", "event_id"]))


@query("select user_id, max(ts) as last_seen, count(*) as n from events group by user_id")
def last_seen(spark, sf_dir):
    return read_table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last_seen"), F.count("*").alias("n"))


@query("select l_partkey, sum(l_quantity) as quantity, round(avg(l_extendedprice), 4) as avg_cost from lineitem group by l_partkey")
def position_rollup(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"), F.round(F.avg("l_extendedprice"), 4).alias("avg_cost"))


@query("""with r as (select event_type, min(value) as lo, max(value) as hi from events group by event_type)
select event_type, least(60, cast(floor((value - lo) / (hi - lo) * 60) as integer) + 1) as bin, count(*) as n from events join r using (event_type) group by 1, 2""")
def histogram(spark, sf_dir):
    return aggregates.histogram(read_table(spark, sf_dir, "events"), "event_type", "value", bins=60)


@query("select event_type, round(avg(value), 6) as mean, round(sum(value), 4) as total, count(*) as n from events where value > 20 group by event_type order by mean desc")
def filtered_summary(spark, sf_dir):
    rows = read_table(spark, sf_dir, "events").where("value > 20").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.sum("value"), 4).alias("total"), F.count("*").alias("n"))
    return rows.orderBy(F.desc("mean"), "event_type")


@query("select event_id, ts, value from events order by ts, event_id limit 100")
def limit_n(spark, sf_dir):
    return read_table(spark, sf_dir, "events").orderBy("ts", "event_id").select("event_id", "ts", "value").limit(100)


@query("select l_orderkey, l_linenumber, round(l_extendedprice * l_quantity, 4) as notional from lineitem order by l_extendedprice * l_quantity desc, l_orderkey, l_linenumber limit 10")
def topk_notional(spark, sf_dir):
    notional = F.col("l_extendedprice") * F.col("l_quantity")
    return read_table(spark, sf_dir, "lineitem").orderBy(notional.desc(), "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", F.round(notional, 4).alias("notional")).limit(10)


@query("select event_type, round(a, 6) as avg_value from (select event_type, avg(value) as a from events group by event_type) order by a desc, event_type limit 1")
def argmax_key(spark, sf_dir):
    means = read_table(spark, sf_dir, "events").groupBy("event_type").agg(F.avg("value").alias("a"))
    return means.agg(F.max_by("event_type", "a").alias("event_type"), F.round(F.max("a"), 6).alias("avg_value"))


def named_streams(spark, sf_dir, name):
    """Streams over the events, defined by name; `name` is run over the first half of the events and, from there on, over the other."""
    root, rows = work_dir(spark), read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    made = named.Streams(spark, f"{root}/streams", {"events": rows.schema})
    made.define("viewed", lambda events: events.where("event_type = 'view'"), ["events"])
    made.define("purchases", lambda events: events.where("event_type = 'purchase'").select("user_id", "value"), ["events"])
    made.define("spenders", lambda purchases: purchases.where("value > 5").groupBy("user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total")), ["purchases"], ["user_id"])
    made.define("users", lambda events: events.groupBy("user_id").agg(F.count("*").alias("n"), F.max("value").alias("high")), ["events"], ["user_id"])
    for part in (0, 1):
        sinks.append(rows.where(F.col("event_id") % 2 == part), f"{root}/in")
        made.run(name, {"events": spark.readStream.schema(rows.schema).parquet(f"{root}/in")})
    return made


@query("select event_id, event_type, value from events where event_type = 'view' and value > 10")
def stream_filter(spark, sf_dir):
    return named_streams(spark, sf_dir, "viewed").ask("viewed", "value > 10").select("event_id", "event_type", "value")


@query("""select user_id, count(*) as n, round(sum(value), 4) as total from
(select user_id, value from events where event_type = 'purchase') where value > 5 group by user_id having count(*) > 1""")
def stream_chain(spark, sf_dir):
    return named_streams(spark, sf_dir, "spenders").ask("spenders", "n > 1").select("user_id", "n", F.round("total", 4).alias("total"))


@query("select * from (select user_id, count(*) as n, max(value) as high from events group by user_id) as v where n > 60")
def view_snapshot(spark, sf_dir):
    return named_streams(spark, sf_dir, "users").ask("users", "n > 60").select("user_id", "n", "high")


@query("select event_id, event_type, value, 'I' as op from events")
def change_rows(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.lit("I").alias("op"))


@query("""select ts, event_type as symbol, 'SPIKE' as signal, value as price, cast(1 + event_id % 7 as double) as volume from events where value > 150
union all select l_shipdate, cast(l_partkey as varchar), 'WHALE', l_extendedprice, l_quantity from lineitem where l_quantity >= 50
union all select ts, event_type, 'ERROR', value, 1.0 from events where event_type = 'error' and value > 50""")
def alert_log(spark, sf_dir):
    ev, li = read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "lineitem")
    spike = alert_rows(ev, "SPIKE", F.col("value") > 150, "ts", "event_type", F.col("value"), 1 + F.col("event_id") % 7)
    whale = alert_rows(li, "WHALE", F.col("l_quantity") >= 50, "l_shipdate", "l_partkey", F.col("l_extendedprice"), F.col("l_quantity"))
    error = alert_rows(ev, "ERROR", (F.col("event_type") == "error") & (F.col("value") > 50), "ts", "event_type", F.col("value"), F.lit(1.0))
    return spike.unionByName(whale).unionByName(error)


@query("""select ts, event_type as symbol, 'HOT' as signal, value as price, 1.0 as volume from events where value > 75
union all select l_shipdate, cast(l_partkey as varchar), 'HIGH_NOTIONAL', l_extendedprice, l_quantity from lineitem where l_extendedprice * l_quantity > 50000
union all select l_shipdate, cast(l_partkey as varchar), 'SELL_PRESSURE', l_extendedprice, l_quantity from lineitem where l_returnflag = 'R' and l_quantity > 40""")
def alerts(spark, sf_dir):
    ev, li = read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "lineitem")
    price, volume = F.col("l_extendedprice"), F.col("l_quantity")
    hot = alert_rows(ev, "HOT", F.col("value") > 75, "ts", "event_type", F.col("value"), F.lit(1.0))
    high = alert_rows(li, "HIGH_NOTIONAL", price * volume > 50_000, "l_shipdate", "l_partkey", price, volume)
    sell = alert_rows(li, "SELL_PRESSURE", (F.col("l_returnflag") == "R") & (volume > 40), "l_shipdate", "l_partkey", price, volume)
    return hot.unionByName(high).unionByName(sell)


@query("""select event_type, event_id, value, back from
(select event_type, event_id, value, row_number() over (partition by event_type order by ts desc, event_id desc) as back from events) where back <= 20""")
def replay_last_n(spark, sf_dir):
    rows = last_rows(read_table(spark, sf_dir, "events"), ["event_type"], [F.desc("ts"), F.desc("event_id")], 20)
    return rows.select("event_type", "event_id", "value", F.col("back").cast("long").alias("back"))
