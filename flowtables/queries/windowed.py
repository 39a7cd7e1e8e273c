"""Time windows, watermarks, late rows and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables import metrics, watermark, windows
from flowtables.queries.base import query
from flowtables.tables import read_table

ORIGIN = "timestamp '1970-01-01'"


@query("""
select event_type, w as window_start, w + interval 1 day as window_end,
       round(sum(value * q) / nullif(sum(q), 0), 6) as vwap, round(avg(value), 6) as avg_price, count(*) as trades,
       case when sum(value * q) / nullif(sum(q), 0) > avg(value) * 1.001 then 'BUY'
            when sum(value * q) / nullif(sum(q), 0) < avg(value) * 0.999 then 'SELL' else 'HOLD' end as signal
from (select event_type, value, 1 + event_id % 7 as q, time_bucket(interval 1 day, ts, timestamp '1970-01-01') as w from events)
group by event_type, w
""")
def win_vwap_signal(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_type", "ts", "value", (1 + F.col("event_id") % 7).alias("q"))
    out = windows.tumble(ev, "ts", size="1 day", keys=["event_type"], aggs=[F.try_divide(F.sum(F.col("value") * F.col("q")), F.sum("q")).alias("v"), F.avg("value").alias("a"), F.count("*").alias("trades")])
    signal = F.when(F.col("v") > F.col("a") * 1.001, "BUY").when(F.col("v") < F.col("a") * 0.999, "SELL").otherwise("HOLD")
    return out.select("event_type", "window_start", "window_end", F.round("v", 6).alias("vwap"), F.round("a", 6).alias("avg_price"), "trades", signal.alias("signal"))


@query(f"""select event_type, time_bucket(interval 1 hour, ts, {ORIGIN}) as window_start, time_bucket(interval 1 hour, ts, {ORIGIN}) + interval 1 hour as window_end,
  count(*) as n, round(sum(value), 4) as total from events group by 1, 2, 3""")
def win_tumble(spark, sf_dir):
    return windows.tumble(read_table(spark, sf_dir, "events"), "ts", size="1 hour", keys=["event_type"], aggs=[F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")])


@query(f"""select event_type, w - k * interval 15 minute as window_start, w - k * interval 15 minute + interval 1 hour as window_end,
  count(value) as n, round(sum(value), 4) as total, min(value) as low, max(value) as high
from (select *, time_bucket(interval 15 minute, ts, {ORIGIN}) as w from events), (select unnest([0, 1, 2, 3]) as k) group by 1, 2, 3""")
def win_hop(spark, sf_dir):
    out = windows.hop(read_table(spark, sf_dir, "events"), "ts", size="1 hour", slide="15 minutes", keys=["event_type"], value="value")
    return out.select("event_type", "window_start", "window_end", "n", F.round("total", 4).alias("total"), "low", "high")


@query("""select user_id, min(ts) as window_start, max(ts) + interval 30 minute as window_end, count(*) as n from
(select *, sum(fresh) over (partition by user_id order by ts, event_id) as s from
 (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 30 minute then 0 else 1 end as fresh from events)) group by user_id, s""")
def win_session(spark, sf_dir):
    return windows.session(read_table(spark, sf_dir, "events"), "ts", gap="30 minutes", keys=["user_id"], aggs=[F.count("*").alias("n")])


@query("""select event_type, epoch_us(ts) // 3600000000 * 3600000 as window_start, epoch_us(ts) // 3600000000 * 3600000 + 3600000 as window_end, count(*) as n
from events group by 1, 2, 3""")
def win_tumble_ms(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return windows.tumble_millis(ev, "ms", size_ms=3_600_000, keys=["event_type"], aggs=[F.count("*").alias("n")])


@query(f"""select event_type, time_bucket(interval 1 day, h, {ORIGIN}) as window_start, time_bucket(interval 1 day, h, {ORIGIN}) + interval 1 day as window_end,
  max(n) as busiest, cast(sum(n) as bigint) as n from (select event_type, time_bucket(interval 1 hour, ts, {ORIGIN}) as h, count(*) as n from events group by 1, 2) group by 1, 2, 3""")
def win_chained(spark, sf_dir):
    hours = windows.tumble(read_table(spark, sf_dir, "events"), "ts", size="1 hour", keys=["event_type"], aggs=[F.count("*").alias("n")])
    return windows.tumble(hours, "window_start", size="1 day", keys=["event_type"], aggs=[F.max("n").alias("busiest"), F.sum("n").alias("n")])


SOURCES = "select event_type, max(ts) - interval 10 second as watermark from events group by event_type"


@query(SOURCES)
def wm_assign(spark, sf_dir):
    return watermark.by_source(read_table(spark, sf_dir, "events"), "event_type", "ts", "10 seconds")


@query(f"select min(watermark) as watermark from ({SOURCES})")
def wm_pipeline(spark, sf_dir):
    return watermark.of_pipeline(read_table(spark, sf_dir, "events"), "event_type", "ts", "10 seconds")


@query(f"""select event_type, watermark, epoch_us(top) // 1000 - epoch_us(watermark) // 1000 as lag_ms from ({SOURCES}), (select max(ts) as top from events)""")
def wm_lag(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    rows = watermark.by_source(ev, "event_type", "ts", "10 seconds").join(F.broadcast(ev.agg(F.max("ts").alias("top"))))  # one row
    return watermark.lag_millis(rows, "watermark", "top").select("event_type", "watermark", "lag_ms")


ARRIVED = "select *, row_number() over (order by event_id + (event_id * 37) % 120, event_id) - 1 as pos from events"


def arrived(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").withColumn("arrival", F.col("event_id") + (F.col("event_id") * 37) % 120)
    return watermark.arrivals(ev, "arrival", "event_id")


@query(f"""with a as ({ARRIVED}), c as (select pos // 50 as s, max(ts) as top from a group by 1),
w as (select s, max(top) over (order by s rows between unbounded preceding and 1 preceding) as watermark from c)
select event_id, ts, watermark, coalesce(ts <= watermark, false) as late from a join w on pos // 50 = s""")
def wm_punctuated(spark, sf_dir):
    return watermark.punctuated(arrived(spark, sf_dir), "ts", 50).select("event_id", "ts", "watermark", "late")


LATE = f"""select *, coalesce(time_bucket(interval 1 hour, ts, {ORIGIN}) + interval 1 hour <= watermark, false) as late from
(select *, max(ts) over (order by pos rows between unbounded preceding and 1 preceding) as watermark from ({ARRIVED}))"""


@query(f"select event_id, ts, watermark, late from ({LATE})")
def late_split(spark, sf_dir):
    return watermark.late_for_window(arrived(spark, sf_dir), "ts", "1 hour").select("event_id", "ts", "watermark", "late")


@query("select event_type, count(*) as events, max(ts) - interval 5 second as watermark from events group by event_type")
def source_metrics(spark, sf_dir):
    return metrics.counters(read_table(spark, sf_dir, "events"), "event_type", "ts", "5 seconds")


@query("""select stream, count(*) as events, max(ts) - interval 5 second as watermark from
(select 'views' as stream, ts from events where event_type = 'view' union all select 'large', ts from events where value > 100) group by stream""")
def stream_metrics(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    outputs = ev.where("event_type = 'view'").select(F.lit("views").alias("stream"), "ts").union(ev.where("value > 100").select(F.lit("large"), "ts"))
    return metrics.counters(outputs, "stream", "ts", "5 seconds")


@query(f"""select count(*) as ingested, count(*) filter (not late) as emitted, count(*) filter (late) as dropped, count(distinct event_id // 1000) as batches, max(ts) as watermark from ({LATE})""")
def pipeline_metrics(spark, sf_dir):
    return metrics.pipeline(watermark.late_for_window(arrived(spark, sf_dir), "ts", "1 hour"), "ts", F.floor(F.col("event_id") / 1000))


@query("""select event_type, count(*) as events, round(case when epoch_us(max(ts)) > epoch_us(min(ts)) then count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) else 0 end, 9) as events_per_second
from events group by event_type""")
def throughput(spark, sf_dir):
    return metrics.throughput(read_table(spark, sf_dir, "events"), "event_type", "ts").withColumn("events_per_second", F.round("events_per_second", 9))
