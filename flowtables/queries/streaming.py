"""Continuous queries over the files of a folder, run until all is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables import commits, deltas, live, sinks, streams, windows
from flowtables.queries.base import query
from flowtables.queries.relational import change_log
from flowtables.queries.windowed import ARRIVED, ORIGIN, arrived
from flowtables.tables import read_table, work_dir

CLOSED = """select event_type, time_bucket(interval 1 hour, ts, timestamp '1970-01-01') as window_start, time_bucket(interval 1 hour, ts, timestamp '1970-01-01') + interval 1 hour as window_end,
  count(*) as n, max(value) as high from events group by 1, 2, 3"""


def events(spark, sf_dir, **options):
    return streams.file_source(spark, sf_dir, "events", ts="ts", options=options)


def hourly(stream):
    return windows.tumble(stream.withWatermark("ts", "0 seconds"), "ts", size="1 hour", keys=["event_type"], aggs=[F.count("*").alias("n"), F.max("value").alias("high")])


def untimed(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@query("select event_id, ts, event_type, value from events")
def src_file_poll(spark, sf_dir):
    stream = events(spark, sf_dir, maxFilesPerTrigger="1", latestFirst="false")
    return untimed(streams.to_table(stream.select("event_id", "ts", "event_type", "value")).drop("batch"), "ts")


@query(f"select * from ({CLOSED}) where window_end <= (select max(ts) from events)")
def emit_on_close(spark, sf_dir):
    return untimed(streams.to_table(hourly(events(spark, sf_dir))).drop("batch"), "window_start", "window_end")


@query(CLOSED)
def emit_changes(spark, sf_dir):
    changed = streams.to_table(hourly(events(spark, sf_dir)), "update")
    return untimed(streams.latest(changed, ["event_type", "window_start", "window_end"]), "window_start", "window_end")


@query("select event_id, value * 2 as twice from events where event_type = 'error'")
def emit_append(spark, sf_dir):
    rows = events(spark, sf_dir).where("event_type = 'error'").select("event_id", (F.col("value") * 2).alias("twice"))
    return streams.to_table(rows).drop("batch")


@query("select event_type, count(*) as n, max(value) as high from events group by event_type")
def agg_stream_update(spark, sf_dir):
    totals = events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("high"))
    return streams.latest(streams.to_table(totals, "update"), ["event_type"])


@query("select o_orderkey, c_name, o_totalprice from orders join customer on o_custkey = c_custkey")
def join_stream_inner(spark, sf_dir):
    # one side is unique, so no order meets more than one customer; both sides stay in the state
    orders = streams.file_source(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = streams.file_source(spark, sf_dir, "customer").select("c_custkey", "c_name")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return streams.to_table(joined.select("o_orderkey", "c_name", "o_totalprice")).drop("batch")


@query("""select c.user_id, c.event_id as click_id, p.event_id as purchase_id from events c join events p on c.user_id = p.user_id
where c.event_type = 'click' and p.event_type = 'purchase' and p.ts >= c.ts and p.ts <= c.ts + interval 1 hour""")
def join_interval(spark, sf_dir):
    clicks = events(spark, sf_dir).where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts")).withWatermark("click_ts", "1 hour")
    bought = events(spark, sf_dir).where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")).withWatermark("purchase_ts", "1 hour")
    pairs = streams.within(clicks, bought, "user_id", "click_ts", "purchase_ts", "1 hour")
    return streams.to_table(pairs.select("user_id", "click_id", "purchase_id")).drop("batch")


@query("""select 'large' as stream, event_id, value from events where value > 100 union all select 'errors', event_id, value from events where event_type = 'error'
union all select 'all', event_id, value from events""")
def stream_fanout(spark, sf_dir):
    root = work_dir(spark)
    outputs = {"large": lambda b: b.where("value > 100"), "errors": lambda b: b.where("event_type = 'error'"), "all": lambda b: b}
    each = streams.fan_out({k: (lambda b, f=f: f(b).select("event_id", "value")) for k, f in outputs.items()}, root)
    streams.run_available(events(spark, sf_dir), each, f"{root}/checkpoint")
    tables = [spark.read.parquet(f"{root}/{k}").select(F.lit(k).alias("stream"), "event_id", "value") for k in outputs]
    return tables[0].union(tables[1]).union(tables[2])


@query("select event_type, count(*) as n from events group by event_type")
def deliver_batches(spark, sf_dir):
    root = work_dir(spark)

    def each(batch, number):
        batch.groupBy("event_type").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    streams.run_available(events(spark, sf_dir), streams.guarded(each), f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.sum("n").alias("n"))


@query("select event_id, event_type, value from events")
def checkpoint_resume(spark, sf_dir):
    # two drops of the table; the second run reads only what has come since the first
    root = work_dir(spark)
    out = commits.Table(spark, f"{root}/out")
    rows = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    for part in (0, 1):
        sinks.append(rows.where(F.col("event_id") % 2 == part), f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        streams.run_available(stream, out.append_once, f"{root}/checkpoint")
    return out.read().select("event_id", "event_type", "value")


def order_log(orders):
    """Every order created, each fifth dearer, each fourth of these moved to another customer, each ninth deleted; lsn rises by kind of change."""
    cents = F.col("o_totalprice").cast("decimal(18,2)")
    made = orders.select(F.lit("I").alias("op"), F.col("o_orderkey").alias("lsn"), "o_orderkey", "o_custkey", "o_orderpriority", cents.alias("o_totalprice"))
    moved = F.when(F.col("o_orderkey") % 4 == 0, 1).otherwise(F.col("o_custkey"))
    dearer = made.where("o_orderkey % 5 = 0").select(F.lit("U"), F.col("lsn") + 10_000_000_000, "o_orderkey", moved, "o_orderpriority", (F.col("o_totalprice") + 100).cast("decimal(18,2)"))
    gone = made.where("o_orderkey % 9 = 0").select(F.lit("D"), F.col("lsn") + 20_000_000_000, "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    return made.union(dearer).union(gone)


ORDERS_NOW = """select o_orderkey, o_orderpriority, case when o_orderkey % 5 = 0 and o_orderkey % 4 = 0 then 1 else o_custkey end as o_custkey,
  cast(o_totalprice as decimal(18,2)) + case when o_orderkey % 5 = 0 then 100 else 0 end as o_totalprice from orders where o_orderkey % 9 != 0"""
BATCHES = 3


def dealt(log, key, number):
    """A batch of a log: its rows by key and kind of change, so that many changes come before earlier ones of their key."""
    return log.where((F.col(key) + F.floor(F.col("lsn") / 10_000_000_000)) % BATCHES == number)


def drops(spark, parts, each, root, prepare=lambda stream: stream, mode="append"):
    """Each part is dropped into a folder, and a stream of the folder goes on where it ended with the part before."""
    for part in parts:
        sinks.append(part, f"{root}/in")
        stream = spark.readStream.schema(part.schema).parquet(f"{root}/in")
        streams.run_available(prepare(stream), each, f"{root}/checkpoint", mode)


@query(f"""select o_orderkey, c_custkey, o_totalprice, case when c_custkey % 3 = 0 then c_name || '*' else c_name end as c_name
from ({ORDERS_NOW}) join customer on o_custkey = c_custkey where c_custkey % 7 != 0""")
def join_changes(spark, sf_dir):
    join = deltas.ChangeJoin(spark, work_dir(spark), ["o_orderkey"], ["c_custkey"], [("o_custkey", "c_custkey")], "lsn")
    orders, customers = order_log(read_table(spark, sf_dir, "orders")).drop("o_orderpriority"), change_log(read_table(spark, sf_dir, "customer")).drop("c_acctbal")
    for number in range(BATCHES):
        join.step(dealt(orders, "o_orderkey", number), dealt(customers, "c_custkey", number), number)
    return join.result().select("o_orderkey", "c_custkey", "o_totalprice", "c_name")


@query(f"""select o_orderpriority, count(*) as n, cast(sum(o_totalprice) as decimal(28,2)) as total, round(cast(avg(o_totalprice) as double), 4) as mean, min(o_totalprice) as low, max(o_totalprice) as high
from ({ORDERS_NOW}) group by o_orderpriority""")
def group_changes(spark, sf_dir):
    root, log = work_dir(spark), order_log(read_table(spark, sf_dir, "orders"))
    measures = {"n": ("count", "*"), "total": ("sum", "o_totalprice"), "mean": ("avg", "o_totalprice"), "low": ("min", "o_totalprice"), "high": ("max", "o_totalprice")}
    group = deltas.ChangeGroup(spark, f"{root}/group", ["o_orderkey"], ["o_orderpriority"], measures, "lsn")
    drops(spark, [dealt(log, "o_orderkey", number) for number in range(BATCHES)], group.step, root)
    return group.result().withColumn("mean", F.round(F.col("mean").cast("double"), 4))


def thirds(rows):
    """Rows with a place `pos` in three parts of equal size, as they came."""
    size = rows.count()
    return [rows.where(F.floor(F.col("pos") * BATCHES / size) == number) for number in range(BATCHES)]


LIVE = f"""with a as (select *, pos * {BATCHES} // count(*) over () as batch from ({ARRIVED})),
b as (select batch, max(ts) as top from a group by batch), w as (select batch, max(top) over (order by batch rows between unbounded preceding and 1 preceding) - interval 10 minute as watermark from b),
l as (select event_id, ts, a.batch, watermark, coalesce(time_bucket(interval 1 hour, ts, {ORIGIN}) + interval 1 hour <= watermark, false) as late from a join w using (batch))"""


def lateness(spark, sf_dir):
    """The events as they came, split by a stream's own watermark, ten minutes behind, into rows on time and late ones."""
    root = work_dir(spark)
    split = live.Lateness(spark, f"{root}/late", "ts", delay="10 minutes", closes=windows.end_of("ts", "1 hour"))
    drops(spark, thirds(arrived(spark, sf_dir).select("event_id", "ts", "pos")), split.step, root)
    return split


@query(f"{LIVE} select event_id, ts, late from l")
def late_side_output(spark, sf_dir):
    split = lateness(spark, sf_dir)
    return split.on_time.read().select("event_id", "ts", F.lit(False).alias("late")).union(split.late.read().select("event_id", "ts", F.lit(True)))


@query(f"{LIVE} select batch, count(*) as n, count_if(not late) as on_time, count_if(late) as late, max(ts) as top, max(watermark) as watermark from l group by batch")
def stream_progress(spark, sf_dir):
    return lateness(spark, sf_dir).progress.read().select("batch", "n", "on_time", "late", "top", "watermark")


@query(f"""with a as ({ARRIVED}), c as (select pos // 50 as s, max(ts) as top from a group by 1),
w as (select s, max(top) over (order by s rows between unbounded preceding and 1 preceding) as watermark from c)
select event_id, ts, watermark, coalesce(ts <= watermark, false) as late from a join w on pos // 50 = s""")
def wm_live(spark, sf_dir):
    # the producer sends the largest time of every fifty rows after them, as a row of its own; places are doubled to make room
    root, rows = work_dir(spark), arrived(spark, sf_dir).select("event_id", "ts", "pos")
    control = rows.groupBy(F.floor(F.col("pos") / 50).alias("s")).agg(F.max("ts").alias("sent")).select((F.col("s") * 100 + 99).alias("place"), "sent")
    parts = thirds(rows.select("event_id", "ts", "pos", (F.col("pos") * 2).alias("place")).unionByName(control.withColumn("pos", F.floor(F.col("place") / 2)), allowMissingColumns=True))
    split = live.Lateness(spark, f"{root}/late", "ts", sent="sent", pos="place")
    drops(spark, parts, split.step, root)
    names = ["event_id", "ts", "watermark"]
    return split.on_time.read().select(*names, F.lit(False).alias("late")).union(split.late.read().select(*names, F.lit(True)))


@query("""select user_id, min(ts) as window_start, max(ts) + interval 3 hour as window_end, count(*) as n, max(value) as high from
(select *, sum(fresh) over (partition by user_id order by ts, event_id) as s from
 (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 3 hour then 0 else 1 end as fresh from events)) group by user_id, s""")
def session_changes(spark, sf_dir):
    # neighbours in time come in different batches, so sessions grow, meet and are taken back
    root, rows = work_dir(spark), read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    sessions = live.SessionChanges(spark, f"{root}/sessions", "ts", "3 hours", ["user_id"], {"n": ("count", "value"), "high": ("max", "value")})
    drops(spark, [rows.where(F.col("event_id") % BATCHES == number) for number in range(BATCHES)], sessions.step, root)
    return sessions.result().select("user_id", "window_start", "window_end", "n", "high")


@query("""select event_type, event_id, value, back from
(select event_type, event_id, value, row_number() over (partition by event_type order by ts desc, event_id desc) as back from events) where back <= 20""")
def replay_buffer(spark, sf_dir):
    root, rows = work_dir(spark), read_table(spark, sf_dir, "events").select("event_type", "event_id", "ts", "value")
    last = live.LastRows(spark, f"{root}/last", ["event_type"], ["ts", "event_id"], 20)
    drops(spark, [rows.where(F.col("event_id") % BATCHES == number) for number in range(BATCHES)], last.step, root)
    return last.read().select("event_type", "event_id", "value", "back")


@query(CLOSED)
def resume_windows(spark, sf_dir):
    # the stream stops in the middle of the table and goes on from its checkpoint with the windows that were open
    root, rows = work_dir(spark), read_table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    half = rows.count() // 2
    out = commits.Table(spark, f"{root}/out")
    drops(spark, [rows.where(F.col("event_id") < half), rows.where(F.col("event_id") >= half)], lambda b, n: out.append_once(b.withColumn("batch", F.lit(n)), n), root, hourly, "update")
    return untimed(streams.latest(out.read(), ["event_type", "window_start", "window_end"]), "window_start", "window_end")


@query("""select o_orderkey, o_custkey, o_orderkey % 3 as version,
  case when o_orderkey % 3 = 2 and o_custkey % 5 = 0 then null when o_orderkey % 3 > 0 and o_custkey % 4 = 0 then 'MOVED' else c_mktsegment end as c_mktsegment
from orders left join customer on o_custkey = c_custkey""")
def lookup_versions(spark, sf_dir):
    # before the second batch of orders a quarter of the customers move, before the third a fifth of them go
    root, orders = work_dir(spark), read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    reference = commits.Table(spark, f"{root}/reference")
    lookup = live.Lookup(spark, f"{root}/lookup", reference, customers.schema, ["o_custkey"])

    def parts():
        for number in range(BATCHES):
            if number == 0:
                reference.append(customers)
            elif number == 1:
                reference.upsert(customers.where("o_custkey % 4 = 0").withColumn("c_mktsegment", F.lit("MOVED")), ["o_custkey"], [])
            else:
                reference.upsert(customers.where("o_custkey % 5 = 0").withColumn("gone", F.lit(True)), ["o_custkey"], [], delete="gone")
            yield orders.where(F.col("o_orderkey") % BATCHES == number)

    drops(spark, parts(), lookup.step, root)
    return lookup.out.read().select("o_orderkey", "o_custkey", "version", "c_mktsegment")
