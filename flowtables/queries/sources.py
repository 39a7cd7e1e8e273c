"""Sources, payload formats, change logs and write modes."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables import cdc, commits, ingest, sinks, types
from flowtables.ordered import positions
from flowtables.queries.base import query
from flowtables.queries.relational import change_log
from flowtables.tables import read_table, work_dir

DECLARED = {"event_id": "int64", "user_id": "i64", "event_type": "string", "value": "float64"}
ROW = "id long, kind string, v double"


def payloads(spark, sf_dir, build):
    """Events in payloads of a hundred neighbouring ids; `build` makes the payload from the rows in order."""
    rows = read_table(spark, sf_dir, "events").select((F.floor(F.col("event_id") / 100)).alias("part"), F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("value").alias("v")).alias("r"))
    return rows.groupBy("part").agg(F.sort_array(F.collect_list("r")).alias("rows")).select("part", build(F.col("rows")).alias("payload"))


ALL = "select event_id as id, event_type as kind, value as v from events"


@query("select event_id, user_id, event_type, value from events")
def src_declared_schema(spark, sf_dir):
    # a column-pruned read by the declared schema
    return spark.read.schema(types.declared(DECLARED)).parquet(f"{sf_dir}/events.parquet")


@query("select event_id, event_type, value from events")
def src_conform(spark, sf_dir):
    rows = read_table(spark, sf_dir, "events").select("value", "event_type", "event_id")
    return types.conform(rows, types.declared({"event_id": "int64", "event_type": "string", "value": "double"}))


@query(ALL)
def ingest_json(spark, sf_dir):
    arrays = payloads(spark, sf_dir, lambda rows: F.to_json(rows))
    lines = payloads(spark, sf_dir, lambda rows: F.array_join(F.transform(rows, lambda r: F.to_json(r)), "\n"))
    both = arrays.where("part % 2 = 0").union(lines.where("part % 2 = 1"))
    return ingest.json_rows(both, "payload", ROW)


@query(ALL)
def ingest_csv(spark, sf_dir):
    text = payloads(spark, sf_dir, lambda rows: F.concat(F.lit("id,kind,v\n"), F.array_join(F.transform(rows, lambda r: F.to_csv(r)), "\n"), F.lit("\n")))
    return ingest.csv_rows(text, "payload", ROW)


@query(ALL)
def ingest_columnar(spark, sf_dir):
    text = payloads(spark, sf_dir, lambda rows: F.to_json(F.struct(F.transform(rows, lambda r: r["id"]).alias("id"), F.transform(rows, lambda r: r["kind"]).alias("kind"), F.transform(rows, lambda r: r["v"]).alias("v"))))
    return ingest.columnar_rows(text, "payload", {"id": "bigint", "kind": "string", "v": "double"})


@query(ALL)
def ingest_rows(spark, sf_dir):
    one = read_table(spark, sf_dir, "events").select(F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("value").alias("v"))).alias("payload"))
    return ingest.json_rows(one, "payload", ROW)


@query("select 'OBJECT<k: BIGINT>' as schema, count(*) as n from events")
def infer_json_schema(spark, sf_dir):
    return read_table(spark, sf_dir, "events").agg(ingest.json_schema("props").alias("schema"), F.count("*").alias("n"))


@query("select event_id, event_id % 97 = 0 as malformed, case when event_id % 97 != 0 then cast(props->>'k' as bigint) end as k from events")
def dead_letter_split(spark, sf_dir):
    broken = F.when(F.col("event_id") % 97 == 0, "not json").otherwise(F.col("props"))
    rows = ingest.split_malformed(read_table(spark, sf_dir, "events").select("event_id", broken.alias("payload")), "payload", "k long")
    return rows.select("event_id", "malformed", "parsed.k")


@query("""select event_id // 100 as part, count(*) filter (event_id % 97 != 0) as n, count(*) filter (event_id % 97 = 0) as dead, round(sum(value) filter (event_id % 97 != 0), 4) as total
from events group by 1""")
def dead_letter_csv(spark, sf_dir):
    # columns in another order than the schema, a line break inside each kind, and a record that lacks a field at every 97th id
    record = lambda r: F.when(r["id"] % 97 == 0, F.concat(r["id"].cast("string"), F.lit(",broken"))).otherwise(F.concat_ws(",", r["v"].cast("string"), r["id"].cast("string"), F.concat(F.lit('"'), r["kind"], F.lit('\n""x"""'))))
    text = payloads(spark, sf_dir, lambda rows: F.concat(F.lit("v,id,kind\r\n"), F.array_join(F.transform(rows, record), "\r\n")))
    records = ingest.csv_records(text, "payload", ROW, ["part"])
    return records.groupBy("part").agg(F.count_if(F.col("problem").isNull()).alias("n"), F.count_if(F.col("problem") == "malformed").alias("dead"), F.round(F.sum("parsed.v"), 4).alias("total"))


@query("""select 'id' as "column", 'bigint' as type, count(*) as n from events union all select 'kind', 'string', count(*) from events union all select 'v', 'double', count(value) from events""")
def infer_csv_schema(spark, sf_dir):
    text = payloads(spark, sf_dir, lambda rows: F.concat(F.lit("id,kind,v\n"), F.array_join(F.transform(rows, lambda r: F.to_csv(r)), "\n")))
    return ingest.csv_schema(text, "payload")


@query("""select part, n, cast(sum(n) over (order by part) as bigint) as total from (select event_id // 100 as part, count(*) as n from events group by 1)""")
def ingest_counts(spark, sf_dir):
    # an insert of a hundred ids; the rows inserted so far are those up to its last row's position
    part = F.floor(F.col("event_id") / 100)
    rows = positions(read_table(spark, sf_dir, "events").select("event_id"), [], ["event_id"], part)
    return rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"), (F.max("pos") + 1).alias("total"))


@query("select event_id, event_type, value, 'json' as form from events where event_id % 2 = 0 union all select event_id, event_type, value, 'csv' from events where event_id % 2 = 1")
def decode_messages(spark, sf_dir):
    row = F.struct("event_id", "event_type", "value")
    schema = "event_id long, event_type string, value double"
    ev = read_table(spark, sf_dir, "events")
    out = []
    for form, rest, text in (("json", 0, F.to_json(row)), ("csv", 1, F.to_csv(row))):
        messages = ev.where(F.col("event_id") % 2 == rest).select(text.cast("binary").alias("value"))
        out.append(ingest.decode(messages, "value", form, schema).withColumn("form", F.lit(form)))
    return out[0].union(out[1])


@query("""select event_id, epoch_us(ts) // 1000 as "T", make_timestamp(epoch_us(ts) // 1000 * 1000) as event_time from events""")
def event_time_extract(spark, sf_dir):
    rows = read_table(spark, sf_dir, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("T"))
    return rows.select("event_id", "`T`", ingest.event_time(F.col("`T`")).cast("timestamp_ntz").alias("event_time"))


def envelope_rows(spark, sf_dir):
    """The customers' change log as envelopes with the row before and after."""
    row = F.struct("c_custkey", "c_name", "c_acctbal")
    kind = F.when(F.col("op") == "I", "c").when(F.col("op") == "U", "u").otherwise("d")
    gone = F.col("op") == "D"
    return change_log(read_table(spark, sf_dir, "customer")).select(F.to_json(F.struct(F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"), kind.alias("op"))).alias("payload"), "lsn")


CUSTOMER = "c_custkey long, c_name string, c_acctbal double"
LOG = """select 'I' as op, c_custkey as lsn, c_custkey, c_name, c_acctbal from customer
union all select 'U', c_custkey + 10000000000, c_custkey, c_name || '*', c_acctbal from customer where c_custkey % 3 = 0
union all select 'D', c_custkey + 20000000000, c_custkey, c_name, c_acctbal from customer where c_custkey % 7 = 0"""


@query(LOG)
def cdc_decode(spark, sf_dir):
    return cdc.envelopes(envelope_rows(spark, sf_dir), "payload", CUSTOMER, "lsn")


@query("select c_custkey, case when c_custkey % 3 = 0 then c_name || '*' else c_name end as c_name, c_acctbal from customer where c_custkey % 7 != 0")
def cdc_apply(spark, sf_dir):
    return cdc.apply_changes(cdc.envelopes(envelope_rows(spark, sf_dir), "payload", CUSTOMER, "lsn"), "c_custkey", "lsn")


@query("select event_id, value from events union all select event_id, value from events where event_type = 'click'")
def sink_append(spark, sf_dir):
    ev, path = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value"), work_dir(spark)
    sinks.append(ev, path)
    sinks.append(ev.where("event_type = 'click'"), path)
    return spark.read.parquet(path).select("event_id", "value")


@query("select event_id, value from events where event_type = 'click'")
def sink_overwrite(spark, sf_dir):
    ev, table = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value"), commits.Table(spark, work_dir(spark))
    table.overwrite_once(ev, 0)
    for _ in range(2):  # the epoch is delivered twice
        table.overwrite_once(ev.where("event_type = 'click'"), 1)
    return table.read().select("event_id", "value")


@query("select event_id, event_type, value, 1 + event_id % 3 as version from events where event_id % 3 > 0")
def source_versions(spark, sf_dir):
    # three versions; a reader that begins at the second gets what this and later ones add
    ev, table = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value"), commits.Table(spark, work_dir(spark))
    for number in range(3):
        table.append(ev.where(F.col("event_id") % 3 == number))
    return table.added(commits.start_after(table, 1)).select("event_id", "event_type", "value", (F.col("version") + 1).alias("version"))


def second_version(orders):
    return orders.where("o_orderkey % 5 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query("select o_orderkey, o_custkey, case when o_orderkey % 5 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice from orders")
def sink_upsert(spark, sf_dir):
    orders, table = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.lit(1).alias("version")), commits.Table(spark, work_dir(spark))
    table.append(orders)
    table.upsert(second_version(orders).withColumn("version", F.lit(2)), ["o_orderkey"], ["version"])
    return table.read().select("o_orderkey", "o_custkey", "o_totalprice")


@query("""select o_orderkey, case when o_orderkey % 11 = 0 then 'D' when o_orderkey % 13 = 0 then 'I' else 'U' end as op,
  case when o_orderkey % 11 = 0 or o_orderkey % 5 != 0 then o_totalprice else o_totalprice + 1 end as o_totalprice from orders
where (o_orderkey % 11 = 0 and o_orderkey % 13 != 0) or (o_orderkey % 13 = 0 and o_orderkey % 11 != 0) or (o_orderkey % 5 = 0 and o_orderkey % 11 != 0)""")
def sink_changelog(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    old = orders.where("o_orderkey % 13 != 0")
    new = orders.where("o_orderkey % 11 != 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return cdc.changes(old, new, "o_orderkey", ["o_totalprice"])


@query("select event_id, value, event_id % 4 as batch from events")
def sink_epoch_idempotent(spark, sf_dir):
    ev, table = read_table(spark, sf_dir, "events").select("event_id", "value"), commits.Table(spark, work_dir(spark))
    for number in (0, 1, 2, 3, 1):  # batch 1 is delivered twice
        table.append_once(ev.where(F.col("event_id") % 4 == number).withColumn("batch", F.lit(number).cast("long")), number)
    return table.read().select("event_id", "value", "batch")


@query("select event_id, event_type, value from events")
def dedup_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return sinks.without_repeats(ev.union(ev), ["event_id"])


@query("""select event_id, event_id || ',' || event_type || ',' || user_id as csv_text from events""")
def encode_messages(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    back = ingest.decode(sinks.encode(ev, "json"), "value", "json", "event_id long, event_type string, user_id long")
    return back.select("event_id", F.to_csv(F.struct("event_id", "event_type", "user_id")).alias("csv_text"))


@query("""select o_orderkey, date_trunc('day', o_orderdate) as day, date_trunc('hour', o_orderdate) as hour,
  cast(('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 8))::bigint % 16 as integer) as bucket, substr(o_orderpriority, 1, 3) as prefix, (o_custkey // 100) * 100 as hundred from orders""")
def partition_transforms(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select("o_orderkey", sinks.days("o_orderdate").cast("timestamp_ntz").alias("day"), sinks.hours("o_orderdate").cast("timestamp_ntz").alias("hour"),
        sinks.bucket("o_orderkey", 16).alias("bucket"), sinks.truncate("o_orderpriority", 3, text=True).alias("prefix"), sinks.truncate("o_custkey", 100).alias("hundred"))


@query("select event_id, event_type, value, true as fewer_files from events")
def compact_files(spark, sf_dir):
    small, target = work_dir(spark), work_dir(spark)
    read_table(spark, sf_dir, "events").select("event_id", "event_type", "value").repartition(16).write.parquet(small)
    sinks.compact(spark, small, target)
    files = lambda path: spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    return spark.read.parquet(target).withColumn("fewer_files", F.lit(files(target) < files(small)))


@query("select event_id, value, case when event_id % 2 = 1 then event_type end as event_type from events")
def schema_evolve(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return sinks.evolve(ev.where("event_id % 2 = 0").select("event_id", "value"), ev.where("event_id % 2 = 1").select("event_id", "value", "event_type"))
