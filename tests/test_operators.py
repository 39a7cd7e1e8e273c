"""Edges that the test tables do not show."""

import math
from datetime import datetime as dt
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

from flowtables import analytics, cdc, commits, ingest, sinks, streams, types, watermark, windows
from flowtables.aggregates import ema
from flowtables.ordered import over_rows, positions, running_max
from flowtables.queries import ORACLES, QUERIES
from flowtables.tables import work_dir


def counted():
    return [F.count("*").alias("n")]


def test_tumble_edges(spark):
    df = spark.createDataFrame([(dt(2024, 1, 1, 0, 0, 9),), (dt(2024, 1, 1, 0, 0, 10),), (dt(2024, 1, 1, 0, 0, 35),), (None,)], "ts timestamp_ntz")
    got = windows.tumble(df, "ts", size="10 seconds", aggs=counted()).orderBy("window_start").collect()
    assert [(r.window_start.second, r.window_end.second, r.n) for r in got] == [(0, 10, 1), (10, 20, 1), (30, 40, 1)]


def test_tumble_millis_below_zero(spark):
    df = spark.createDataFrame([(-1,), (0,), (999,), (1000,)], "ms long")
    got = {r.window_start: r.n for r in windows.tumble_millis(df, "ms", size_ms=1000, aggs=counted()).collect()}
    assert got == {-1000: 1, 0: 2, 1000: 1}


def test_session_gap_is_inclusive(spark):
    df = spark.createDataFrame([("a", dt(2024, 1, 1, 0, 0, s)) for s in (0, 10, 21)], "k string, ts timestamp_ntz")
    got = windows.session(df, "ts", gap="10 seconds", keys=["k"], aggs=counted()).orderBy("window_start").collect()
    assert [(r.window_start.second, r.window_end.second, r.n) for r in got] == [(0, 20, 2), (21, 31, 1)]


def test_hop_against_built_in(spark):
    df = spark.createDataFrame([("a", dt(2024, 1, 1, 0, m), float(m)) for m in (0, 3, 7, 20)], "k string, ts timestamp_ntz, v double")
    got = {(r.window_start, r.window_end, r.n, r.total, r.low, r.high) for r in windows.hop(df, "ts", size="10 minutes", slide="5 minutes", keys=["k"], value="v").collect()}
    want = df.groupBy(F.window("ts", "10 minutes", "5 minutes").alias("w"), "k").agg(F.count("v"), F.sum("v"), F.min("v"), F.max("v")).collect()
    assert got == {(r.w.start, r.w.end, *r[2:]) for r in want}
    with pytest.raises(ValueError):
        windows.hop(df, "ts", size="10 minutes", slide="3 minutes", keys=["k"], value="v")


@pytest.mark.parametrize("text,length", [("5 seconds", 5_000_000), ("'5' SECOND", 5_000_000), ("1 minute", 60_000_000)])
def test_intervals(text, length):
    assert windows.micros(text) == length


@pytest.mark.parametrize("text", ["", "5", "five seconds", "0 seconds", "3 fortnights"])
def test_bad_intervals(text):
    with pytest.raises(ValueError):
        windows.micros(text)


def test_types():
    assert types.declared({"a": "i64", "b": "FLOAT64", "c": "u64"}).simpleString() == "struct<a:bigint,b:double,c:decimal(20,0)>"
    with pytest.raises(ValueError):
        types.declared({"a": "quaternion"})


def test_conform(spark):
    df = spark.createDataFrame([(1, "x")], "a long, b string")
    assert types.conform(df, types.declared({"b": "str", "a": "int64"})).columns == ["b", "a"]
    for wrong in ({"a": "int64"}, {"a": "int32", "b": "str"}, {"a": "int64", "b": "str", "c": "str"}):
        with pytest.raises(ValueError):
            types.conform(df, types.declared(wrong))


def test_json_payload_forms(spark):
    df = spark.createDataFrame([(' [{"a":1},{"a":2}] ',), ('{"a":3}\n{"a":4}\n',), ('{"a":5}',), ("[]",), (None,)], "p string")
    assert sorted(r.a for r in ingest.json_rows(df, "p", "a long").collect()) == [1, 2, 3, 4, 5]


def records(df):
    return sorted(((r.problem, tuple(r.parsed) if r.problem is None else r.record) for r in df.collect()), key=repr)


def test_json_problems(spark):
    good = [None, (1, "a")]
    cases = [
        ('[{"a":1,"b":"a"}, oops]', [("malformed", '[{"a":1,"b":"a"}, oops]')]),
        ('{"a":1,"b":"a"}\nnot json\n\n', [("malformed", "not json"), (None, (1, "a"))]),
        ('{\n "a": 1,\n "b": "a"\n}', [(None, (1, "a"))]),
        ('[{"a":1,"b":"a"},{"a":"x"},3]', [("malformed", '{"a":"x"}'), ("malformed", "3"), (None, (1, "a"))]),
        ("[]", [("empty", "")]),
        ("", [("empty", "")]),
        (None, [("empty", "")]),
        ('{"a":1', [("malformed", '{"a":1')]),
    ]
    for text, want in cases:
        df = spark.createDataFrame([(text,)], "p string")
        assert records(ingest.json_records(df, "p", "a long, b string")) == sorted(want, key=repr), (text, good)
    both = spark.createDataFrame([(t,) for t, _ in cases], "p string")
    rows, dead = ingest.dead_letters(ingest.json_records(both, "p", "a long, b string"))
    assert rows.count() + dead.count() == sum(len(w) for _, w in cases)
    for text in ("not json", '{"a":"x"}'):
        with pytest.raises(Exception, match="malformed payload"):
            ingest.json_rows(spark.createDataFrame([(text,)], "p string"), "p", "a long").collect()
    with pytest.raises(Exception, match="empty payload"):
        ingest.json_rows(spark.createDataFrame([("[]",)], "p string"), "p", "a long", empty=False).collect()


def test_csv_problems(spark):
    cases = [
        ("b,a,c\r\nx,1,0.5\r\n", [(None, (1, "x", 0.5))]),
        ('a,b,c\n1,"two\nlines, ""quoted""",2.5\n\n2,,\n', [(None, (1, 'two\nlines, "quoted"', 2.5)), (None, (2, None, None))]),
        ("a,b,c\n1,x\n2,y,1.0,9\n3,z,1.5", [("malformed", "1,x"), ("malformed", "2,y,1.0,9"), (None, (3, "z", 1.5))]),
        ("a,b,c\none,x,1\n2,y,2", [("malformed", "one,x,1"), (None, (2, "y", 2.0))]),
        ('a,b,c\n1,"open,2\n', [("malformed", 'a,b,c\n1,"open,2\n')]),
        ("a,b\n1,x\n", [("malformed", "a,b\n1,x\n")]),
        ('a,b,c\n1,x"y"z,2', [("malformed", '1,x"y"z,2')]),
        ('a,extra,b,c\n1,?,"",2', [(None, (1, "", 2.0))]),
        ("a,b,c\n", [("empty", "")]),
        ("", [("empty", "")]),
        (None, [("empty", "")]),
    ]
    for text, want in cases:
        df = spark.createDataFrame([(text,)], "p string")
        assert records(ingest.csv_records(df, "p", "a long, b string, c double")) == sorted(want, key=repr), text
    with pytest.raises(Exception, match="malformed payload"):
        ingest.csv_rows(spark.createDataFrame([("a\nx",)], "p string"), "p", "a long").collect()


def test_columnar_problems(spark):
    cases = [('{"a":[1,2],"b":["x","y"]}', [(None, (1, "x")), (None, (2, "y"))]), ('{"a":[1,2],"b":["x"]}', None), ('{"a":[1]}', None), ("oops", None), ('{"a":["x"],"b":["x"]}', None), (None, None)]
    for text, want in cases:
        df = spark.createDataFrame([(text,)], "p string")
        assert records(ingest.columnar_records(df, "p", {"a": "bigint", "b": "string"})) == (want or [("malformed", text)])


def test_csv_schema_over_all_rows(spark):
    texts = ['i,d,s,b,t,u,none\n1,1,x,true,2024-01-01,2024-01-01 10:00:00,\n2,2.5,1,FALSE,2024-02-03,2024-01-02,', 'b,i,d,s,t,u,none\ntrue,-7,1e3,"a\nb",2023-12-31,2020-01-01T00:00:00,', "m\n1\ntrue"]
    got = {r.column: r.type for r in ingest.csv_schema(spark.createDataFrame([(t,) for t in texts], "p string"), "p").collect()}
    assert got == {"i": "bigint", "d": "double", "s": "string", "b": "boolean", "t": "date", "u": "timestamp", "none": "string", "m": "string"}


def test_changes_of_null_keys(spark):
    old = spark.createDataFrame([(None, "x"), (1, "y")], "k int, v string")
    new = spark.createDataFrame([(None, "x"), (1, "z")], "k int, v string")
    assert {(r.k, r.op, r.v) for r in cdc.changes(old, new, "k", ["v"]).collect()} == {(1, "U", "z")}
    assert {(r.k, r.op, r.v) for r in cdc.changes(old, new.where("k = 1"), "k", ["v"]).collect()} == {(1, "U", "z"), (None, "D", "x")}


def test_malformed_fails_fast(spark):
    df = spark.createDataFrame([("not json",)], "p string")
    assert ingest.split_malformed(df, "p", "k long").first().malformed
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        ingest.fail_on_malformed(df, "p", "k long").select("parsed.k").collect()


def test_changes_see_nulls(spark):
    old = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    new = spark.createDataFrame([(1, None), (2, None), (4, "z")], "k int, v string")
    assert {(r.k, r.op, r.v) for r in cdc.changes(old, new, "k", ["v"]).collect()} == {(2, "U", None), (3, "D", "y"), (4, "I", "z")}


@pytest.mark.parametrize("block", [3, 7, 100])
def test_rows_in_blocks(spark, block):
    df = spark.createDataFrame([("a", i, (i * 7919) % 101) for i in range(95)] + [("b", i, i) for i in range(4)], "k string, i long, v long")
    placed = positions(df, ["k"], ["i"], F.floor(F.col("i") / 10))
    assert positions(df, ["k"], ["i"], F.col("i").cast("string").substr(1, 0)).where("pos != i").count() == 0
    assert all(r.pos == r.i for r in placed.collect())
    got = {(r.k, r.i): r.signal for r in analytics.crossover(placed, "k", "v", short=3, long=8, block=block).collect()}
    want = {(r.k, r.i): r.signal for r in analytics.crossover(placed, "k", "v", short=3, long=8, block=10_000).collect()}
    assert got == want and got["b", 3] is None and got["a", 7] == "HOLD" and {"BUY", "SELL"} <= set(got.values())
    sums = over_rows(placed, ["k"], reach=4, columns={"s": lambda w: F.sum("v").over(w.rowsBetween(-4, 0))}, block=block)
    assert all(r.s == sum((j * 7919) % 101 for j in range(max(0, r.i - 4), r.i + 1)) for r in sums.where("k = 'a'").collect())


def test_rows_without_a_time_come_last(spark, tmp_path):
    hour = F.date_trunc("hour", "ts")
    rows = [("a", i, dt(2024, 1, 1, i % 5), float(i + 1)) for i in range(8)] + [("a", 8, None, 20.0), ("a", 9, None, 21.0), ("b", 10, None, 3.0)]
    df = spark.createDataFrame(rows, "event_type string, event_id long, ts timestamp_ntz, value double")
    order = sorted((r for r in rows if r[0] == "a"), key=lambda r: (r[2] is None, r[2] or dt.max, r[1]))
    want = {r[1]: n for n, r in enumerate(order)} | {10: 0}
    for slot in (hour, F.hour("ts"), F.hour("ts").cast("long") * 5000):
        assert {r.event_id: r.pos for r in positions(df, ["event_type"], ["ts", "event_id"], slot).collect()} == want
        e = order[0][3]
        for r in order[1:]:
            e = 0.3 * r[3] + 0.7 * e
        assert {r.event_type: r.ema for r in ema(df, "event_type", "value", ["ts", "event_id"], slot, 0.3).collect()} == {"a": pytest.approx(e), "b": pytest.approx(3.0)}
    df.withColumns({"user_id": F.lit(1), "props": F.lit("{}")}).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("rolling_mean", "ma_crossover", "returns"):
        assert QUERIES[name](spark, str(tmp_path)).count() == len(rows)
    got = {r.event_id: r.ret for r in QUERIES["returns"](spark, str(tmp_path)).collect()}
    assert got[8] == pytest.approx((20 - order[7][3]) / order[7][3], abs=1e-7) and got[10] is None


def test_returns_from_a_price_of_zero(spark, tmp_path):
    values = {"a": [0.0, 5.0, 4.0, 0.0, 0.0, -1.0, -0.0, 2.0], "b": [3.0, None, 6.0]}
    rows = [(k, 10 * n + i, dt(2024, 1, 1, i), v) for n, (k, vs) in enumerate(values.items()) for i, v in enumerate(vs)]
    spark.createDataFrame(rows, "event_type string, event_id long, ts timestamp_ntz, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_id: r.ret for r in QUERIES["returns"](spark, str(tmp_path)).collect()}
    assert repr([got[i] for i in range(8)]) == repr([None, math.inf, -0.2, -1.0, math.nan, -math.inf, -1.0, -math.inf])
    assert [got[10 + i] for i in range(3)] == [None] * 3
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert repr(got) == repr({i: got[i] for i in got} | dict(con.execute(ORACLES["returns"]).fetchall()))


def test_risk_counts_returns_from_a_price_of_zero(spark):
    # 20 prices give 19 returns, one of them infinite
    prices = [10.0, 0.0, 10.0] + [10.0 + i for i in range(1, 18)]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(prices)] + [("b", i, float(i * i % 7 + 1)) for i in range(20)], "k string, i long, v double")
    rets = sorted(math.inf if not a else (b - a) / a for a, b in zip(prices, prices[1:], strict=False))
    got = {r.k: r["var"] for r in analytics.value_at_risk(df, "k", "v", [F.desc("i")]).collect()}
    assert got.keys() == {"a", "b"} and got["a"] == pytest.approx(0.1 * rets[0] + 0.9 * rets[1])
    # such a key stays in the matrix, though its correlation has no value, which is none beyond the limit either
    corr = analytics.correlations(df, analytics.key_pairs(df, "k"), "k", "v", [F.desc("i")], prices=20)
    assert [(r.a, r.b, math.isnan(r.corr)) for r in corr.collect()] == [("a", "b", True)]
    assert analytics.high_correlations(corr).count() == 0


def test_correlations_of_prices_that_stand_still(spark):
    moves = {"a": [5.0] * 4, "b": [1.0, 2.0, 3.0, 5.0], "c": [4.0, 8.0, 12.0, 20.0]}
    df = spark.createDataFrame([(k, i, v) for k, vs in moves.items() for i, v in enumerate(vs)], "k string, i long, v double")
    corr = analytics.correlations(df, analytics.key_pairs(df, "k"), "k", "v", [F.desc("i")], prices=4)
    got = {(r.a, r.b): r.corr for r in corr.collect()}
    assert math.isnan(got["a", "b"]) and math.isnan(got["a", "c"]) and got["b", "c"] == pytest.approx(1)
    assert [(r.a, r.b) for r in analytics.high_correlations(corr).collect()] == [("b", "c")]


def test_correlations_of_all_types(spark):
    sf_dir = "/root/testdata/sf0.1"
    types = sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type").distinct().collect())
    matrix = {(r.a, r.b): r.corr for r in QUERIES["corr_matrix"](spark, sf_dir).collect()}
    assert matrix.keys() == set(combinations(types, 2)) and len(matrix) == 10
    high = {(r.a, r.b): r.corr for r in QUERIES["corr_pairs"](spark, sf_dir).collect()}
    assert high == {p: c for p, c in matrix.items() if abs(c) > 0.5} and ("purchase", "view") in high


def test_correlation_threshold(spark):
    corr = spark.createDataFrame([("a", "b", 0.5), ("a", "c", -0.6), ("b", "c", 0.2), ("b", "d", None)], "a string, b string, corr double")
    assert [(r.a, r.b) for r in analytics.high_correlations(corr).collect()] == [("a", "c")]
    assert analytics.high_correlations(corr, 0.1).count() == 3


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_running_max(spark, levels):
    values = [(i * 37) % 50 for i in range(60)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "pos long, v long")
    got = {r.pos: r.m for r in running_max(df, "v", "m", block=4, levels=levels).collect()}
    assert got == {i: max(values[:i], default=None) for i in range(60)}


def test_late_rows(spark):
    times = [1, 5, 3, 5, 9, 2]
    df = spark.createDataFrame([(i, dt(2024, 1, 1, 0, 0, s)) for i, s in enumerate(times)], "pos long, ts timestamp_ntz")
    assert [r.late for r in watermark.punctuated(df, "ts", 2).orderBy("pos").collect()] == [False, False, True, True, False, True]
    assert [r.late for r in watermark.late_for_window(df, "ts", "3 seconds").orderBy("pos").collect()] == [False, False, False, False, False, True]


def test_rows_without_a_time_are_not_late(spark):
    rows = [(0, dt(2024, 1, 1, 5)), (1, None), (2, dt(2024, 1, 1, 1))]
    got = watermark.late_for_window(spark.createDataFrame(rows, "pos long, ts timestamp_ntz"), "ts", "1 hour").collect()
    assert sorted((r.pos, r.late) for r in got) == [(0, False), (1, False), (2, True)]


def test_ema_is_sequential(spark):
    values = [3.0, -1.0, 4.0, 1.5, 9.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, i long, v double")
    want = values[0]
    for v in values[1:]:
        want = 0.3 * v + 0.7 * want
    for width in (1, 2, 10):
        assert ema(df, "k", "v", ["i"], F.floor(F.col("i") / width), 0.3).first().ema == pytest.approx(want)


def test_upsert_leaves_old_files(spark):
    table = commits.Table(spark, work_dir(spark))
    table.append(spark.createDataFrame([(i, 0, 0) for i in range(50)], "k long, v int, o int"))
    files = lambda: {r[0] for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{table.root}/data").select(F.input_file_name()).distinct().collect()}
    before = files()
    table.upsert(spark.createDataFrame([(7, 1, 1), (7, 2, 2), (99, 5, 1)], "k long, v int, o int"), ["k"], ["o"])
    got = [(r.k, r.v) for r in table.read().collect()]
    assert sorted(got) == sorted({**{i: 0 for i in range(50)}, 7: 2, 99: 5}.items())
    assert before <= files()


def feed(spark, path, rows):
    spark.createDataFrame(rows, "id long, v string").coalesce(1).write.mode("append").parquet(path)


def test_errors_stop_unless_handled(spark):
    root = work_dir(spark)
    feed(spark, f"{root}/in", [(1, "a")])

    def broken(batch, number):
        raise RuntimeError("broken batch")

    stream = lambda: spark.readStream.schema("id long, v string").parquet(f"{root}/in")
    seen = []
    streams.run_available(stream(), streams.guarded(broken, lambda e, n: seen.append(str(e)) or True), f"{root}/a")
    assert seen == ["broken batch"]
    for handler in (None, lambda e, n: False):
        with pytest.raises(Exception, match="broken batch"):
            streams.run_available(stream(), streams.guarded(broken, handler), work_dir(spark))


def test_resume_reads_only_new_files(spark):
    root = work_dir(spark)
    out = commits.Table(spark, f"{root}/out")
    for part in range(3):
        feed(spark, f"{root}/in", [(part, "x")])
        stream = spark.readStream.schema("id long, v string").parquet(f"{root}/in")
        streams.run_available(stream, out.append_once, f"{root}/checkpoint")
    assert {(r.id, r.version) for r in out.added(-1).collect()} == {(0, 0), (1, 1), (2, 2)}


def test_stream_is_like_batch(spark):
    root = work_dir(spark)
    rows = [(i, "ab"[i % 2]) for i in range(9)]
    for k in range(3):
        feed(spark, f"{root}/in", rows[k::3])
    count = lambda df: df.groupBy("v").agg(F.count("*").alias("n"))
    stream = spark.readStream.schema("id long, v string").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    got = streams.latest(streams.to_table(count(stream), "update"), ["v"])
    assert sorted(got.collect()) == sorted(count(spark.read.parquet(f"{root}/in")).collect())


def test_schema_without_a_run(spark):
    df = spark.createDataFrame([], "a long, b string")
    assert df.where("a > 0").select("b").schema.simpleString() == "struct<b:string>"


def test_accounts_without_limit_or_risk_come_out(spark):
    exposures = spark.createDataFrame([(1, 5.0, 0.1), (2, 50.0, None), (3, 5.0, None), (4, 5.0, 0.1), (5, 5.0, 0.9)], "a long, exposure double, var double")
    limits = spark.createDataFrame([(1, 10.0, 0.5), (2, 10.0, 0.5), (3, 10.0, 0.5), (5, 10.0, 0.5)], "a long, max_notional double, max_var double")
    got = {r.a: r.status for r in analytics.breaches(exposures, limits, "a").collect()}
    assert got == {1: "OK", 2: "BREACH", 3: "UNKNOWN", 4: "UNKNOWN", 5: "BREACH"}


def test_correlated_pairs_of_the_tables_own_types(spark):
    rows = [(k, i, {"a": 100 + i % 7, "b": 200 + 2 * (i % 7), "new": 50 + i * i % 5, "few": 1.0}[k]) for i in range(40) for k in ("a", "b", "new", "few") if k != "few" or i < 10]
    df = spark.createDataFrame([(k, i, float(v)) for k, i, v in rows] + [(None, 1, 1.0)], "k string, i long, v double")
    pairs = analytics.key_pairs(df, "k")
    assert sorted(map(tuple, pairs.collect())) == [("a", "b"), ("a", "few"), ("a", "new"), ("b", "few"), ("b", "new"), ("few", "new")]
    corr = analytics.correlations(df, pairs, "k", "v", [F.desc("i")])
    assert {(r.a, r.b) for r in corr.collect()} == {("a", "b"), ("a", "new"), ("b", "new")}
    assert [(r.a, r.b) for r in analytics.high_correlations(corr).collect()] == [("a", "b")]
    assert analytics.key_pairs(df.where("false"), "k").collect() == []
    with pytest.raises(ValueError, match="more than 3"):
        analytics.key_pairs(df, "k", most=3)
