"""What running streams keep, against plain Python and the batch functions."""

import random
from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from flowtables import live, windows
from flowtables.commits import Table
from flowtables.tables import work_dir

T0 = dt(2024, 1, 1)
ROW = "id long, k string, ts timestamp_ntz, v long"


def minute(m):
    return None if m is None else T0 + timedelta(minutes=m)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_late_rows_are_kept(spark):
    rnd = random.Random(5)
    batches = [[(b * 100 + i, "a", minute(rnd.choice([None, rnd.randrange(b * 20, b * 20 + 60)])), i) for i in range(rnd.choice([5, 12]))] for b in range(3)]
    split = live.Lateness(spark, work_dir(spark), "ts", delay="5 minutes", closes=windows.end_of("ts", "10 minutes"))
    want, top = set(), None
    for n, batch in enumerate(batches):
        for _ in range(2):
            split.step(spark.createDataFrame(batch, ROW), n)
        mark = top and top - timedelta(minutes=5)
        want |= {(r[0], bool(mark and r[2] and r[2].replace(minute=r[2].minute // 10 * 10) + timedelta(minutes=10) <= mark)) for r in batch}
        top = max([r[2] for r in batch if r[2]] + [top] * (top is not None), default=None)
    got = [(r.id, False) for r in split.on_time.read().collect()] + [(r.id, True) for r in split.late.read().collect()]
    assert len(got) == len(want) and set(got) == want and any(x for _, x in want)
    progress = split.progress.read().orderBy("batch").collect()
    assert [r.n for r in progress] == [len(b) for b in batches] and all(r.n == r.on_time + r.late for r in progress)
    assert progress[0].watermark is None and progress[2].watermark == max(r[2] for b in batches[:2] for r in b if r[2]) - timedelta(minutes=5)
    split.step(spark.createDataFrame([], ROW), 3)
    assert split.progress.read().where("batch = 3").first().n == 0


def test_a_failed_split_is_done_again(spark, monkeypatch):
    split = live.Lateness(spark, work_dir(spark), "ts")
    split.step(spark.createDataFrame([(1, "a", minute(10), 1)], ROW), 0)
    batch = spark.createDataFrame([(2, "a", minute(10), 1), (3, "a", minute(11), 1)], ROW)
    put = split.progress.append_once
    monkeypatch.setattr(split.progress, "append_once", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        split.step(batch, 1)
    monkeypatch.setattr(split.progress, "append_once", put)
    split.step(batch, 1)
    assert [r.id for r in split.late.read().collect()] == [2] and sorted(r.id for r in split.on_time.read().collect()) == [1, 3]


def test_what_the_split_lets_through_spark_does_not_drop(spark):
    """Rows on time, read as a stream with the same delay, meet no window that is closed; all rows as a stream do."""
    root, seen = work_dir(spark), {}
    split = live.Lateness(spark, f"{root}/split", "ts", delay="5 minutes", closes=windows.end_of("ts", "10 minutes"))
    batches = [[(1, "a", minute(0), 1), (2, "a", minute(40), 1)], [(3, "a", minute(1), 1), (4, "a", minute(55), 1)], [(5, "a", minute(2), 1), (6, "a", minute(70), 1)], [(7, "a", minute(3), 1)]]
    for name in ("all", "on_time"):
        dropped, ids = 0, []
        for n, batch in enumerate(batches):
            df = spark.createDataFrame(batch, ROW)
            if name == "on_time":
                split.step(df, n)
                df = split.on_time.added(-1 if n == 0 else split.on_time.version() - 1).select("id", "k", "ts", "v")
            df.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(f"{root}/{name}")
            stream = spark.readStream.schema("id long, k string, ts timestamp, v long").parquet(f"{root}/{name}").withWatermark("ts", "5 minutes")
            query = windows.tumble(stream, "ts", size="10 minutes", keys=["id"], aggs=[F.count("*").alias("n")]).writeStream.outputMode("update").option("checkpointLocation", f"{root}/c-{name}")
            run = query.trigger(availableNow=True).foreachBatch(lambda b, i: ids.extend(r.id for r in b.collect())).start()
            run.awaitTermination()
            dropped += sum(int(s["numRowsDroppedByWatermark"]) for p in run.recentProgress for s in p["stateOperators"])
        seen[name] = (dropped, sorted(set(ids)))
    late = sorted(r.id for r in split.late.read().collect())
    assert late == [3, 5, 7] and seen["on_time"] == (0, [1, 2, 4, 6])
    assert seen["all"][0] > 0 and set(seen["all"][1]) >= {1, 2, 4, 6} and set(range(1, 8)) - set(seen["all"][1]) <= set(late)


def test_watermarks_of_the_producer(spark):
    schema = "id long, ts timestamp_ntz, sent timestamp_ntz, pos long"
    come = [(1, minute(5), None, 0), (None, None, minute(5), 1), (2, minute(5), None, 2), (3, minute(6), None, 3), (None, None, minute(2), 4), (4, minute(4), None, 5), (5, None, None, 6), (None, None, minute(9), 7), (6, minute(9), None, 8), (7, minute(10), None, 9)]
    for cuts in ([10], [1, 5, 10], [8, 10]):
        split, at = live.Lateness(spark, work_dir(spark), "ts", sent="sent", pos="pos"), 0
        for n, end in enumerate(cuts):
            split.step(spark.createDataFrame(come[at:end], schema), n)
            at = end
        assert sorted(r.id for r in split.late.read().collect()) == [2, 4, 6]
        assert {r.id: r.watermark for r in split.on_time.read().collect()} == {1: None, 3: minute(5), 5: minute(5), 7: minute(9)}
    with pytest.raises(ValueError):
        live.Lateness(spark, work_dir(spark), "ts", sent="sent")


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_in_any_order(spark, seed):
    rnd = random.Random(seed)
    come = [(i, rnd.choice(["a", "b", None]), minute(rnd.choice([None, *range(0, 120, 3)])), i) for i in range(30)]
    sessions = live.SessionChanges(spark, work_dir(spark), "ts", "10 minutes", ["k"], {"n": ("count", "v"), "total": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v")})
    rnd.shuffle(come)
    for n in range(3):
        for _ in range(2):
            sessions.step(spark.createDataFrame(come[n::3], ROW), n)
    aggs = [F.count("v").alias("n"), F.sum("v").alias("total"), F.min("v").alias("low"), F.max("v").alias("high")]
    want = windows.session(spark.createDataFrame(come, ROW), "ts", gap="10 minutes", keys=["k"], aggs=aggs)
    assert rows(sessions.result().select(*want.columns)) == rows(want)


def test_session_steps(spark):
    sessions = live.SessionChanges(spark, work_dir(spark), "ts", "10 minutes", ["k"], {"n": ("count", "v")})
    step = lambda n, *at, **more: sessions.step(spark.createDataFrame([(0, "a", minute(m), 1) for m in at], ROW), n, **more)
    step(0, 0, 20)
    step(1, 10)  # joins both, ends included
    step(2, 60, watermark=F.lit("2024-01-01 00:45:00").cast("timestamp_ntz"))
    got = [(r.batch, r.op, r.window_start, r.window_end, r.n) for r in sessions.changes().orderBy("batch", "window_start").collect()]
    assert got == [(0, "I", minute(0), minute(10), 1), (0, "I", minute(20), minute(30), 1), (1, "U", minute(0), minute(30), 3), (1, "D", minute(20), minute(30), 1), (2, "I", minute(60), minute(70), 1)]
    assert [r.window_start for r in sessions.state.read().collect()] == [minute(60)]  # the first one is out of reach
    assert sessions.result().count() == 2


def test_last_rows(spark):
    rnd = random.Random(4)
    come = [(i, rnd.choice(["a", "b", None]), minute(rnd.choice([None, *range(9)])), rnd.randrange(3)) for i in range(24)]
    last = live.LastRows(spark, work_dir(spark), ["k"], ["ts"], 3)
    for n in range(3):
        for _ in range(2):
            last.step(spark.createDataFrame(come[n::3], ROW), n)
    want = []
    for k in ("a", "b", None):
        mine = sorted((r for r in come if r[1] == k), key=lambda r: (r[2] is not None, r[2] or T0, r[0], r[3]), reverse=True)
        want += [(*r, i + 1) for i, r in enumerate(mine[:3])]
    assert rows(last.read().select("id", "k", "ts", "v", "back")) == sorted(want, key=repr)


def test_lookup_keeps_the_version_of_a_batch(spark, monkeypatch):
    root, like = work_dir(spark), spark.createDataFrame([], "k string, r long").schema
    reference = Table(spark, f"{root}/ref")
    lookup = live.Lookup(spark, f"{root}/lookup", reference, like, ["k"])
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, k string")
    lookup.step(batch, 0)  # no version yet
    reference.append(spark.createDataFrame([("a", 10), (None, 9)], like))
    put = lookup.out.append_once
    monkeypatch.setattr(lookup.out, "append_once", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        lookup.step(batch, 1)
    monkeypatch.setattr(lookup.out, "append_once", put)
    reference.upsert(spark.createDataFrame([("a", 20), ("b", 21)], like), ["k"], [])
    for number in (1, 2, 1, 0):
        lookup.step(batch, number)
    got = {(r.version, r.id): r.r for r in lookup.out.read().collect()}
    assert got == {(-1, 1): None, (-1, 2): None, (-1, 3): None, (0, 1): 10, (0, 2): None, (0, 3): None, (1, 1): 20, (1, 2): 21, (1, 3): None}
    with pytest.raises(ValueError, match="both sides have r"):
        lookup.step(batch.withColumnRenamed("id", "r"), 3)
