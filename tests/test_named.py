"""Streams by name: the same rows as tables, after any number of runs."""

import random

import pytest
from pyspark.sql import functions as F

from flowtables import named, sinks
from flowtables.tables import work_dir

ROW = "id long, k string, v long"


def define(spark):
    made = named.Streams(spark, work_dir(spark), {"rows": spark.createDataFrame([], ROW).schema})
    made.define("big", lambda rows: rows.where("v > 2"), ["rows"])
    made.define("byk", lambda big: big.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s")), ["big"], ["k"])
    return made


def test_names():
    made = named.Streams(None, "/nowhere", {"rows": None})
    made.define("a", lambda r: r, ["rows"])
    for name, inputs in (("a", ["rows"]), ("rows", ["a"]), ("b", ["c"]), ("b", ["b"])):
        with pytest.raises(ValueError):
            made.define(name, lambda r: r, inputs)
    with pytest.raises(ValueError, match="no stream c"):
        made.table("c")


def test_schema_and_rows_before_a_run(spark):
    made = define(spark)
    assert made.schema("byk").simpleString() == "struct<k:string,n:bigint,s:bigint>"
    assert made.ask("byk", "n > 1").count() == 0 and made.ask("big").columns == ["id", "k", "v"]


def test_any_split_into_runs(spark):
    rnd, made, root = random.Random(3), define(spark), work_dir(spark)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([None, 1, 3, 5])) for i in range(60)]
    seen = []
    for part in (rows[:7], rows[7:8], [], rows[8:]):
        seen += part
        if part:
            sinks.append(spark.createDataFrame(part, ROW), f"{root}/in")
        for name in ("big", "byk"):
            made.run(name, {"rows": spark.readStream.schema(ROW).parquet(f"{root}/in")})
        table = spark.createDataFrame(seen, ROW)
        for name, where in (("big", "k is null"), ("byk", "n > 1"), ("byk", None)):
            want = made.over(name, {"rows": table})
            want = want.where(where) if where else want
            assert sorted(map(tuple, made.ask(name, where).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert made.ask("big", version=0).count() == sum((r[2] or 0) > 2 for r in rows[:7])


def test_source_columns_that_no_one_declared(spark):
    made = define(spark)
    wide = spark.createDataFrame([(1, "a", 3, "x")], ROW + ", n string")
    assert made.over("byk", {"rows": wide}).collect() == [("a", 1, 3)]
