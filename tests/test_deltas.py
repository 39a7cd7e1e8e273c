"""Continuous joins and groupings of change logs against what the whole logs lead to, however they are dealt into batches."""

import random

import pytest
from pyspark.sql import functions as F

from flowtables import deltas
from flowtables.tables import work_dir

LEFT = "op string, lsn long, a long, k long, v string"
RIGHT = "op string, lsn long, b long, j long, w double"
MEASURES = {"n": ("count", "*"), "some": ("count", "w"), "total": ("sum", "w"), "mean": ("avg", "w"), "low": ("min", "w"), "high": ("max", "w")}


def log(rnd, size, values):
    """Changes of a few keys, null among them, in order of position."""
    return [(rnd.choice("IUUD"), n, rnd.choice([None, *range(6)]), rnd.choice([None, 0, 1, 2]), values(rnd)) for n in range(size)]


def table(rows):
    last = {}
    for op, _, key, *rest in sorted(rows, key=lambda r: r[1]):
        last[key] = None if op == "D" else (key, *rest)
    return [r for r in last.values() if r]


def split(rnd, rows, n):
    out = [[] for _ in range(n)]
    for r in rows:
        rnd.choice(out).append(r)
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def folded(df, keys):
    """The rows that a change log leads to; each change must fit what is there."""
    there = {}
    for r in df.orderBy("batch").collect():
        at = tuple(r[k] for k in keys)
        assert (at in there) == (r.op != "I") and r.op in "IUD"
        there[at] = tuple(r[c] for c in df.columns if c not in ("op", "batch"))
        if r.op == "D":
            del there[at]
    return sorted(there.values(), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_join_of_any_split(spark, seed):
    rnd = random.Random(seed)
    left, right = log(rnd, 30, lambda r: r.choice("xyz")), log(rnd, 30, lambda r: r.choice([None, 1.0, 2.5]))
    join = deltas.ChangeJoin(spark, work_dir(spark), ["a"], ["b"], [("k", "j")], "lsn")
    for n, (x, y) in enumerate(zip(split(rnd, left, 3), split(rnd, right, 3), strict=True)):
        join.step(spark.createDataFrame(x, LEFT), spark.createDataFrame(y, RIGHT), n)
    want = sorted(((a, b, k, v, j, w) for a, k, v in table(left) for b, j, w in table(right) if k is not None and k == j), key=repr)
    assert rows(join.result().select("a", "b", "k", "v", "j", "w")) == want
    assert folded(join.changes().select("op", "a", "b", "k", "v", "j", "w", "batch"), ["a", "b"]) == want


def test_a_failed_batch_is_done_again(spark, monkeypatch):
    join = deltas.ChangeJoin(spark, work_dir(spark), ["a"], ["b"], [("k", "j")], "lsn")
    make = lambda l, r: (spark.createDataFrame(l, LEFT), spark.createDataFrame(r, RIGHT))
    join.step(*make([("I", 1, 1, 7, "x")], [("I", 1, 1, 7, 1.0)]), 0)
    batch = make([("U", 2, 1, 7, "y")], [("U", 2, 1, 7, 2.0), ("I", 3, 2, 7, None)])
    put = join.out.append_once
    monkeypatch.setattr(join.out, "append_once", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        join.step(*batch, 1)  # the state has the batch, the output has not
    monkeypatch.setattr(join.out, "append_once", put)
    join.step(*batch, 1)
    join.step(*batch, 1)
    want = [("I", 1, 2, 1, "y", None), ("U", 1, 1, 1, "y", 2.0)]
    assert rows(join.changes().where("batch = 1").select("op", "a", "b", "batch", "v", "w")) == want
    join.step(*make([], []), 2)
    assert join.changes().where("batch = 2").count() == 0


def test_columns_on_both_sides(spark):
    join = deltas.ChangeJoin(spark, work_dir(spark), ["a"], ["a"], [("k", "k")], "lsn")
    with pytest.raises(ValueError):
        join.step(spark.createDataFrame([], LEFT), spark.createDataFrame([], LEFT), 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_any_split(spark, seed):
    rnd = random.Random(seed)
    changes = log(rnd, 40, lambda r: r.choice([None, 1.0, 2.5, 4.0, float("inf")]))
    group = deltas.ChangeGroup(spark, work_dir(spark), ["b"], ["j"], MEASURES, "lsn")
    for n, part in enumerate(split(rnd, changes, 3)):
        group.step(spark.createDataFrame(part, RIGHT), n)
        group.step(spark.createDataFrame(part, RIGHT), n)
    now = spark.createDataFrame(table(changes), "b long, j long, w double")
    want = now.groupBy("j").agg(F.count("*"), F.count("w"), F.sum("w"), F.avg("w"), F.min("w"), F.max("w"))
    assert rows(group.result().select("j", *MEASURES)) == rows(want)
    assert folded(group.changes().select("op", "j", *MEASURES, "batch"), ["j"]) == rows(want)


def test_group_steps(spark):
    group = deltas.ChangeGroup(spark, work_dir(spark), ["b"], ["j"], {"n": ("count", "*"), "low": ("min", "w")}, "lsn")
    step = lambda n, *changes: group.step(spark.createDataFrame(list(changes), RIGHT), n)
    step(0, ("I", 1, 1, 0, 5.0), ("I", 2, 2, 0, 3.0), ("I", 3, 3, 1, 9.0))
    step(1, ("D", 4, 2, 0, 3.0))  # the least goes
    step(2, ("U", 5, 3, 0, 9.0))  # to the other group; its own has no rows then
    step(3, ("U", 1, 3, 1, 9.0))  # older than what is there
    got = [(r.batch, r.op, r.j, r.n, r.low) for r in group.changes().orderBy("batch", "j").collect()]
    assert got == [(0, "I", 0, 2, 3.0), (0, "I", 1, 1, 9.0), (1, "U", 0, 1, 5.0), (2, "U", 0, 2, 5.0), (2, "D", 1, 1, 9.0)]
    with pytest.raises(ValueError):
        deltas.ChangeGroup(spark, work_dir(spark), ["b"], ["j"], {"n": ("median", "w")}, "lsn")
