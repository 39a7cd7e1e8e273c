"""Aggregates that the caller writes, against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from flowtables import accumulate

ROW = "k string, d date, ts long, v double"


def ema(values, alpha):
    out = None
    for v in values:
        out = v if out is None else alpha * v + (1 - alpha) * out
    return out


def rows_of(n, seed=1):
    rnd = random.Random(seed)
    return [(rnd.choice(["a", "a", "a", "b", None]), None, i, rnd.choice([None, 0.0, -3.5, rnd.uniform(0.01, 500)])) for i in rnd.sample(range(n), n)]


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r[2]):
        out.setdefault(r[0], []).append(r)
    return {k: [r[3] for r in g if r[3] is not None] for k, g in out.items()}


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_ordered(spark, monkeypatch, block):
    monkeypatch.setattr(accumulate, "FAN", 3)
    rows = rows_of(300)
    df = spark.createDataFrame(rows, ROW).repartition(5)
    got = accumulate.aggregate(df, ["k", "d"], {"e": accumulate.ema("v", 0.1), "m": accumulate.mean("v")}, order=["ts"], slot=F.floor(F.col("ts") / 10), block=block).collect()
    want = by_key(rows)
    assert {r.k for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert r.d is None
        assert math.isclose(r.e, ema(want[r.k], 0.1), rel_tol=1e-9)
        assert math.isclose(r.m, sum(want[r.k]) / len(want[r.k]), rel_tol=1e-9)


@pytest.mark.parametrize("share", [0, 0.25, 0.5, 0.99, 1])
def test_quantile_within_its_error(spark, share):
    rows = rows_of(500, 2)
    got = accumulate.aggregate(spark.createDataFrame(rows, ROW).repartition(6), ["k"], {"q": accumulate.quantile("v", share)}).collect()
    for r in got:
        values = sorted(by_key(rows)[r.k])
        true = values[math.floor(share * (len(values) - 1))]
        assert math.isclose(r.q, true, rel_tol=0.0101, abs_tol=1e-12)


def test_states_put_out_early(spark, monkeypatch):
    """A caller's own aggregate, with more keys than a task holds states of."""
    monkeypatch.setattr(accumulate, "MOST_STATES", 2)
    longest = accumulate.Aggregate(("s",), lambda: "", lambda s, rows: max([s, *[x for x in rows["s"].to_pylist() if x]], key=lambda x: (len(x), x)), lambda a, b: max(a, b, key=lambda x: (len(x), x)), lambda s: s or None, "string")
    rows = [(i % 11, "x" * (i % 17)) for i in range(200)] + [(99, None)]
    got = dict(accumulate.aggregate(spark.createDataFrame(rows, "k int, s string").repartition(4), ["k"], {"s": longest}).collect())
    want = {}
    for k, s in rows:
        want[k] = max(want.get(k, ""), s or "", key=len)
    assert got == {k: v or None for k, v in want.items()}


def test_edges(spark):
    agg = {"m": accumulate.mean("v"), "q": accumulate.quantile("v", 0.5)}
    empty = spark.createDataFrame([], ROW)
    assert accumulate.aggregate(empty, ["k"], agg).collect() == [] and accumulate.aggregate(empty, [], agg).collect() == []
    one = accumulate.aggregate(spark.createDataFrame([("a", None, 1, None), ("b", None, 2, 4.0)], ROW), [], agg).collect()
    assert len(one) == 1 and one[0].m == 4.0 and math.isclose(one[0].q, 4.0, rel_tol=0.01)
    nothing = accumulate.aggregate(spark.createDataFrame([("a", None, 1, None)], ROW), ["k"], agg).collect()
    assert nothing == [("a", None, None)]
    with pytest.raises(ValueError, match="floating"):
        accumulate.aggregate(empty, ["v"], agg)
    with pytest.raises(ValueError, match="slot"):
        accumulate.aggregate(empty, ["k"], agg, order=["ts"])


def test_infinite_and_nan_values(spark):
    rows = [("a", None, 1, float("nan")), ("a", None, 2, float("inf")), ("a", None, 3, float("-inf")), ("a", None, 4, 2.0)]
    for share, want in ((0, -math.inf), (0.5, 2.0), (1, math.inf)):
        got = accumulate.aggregate(spark.createDataFrame(rows, ROW), ["k"], {"q": accumulate.quantile("v", share)}).first().q
        assert got == want or math.isclose(got, want, rel_tol=0.01)
