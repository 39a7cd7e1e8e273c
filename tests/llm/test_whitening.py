"""Whitening against numpy's eigenvectors of the exact covariance."""

import math

import numpy as np
import pytest

from flowtables.llm import whitening
from flowtables.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, n long, x string"


def plain(vectors, components=16):
    """n, S, and for each distinct vector the whitened values, by numpy."""
    x = np.array([[math.floor(64 * float(c)) + 1000000 for c in v] for v in vectors], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = (n * fit - s) / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)[:components]
    return n, s, x, e[order], q[:, order], e.sum()


def check(rows, vectors, components):
    n, s, x, e, q, trace = plain(vectors, components)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert len(by_id) == len(vectors)
    y = np.array([[by_id[i][k + 1].whitened for k in range(len(e))] for i in range(len(vectors))])
    want = ((n * x - s) / n) @ q / np.sqrt(e)
    flip = np.sign((y * want).sum(0))
    assert np.allclose(y, want * flip, rtol=1e-8, atol=1e-8)
    for i in range(len(vectors)):
        assert by_id[i][1].deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s, strict=True)) and by_id[i][1].n == n
    assert np.allclose([by_id[0][k + 1].explained for k in range(len(e))], e / trace, rtol=1e-9)
    assert 0 <= by_id[0][1].identity_error < 1e-8


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 24)) * 2
    vectors = (centres[rng.integers(5, size=300)] + rng.normal(size=(300, 24)) * 0.4).astype(np.float32)
    vectors[50:80] = vectors[10]  # repeats count once
    rows = [(i, v.tolist(), 1, 7, "clash") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(whitening.transform(df, whitening.fit(df)).collect(), vectors, 16)


def test_equal_variances_are_all_found(spark):
    # +-1 along each axis: every eigenvalue is the same but for the third axis, so one Krylov space has two directions
    vectors = []
    for d in range(6):
        for sign in (1.0, -1.0):
            v = [0.0] * 6
            v[d] = sign * (3 if d == 2 else 1)
            vectors.append(v)
    df = spark.createDataFrame([(i, v, 0, 0, "") for i, v in enumerate(vectors)], SCHEMA)
    model = whitening.fit(df)
    x = np.array(vectors) * 64
    assert np.allclose(model.deviations**2, [2 * 192**2 / 12, *[2 * 64**2 / 12] * 5]) and model.identity_error < 1e-9
    y = x @ model.components / model.deviations
    assert np.allclose(y.T @ y / 12, np.eye(6), atol=1e-9)


def test_many_dimensions_stop_early(spark):
    rng = np.random.default_rng(9)
    base = np.linalg.qr(rng.normal(size=(120, 120)))[0]
    vectors = (rng.normal(size=(400, 120)) * np.concatenate([[40, 30, 22, 15, 10, 7], np.full(114, 0.5)])) @ base
    df = spark.createDataFrame([(i, v.tolist(), 0, 0, "") for i, v in enumerate(vectors)], SCHEMA)
    check(whitening.transform(df, whitening.fit(df, components=6)).collect(), vectors.astype(np.float32), 6)


def test_odd_rows(spark):
    ok = [[1.0, 2.0], [3.0, 1.0], [-1.0, 0.25]]
    rows = [(i, v, None, 1, None) for i, v in enumerate(ok)]
    bad = [(9, None, 0, 0, ""), (8, [1.0, None], 0, 0, ""), (7, [float("nan"), 1.0], 0, 0, ""), (6, [float("inf"), 1.0], 0, 0, ""), (5, [1e30, 1.0], 0, 0, ""), (4, [], 0, 0, ""), (3, [1.0], 0, 0, "")]
    repeats = [(0, ok[0], 1, 1, ""), (None, ok[1], 1, 1, "")]
    df = spark.createDataFrame(rows + bad + repeats, SCHEMA)
    got = whitening.transform(df, whitening.fit(df)).collect()
    assert sorted((r.vec_id, r.component) for r in got if r.vec_id is not None) == sorted([(i, c) for i in (0, 0, 1, 2) for c in (1, 2)]) and len(got) == 10
    assert {r.n for r in got} == {3}
    for none in (df.where("vec_id < 0"), df.where("vec_id = 1"), df.where("vec_id = 9")):
        assert whitening.transform(none, whitening.fit(none)).count() == 0


def test_long_sums_are_exact():
    x = np.array([[1 << 39, 5], [7, 9]], np.int64)
    n, total = 1 << 30, [1 << 60, 123456789]
    want = [sum((n * int(a) - b) ** 2 for a, b in zip(r, total, strict=True)) for r in x]
    assert whitening._deviation(x, n, total) == [v if v < 1 << 63 else None for v in want]
    small = np.array([[3, 5]], np.int64)
    assert whitening._deviation(small, 2, [4, 6]) == [20]


def test_query(spark):
    import duckdb

    vectors = [r[0] for r in duckdb.sql("select embedding from '/root/testdata/sf0.001/embeddings.parquet' order by vec_id").fetchall()]
    rows = QUERIES["op11_embedding_whitening"](spark, "/root/testdata/sf0.001").collect()
    ids = [r[0] for r in duckdb.sql("select vec_id from '/root/testdata/sf0.001/embeddings.parquet' order by vec_id").fetchall()]
    assert ids == list(range(len(ids)))
    check(rows, vectors, 16)
