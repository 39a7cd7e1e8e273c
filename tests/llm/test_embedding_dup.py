import numpy as np
import pytest

from flowtables.llm import embedding_dup as E


def table(seed=0, n=90, dim=32, noise=0.02):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for label in (1, 1, 2):
        for v in rng.normal(size=(n // 6, dim)):
            for _ in range(int(rng.integers(1, 5))):
                rows.append((at, (v + noise * rng.normal(size=dim) * float(rng.random() * 8)).astype(np.float32).tolist(), label))
                at += 1
    same = rows[0][1]
    rows += [(500 + i, same, 1) for i in range(5)] + [(600, [2 * x for x in same], 1), (601, same, 3), (602, same, None)]
    rows += [(603, None, 1), (604, [0.0] * dim, 1), (605, [float("nan")] + same[1:], 1), (606, [None] + same[1:], 1), (607, [], 1), (608, [float("inf")] + same[1:], 1), (609, [1.0, 2.0], 1)]
    return rows


def brute(rows, cosine):
    def sound(v):
        return bool(v) and None not in v and bool(np.isfinite(v).all()) and any(v)

    n, root = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    good = [(i, np.array(v, np.float64), l) for i, v, l in rows if l is not None and v is not None and sound(v)]
    for x, (i, a, l) in enumerate(good):
        for j, b, k in good[x + 1 :]:
            if l == k and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                n[i] += 1
                n[j] += 1
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: (n[i], find(i), find(i) == i) for i in n}


@pytest.mark.parametrize("block,cells", [(1024, False), (16, False), (16, True)])
def test_against_brute_force(spark, monkeypatch, block, cells):
    monkeypatch.setattr(E, "BLOCK", block)
    if cells:  # several rounds of sign cells even for small labels
        monkeypatch.setattr(E, "rounds_for", lambda n, cosine: (3, 40) if n > 20 else (0, 1))
    rows = table()
    df = spark.createDataFrame([(i, v, l, "x") for i, v, l in rows], "vec_id long, embedding array<float>, label int, n_links string").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in E.near_vectors(df).collect()}
    want = brute(rows, 0.98)
    assert got == want and max(n for n, _, _ in want.values()) > 5


def test_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, E.near_vectors(df).collect()), key=repr) == sorted([(None, 0, None, False), (4, 0, 4, True)], key=repr)
    assert E.near_vectors(df.where("vec_id < 0")).collect() == []


def test_windows_keep_pairs_at_the_limit():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.98001 * a + np.sqrt(1 - 0.98001**2) * side
    for at in range(0, 3000, 500):
        i, j = E.linked(a[at : at + 500], b[at : at + 500], 0.98)
        assert set(range(500)) <= {int(x) for x, y in zip(i, j, strict=True) if x == y}


def test_rounds():
    assert E.rounds_for(1000, 0.98) == (0, 1)
    bits, rounds = E.rounds_for(10**7, 0.98)
    meet = (1 - np.arccos(0.98) / np.pi) ** bits
    assert bits > 10 and (1 - meet) ** rounds <= E.LOSS
