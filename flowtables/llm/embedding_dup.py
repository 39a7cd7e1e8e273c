"""Embedding near-dedup by collision-counting projections.

Vectors of one label are projected on PROJECTIONS orthonormal directions. Each projection is sorted, and a query collides
with every vector in a window of HALF_WIDTH around its own value. Two linked vectors are close, so they collide in most
projections; pairs that reach a count set by the wanted recall are verified by their cosine in double precision.

Counting is done in blocks of bounded size. Labels too large for all of their blocks are first dealt into cells by the signs
of a few random projections, in several rounds, as many as it takes to bring every linked pair together but for LOSS; a
pair is counted in the first round in which its vectors share a cell.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import components
from flowtables.tables import cut

PROJECTIONS, HALF_WIDTH, LOSS = 24, 2.5, 1e-9
BLOCK, CELL, LEAST_BITS, MOST_BITS = 1024, 512, 6, 20


def rounds_for(n: int, cosine: float) -> tuple[int, int]:
    """(sign bits, rounds) for a label of n vectors: none and one, unless cells of about CELL vectors cost less."""
    bits = min(MOST_BITS, math.ceil(math.log2(max(n, 1) / CELL))) if n > CELL else 0
    if bits < LEAST_BITS:
        return 0, 1
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(LOSS) / math.log(1 - meet))


def least_count(projections: int) -> int:
    """The number of windows that a linked pair hits but with probability LOSS: each is missed with that of 2.5 deviations."""
    miss, tail = math.erfc(HALF_WIDTH / math.sqrt(2)), 0.0
    for missed in range(projections, -1, -1):
        tail += math.comb(projections, missed) * miss**missed * (1 - miss) ** (projections - missed)
        if tail > LOSS:
            return projections - missed
    return 0


def directions(dim: int, n: int, seed: int) -> np.ndarray:
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, min(n, dim))))[0]
    return q[:, : min(n, dim)]


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


def linked(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into x, into y) with at least this cosine."""
    ux, uy = unit(x), unit(y)
    basis = directions(x.shape[1], PROJECTIONS, 17)
    m = basis.shape[1]
    # a pair at the limit differs by a vector of this length, whose parts along the directions have this deviation
    half = HALF_WIDTH * math.sqrt((2 - 2 * cosine) / x.shape[1]) if m == PROJECTIONS else math.sqrt(2 - 2 * cosine)
    px, py = ux @ basis, uy @ basis
    count = np.zeros((len(x), len(y)), np.uint8)
    for j in range(m):
        order = np.argsort(py[:, j], kind="stable")
        rank = np.empty(len(y), np.uint16)
        rank[order] = np.arange(len(y))
        line = py[order, j]
        lo, hi = np.searchsorted(line, px[:, j] - half), np.searchsorted(line, px[:, j] + half, "right")
        # a rank below the window wraps round to a large number
        count += (rank[None, :] - lo.astype(np.uint16)[:, None]) < (hi - lo).astype(np.uint16)[:, None]
    a, b = np.nonzero(count >= (least_count(m) if m == PROJECTIONS else m))
    close = np.zeros(len(a), bool)
    for at in range(0, len(a), 65536):
        s = slice(at, at + 65536)
        dot = np.einsum("ij,ij->i", x[a[s]], y[b[s]])
        close[s] = dot / np.sqrt(np.einsum("ij,ij->i", x[a[s]], x[a[s]]) * np.einsum("ij,ij->i", y[b[s]], y[b[s]])) >= cosine
    return a[close], b[close]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each of n is connected to by the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _count_block(cosine: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # each row says with its side whether it is in the pair's first block, the second, or both (a block with itself)
        rows = rows.sort_values("id", kind="stable").reset_index(drop=True)
        vectors = np.stack(rows.vector.to_numpy()).astype(np.float64)
        left, right = (np.flatnonzero(rows.side.isin(s).to_numpy()) for s in ((0, 2), (1, 2)))
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "n": [], "root": []})
        a, b = linked(vectors[left], vectors[right], cosine)
        a, b = left[a], right[b]
        keep = a != b
        if (rows.side == 2).any():
            keep &= a < b
        turn = int(rows.turn[0])
        if turn:
            cells = np.stack(rows.cells.to_numpy())[:, :turn]
            keep &= ~(cells[a] == cells[b]).any(1)
        a, b = a[keep], b[keep]
        n = np.zeros(len(rows), np.int64)
        copies = rows.copies.to_numpy()
        np.add.at(n, a, copies[b])
        np.add.at(n, b, copies[a])
        root = _roots(len(rows), a, b)
        some = np.flatnonzero(n)
        ids = rows.id.to_numpy()
        return pd.DataFrame({"id": ids[some], "n": n[some], "root": ids[root[some]]})

    return run


def _cells(cosine: float):
    def run(batches):
        for rows in batches:
            out = []
            for (dim, size), part in rows.groupby(["dim", "size"]):
                bits, turns = rounds_for(int(size), cosine)
                units = unit(np.stack(part.vector.to_numpy()).astype(np.float64))
                cells = np.zeros((len(part), turns), np.int64)
                for t in range(turns if bits else 0):
                    planes = np.random.default_rng(1000 + t).normal(size=(int(dim), bits))
                    cells[:, t] = (units @ planes > 0) @ (1 << np.arange(bits))
                out.append(part.assign(cells=list(cells)))
            if out:
                yield pd.concat(out)[["id", "label", "dim", "vector", "copies", "cells"]]

    return run


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98) -> DataFrame:
    """One row per vector: id_col, n_links, component_id, kept.

    Links vectors of equal, not null labels (and equal length) whose cosine in double precision is at least `cosine`.
    n_links counts the vectors a vector is linked with directly, component_id is the smallest id reachable by links, kept
    tells whether it is the vector's own.

    Vectors that are null, empty, zero, or hold null or non-finite parts, and rows with null label link with nothing: n_links 0,
    their own component. Rows with a null id get null component_id and kept false, and are counted for nobody. Rows that
    repeat an id are vectors of their own that share it. An empty table gives an empty one; other columns are not looked at.

    Equal vectors of a label are one class that is compared once and counted as often as it has copies; no pairs
    are written, only each vector's count and root in a block.
    """
    spark = vectors.sparkSession
    v = F.col("vector")
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    base = base.withColumn("sound", F.coalesce(sound, F.lit(False)) & F.col("label").isNotNull() & F.col("id").isNotNull())
    # -0.0 and 0.0 are one value, in the class as in the cosine
    base = cut(base.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0))).withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")}))
    good = base.where("sound")
    classes = cut(good.groupBy("label", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    reps = good.join(classes.select("label", "h1", "h2", F.col("rep").alias("id"), "copies"), ["label", "h1", "h2", "id"]).dropDuplicates(["label", "h1", "h2"])
    reps = reps.select("id", F.col("label").cast("string").alias("label"), F.size("vector").alias("dim"), "vector", "copies")
    sizes = reps.groupBy("label", "dim").agg(F.count("*").alias("size"))
    dealt = cut(reps.join(cut(sizes), ["label", "dim"]).mapInPandas(_cells(cosine), "id long, label string, dim int, vector array<double>, copies long, cells array<long>"))
    spread = dealt.select("*", F.posexplode("cells").alias("turn", "cell"))
    held = cut(spread.groupBy("label", "dim", "turn", "cell").agg(F.count("*").alias("held")).where("held > 1"))
    blocks = F.ceil(F.col("held") / BLOCK).cast("int")
    placed = spread.join(held, ["label", "dim", "turn", "cell"]).withColumn("of", blocks).withColumn("own", F.pmod(F.xxhash64("id"), "of").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    placed = placed.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)})
    counted = cut(placed.select("label", "dim", "turn", "cell", "i", "j", "side", "id", "vector", "copies", "cells").groupBy("label", "dim", "turn", "cell", "i", "j").applyInPandas(_count_block(cosine), "id long, n long, root long"))
    comps = components(counted, "id", "root")
    links = counted.groupBy("id").agg(F.sum("n").alias("n"))
    found = classes.join(links.withColumnRenamed("id", "rep"), "rep", "left").join(comps.withColumnRenamed("id", "rep"), "rep", "left")
    found = cut(found.select("label", "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")))
    out = good.select("id", "label", "h1", "h2").join(found, ["label", "h1", "h2"]).select("id", "n_links", "component")
    out = out.union(base.where("not sound").select("id", F.lit(0).cast("long"), "id"))
    return out.select(F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
