"""Repeated strings against brute force, and the suffix arrays against sorted suffixes."""

import hashlib
import random

import numpy as np
import pytest

from flowtables.llm import repeats as R
from flowtables.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n_bytes long, spans string, kept string, d1 long"


def brute(docs, length, keep_first):
    """For each row, in order of ids and then as given: n_bytes, n_removed, n_spans and the kept bytes."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    seen = {}
    data = [(t or "").encode() for _, t in docs]
    for i in order:
        for s in range(len(data[i]) - length + 1):
            seen.setdefault(data[i][s : s + length], []).append((i, s))
    out = []
    for i, b in enumerate(data):
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            places = seen[b[s : s + length]]
            if len(places) > 1 and (not keep_first or places[0] != (i, s)):
                gone[s : s + length] = b"\x01" * length
        runs = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((docs[i][0], len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def made(seed, n=60, letters="abcdefgh é"):
    """Documents with passages of others: whole, cut off, overlapping, with a byte changed, repeated inside, and periodic ones."""
    rnd = random.Random(seed)
    word = lambda k: "".join(rnd.choice(letters) for _ in range(k))
    passages = [word(rnd.randrange(20, 160)) for _ in range(6)]
    docs = []
    for i in range(n):
        kind = rnd.randrange(7)
        p = rnd.choice(passages)
        if kind == 0:
            t = word(rnd.randrange(200))
        elif kind == 1:
            t = word(rnd.randrange(40)) + p + word(rnd.randrange(40))
        elif kind == 2:
            t = word(9) + p[rnd.randrange(20) :][: rnd.randrange(150)] + word(3) + rnd.choice(passages)
        elif kind == 3:
            at = rnd.randrange(len(p))
            t = p[:at] + "#" + p[at + 1 :]
        elif kind == 4:
            t = p + p
        elif kind == 5:
            t = rnd.choice(["a", "ab", "abc "]) * rnd.randrange(10, 80)
        else:
            t = docs[rnd.randrange(len(docs))][1] if docs else p
        docs.append((i, t))
    return docs


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed, keep_first):
    docs = made(seed)
    df = spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in docs], SCHEMA)
    # small blocks, pieces and batches, so that all boundaries are crossed
    options = [{}, {"block": 2, "piece": 64, "batch_bytes": 200, "spread": 12}, {"block": 1, "piece": 37, "batch_bytes": 1, "spread": 7}][seed - 1]
    assert got(R.without_repeats(df, length=32, gram=8, keep_first=keep_first, **options)) == brute(docs, 32, keep_first)


def test_odd_rows(spark):
    p = "é" * 30 + "xyz" * 40
    docs = [(1, None), (2, ""), (3, "short"), (4, p), (None, "q" + p), (5, p), (5, p), (5, "other"), (6, None)]
    df = spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in docs], SCHEMA)
    assert got(R.without_repeats(df, length=32, gram=8, keep_first=False)) == brute(docs, 32, False)
    once = docs[:5] + docs[6:]
    assert got(R.without_repeats(df.where("doc_id < 5 or doc_id is null").union(df.where("doc_id >= 5").dropDuplicates()), length=32, gram=8)) == brute(once, 32, True)
    # rows equal in id and text stand at one place: all of document 5 repeats document 4
    assert all(r[2] == r[1] for r in got(R.without_repeats(df, length=32, gram=8)) if r[0] == 5 and r[1] > 10)
    assert R.without_repeats(df.where("doc_id > 99")).count() == 0


def test_suffix_arrays():
    rnd = random.Random(5)
    for _ in range(60):
        parts = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 60))).encode() for _ in range(rnd.randrange(1, 9))]
        raw = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        starts = ends - [len(p) for p in parts]
        length = rnd.choice([8, 9, 13, 16, 24])
        at, order, lcp = R.suffix_order(raw, starts, ends, length)
        suffixes = [p[i:] for p in parts for i in range(len(p)) if len(p) - i >= length]
        assert at.tolist() == [int(s) + i for p, s in zip(parts, starts, strict=True) for i in range(len(p)) if len(p) - i >= length]
        same = lambda x, y: next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
        assert [suffixes[i][:length] for i in order] == sorted((s[:length] for s in suffixes))
        assert lcp.tolist()[1:] == [min(length, same(suffixes[a], suffixes[b])) for a, b in zip(order, order[1:], strict=False)]
        position = rnd.sample(range(1000), len(suffixes))
        least = rnd.choice([1, 3, length])
        earlier, later = R.longest_factors(order, lcp, np.array(position), least)
        for i, s in enumerate(suffixes):
            for found, sign in ((earlier, 1), (later, -1)):
                best = max((min(length, same(s, o)) for j, o in enumerate(suffixes) if sign * position[j] < sign * position[i]), default=0)
                assert found[i] == (best if best >= least else 0)


def test_alternating_texts(spark):
    # two texts that differ in a Thue-Morse pattern around a common middle: sums of powers modulo 2^64 by single bytes are the same
    signs = np.ones(1, int)
    for step in (1, 2, 4, 8, 16, 32, 64, 128, 384):
        signs = np.concatenate([np.zeros(step, int), signs]) - np.concatenate([signs, np.zeros(step, int)])
    middle = "pu nqmtsuu  vlkqovuprrvkqspv uqvksnnstvmvuokuupmlotokstmrpqksnrprlostoktqsmpvvosluno rvmt lnlnokvnvtmtullokpqsrpmrputtronprollkm"
    docs = [(i, "".join("L" if c == sign else "0" for c in signs[:256]) + middle + "".join("L" if c == sign else "0" for c in signs[384:])) for i, sign in enumerate((1, -1))]
    df = spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in docs], SCHEMA)
    for keep_first in (False, True):
        assert got(R.without_repeats(df, keep_first=keep_first)) == brute(docs, 400, keep_first)
    assert sum(r[2] for r in brute(docs, 400, False)) == 0


def test_anchor_windows():
    rng = np.random.default_rng(2)
    for width in (1, 3, 10):
        for high in (3, 1 << 44):
            values = rng.integers(0, high, 50).astype(np.uint64) << np.uint64(20)
            want = [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]
            assert R.least_in_window(values, width).tolist() == want


def test_query(spark):
    import duckdb

    docs = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    want = [(i, n, r, s, hashlib.sha256(k).hexdigest()) for i, n, r, s, k in brute(docs, 400, False)]
    rows = QUERIES["op13_suffix_array_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=repr) == sorted(want, key=repr)
    assert sum(r[2] for r in want) > 0
