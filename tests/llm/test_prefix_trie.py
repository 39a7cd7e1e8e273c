"""The trie against one built turn by turn in plain Python, and its parts."""

import hashlib
import random
import re
import zlib

import pytest

from flowtables.llm import prefix_trie as P
from flowtables.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, n long, p string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in sorted(((r[0], (r[1] is not None, r[1] or 0), r[2] or "", r[3] or "") for r in rows if r[0] is not None)):
        own.setdefault(c, []).append((role, text))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    return out


def plain(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = sum(all(o == p or o[: len(p)] != p for o in nodes) for p in below)
        saved = sum((len(nodes[p]) - 1) * len(re.findall(P.WORD, p[-1][1])) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(path))))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def spliced(df):
    return P.prefix_trie(df, donor=lambda c: c - c % 20, take=lambda c: P.F.crc32(c.cast("string")) % 4)


def made(seed, n):
    """Conversations of few different turns, so that they share prefixes of all lengths."""
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, t, rnd.choice(["user", "assistant"]), " ".join(rnd.choice(["a", "bb", "é c"]) for _ in range(rnd.randrange(2))), 1, "x"))
    return rows


@pytest.mark.parametrize("partitions", ["1", "3", "7"])
def test_against_plain_python(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = made(int(partitions), 120)
        df = spark.createDataFrame(rows, SCHEMA)
        assert got(spliced(df)) == plain(rebuilt(rows))
        own = {}
        for r in rows:
            own.setdefault(r[0], []).append((r[2], r[3]))
        if partitions == "7":
            assert got(P.prefix_trie(df)) == plain(own)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_any_cut_of_the_sorted_classes_gives_the_same_forest():
    """Contracting random stretches, and stretches of these, closes the same nodes as one pass."""
    rnd = random.Random(4)
    for _ in range(200):
        keys = sorted({tuple(rnd.randrange(2) for _ in range(rnd.randrange(1, 8))) for _ in range(rnd.randrange(1, 25))})
        nodes = [[len(k), hash(k), 0, 3 * len(k), rnd.randrange(1, 4), i, 0, 0, 0] for i, k in enumerate(keys)]
        edges = []
        for a, b in zip(keys, keys[1:], strict=False):
            d = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            edges.append((d, hash(a[:d]) if d else 0, 0, 3 * d))

        def close(forest):
            forest.done.append((forest.under(forest.rest()[0][0], (0, 0, 0, 0)), (-1, 0, 0, 0)))
            return sorted(map(repr, forest.done))

        whole = P.Forest([list(n) for n in nodes], edges, -1, -1)
        whole.grow()
        want = close(whole)
        done, items, links = [], [list(n) for n in nodes], list(edges)
        for _ in range(2):
            cuts = sorted({0, len(items), *(rnd.randrange(len(items) + 1) for _ in range(4))})
            kept, between = [], []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                part = P.Forest(items[lo:hi], links[lo : hi - 1], P.SHUT, P.SHUT)
                part.grow()
                done += part.done
                for node, edge in part.rest():
                    kept.append(node)
                    between.append(edge or (links[hi - 1] if hi <= len(links) else None))
            items, links = kept, between[:-1]
        last = P.Forest(items, links, -1, -1)
        last.grow()
        last.done = done + last.done
        assert close(last) == want


def test_odd_rows(spark):
    rows = [(20, None, "user", "first"), (20, 3, None, None), (20, 3, None, None), (21, 0, "user", "x"), (None, 0, "user", "lost"), (25, 1, "b", "tie"), (25, 1, "a", "tie"), (40, -5, "user", " two  words\n"), (-3, 0, "user", "x"), (60, 0, "", "")]
    rows += [(61 + i, t, "user", "same " * 300) for i in range(30) for t in range(3)]  # many copies
    rows += [(100, t, "user", f"turn {t}") for t in range(900)] + [(180 + 20 * i, t, "user", f"turn {t}") for i in range(2) for t in range(500 + i)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    small = [r for r in rows if r[0] is None or r[0] < 100]
    assert got(spliced(spark.createDataFrame([(*r, 1, "x") for r in small], SCHEMA))) == plain(rebuilt(small))
    deep = {(r.conv_id, r.depth): r for r in P.prefix_trie(df.where("conv_id >= 100")).collect()}
    assert len(deep) == 901 and deep[(100, 500)].n_convs == 3 and deep[(100, 501)].n_convs == 2 and deep[(100, 502)].n_convs == 1 and deep[(100, 0)].n_leaves == 1
    assert spliced(df.where("conv_id < -9")).count() == 0


def test_query_against_plain_python(spark):
    import duckdb

    rows = duckdb.sql("select conv_id, turn, role, text from '/root/testdata/sf0.001/conversations.parquet'").fetchall()
    assert got(QUERIES["op12_prefix_trie"](spark, "/root/testdata/sf0.001")) == plain(rebuilt(rows))


def test_query_against_its_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create view conversations as select * from '/root/testdata/sf0.01/conversations.parquet'")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    want = con.execute(f"select {', '.join(names)} from ({ORACLES['op12_prefix_trie']})").fetchall()
    assert got(QUERIES["op12_prefix_trie"](spark, "/root/testdata/sf0.01")) == sorted(want, key=repr)
