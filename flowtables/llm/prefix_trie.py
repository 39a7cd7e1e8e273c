"""Prefix trie of conversations by union-find over the LCP edges of sorted neighbours.

A conversation is the sequence of its turns; turns are compared by hashes of 128 bits, and the prefix of a conversation by the
XOR of its turns' hashes with their depths, which any part of a long conversation can add to on its own. Equal conversations are one
class. Classes are sorted by their prefixes, as deep as another class shares them; the depth to which two neighbours agree is the LCP edge
between them. Going through the edges from the deepest up, union-find joins neighbouring components, and each joining makes (or
widens) the branching node at that depth.

Every partition of the sorted classes does this for itself and holds back what its neighbours may still change: components that an edge
deeper than the one at hand, or the partition's border, shuts in. These are contracted to a row each, so a partition leaves
about as many rows as there are branching depths on its border. Borders are then joined by the same step, some partitions at a
time, until one is left. Nodes between two branching nodes have the members of the lower one and are filled in at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.tables import cut

WORD = r"[^\x20\x09-\x0D]+"
AT_ONCE = 32  # contracted partitions that are joined by one task
SHUT, NO_EDGE = 1 << 62, (-2, 0, 0, 0)
NODE = "t long, p long, q long, cw long, n long, low long, kids long, leaves long, below long"
EDGE = "et long, ep long, eq long, ecw long"
STEP = f"kind string, part int, place int, {NODE}, {EDGE}, first array<long>, first_cw array<long>, last array<long>, last_cw array<long>"
NODE_COLUMNS = ["t", "p", "q", "cw", "n", "low", "kids", "leaves", "below"]


class Forest:
    """Components of neighbouring elements; each has one top node.

    A node is [depth, hash, hash, words on its path, members, smallest member, children, leaves below, saved below]; leaves and saved
    words are those of its children's subtrees.
    """

    def __init__(self, nodes: list[list[int]], edges: list[tuple[int, int, int, int]], left: int, right: int):
        self.tops, self.edges, self.outer = nodes, edges, (left, right)
        self.root = list(range(len(nodes)))
        self.span = [(i, i) for i in range(len(nodes))]
        self.done: list[tuple[list[int], tuple[int, int, int, int]]] = []

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def under(self, top: list[int], edge: tuple[int, int, int, int]) -> list[int]:
        """The node at the edge's depth as far as one component knows it: its top, or a node with its finished top as the only child."""
        if top[0] == edge[0]:
            return top
        _, _, _, cw, n, low, kids, leaves, below = top
        self.done.append((top, edge))
        return [*edge, n, low, 1, leaves if kids else 1, below + (n - 1) * (cw - edge[3])]

    def join(self, a: int, b: int, edge: tuple[int, int, int, int]) -> None:
        x, y = self.under(self.tops[a], edge), self.under(self.tops[b], edge)
        self.tops[a] = [*x[:4], x[4] + y[4], min(x[5], y[5]), *(i + j for i, j in zip(x[6:], y[6:], strict=True))]
        self.root[b] = a
        self.span[a] = (self.span[a][0], self.span[b][1])

    def shut(self, a: int, b: int, depth: int) -> bool:
        """Whether a deeper edge that could not be used lies on the outer side of either component."""
        begin, end = self.span[a][0], self.span[b][1]
        before = self.edges[begin - 1][0] if begin else self.outer[0]
        after = self.edges[end][0] if end < len(self.edges) else self.outer[1]
        return max(before, after) > depth

    def grow(self) -> None:
        for e in sorted(range(len(self.edges)), key=lambda e: -self.edges[e][0]):
            a, b = self.find(e), self.find(e + 1)
            if not self.shut(a, b, self.edges[e][0]):
                self.join(a, b, self.edges[e])

    def rest(self) -> list[tuple[list[int], tuple[int, int, int, int] | None]]:
        """The components left, in order, each with the edge to the next."""
        out, at = [], 0
        while at < len(self.tops):
            a = self.find(at)
            at = self.span[a][1] + 1
            out.append((self.tops[a], self.edges[at - 1] if at < len(self.tops) else None))
        return out


def lcp(a: np.ndarray, a_cw: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int]:
    """The edge between neighbours with these keys (two hashes a depth): depth, hashes and words of their common prefix."""
    m = min(len(a), len(b))
    apart = np.flatnonzero(a[:m] != b[:m])
    depth = int(apart[0]) // 2 if len(apart) else m // 2
    return (depth, int(a[2 * depth - 2]), int(a[2 * depth - 1]), int(a_cw[depth - 1])) if depth else (0, 0, 0, 0)


def _rows(forest: Forest, part: int, borders) -> pd.DataFrame:
    """The finished nodes with their parents, and the contracted components with the keys at the partition's borders."""
    rows = [("node", part, 0, *node, *edge, None, None, None, None) for node, edge in forest.done]
    rest = forest.rest()
    for i, (node, edge) in enumerate(rest):
        first, last = borders[0] if i == 0 else (None, None), borders[1] if i == len(rest) - 1 else (None, None)
        rows.append(("rest", part, i, *node, *(edge or NO_EDGE), *first, *last))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in STEP.split(", ")])


def _first_step(batches):
    """One sorted partition of classes."""
    nodes, edges, first, before = [], [], None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("t", "p", "q", "cw", "n", "low")]
        keys, cws = batch.column("key"), batch.column("key_cw")
        for i, node in enumerate(zip(*columns, strict=True)):
            key, cw = (np.asarray(c[i].values, np.int64) for c in (keys, cws))
            if before is not None:
                edges.append(lcp(*before, key))
            else:
                first = key, cw
            before = key, cw
            nodes.append([*node, 0, 0, 0])
    if nodes:
        forest = Forest(nodes, edges, SHUT, SHUT)
        forest.grow()
        schema = pa.schema([pa.field(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}.get(t, pa.list_(pa.int64()))) for n, t in (c.split() for c in STEP.split(", "))])
        yield pa.RecordBatch.from_pandas(_rows(forest, TaskContext.get().partitionId(), (first, before)), schema=schema, preserve_index=False)


def _next_step(final: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "place"], kind="stable").reset_index(drop=True)
        nodes = rows[NODE_COLUMNS].to_numpy(np.int64).tolist()
        edges, before = [], None
        for i in range(len(rows)):
            if rows["first"][i] is not None and before is not None:
                edges.append(lcp(*before, np.asarray(rows["first"][i], np.int64)))
            if rows["last"][i] is not None:
                before = tuple(np.asarray(rows[c][i], np.int64) for c in ("last", "last_cw"))
            else:
                edges.append(tuple(int(rows[c][i]) for c in ("et", "ep", "eq", "ecw")))
        outer = -1 if final else SHUT
        forest = Forest(nodes, edges, outer, outer)
        forest.grow()
        if final:  # one component is left: the root, or what hangs from it
            root = forest.under(forest.rest()[0][0], (0, 0, 0, 0))
            forest.done.append((root, (-1, 0, 0, 0)))
            forest.tops, forest.edges = [], []
        start, end = (rows["first"][0], rows["first_cw"][0]), (rows["last"].iloc[-1], rows["last_cw"].iloc[-1])
        return _rows(forest, int(rows["part"][0]) // AT_ONCE, (start, end))

    return run


def _numbered(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """c, part, pos (from 0), hashes a and b and words of every turn. Range partitions split also one very long conversation."""
    said = conversations.select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")).where("c is not null")
    order = ["c", "turn", "role", "text"]
    hashes = F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(7), "text", "role").alias("b")
    dealt = cut(said.repartitionByRange(*order).sortWithinPartitions(*order).select("c", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), *hashes, F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")))
    runs = dealt.groupBy("c", "part").agg(F.count("*").alias("n"))
    start = F.coalesce(F.sum("n").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("c", "part").orderBy("at"))
    return cut(dealt.withColumn("inside", inside).join(runs.withColumn("start", start).drop("n"), ["c", "part"]).select("c", "part", (F.col("start") + F.col("inside") - 1).alias("pos"), "a", "b", "words"))


def _spliced(turns: DataFrame, donor: Callable[[Column], Column] | None, take: Callable[[Column], Column] | None, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows (c, part, d, a, b, words) of the conversations that the trie is of, and every conversation's length."""
    convs = turns.groupBy("c").agg(F.count("*").alias("own"))
    if donor is None:
        return turns.withColumn("d", F.col("pos") + 1), convs.withColumnRenamed("own", "length")
    heads = turns.where(F.col("pos") < most).where(F.col("c") == donor(F.col("c"))).groupBy(F.col("c").alias("donor")).agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "words"))).alias("head"))
    given = convs.withColumns({"donor": donor(F.col("c")), "skip": F.least(take(F.col("c")), F.lit(most)).cast("int")}).join(heads, "donor", "left")
    head = F.when(F.col("head").isNotNull() & (F.col("skip") > 0), F.slice("head", 1, F.greatest("skip", F.lit(1))))
    given = cut(given.select("c", "own", "skip", F.coalesce(head, F.array().cast("array<struct<pos:bigint,a:bigint,b:bigint,words:bigint>>")).alias("head")))
    # by conversation and partition, so that a very long conversation is no single key
    parts = turns.select("c", "part").distinct().join(given.select("c", "skip", F.size("head").alias("got")), "c")
    own = turns.join(parts, ["c", "part"]).where("pos >= skip").select("c", "part", (F.col("got") + F.col("pos") - F.col("skip") + 1).alias("d"), "a", "b", "words")
    lent = given.select("c", F.explode("head").alias("h")).select("c", F.lit(-1).alias("part"), (F.col("h.pos") + 1).alias("d"), "h.a", "h.b", "h.words")
    return own.union(lent), given.select("c", (F.size("head") + F.greatest(F.col("own") - F.col("skip"), F.lit(0))).alias("length"))


def _prefixes(rows: DataFrame) -> DataFrame:
    """c, d, p, q, words, cw: the hashes of the prefix that ends in a row, and the words in it."""
    rows = rows.withColumns({"x": F.xxhash64("d", "a", "b"), "y": F.xxhash64(F.lit(3), "b", "d", "a")}).select("c", "part", "d", "x", "y", "words")
    rows = cut(rows)
    totals = rows.groupBy("c", "part").agg(F.bit_xor("x").alias("tx"), F.bit_xor("y").alias("ty"), F.sum("words").alias("tw"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = totals.select("c", "part", *[F.coalesce(f(t).over(before), zero).alias(t) for f, t in ((F.bit_xor, "tx"), (F.bit_xor, "ty"), (F.sum, "tw"))])
    upto = Window.partitionBy("c", "part").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.select("c", "part", "d", "words", F.bit_xor("x").over(upto).alias("x"), F.bit_xor("y").over(upto).alias("y"), F.sum("words").over(upto).alias("w"))
    joined = inside.join(carried, ["c", "part"])
    return cut(joined.select("c", "d", F.col("x").bitwiseXOR(F.col("tx")).alias("p"), F.col("y").bitwiseXOR(F.col("ty")).alias("q"), "words", (F.col("w") + F.col("tw")).alias("cw")))


def _joined_ids(batches):
    """Runs of equal (p, q) in sorted rows: the run's least id and its ids in decimal, joined by commas."""
    for batch in batches:
        p, q, c = (batch.column(x).to_numpy() for x in ("p", "q", "c"))
        if not len(c):
            continue
        starts = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (q[1:] != q[:-1])]))
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(c)).astype(np.int32)), batch.column("c").cast(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(p[starts]), pa.array(q[starts]), pa.array(c[starts]), pc.binary_join(lists, ",")], ["p", "q", "c", "ids"])


def _digests(batches):
    """The SHA-256 of each (p, q)'s blocks of ids, read in order one at a time."""
    at, digest = None, None
    for batch in batches:
        out = []
        for p, q, ids in zip(*(batch.column(x).to_pylist() for x in ("p", "q", "ids")), strict=True):
            if (p, q) == at:
                digest.update(b"," + ids.encode())
                continue
            if at is not None:
                out.append((*at, digest.hexdigest()))
            at, digest = (p, q), hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["p", "q", "ends"])
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]]), pa.array([digest.hexdigest()])], ["p", "q", "ends"])


def _branching(classes: DataFrame) -> DataFrame:
    """Every node in which a class ends or that branches, with its parent's depth and hashes (depth -1 for the root)."""
    steps = cut(classes.repartitionByRange("key", "low").sortWithinPartitions("key", "low").mapInArrow(_first_step, STEP))
    nodes, rest = steps.where("kind = 'node'"), steps.where("kind = 'rest'")
    parts = (rest.agg(F.max("part").alias("n")).first().n or 0) + 1
    final = False
    while not final:
        final = parts <= AT_ONCE
        steps = cut(rest.groupBy(F.floor(F.col("part") / AT_ONCE).alias("group")).applyInPandas(_next_step(final), STEP))
        nodes, rest = nodes.union(steps.where("kind = 'node'")), steps.where("kind = 'rest'")
        parts = -(-parts // AT_ONCE)
    return nodes.select(*NODE_COLUMNS, F.col("et").alias("pt"), F.col("ep").alias("pp"), F.col("eq").alias("pq"))


def prefix_trie(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", donor: Callable[[Column], Column] | None = None, take: Callable[[Column], Column] | None = None, most: int = 3) -> DataFrame:
    """A row per node of the trie of all conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a distinct sequence of a conversation's first `depth` turns (role and text), the root that of none; its members are the
    conversations that begin with it, conv_id the smallest, parent_conv_id that of its parent (null for the root). n_leaves counts the
    childless nodes of its subtree, itself included, saved_tokens sums (n_convs - 1) times the words of the last text over the subtree, and
    ends_sha256 is of the ids of the members that end in it, ascending and joined by commas.

    Turns are ordered by turn, null first, equal ones by role and text; a null role or text is empty; repeated rows are turns of
    their own. Rows without a conversation id are left out. With `donor` and `take`, conversation c begins with the first take(c) (at most
    `most`) turns of conversation donor(c), as many as there are, in place of its own; donor(donor(c)) must be donor(c). A conversation
    that is left without turns ends in the root. An empty table has no nodes; other columns are not looked at.

    Turns are sorted once with their texts, by range, so that a very long conversation is many tasks' work; from then on only hashes move.
    """
    rows, lengths = _spliced(_numbered(conversations, conv_col, turn_col, role_col, text_col), donor, take, most)
    rows = _prefixes(rows)
    last = rows.groupBy("c").agg(F.max(F.struct("d", "p", "q", "cw")).alias("top"))
    zero = F.lit(0).cast("long")
    ends = cut(lengths.join(last, "c", "left").select("c", *[F.coalesce(f"top.{x}", zero).alias(y) for x, y in (("d", "t"), ("p", "p"), ("q", "q"), ("cw", "cw"))]))
    classes = cut(ends.groupBy("t", "p", "q").agg(F.min("c").alias("low"), F.count("*").alias("n"), F.max("cw").alias("cw")))
    rows = cut(rows.join(classes.select(F.col("low").alias("c")), "c", "left_semi"))
    shared = cut(rows.groupBy("p", "q").agg(F.count("*").alias("n")).where("n > 1").select("p", "q"))
    keys = rows.join(shared, ["p", "q"], "left_semi").groupBy(F.col("c").alias("low")).agg(F.sort_array(F.collect_list(F.struct("d", "p", "q", "cw"))).alias("k"))
    none = F.array().cast("array<bigint>")
    key = F.coalesce(F.flatten(F.transform("k", lambda x: F.array(x["p"], x["q"]))), none)
    keyed = classes.join(keys, "low", "left").select("t", "p", "q", "cw", "n", "low", key.alias("key"), F.coalesce(F.transform("k", lambda x: x["cw"]), none).alias("key_cw"))
    if not classes.take(1):
        nodes = conversations.sparkSession.createDataFrame([], f"{NODE}, pt long, pp long, pq long")
    else:
        nodes = cut(_branching(keyed))
    blocks = ends.select("p", "q", "c").repartitionByRange("p", "q", "c").sortWithinPartitions("p", "q", "c").mapInArrow(_joined_ids, "p long, q long, c long, ids string")
    digests = blocks.repartition("p", "q").sortWithinPartitions("p", "q", "c").mapInArrow(_digests, "p long, q long, ends string")
    nodes = nodes.join(nodes.select(F.col("t").alias("pt"), F.col("p").alias("pp"), F.col("q").alias("pq"), F.col("low").alias("parent")), ["pt", "pp", "pq"], "left").join(digests, ["p", "q"], "left")
    nothing = F.lit(hashlib.sha256().hexdigest())
    leaves = F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves"))
    root = nodes.where("t = 0").select("low", zero, F.lit(None).cast("long"), "n", "kids", leaves, "below", F.coalesce("ends", nothing))
    # the nodes from below a parent down to its child have the child's members
    here = F.col("d") == F.col("t")
    filled = rows.withColumnRenamed("c", "low").join(cut(nodes.where("t > 0").drop("p", "q").withColumnRenamed("cw", "tw")), "low").where("d > pt and d <= t")
    out = filled.select(
        F.col("low").alias("conv_id"), F.col("d").alias("depth"), F.when(F.col("d") == F.col("pt") + 1, F.col("parent")).otherwise(F.col("low")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(here, F.col("kids")).otherwise(1).cast("long").alias("n_children"), leaves.cast("long").alias("n_leaves"),
        (F.col("below") + (F.col("n") - 1) * (F.col("tw") - F.col("cw") + F.col("words"))).alias("saved_tokens"), F.when(here, F.coalesce("ends", nothing)).otherwise(nothing).alias("ends_sha256"))
    return out.union(root)
