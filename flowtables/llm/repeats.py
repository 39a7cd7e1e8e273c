"""Suffix-array dedup: strings of LENGTH bytes that occur more than once, found by longest-previous-factor arrays.

Every string of LENGTH bytes has an anchor: of its runs of GRAM bytes the one with the least hash, the first of equal ones. Equal strings
have equal anchors, so strings are dealt by their anchor's hash, and neighbouring starts with one anchor go together as a stretch: a
fragment of text of less than 2 * LENGTH bytes. Equal fragments under one anchor are one class; only classes whose anchor other
classes have too send one copy of their text.

These texts are sorted as suffixes, in batches of whole anchors: ranks by 8 bytes are doubled to LENGTH. The LCP of neighbours comes from
the same ranks, and for each suffix the previous and the next one in suffix order with a smaller position in the corpus give
the longest earlier match (the longest previous factor); those with a larger position give the longest later one. The classes of an anchor
with very many are taken apart once more, by anchors nearly as long as the string: most of these are a class's own, and what is left is
short. Where there are still very many they are dealt into blocks, each sorted on its own, and a block's strings are then held against
the other blocks' by their hashes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import BYTE_WORDS, ODD, mix, slices, utf8
from flowtables.tables import cut

LENGTH, GRAM, PIECE, BLOCK, BATCH = 400, 100, 1 << 17, 512, 1 << 19
# an anchor with more classes than a block holds is taken apart by anchors this much shorter than the string
LONG_GRAM = 32
ODD2 = np.uint64(0xD1342543DE82EF95)
PLACE = np.uint64((1 << 20) - 1)  # pieces are shorter
LAST = (1 << 63) - 1


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Hashes of any stretch of a byte array, equal for equal bytes wherever they are.

    With a `window` (1, 2, 4 or 8 bytes; a stretch has at least as many) a place counts by all the bytes there together. Sums by single
    bytes come out alike, whatever the base, for some texts that differ in a Thue-Morse pattern: modulo 2^64 its powers have a common zero.
    """

    def __init__(self, raw: np.ndarray, base: np.uint64, window: int = 1):
        self.window = window
        if window == 1:
            words = BYTE_WORDS[raw]
        else:
            words = raw.astype(np.uint64)
            for width in (1, 2, 4)[: window.bit_length() - 1]:
                words = words[:-width] << np.uint64(8 * width) | words[width:]
            words = mix(words + base)
        self.inverse = np.uint64(pow(int(base), -1, 1 << 64))
        n = len(words)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * _powers(base, n), out=self.sums[1:])
        self.back = _powers(self.inverse, n + 1)

    def of(self, start, end) -> np.ndarray:
        return mix((self.sums[end - self.window + 1] - self.sums[start]) * self.back[start])


def _hashes(raw: np.ndarray, length: int) -> tuple[Hashes, Hashes]:
    """Two hashes of stretches of at least `length` bytes: by bytes, and by as many as 8 together."""
    return Hashes(raw, ODD), Hashes(raw, ODD2, 1 << min(length.bit_length() - 1, 3))


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least value in every run of `width` values, by their upper bits and the first of equal ones: the
    places stand in the lower bits, and the minima come from prefix and suffix minima of blocks of that width."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values & ~PLACE | np.arange(len(values), dtype=np.uint64)
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & PLACE).astype(np.int64)


def stretches(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """First and last start of every run of strings of `length` bytes with one anchor, the anchor's hash, and two hashes of the bytes they cover."""
    n = len(raw) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 3
    one, two = _hashes(raw, length)
    at = np.arange(len(raw) - gram + 1)
    grams = one.of(at, at + gram)
    place = least_in_window(grams, length - gram + 1)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], n) - 1
    size = (last + length - first).astype(np.uint64) + (place[first] - first).astype(np.uint64) * np.uint64(4096)
    return first, last, grams[place[first]], mix(one.of(first, last + length) + size), mix(two.of(first, last + length) + size * ODD)


RUNS = "d1 long, d2 long, id long, origin long, copies long, first long, last long, anchor long, h1 long, h2 long"


def _anchored(length: int, gram: int, piece: int):
    """Batches of (d1, d2, id, origin, copies, text), a text that begins at byte origin of its document, to a row per stretch.

    Long texts go piece by piece, each with the bytes its last strings reach into.
    """

    def run(batches):
        for part in slices(batches, "text"):
            raw, ends = utf8(part.column("text"))
            origin = part.column("origin").to_pylist()
            rows = []
            for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                for at in range(a, max(b - length + 1, a), piece):
                    first, last, anchor, h1, h2 = stretches(raw[at : min(b, at + piece + length - 1)], length, gram)
                    rows.append((np.full(len(first), i), first + (at - a + origin[i]), last + (at - a + origin[i]), anchor, h1, h2))
            if rows:
                i, first, last, anchor, h1, h2 = (np.concatenate(x) for x in zip(*rows, strict=True))
                doc = [part.column(c).take(pa.array(i)) for c in ("d1", "d2", "id", "origin", "copies")]
                names = [c.split()[0] for c in RUNS.split(", ")]
                yield pa.RecordBatch.from_arrays([*doc, *[pa.array(x) for x in (first, last, anchor.view(np.int64), h1.view(np.int64), h2.view(np.int64))]], names)

    return run


def suffix_order(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of all strings raw[start:end] that have `length` bytes, sorted by these: their places in the strings put one after the
    other, their order, and the LCP of each with the one before it (at most `length`).

    Ranks of 8 bytes are doubled. A place has a rank for a width if as many bytes follow in its string.
    """
    size = ends - starts
    n = int(size.sum())
    begin = np.cumsum(size) - size
    text = raw[np.arange(n) - np.repeat(begin, size) + np.repeat(starts, size)]
    left = np.repeat(begin + size, size) - np.arange(n)  # bytes to the string's end
    following = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    width = min(8, length)
    key = np.zeros(n, np.uint64)
    for j in range(width):
        key = (key << np.uint64(8)) | following[j : n + j]

    def ranked(values, at):
        order = np.argsort(values)
        ordered = values[order]
        rank = np.full(n, -1, np.int64)
        rank[at[order]] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])[: len(order)])
        return rank, order

    at = np.flatnonzero(left >= width)
    rank, order = ranked(key[at], at)
    ranks = [(width, rank)]
    while width < length:
        step = min(width, length - width)
        width += step
        at = np.flatnonzero(left >= width)
        rank, order = ranked(rank[at] * (n + 1) + rank[at + step], at)
        ranks.append((width, rank))
    a, b = at[order[:-1]], at[order[1:]]
    matched = np.where(rank[a] == rank[b], length, 0)
    for width, r in reversed(ranks[:-1]):
        fits = matched + width <= length
        equal = np.zeros(len(a), bool)
        equal[fits] = r[a[fits] + matched[fits]] == r[b[fits] + matched[fits]]
        matched += np.where(equal, width, 0)
    for _ in range(7):  # what is left of less than 8 bytes
        fits = matched < length
        equal = np.zeros(len(a), bool)
        equal[fits] = text[a[fits] + matched[fits]] == text[b[fits] + matched[fits]]
        matched += equal
    return at, order, np.concatenate([[0], matched])[: len(at)]


def nearest_smaller(position: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """For each place in suffix order the LCP with the previous place of a smaller position; 0 once that is below `least`.

    All places look back at once: from a place whose position is not smaller they go on to where that place looks, which lies behind
    larger positions only, so the distance grows like that of pointers that jump.
    """
    n = len(position)
    look, match = np.arange(n) - 1, lcp.copy()
    going = np.flatnonzero((look >= 0) & (match >= least))
    match[(look < 0) | (match < least)] = 0
    while True:
        going = going[(match[going] >= least) & (look[going] >= 0)]
        going = going[position[look[going]] >= position[going]]
        if not len(going):
            break
        to = look[going]
        match[going] = np.minimum(match[going], match[to])
        look[going] = look[to]
        ended = going[(look[going] < 0) | (match[going] < least)]
        match[ended] = 0
    return match


def longest_factors(order: np.ndarray, lcp: np.ndarray, position: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix the length of its longest match with an earlier position and with a later one, 0 where that is below `least`."""
    at = position[order]
    back = np.concatenate([lcp[1:], [0]])[::-1]
    out = []
    for p in (at, -at):
        before = nearest_smaller(p, lcp, least)
        after = nearest_smaller(p[::-1], back, least)[::-1]
        found = np.empty(len(order), np.int64)
        found[order] = np.maximum(before, after)
        out.append(found)
    return out[0], out[1]


def _intervals(flags: np.ndarray, own: np.ndarray, offset: np.ndarray):
    """Runs of neighbouring flagged starts of one class: class, first and last start."""
    at = np.flatnonzero(flags)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    begin = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(own[at], prepend=-1) != 0))
    end = np.append(begin[1:], len(at)) - 1
    return own[at[begin]], offset[at[begin]], offset[at[end]]


RESULT = "kind string, h1 long, h2 long, first long, last long, d1 long, d2 long, id long, w1 long, w2 long, alone boolean"


def _sorted_batch(rows: list[dict], length: int, keep_first: bool) -> pa.RecordBatch | None:
    """The repeated starts of some whole anchors' classes (kind 'found'), and of anchors in blocks also each string's first start ('block')."""
    texts = [r["text"] for r in rows]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array(list(map(len, texts)))
    ends = np.cumsum(size)
    starts = ends - size
    at, order, lcp = suffix_order(raw, starts, ends, length)
    own = np.repeat(np.arange(len(rows)), size)[at]
    offset = at - starts[own]
    # positions in the corpus: by document, then by byte
    first = np.array([r["first"] for r in rows])
    by_doc = np.lexsort((first, [r["d2"] for r in rows], [r["d1"] for r in rows], [r["id"] for r in rows]))
    doc = np.empty(len(rows), np.int64)
    changed = [any(rows[a][c] != rows[b][c] for c in ("id", "d1", "d2")) for a, b in zip(by_doc, by_doc[1:], strict=False)]
    doc[by_doc] = np.concatenate([[0], np.cumsum(changed)])
    earlier, later = longest_factors(order, lcp, doc[own] * (1 << 40) + first[own] + offset, length)
    gone = (earlier >= length) if keep_first else (earlier >= length) | (later >= length)
    whole = np.array([r["copies"] > 1 for r in rows])
    if not keep_first:
        gone &= ~whole[own]  # all their starts are known to repeat
    cls, lo, hi = _intervals(gone, own, offset)
    h1, h2, d1, d2, ids = ([r[c] for r in rows] for c in ("h1", "h2", "d1", "d2", "id"))
    pick = lambda values, at: [values[i] for i in at]
    n = len(cls)
    parts = [[["found"] * n, pick(h1, cls), pick(h2, cls), (first[cls] + lo).tolist(), (first[cls] + hi).tolist(), pick(d1, cls), pick(d2, cls), pick(ids, cls), [0] * n, [0] * n, [False] * n]]
    hot = np.array([r["blocks"] > 1 for r in rows])
    if hot.any():
        some = np.flatnonzero(hot[own] & (earlier < length))
        w1, w2 = (h.of(at[some], at[some] + length).view(np.int64).tolist() for h in _hashes(raw, length))
        alone = ((later[some] < length) & ~whole[own[some]]) | keep_first
        place = (first[own[some]] + offset[some]).tolist()
        o = own[some]
        parts.append([["block"] * len(some), pick(h1, o), pick(h2, o), place, place, pick(d1, o), pick(d2, o), pick(ids, o), w1, w2, alone.tolist()])
    columns = [sum(c, []) for c in zip(*parts, strict=True)]
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.string(), *[pa.int64()] * 9, pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names) if columns[0] else None


def _suffix_sorted(length: int, keep_first: bool, batch_bytes: int):
    """Rows sorted by anchor and block, taken in batches of whole blocks of about `batch_bytes`."""

    def run(batches):
        rows, held, size = [], [], 0
        at = None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["anchor"], row["block"]) != at:
                    at = row["anchor"], row["block"]
                    rows += held
                    held = []
                    if size > batch_bytes:
                        if (out := _sorted_batch(rows, length, keep_first)) is not None:
                            yield out
                        rows, size = [], 0
                held.append(row)
                size += len(row["text"])
        rows += held
        if rows and (out := _sorted_batch(rows, length, keep_first)) is not None:
            yield out

    return run


def _fragments(length: int):
    """The bytes of the wanted stretches of each text."""

    def run(batches):
        for part in slices(batches, "text"):
            raw, ends = utf8(part.column("text"))
            wanted = part.column("wanted")
            flat = wanted.flatten()
            count = np.diff(wanted.offsets.to_numpy())
            row = np.repeat(np.arange(part.num_rows), count)
            origin = part.column("origin").to_numpy()[row]
            first, last = (flat.field(c).to_numpy() - origin for c in ("first", "last"))
            text = [raw[a:b].tobytes() for a, b in zip(ends[row] + first, ends[row] + last + length, strict=True)]
            yield pa.RecordBatch.from_arrays([flat.field("anchor"), flat.field("h1"), flat.field("h2"), pa.array(text, pa.binary())], ["anchor", "h1", "h2", "text"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.col(id_col).cast("long")
    return docs.select(*others, F.xxhash64(key, text).alias("d1"), F.xxhash64(F.lit(5), text, key).alias("d2"), F.coalesce(key, F.lit(LAST)).alias("id"), text.alias("text"))


def repeated_starts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, keep_first: bool = False, piece: int = PIECE, block: int = BLOCK, batch_bytes: int = BATCH, spread: int = LONG_GRAM) -> DataFrame:
    """(d1, d2, first, last): runs of starts, in the document with these hashes of id and text, of strings of `length` bytes that start
    elsewhere too, or, with `keep_first`, that start earlier too. Runs may overlap.

    A string's places are ordered by id (null last) and byte. Rows that repeat both an id and a text count as copies of each other, but with
    `keep_first` stand at the same place and are treated alike.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    base = _keyed(docs, id_col, text_col).withColumns({"origin": zero, "copies": one})
    found, texts = [], base.where(F.octet_length("text") >= length)
    for size in (gram, max(length - spread, gram)):
        last = size != gram or length - spread <= gram
        runs, classes, met, dealt = _dealt(texts, length, size, piece)
        copied = classes.where("copies > 1")
        if keep_first:
            # all copies but the first, whose strings are looked at one by one
            again = runs.join(copied.select("anchor", "h1", "h2", "at"), ["anchor", "h1", "h2"]).where(F.struct("id", "d1", "d2", "first", "last") != F.col("at"))
        else:
            again = runs.join(copied, ["anchor", "h1", "h2"], "left_semi")
        found.append(again.select("d1", "d2", "first", "last"))
        blocks = F.ceil(F.col("classes") / block).cast("int")
        sorted_here = dealt if last else dealt.where(F.col("classes") <= block)
        steps = sorted_here.withColumn("blocks", blocks).withColumn("block", F.pmod("h1", "blocks")).repartition("anchor", "block").sortWithinPartitions("anchor", "block")
        steps = cut(steps.select("anchor", "block", "blocks", "h1", "h2", "copies", "id", "d1", "d2", "first", "text").mapInArrow(_suffix_sorted(length, keep_first, batch_bytes), RESULT))
        found.append(steps.where("kind = 'found'").select("d1", "d2", "first", "last"))
        texts = dealt.where(F.col("classes") > block).select("d1", "d2", "id", F.col("first").alias("origin"), "copies", "text")
        if last or not texts.take(1):
            break
    blocked = steps.where("kind = 'block'")
    where = F.struct("id", "d1", "d2", "first")
    again = blocked.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(where).alias("earliest")).where("n > 1")
    across = blocked.where("alone").join(again, ["w1", "w2"])
    found.append((across.where(where != F.col("earliest")) if keep_first else across).select("d1", "d2", "first", "last"))
    return reduce(DataFrame.union, found)


def _dealt(texts: DataFrame, length: int, gram: int, piece: int) -> tuple[DataFrame, ...]:
    """The stretches of some texts, their classes, the classes that meet others under their anchor, and these with their text and the number of classes there."""
    runs = cut(texts.select("d1", "d2", "id", "origin", "copies", "text").mapInArrow(_anchored(length, gram, piece), RUNS))
    place = F.min(F.struct("id", "d1", "d2", "first", "last", "origin"))
    classes = cut(runs.groupBy("anchor", "h1", "h2").agg(F.sum("copies").alias("copies"), place.alias("place")).withColumn("at", F.struct("place.id", "place.d1", "place.d2", "place.first", "place.last")))
    many = cut(classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1"))
    met = cut(classes.drop("at").join(many, "anchor").select("anchor", "h1", "h2", "copies", "classes", "place.*"))
    wanted = met.groupBy("d1", "d2", "origin").agg(F.collect_list(F.struct("anchor", "h1", "h2", "first", "last")).alias("wanted"))
    found = texts.select("d1", "d2", "origin", "text").join(wanted, ["d1", "d2", "origin"]).dropDuplicates(["d1", "d2", "origin"])
    found = found.select("text", "origin", "wanted").mapInArrow(_fragments(length), "anchor long, h1 long, h2 long, text binary")
    return runs, classes, met, cut(met.join(found, ["anchor", "h1", "h2"]))


def _cut_out(columns: list[str], length: int):
    def run(batches):
        for part in slices(batches, "text"):
            raw, ends = utf8(part.column("text"))
            spans = part.column("spans")
            flat, at = spans.flatten(), spans.offsets.to_numpy() - spans.offsets[0].as_py()
            lo, hi = (flat.field(c).to_numpy() for c in ("first", "last"))
            kept, removed, runs = [], [], []
            for i in range(part.num_rows):
                text = raw[ends[i] : ends[i + 1]]
                mark = np.zeros(len(text) + 1, np.int32)
                s = slice(at[i], at[i + 1])
                np.add.at(mark, lo[s], 1)
                np.add.at(mark, np.minimum(hi[s] + length, len(text)), -1)
                gone = np.cumsum(mark[:-1]) > 0
                kept.append(text[~gone].tobytes())
                removed.append(int(gone.sum()))
                runs.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(np.diff(ends)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], [*columns, "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_first: bool = True, **options) -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans, kept: every text's UTF-8 bytes without those that a repeated string of `length` bytes covers.

    With `keep_first` the earliest place of each string stays, by id (null last) and byte; without it none does. Strings are looked for in
    the texts as they come in, within and across documents, and may overlap; n_spans counts the runs of bytes that go. kept is bytes, as a
    run may begin inside a character.

    Null text is empty and stays so, as do texts shorter than `length`. Rows that repeat an id are documents of their own; those
    that repeat id and text are treated alike. An empty table gives an empty one; other columns are not looked at. Texts
    move twice, once to give their repeated fragments and once to be cut.
    """
    starts = repeated_starts(docs, id_col=id_col, text_col=text_col, length=length, keep_first=keep_first, **options)
    spans = starts.groupBy("d1", "d2").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    none = F.array().cast("array<struct<first:bigint,last:bigint>>")
    rows = _keyed(docs.withColumn("__id", F.col(id_col)), id_col, text_col, "__id").drop("id").join(spans, ["d1", "d2"], "left").select(F.col("__id").cast("long").alias("__id"), "text", F.coalesce("spans", none).alias("spans"))
    out = rows.mapInArrow(_cut_out(["__id"], length), "__id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("__id", id_col)
