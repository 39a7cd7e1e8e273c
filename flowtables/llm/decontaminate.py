"""Benchmark decontamination by the q-gram lemma.

A benchmark item is covered by windows of `WINDOW` bytes, one every `STRIDE` bytes. A window of m bytes that occurs in a
document with at most k edits shares at least m - q + 1 - k * q of its q-grams with it, all on diagonals (place in the
document minus place in the item) that differ by at most k. So q-gram hits are counted in diagonal bands that overlap
by half, and only regions that reach the bound are aligned, in a band around their diagonals.

Any stretch of `WINDOW` bytes of an item begins at most STRIDE / 2 = 4 bytes from a window, and so differs from it by at
most 4 of the 6 edits that a window may have: every exact passage of at least 80 bytes is found wherever it begins, also with
2 edits in it. With 6 edits, every passage of at least WINDOW + STRIDE - 1 = 87 bytes is found, as it holds a whole window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import LOWER, SPACE, slices, utf8

WINDOW, STRIDE, Q, EDITS, PIECE = 80, 8, 8, 0.08, 1 << 16
BATCH_BYTES, ALIGN_ROWS = 8 << 20, 2048
MATCH_TYPE = "doc_id long, item_id long, item_start int, item_end int, doc_start long, doc_end long, edits int"


def squeeze(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A-Z lower-cased, each run of white space one space, none at a row's ends; and the new row offsets."""
    buf = LOWER[raw]
    space = SPACE[buf]
    follows = np.zeros(len(buf) + 1, bool)
    follows[1:-1] = space[:-1]
    follows[ends[:-1]] = True
    keep = ~(space & follows[:-1])
    buf = np.where(space, np.uint8(32), buf)[keep]
    at = np.concatenate([[0], np.cumsum(keep)])[ends]
    tail = (at[1:] > at[:-1]) & (buf[np.maximum(at[1:] - 1, 0)] == 32) if len(buf) else np.zeros(len(at) - 1, bool)
    drop = np.ones(len(buf), bool)
    drop[at[1:][tail] - 1] = False
    return buf[drop], at - np.concatenate([[0], np.cumsum(tail)])


def windows(length: int) -> list[tuple[int, int]]:
    """(start, end) of the windows that cover an item; a shorter item is one window."""
    if length <= WINDOW:
        return [(0, length)]
    starts = [*range(0, length - WINDOW, STRIDE), length - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def budget(m: int) -> int:
    return int(EDITS * m)


class Index:
    """The q-grams of some benchmark items, sorted, with a bitmap that rejects most other q-grams."""

    def __init__(self, items: list[tuple[int, bytes]], bits: int = 22):
        self.items = items
        self.text = np.frombuffer(b"".join(text for _, text in items), np.uint8)
        self.offset = np.cumsum([0, *(len(text) for _, text in items)])
        grams, where, place, first = [], [], [], [0]
        self.spans = []
        for n, (_, text) in enumerate(items):
            g = grams_of(np.frombuffer(text, np.uint8))
            grams.append(g)
            where.append(np.full(len(g), n))
            place.append(np.arange(len(g)))
            self.spans += [(n, a, b) for a, b in windows(len(text))]
            first.append(len(self.spans))
        self.first = np.array(first)
        gram, where, place = (np.concatenate([*x, np.zeros(0, t)]) for x, t in ((grams, np.uint64), (where, np.int64), (place, np.int64)))
        order = np.argsort(gram, kind="stable")
        self.gram, self.where, self.place = gram[order], where[order], place[order]
        self.item, self.starts, self.ends = (np.array([s[j] for s in self.spans] or [0]) for j in (0, 1, 2))
        self.long = int(self.offset[-1]) + 2 * WINDOW
        self.order = self.item * self.long + self.starts  # rising, as items and their windows are
        size = self.ends - self.starts
        width = (EDITS * size).astype(np.int64) + 1
        self.width, self.least = width, np.maximum(size - Q + 1 - (width - 1) * Q, 1)
        self.fewest, self.reach = int(self.least.min()), int((size + width).max())
        self.bits = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self.slot(self.gram)] = True

    def slot(self, gram: np.ndarray) -> np.ndarray:
        return (gram * np.uint64(0x9E3779B97F4A7C15)) >> self.bits

    def hits(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text place, item, item place) of the text's q-grams that an item has, where they are dense enough for a window."""
        seen = self.seen[self.slot(gram)]
        if self.fewest > 1:
            total = np.concatenate([[0], np.cumsum(seen, dtype=np.int32)])
            ends = np.minimum(np.arange(len(gram)) + self.reach, len(gram))
            dense = np.concatenate([[0], np.cumsum(total[ends] - total[:-1] >= self.fewest, dtype=np.int32)])
            starts = np.maximum(np.arange(len(gram)) - self.reach + 1, 0)
            seen &= dense[1:] > dense[starts]
        at = np.flatnonzero(seen)
        lo, hi = np.searchsorted(self.gram, gram[at]), np.searchsorted(self.gram, gram[at], "right")
        n = hi - lo
        flat = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return np.repeat(at, n), self.where[flat], self.place[flat]


def grams_of(buf: np.ndarray) -> np.ndarray:
    """All runs of Q bytes, each as one integer."""
    n = len(buf) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((n,), "<u8", padded, 0, (1,)) & np.uint64((1 << 8 * Q) - 1)


def regions(index: Index, buf: np.ndarray) -> list[tuple[int, int, int]]:
    """(window, lowest diagonal, highest diagonal) of every region that reaches the q-gram bound.

    The text is looked at in pieces of PIECE bytes, each with the bytes that a window beginning in it can reach, so that
    memory depends on the piece and not on the text.
    """
    found = set()
    for at in range(0, len(buf), PIECE):
        part = buf[at : at + PIECE + 2 * WINDOW]
        found.update((w, lowest + at, highest + at) for w, lowest, highest in _regions(index, part))
    return sorted(found)


def _regions(index: Index, buf: np.ndarray) -> list[tuple[int, int, int]]:
    at, item, place = index.hits(grams_of(buf))
    if not len(at):
        return []
    width = index.width[index.first[item]]
    band = (at - place) // width
    # bands b and b + 1 together make a region, so each diagonal lies in two; a place of the item counts once in each
    rows = np.concatenate([np.stack([item, band - shift, place], 1) for shift in (0, 1)])
    rows = rows[np.lexsort(rows.T[::-1])]
    rows = rows[np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])]
    item, band, place = rows.T
    new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)])
    group = np.cumsum(new)
    key = group * index.long + place
    # each window is looked at from its first place in the region: it starts after the place before and holds this one
    after = np.where(new, 0, np.append(0, place[:-1]) + 1)
    lo = np.searchsorted(index.order, item * index.long + np.maximum(after, place + Q - WINDOW))
    n = np.searchsorted(index.order, item * index.long + place, "right") - lo
    head = np.repeat(np.arange(len(rows)), n)
    w = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    count = np.searchsorted(key, group[head] * index.long + index.ends[w] - Q, "right") - head
    fit = count >= index.least[w]
    w, band = w[fit], band[head[fit]]
    width = index.width[w]
    return list(zip(w.tolist(), (band * width).tolist(), ((band + 2) * width - 1).tolist(), strict=True))


def align(patterns: np.ndarray, buf: np.ndarray, begins: np.ndarray, sizes: np.ndarray, lo: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, begin, end) of the best place of each pattern in its text, buf[begin : begin + size], within `width` diagonals from `lo` on.

    The patterns are rows of equal length; a diagonal is text place minus pattern place. Row i of the table holds the cells
    of these diagonals, for all patterns at once.
    """
    m = patterns.shape[1]
    at = lo[:, None] + np.arange(m + width)
    inside = (at >= 0) & (at <= sizes[:, None])
    here = (at >= 0) & (at < sizes[:, None])
    text = np.where(here, np.append(buf, np.uint8(0))[np.where(here, begins[:, None] + at, 0)], np.int16(-1))
    far = np.int32(1 << 20)
    steps = np.arange(width, dtype=np.int32)
    cost = np.where(inside[:, :width], np.int32(0), far)
    begin = at[:, :width].astype(np.int32)
    edge = np.full((len(lo), 1), far), np.zeros((len(lo), 1), np.int32)
    for i in range(1, m + 1):
        diag = cost + (text[:, i - 1 : i - 1 + width] != patterns[:, i - 1 : i])
        up = np.concatenate([cost[:, 1:], edge[0]], 1) + np.int32(1)
        took = up < diag
        best, frm = np.where(took, up, diag), np.where(took, np.concatenate([begin[:, 1:], edge[1]], 1), begin)
        valid = inside[:, i : i + width]
        best = np.where(valid, best, far) - steps
        run = np.minimum.accumulate(best, 1)  # moves along the text cost one each
        source = np.maximum.accumulate(np.where(best == run, steps, 0), 1)
        cost, begin = np.where(valid, run + steps, far), np.take_along_axis(frm, source, 1)
    j, each = cost.argmin(1), np.arange(len(lo))
    return cost[each, j], begin[each, j], lo + m + j


def aligned(pattern: np.ndarray, buf: np.ndarray, lowest: int, highest: int, start: int, k: int) -> tuple[int, int, int] | None:
    """(edits, begin, end) of the best place of `pattern` in `buf` within the diagonals, or None beyond k edits.

    `start` is the pattern's place in the item; diagonals are text place minus item place. They are widened by k on both sides.
    """
    one = np.array([0, len(buf), lowest + start - k])[:, None]
    edits, begin, end = (int(x[0]) for x in align(pattern[None], buf, *one, highest - lowest + 1 + 2 * k))
    return (edits, begin, end) if edits <= k else None


def matches(index: Index, column, enough: int = 0) -> dict[tuple[int, int], tuple[int, int, int, int, int]]:
    """(row, number of the item) to (edits, item begin, item end, text begin, text end) of the best window; one of at most `enough` edits will do."""
    raw, ends = squeeze(*utf8(column))
    # zero bytes between rows, so that no q-gram of an item spans two
    gap = np.arange(len(ends)) * Q
    buf = np.zeros(len(raw) + gap[-1], np.uint8)
    buf[np.arange(len(raw)) + np.repeat(gap[:-1], np.diff(ends))] = raw
    begins, stops = ends[:-1] + gap[:-1], ends[1:] + gap[:-1]
    best: dict[tuple[int, int], tuple] = {}
    if not (spots := regions(index, buf)):
        return best
    w, lowest, highest = np.array(spots, np.int64).T
    a, b = index.starts[w], index.ends[w]
    # a region of hits in one row may begin or end in its neighbours' margins
    rows = np.searchsorted(begins, np.stack([np.maximum(0, lowest + a + Q), (lowest + highest) // 2 + (a + b) // 2, highest + b - Q]), "right") - 1
    use = (rows >= 0) & (rows < len(begins))
    use[1:] &= rows[1:] != rows[:1]
    use[2] &= rows[2] != rows[1]
    guess, spot = np.nonzero(use)
    row = rows[guess, spot]
    order = np.lexsort((lowest[spot], w[spot], index.item[w[spot]], row))
    row, spot = row[order], spot[order]
    pair = np.stack([row, index.item[w[spot]]], 1)
    new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]).any(1)]))
    size = np.diff(np.append(new, len(row)))
    rank, number = np.arange(len(row)) - np.repeat(new, size), np.repeat(np.arange(len(new)), size)
    open_pairs = np.ones(len(new), bool)
    for least, below in ((0, 1), (1, 16), (16, len(row))):  # most pairs have an exact window early on
        todo = np.flatnonzero((rank >= least) & (rank < below) & open_pairs[number])
        length = index.ends[w[spot[todo]]] - index.starts[w[spot[todo]]]
        for m in np.unique(length).tolist():
            same = todo[length == m]
            for part in (same[i : i + ALIGN_ROWS] for i in range(0, len(same), ALIGN_ROWS)):
                s, r, k = spot[part], row[part], budget(m)
                n, start = index.item[w[s]], index.starts[w[s]]
                patterns = index.text[(index.offset[n] + start)[:, None] + np.arange(m)]
                span = int(highest[s[0]] - lowest[s[0]]) + 1 + 2 * k
                edits, begin, end = align(patterns, buf, begins[r], (stops - begins)[r], lowest[s] - begins[r] + start - k, span)
                for j in np.flatnonzero(edits <= k).tolist():
                    value = (int(edits[j]), int(start[j]), int(start[j]) + m, int(begin[j]), int(end[j]))
                    at = (int(r[j]), int(n[j]))
                    if at not in best or value < best[at]:
                        best[at] = value
                        open_pairs[number[part[j]]] = value[0] > enough
    return best


def _search(index: Index):
    def run(batches):
        for part in slices(batches, "text"):
            ids = part.column("doc_id").to_pylist()
            if best := matches(index, part.column("text")):
                rows = [(ids[row], index.items[n][0], a, b, begin, end, edits) for (row, n), (edits, a, b, begin, end) in sorted(best.items())]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()), strict=True)], ["doc_id", "item_id", "item_start", "item_end", "doc_start", "doc_end", "edits"])

    return run


def _clean(index: Index, text_col: str):
    def run(batches):
        for part in slices(batches, text_col):
            keep = np.ones(part.num_rows, bool)
            keep[[row for row, _ in matches(index, part.column(text_col), WINDOW)]] = False
            yield part.filter(pa.array(keep))

    return run


def _groups(benchmark: DataFrame, id_col: str, text_col: str):
    """The benchmark in groups of at most BATCH_BYTES of text, each small enough to send to every task."""
    group, held = [], 0
    rows = benchmark.select(F.col(id_col).cast("long"), text_col).where(F.col(text_col).isNotNull())
    for item, text in rows.toLocalIterator():
        raw, ends = utf8(pa.array([text]))
        text = squeeze(raw, ends)[0].tobytes()
        if len(text) < Q:
            continue
        if group and held + len(text) > BATCH_BYTES:
            yield group
            group, held = [], 0
        group.append((item, text))
        held += len(text)
    if group:
        yield group


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and benchmark item of which it holds a window with at most EDITS of its length in edits.

    Every exact passage of at least WINDOW = 80 bytes of an item is found, wherever in the item it begins; shorter items count as a whole.

    Returns doc_id, item_id, the window (item_start, item_end), where its best match lies (doc_start, doc_end) and its
    edits; offsets are in bytes of the text with A-Z lower-cased and white space squeezed. Of several windows the one with the
    fewest edits counts, then the first.

    Null and empty texts match nothing; items of under Q bytes are passed over. Rows that repeat an id give rows of
    their own, a null id stays null. Empty tables give no rows. Other columns are not looked at.

    The documents are read once for each group of BATCH_BYTES of benchmark text and never shuffled.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for group in _groups(benchmark, item_id, item_text):
        found = base.mapInArrow(_search(Index(group)), MATCH_TYPE)
        out = found if out is None else out.union(found)
    return base.sparkSession.createDataFrame([], MATCH_TYPE) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs` that `contaminated` finds nothing in, unchanged, null and repeated ids like others."""
    for group in _groups(benchmark, item_id, item_text):
        docs = docs.mapInArrow(_clean(Index(group), text_col), docs.schema)
    return docs
