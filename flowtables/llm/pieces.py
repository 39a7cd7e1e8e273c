"""SentencePiece encoding and decoding as a max-plus parallel scan.

A piece sequence is the byte-pair encoding of its text exactly if every two neighbours are the encoding of the two of
them alone. So encoding is a path search over the pieces that match the text, in max-plus algebra: a step between neighbours
weighs 0 if they are compatible and minus infinity if not, and just one path has weight 0.

Where a space follows something else no piece can lie across; between two such places a text is a unit, encoded once
however often it occurs. A giant document is cut into chunks anywhere. Its state at a cut is the piece that lies across
or ends there; a chunk yields the matrix of weights from the states at its begin to those at its end. Matrices are
combined associatively along the document, which leaves one state at each cut, and every chunk is then traced back on its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from flowtables.llm.common import BYTE_WORDS, ODD, slices, utf8
from flowtables.tables import cut

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK, LONG_UNIT, PAIR_BITS, KNOWN_UNITS, DECODED = 1 << 16, 64, 21, 200_000, 100_000
NO, EDGE = -1, -2
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))


def _fields(data: bytes):
    """(number, begin, end of the field, begin of its content) of the length-delimited and other fields of a protobuf message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        begin = at
        tag = varint()
        kind = tag & 7
        if kind == 2:
            size = varint()
            inside = at
            at += size
        else:
            inside = at
            at = at + 8 if kind == 1 else at + 4 if kind == 5 else at
            if kind == 0:
                varint()
        yield tag >> 3, begin, at, inside


def without_prefix(model: bytes) -> bytes:
    """The model with its normalizer told not to put a space before a text."""
    out = b""
    for number, begin, end, inside in _fields(model):
        if number == 3:  # normalizer_spec; its add_dummy_prefix is field 3, the last value counts
            spec = model[inside:end] + b"\x18\x00"
            size, n = b"", len(spec)
            while n > 127:
                size, n = size + bytes([n & 127 | 128]), n >> 7
            out += b"\x1a" + size + bytes([n]) + spec
        else:
            out += model[begin:end]
    return out


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Vocabulary:
    """The pieces of a byte-pair model with byte fallback, spaces as spaces."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        with open(path, "rb") as f:
            self.model = without_prefix(f.read())
        sp = self.processor()
        n = sp.get_piece_size()
        self.texts = ["" if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ") for i in range(n)]
        self.first_byte = next(i for i in range(n) if sp.is_byte(i))
        alone = sp.encode(self.texts, num_threads=1)
        self.ids = {t.encode(): i for i, (t, e) in enumerate(zip(self.texts, alone, strict=True)) if t and e == [i]}
        self.bytes = [bytes([i - self.first_byte]) if sp.is_byte(i) else t.encode() for i, t in enumerate(self.texts)]
        self.size = np.array([len(b) for b in self.bytes], np.int64)
        self.lengths = sorted({len(b) for b in self.ids}, reverse=True)
        self.longest = max(self.lengths)
        whole = any(b" " in b.lstrip(b" ") for b in self.ids)
        if whole:
            raise ValueError("pieces that go on after a space are not supported")
        inside = set(b"".join(self.ids))
        self.barrier = np.array([b < 128 and b not in inside for b in range(256)])
        self.tables = {}
        for length in self.lengths:
            same = [(b, i) for b, i in self.ids.items() if len(b) == length]
            raw = np.frombuffer(b"".join(b for b, _ in same), np.uint8).reshape(-1, length)
            h = (BYTE_WORDS[raw] * powers(ODD, length)).sum(1, dtype=np.uint64)
            order = np.argsort(h)
            seen = np.zeros(1 << 16, bool)
            seen[(h * ODD) >> np.uint64(48)] = True
            self.tables[length] = h[order], np.array([i for _, i in same], np.int32)[order], seen
        self.pool = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.pool_at = np.cumsum(self.size) - self.size

    def processor(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    def lookup(self, h: np.ndarray, length: int) -> np.ndarray:
        """The piece of each hash of `length` bytes, or NO."""
        hashes, ids, seen = self.tables[length]
        out = np.full(len(h), NO, np.int32)
        at = np.flatnonzero(seen[(h * ODD) >> np.uint64(48)])
        if len(at):
            place = np.minimum(np.searchsorted(hashes, h[at]), len(hashes) - 1)
            hit = hashes[place] == h[at]
            out[at[hit]] = ids[place[hit]]
        return out


class Encoder:
    """Encodes bytes with a vocabulary; remembers which pieces go together, and up to KNOWN_UNITS units."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.sp = vocabulary.processor()
        self.pair_keys = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_fit = np.zeros(1 << PAIR_BITS, bool)
        self.pairs: dict[int, bool] = {}
        self.power, self.inverse = powers(ODD, 1 << 16), powers(INVERSE, 1 << 16)
        self.forget()

    def forget(self) -> None:
        self.units: dict[int, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.unit_at, self.unit_n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ask(self, keys: list[int]) -> list[bool]:
        n, texts = len(self.v.texts), self.v.texts
        both = [divmod(k, n) for k in keys]
        return [e == [p, t] for e, (p, t) in zip(self.sp.encode([texts[p] + texts[t] for p, t in both], num_threads=1), both, strict=True)]

    def compatible(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether `after` may follow `before`, for arrays of pieces; pieces of a fallen-back byte go with all."""
        lo, hi = self.v.first_byte, self.v.first_byte + 256
        free = (before < 0) | (before >= lo) & (before < hi) | (after >= lo) & (after < hi)
        key = before.astype(np.int64) * len(self.v.texts) + after
        slot = ((key.astype(np.uint64) * ODD) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        fit = self.pair_fit[slot]
        new = np.flatnonzero((self.pair_keys[slot] != key) & ~free)
        if len(new):
            asked, at = np.unique(key[new], return_inverse=True)
            answer = np.array(self.ask(asked.tolist()))
            fit[new] = answer[at]
            place = ((asked.astype(np.uint64) * ODD) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
            self.pair_keys[place], self.pair_fit[place] = -1, False
            # of two pairs in one place the last stays, with its own answer
            self.pair_keys[place], self.pair_fit[place] = asked, answer
        return fit | free

    def fits(self, before: int, after: int) -> bool:
        lo, hi = self.v.first_byte, self.v.first_byte + 256
        if before < 0 or lo <= before < hi or lo <= after < hi:
            return True
        key = before * len(self.v.texts) + after
        if key not in self.pairs:
            if len(self.pairs) > 1 << 20:
                self.pairs.clear()
            self.pairs[key] = self.ask([key])[0]
        return self.pairs[key]

    def cuts(self, buf: np.ndarray) -> np.ndarray:
        """Where no piece can lie across: before a space after something else, and around bytes that no piece holds."""
        space, barrier = buf == 32, self.v.barrier[buf]
        out = np.zeros(len(buf), bool)
        if len(buf):
            out[0] = True
            out[1:] = space[1:] & ~space[:-1] | barrier[1:] | barrier[:-1]
        return out

    def unknown(self, raw: bytes) -> set[int]:
        """The places of bytes whose character is no piece."""
        out, at = set(), 0
        for c in raw.decode("utf-8", "surrogateescape"):
            size = len(c.encode("utf-8", "surrogateescape"))
            if raw[at : at + size] not in self.v.ids:
                out.update(range(at, at + size))
            at += size
        return out

    def grow(self, raw: bytes, unknown: set[int], last: dict[int, int], begin: int, end: int) -> dict[int, int]:
        """Pieces ending at each place from begin + 1 to end, on from those in `last`; at most one can end at a place."""
        ids, lengths, byte = self.v.ids, self.v.lengths, self.v.first_byte
        for i in range(begin + 1, end + 1):
            if i - 1 in unknown:
                if i - 1 in last:
                    last[i] = byte + raw[i - 1]
                continue
            for n in lengths:
                p = last.get(i - n)
                if p is not None and (t := ids.get(raw[i - n : i])) is not None and self.fits(p, t):
                    last[i] = t
                    break
        return last

    def back(self, last: dict[int, int], end: int, begin: int) -> list[int]:
        out = []
        while end > begin:
            out.append(last[end])
            end -= int(self.v.size[last[end]])
        return out[::-1]

    def sums(self, buf: np.ndarray) -> np.ndarray:
        """Sums from which the hash of any stretch of the buffer follows (`stretch`)."""
        if len(buf) >= len(self.power):
            self.power, self.inverse = powers(ODD, 2 * len(buf)), powers(INVERSE, 2 * len(buf))
        out = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(BYTE_WORDS[buf] * self.power[: len(buf)], out=out[1:])
        return out

    def stretch(self, sums: np.ndarray, at: np.ndarray, n) -> np.ndarray:
        return (sums[at + n] - sums[at]) * self.inverse[at]

    def encode(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of a buffer of texts that begin at `starts`, and where each text's pieces begin. A unit is searched once."""
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(starts), np.int64)
        edge = self.cuts(buf)
        edge[starts[starts < len(buf)]] = True
        begin = np.flatnonzero(edge)
        length = np.diff(np.append(begin, len(buf)))
        key = self.stretch(self.sums(buf), begin, length) + length.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        unique, index, of = np.unique(key, return_index=True, return_inverse=True)
        if len(self.units) > KNOWN_UNITS:
            self.forget()
        names = unique.tolist()
        place = np.array([self.units.get(k, NO) for k in names], np.int64)
        new = np.flatnonzero(place == NO)
        if len(new):
            n = length[index[new]]
            at = np.cumsum(n) - n
            flat, counts = self.search(buf[np.arange(n.sum()) + np.repeat(begin[index[new]] - at, n)], at, n)
            place[new] = np.arange(len(self.units), len(self.units) + len(new))
            self.units.update((names[i], p) for i, p in zip(new.tolist(), place[new].tolist(), strict=True))
            if self.used + len(flat) > len(self.flat):
                self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used + len(flat), np.int32)])
            self.flat[self.used : self.used + len(flat)] = flat
            self.unit_at = np.append(self.unit_at, self.used + np.cumsum(counts) - counts)
            self.unit_n = np.append(self.unit_n, counts)
            self.used += len(flat)
        which = place[of]
        n = self.unit_n[which]
        ends = np.cumsum(n)
        pieces = self.flat[np.arange(ends[-1]) + np.repeat(self.unit_at[which] - ends + n, n)]
        return pieces, np.concatenate([[0], ends])[np.searchsorted(begin, starts)]

    def search(self, buf: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of units, and the number of each; units of up to LONG_UNIT bytes go through the search side by side, a place at a time."""
        v, sums = self.v, self.sums(buf)
        # characters of several bytes that are no piece, and single bytes that are none
        lost = np.array([bytes([b]) not in v.ids for b in range(256)])[buf]
        for n, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0xF8)):
            at = np.flatnonzero((buf >= low) & (buf < high))
            at = at[at + n <= len(buf)]
            known = v.lookup(self.stretch(sums, at, n), n) != NO if n in v.tables else np.zeros(len(at), bool)
            for j in range(n):
                lost[at[known] + j] = False
        counts = np.zeros(len(first), np.int64)
        parts, order = [], []
        by_size = np.argsort(-size, kind="stable")
        long = int(np.searchsorted(-size[by_size], -LONG_UNIT))
        if long < len(by_size):
            units = by_size[long:]
            s, n = first[units], size[units]
            most = int(n[0])
            live = np.searchsorted(-n, -np.arange(most + 1), "right")  # units of at least so many bytes come first
            last = np.full((len(units), most + 1), NO, np.int32)
            last[:, 0] = EDGE
            for i in range(1, most + 1):
                by_byte = np.flatnonzero(lost[s[: live[i]] + i - 1])
                last[by_byte, i] = np.where(last[by_byte, i - 1] != NO, v.first_byte + buf[s[by_byte] + i - 1], NO)
                todo = np.flatnonzero(~lost[s[: live[i]] + i - 1])
                for m in v.lengths:
                    if m > i or not len(todo):
                        continue
                    rows = todo[last[todo, i - m] != NO]
                    piece = v.lookup(self.stretch(sums, s[rows] + i - m, m), m)
                    rows, piece = rows[piece != NO], piece[piece != NO]
                    if len(rows):
                        fit = self.compatible(last[rows, i - m], piece)
                        last[rows[fit], i] = piece[fit]
                        todo = todo[last[todo, i] == NO]
            if (last[np.arange(len(units)), n] == NO).any():
                raise ValueError("a text has no encoding with this vocabulary")
            out, at, taken = np.zeros((len(units), most), np.int32), n.copy(), np.zeros(len(units), np.int64)
            walk = np.arange(len(units))
            while len(walk):
                t = last[walk, at[walk]]
                taken[walk] += 1
                out[walk, most - taken[walk]] = t
                at[walk] -= v.size[t]
                walk = walk[at[walk] > 0]
            counts[units] = taken
            parts.append(out[np.arange(most)[None, :] >= (most - taken)[:, None]])
            order.append(units)
        for u in by_size[:long]:
            raw = buf[first[u] : first[u] + size[u]].tobytes()
            ids = self.back(self.grow(raw, self.unknown(raw), {0: EDGE}, 0, len(raw)), len(raw), 0)
            counts[u] = len(ids)
            parts.append(np.array(ids, np.int32))
            order.append(np.array([u]))
        flat, order = np.concatenate(parts), np.concatenate(order)
        at, n = np.empty(len(first), np.int64), counts
        at[order] = np.cumsum(counts[order]) - counts[order]
        ends = np.cumsum(n)
        return flat[np.arange(ends[-1]) + np.repeat(at - ends + n, n)], counts


def worker_encoder(vocabulary: Vocabulary) -> Encoder:
    """The encoder of this Python process: what it has learned serves all tasks that run here."""
    import sentencepiece

    kept = sentencepiece.__dict__.setdefault("_flowtables_encoders", {})
    if vocabulary.model not in kept:
        kept[vocabulary.model] = Encoder(vocabulary)
    return kept[vocabulary.model]


class Chunk:
    """The stretch from a to b of a document, seen with enough bytes on either side to tell the states at its ends."""

    def __init__(self, encoder: Encoder, raw: bytes, a: int, b: int, at_start: bool, at_end: bool):
        self.e, self.raw, self.a, self.b = encoder, raw, a, b
        self.edge = encoder.cuts(np.frombuffer(raw, np.uint8))
        self.edge[0] = at_start  # what precedes the bytes in view is not known otherwise
        self.edge = np.append(self.edge, at_end)
        # a character cut by the view's ends never matters: states reach no further than the longest piece
        self.unknown = encoder.unknown(raw)
        inner = np.flatnonzero(self.edge[a : b + 1])
        self.first, self.last = (a + int(inner[0]), a + int(inner[-1])) if len(inner) else (None, None)

    def states(self, at: int) -> list[tuple[int, int] | None]:
        """The pieces that may lie across or end at a place, as (begin, piece); None where no piece can lie across."""
        if self.edge[at]:
            return [None]
        v, out = self.e.v, []
        for s in range(max(0, at - v.longest), at):
            if s in self.unknown:
                if s == at - 1:
                    out.append((s, v.first_byte + self.raw[s]))
                continue
            for n in v.lengths:
                if s + n >= at and s + n <= len(self.raw) and (t := v.ids.get(self.raw[s : s + n])) is not None:
                    out.append((s, t))
        return sorted(out)

    def reach(self, state: tuple[int, int] | None, to: int) -> dict[int, int]:
        """Pieces ending at each place up to `to` on the ways from a state at a."""
        if state is None:
            return self.e.grow(self.raw, self.unknown, {self.a: EDGE}, self.a, to)
        end = state[0] + int(self.e.v.size[state[1]])
        return self.e.grow(self.raw, self.unknown, {end: state[1]}, end, to)

    def leaves(self, last: dict[int, int], state: tuple[int, int] | None) -> bool:
        """Whether the ways in `last` go on to a state at b."""
        if state is None:
            return self.b in last
        return state[0] in last and self.e.fits(last[state[0]], state[1])

    def matrix(self) -> np.ndarray:
        """Max-plus weights from the states at a to those at b: 0 where a way leads, else minus infinity."""
        enter, leave = self.states(self.a), self.states(self.b)
        if self.first is not None:
            head = np.array([0.0 if self.first in self.reach(s, self.first) else -np.inf for s in enter])
            ways = self.e.grow(self.raw, self.unknown, {self.last: EDGE}, self.last, self.b)
            tail = np.array([0.0 if self.leaves(ways, s) else -np.inf for s in leave])
            return head[:, None] + tail[None, :]
        ways = [self.reach(s, self.b) for s in enter]
        return np.array([[0.0 if self.leaves(w, s) else -np.inf for s in leave] for w in ways])

    def trace(self, enter: int, leave: int) -> np.ndarray:
        """The pieces that begin in the chunk, given the number of its state at either end."""
        start, stop = self.states(self.a)[enter], self.states(self.b)[leave]
        begin = self.a if start is None else start[0] + int(self.e.v.size[start[1]])
        end = self.b if stop is None else stop[0]
        own = [] if stop is None else [stop[1]]
        if self.first is None:
            return np.array(self.e.back(self.reach(start, end), end, begin) + own, np.int32)
        head = self.e.back(self.reach(start, self.first), self.first, begin) if self.first > begin else []
        middle, _ = self.e.encode(np.frombuffer(self.raw[self.first : self.last], np.uint8), np.zeros(1, np.int64))
        tail = self.e.back(self.e.grow(self.raw, self.unknown, {self.last: EDGE}, self.last, end), end, self.last)
        return np.concatenate([np.array(head, np.int32), middle, np.array(tail + own, np.int32)])


def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The max-plus product: the best weight through any state in between. Associative."""
    return (x[:, :, None] + y[None, :, :]).max(1)


def best_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at each cut of the best way through a document's chunks: suffix products from the end, then the
    best state each time from the start."""
    after = [matrices[-1].max(1)]
    for m in reversed(matrices[:-1]):
        after.append(product(m, after[-1][:, None])[:, 0])
    after.append(np.zeros(matrices[-1].shape[1]))
    after = after[:-1][::-1] + after[-1:]
    out = [int(after[0].argmax())]
    for m, rest in zip(matrices, after[1:], strict=True):
        out.append(int((m[out[-1]] + rest).argmax()))
    return out


def _spaced(column) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, each with a space before it unless it is empty, and their ends."""
    raw, ends = utf8(column)
    n = np.diff(ends)
    shift = np.cumsum(n > 0)
    out = np.full(len(raw) + int(shift[-1]) if len(shift) else 0, 32, np.uint8)
    out[np.arange(len(raw)) + np.repeat(shift, n)] = raw
    return out, ends + np.concatenate([[0], shift])


def _encode_small(vocabulary: Vocabulary, text_col: str, columns: list[str]):
    def run(batches):
        encoder = worker_encoder(vocabulary)
        for part in slices(batches, text_col):
            buf, ends = _spaced(part.column(text_col))
            pieces, at = encoder.encode(buf, ends)
            offsets = pa.array(np.append(at[:-1], len(pieces)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.ListArray.from_arrays(offsets, pa.array(pieces))], [*columns, "ids"])

    return run


def _chunks(margin: int, size: int):
    """Giant texts to rows of a chunk each, with `margin` bytes on either side."""

    def run(batches):
        for part in slices(batches, "text"):
            buf, ends = _spaced(part.column("text"))
            for i in range(part.num_rows):
                raw = buf[ends[i] : ends[i + 1]].tobytes()
                at, k = 0, 0
                while at < len(raw):
                    to = min(len(raw), at + size)
                    while to < len(raw) and raw[to] & 0xC0 == 0x80:
                        to += 1  # between characters
                    lo, hi = max(0, at - margin), min(len(raw), to + margin)
                    while lo > 0 and raw[lo] & 0xC0 == 0x80:
                        lo -= 1
                    while hi < len(raw) and raw[hi] & 0xC0 == 0x80:
                        hi += 1
                    yield pa.RecordBatch.from_arrays([part.column("id").slice(i, 1), part.column("th").slice(i, 1), *(pa.array([x], t) for x, t in ((k, pa.int64()), (raw[lo:hi], pa.binary()), (at - lo, pa.int32()), (to - lo, pa.int32()), (lo == 0, pa.bool_()), (hi == len(raw), pa.bool_())))], ["id", "th", "chunk", "raw", "a", "b", "at_start", "at_end"])
                    at, k = to, k + 1

    return run


CHUNK_TYPE = "id long, th long, chunk long, raw binary, a int, b int, at_start boolean, at_end boolean"


def _chunk(encoder, row) -> Chunk:
    return Chunk(encoder, bytes(row.raw), int(row.a), int(row.b), bool(row.at_start), bool(row.at_end))


def _matrices(vocabulary: Vocabulary):
    def run(frames):
        encoder = worker_encoder(vocabulary)
        for rows in frames:
            found = [_chunk(encoder, r).matrix() for r in rows.itertuples()]
            yield pd.DataFrame({"id": rows.id, "th": rows.th, "chunk": rows.chunk, "height": [m.shape[0] for m in found], "weights": [m.ravel().tolist() for m in found]})

    return run


def _resolve(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("chunk")
    states = best_states([np.array(w).reshape(h, -1) for w, h in zip(rows.weights, rows.height, strict=True)])
    return pd.DataFrame({"id": rows.id, "th": rows.th, "chunk": rows.chunk, "enter": states[:-1], "leave": states[1:]})


def _traced(vocabulary: Vocabulary):
    def run(frames):
        encoder = worker_encoder(vocabulary)
        for rows in frames:
            yield pd.DataFrame({"id": rows.id, "th": rows.th, "chunk": rows.chunk, "ids": [_chunk(encoder, r).trace(int(r.enter), int(r.leave)) for r in rows.itertuples()]})

    return run


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None, model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """`columns` of every row (all by default) and ids: the pieces of its text, the same as SentencePiece's own encoding.

    Null and empty texts have no pieces (an empty array). Rows with null and repeated ids are rows like others; an empty
    table gives an empty one. An input column named ids is replaced, others pass through. Unlike in SentencePiece, the
    character U+2581, which stands for a space in pieces, is encoded by its bytes, so that every text decodes to itself.

    Texts of more than `chunk` bytes are cut into chunks, so that no task encodes a whole one; only their small matrices
    are gathered by document, and the chunks' pieces by row.
    """
    vocabulary = Vocabulary(model)
    columns = [c for c in (docs.columns if columns is None else columns) if c != "ids"]
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0))
    schema = StructType([*(docs.schema[c] for c in columns), StructField("ids", ArrayType(IntegerType()))])
    small = docs.where(size <= chunk).select(*dict.fromkeys([*columns, text_col])).mapInArrow(_encode_small(vocabulary, text_col, columns), schema)
    rows = docs.where(size > chunk).withColumns({"__id": F.coalesce(F.col(id_col).cast("long"), F.lit(-1)), "__th": F.xxhash64(text_col)})
    large = rows.select(F.col("__id").alias("id"), F.col("__th").alias("th"), F.col(text_col).alias("text")).dropDuplicates(["id", "th"])
    parts = cut(large.mapInArrow(_chunks(vocabulary.longest + 4, chunk), CHUNK_TYPE))
    matrices = parts.repartition("id", "th", "chunk").mapInPandas(_matrices(vocabulary), "id long, th long, chunk long, height int, weights array<double>")
    states = matrices.groupBy("id", "th").applyInPandas(_resolve, "id long, th long, chunk long, enter int, leave int")
    traced = parts.join(states, ["id", "th", "chunk"]).mapInPandas(_traced(vocabulary), "id long, th long, chunk long, ids array<int>")
    whole = traced.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts")).select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.flatten(F.col("parts.ids")).alias("__ids"))
    again = rows.join(whole, ["__id", "__th"]).select(*columns, F.col("__ids").alias("ids"))
    return small.union(again)


def decode(encoded: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """(id_col, ids_col, text) of every row of pieces; null and empty arrays give the empty text."""
    vocabulary = Vocabulary(model)

    def run(batches):
        v = vocabulary
        for batch in batches:
            total = np.concatenate([[0], np.cumsum(batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            to = 0
            while to < batch.num_rows:
                at, to = to, max(to + 1, int(np.searchsorted(total, total[to] + DECODED, "right")) - 1)
                part, offsets = batch.slice(at, to - at), total[at : to + 1] - total[at]
                ids = part.column("ids")
                pieces = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                size = v.size[pieces]
                ends = np.concatenate([[0], np.cumsum(size)])
                buf = v.pool[np.arange(ends[-1]) - np.repeat(ends[:-1] - v.pool_at[pieces], size)]
                begin, stop = ends[offsets[:-1]], ends[offsets[1:]]
                texts = [buf[a + 1 : b].tobytes().decode("utf-8", "replace") for a, b in zip(begin, stop, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), ids, pa.array(texts, pa.string())], ["id", "ids", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "id long, ids array<int>, text string").select(F.col("id").alias(id_col), F.col("ids").alias(ids_col), "text")
