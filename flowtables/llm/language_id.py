"""Language ID by a byte convolutional network.

Filters of several widths slide over one-hot bytes of fixed-length windows; each filter's largest response in a window,
rectified, feeds a softmax over the languages. Trained in numpy on labelled text, applied to all windows of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.common import LOWER, mix, slices, utf8
from flowtables.tables import cut

WIDTHS, FILTERS, LENGTH = (2, 3, 4), 12, 256
SAMPLE_PER_LANG, WINDOWS_PER_TEXT = 600, 4
OUT_TYPE = "doc_id long, lang_pred string, score double"


def windows_of(buf: np.ndarray) -> np.ndarray:
    """The text's bytes as rows of LENGTH, A-Z lower-cased, the last one filled up with zeros."""
    n = max(1, -(-len(buf) // LENGTH))
    out = np.zeros(n * LENGTH, np.uint8)
    out[: len(buf)] = LOWER[buf]
    return out.reshape(n, LENGTH)


class ByteNet:
    """Tables of filter weights by offset and byte, biases, and the softmax layer."""

    def __init__(self, langs: list[str], seed: int = 3):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.tables = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.05, seed: int = 5) -> None:
        """Adagrad on the cross-entropy; a filter's gradient goes to the bytes of its largest response."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.bias, self.out, self.out_bias]
        seen = [np.full_like(p, 1e-3) for p in params]
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows, target = x[order[at : at + batch]], y[order[at : at + batch]]
                tops, wheres = [], []
                for w, table in zip(WIDTHS, self.tables, strict=True):
                    p = rows.shape[1] - w + 1
                    response = sum(table[o][rows[:, o : o + p]] for o in range(w))
                    wheres.append(response.argmax(1))
                    tops.append(response.max(1))
                hidden = np.maximum(np.concatenate(tops, 1) + self.bias, 0)
                logits = hidden @ self.out + self.out_bias
                prob = np.exp(logits - logits.max(1, keepdims=True))
                prob /= prob.sum(1, keepdims=True)
                prob[np.arange(len(target)), target] -= 1
                prob /= len(target)
                back = (prob @ self.out.T) * (hidden > 0)
                grads = []
                for j, (w, where) in enumerate(zip(WIDTHS, wheres, strict=True)):
                    grad = np.zeros((w, 256, FILTERS), np.float32)
                    part = back[:, j * FILTERS : (j + 1) * FILTERS]
                    for o in range(w):
                        np.add.at(grad[o], (np.take_along_axis(rows, where + o, 1), np.arange(FILTERS)[None, :]), part)
                    grads.append(grad)
                for p, s, g in zip(params, seen, [*grads, back.sum(0), hidden.T @ prob, prob.sum(0)], strict=True):
                    s += g * g
                    p -= rate * g / np.sqrt(s)

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Softmax inputs of each window; weights of neighbouring bytes are looked up in pairs."""
        if not hasattr(self, "pairs"):
            two, three, four = self.tables
            join = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
            self.pairs = [join(two[0], two[1]), join(three[0], three[1]), join(four[0], four[1]), join(four[2], four[3])]
        out = np.empty((len(x), len(self.langs)), np.float32)
        for at in range(0, len(x), 64):
            rows = x[at : at + 64]
            pair = rows[:, :-1].astype(np.int32) * 256 + rows[:, 1:]
            a = np.take(self.pairs[0], pair, axis=0).max(1)
            b = np.take(self.pairs[1], pair[:, :-1], axis=0)
            b += np.take(self.tables[1][2], rows[:, 2:], axis=0)
            c = np.take(self.pairs[2], pair[:, :-2], axis=0)
            c += np.take(self.pairs[3], pair[:, 2:], axis=0)
            hidden = np.maximum(np.concatenate([a, b.max(1), c.max(1)], 1) + self.bias, 0)
            out[at : at + 64] = hidden @ self.out + self.out_bias
        return out

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "pairs"}


def _samples(batches):
    for part in slices(batches, "text"):
        raw, ends = utf8(part.column("text"))
        ids = part.column("doc_id").to_pylist()
        rows, langs = [], part.column("lang").to_pylist()
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            n = int(max(1, (b - a) // LENGTH))
            picks = {int(mix(np.uint64((ids[i] or 0) & (2**63 - 1)) + np.uint64(j))) % n for j in range(WINDOWS_PER_TEXT)}
            rows += [(ids[i], langs[i], raw[a + p * LENGTH : min(b, a + (p + 1) * LENGTH)].tobytes()) for p in sorted(picks)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.binary()), strict=True)], ["doc_id", "lang", "piece"])


def _least(rows: DataFrame, k: int) -> DataFrame:
    """lang, doc_id: the k ids of each language with the least hashes `h`, of rows (lang, doc_id, h) without repeats.

    Rows are counted by language and the first bits of the hash, 10 bits more each time, and those of later bins than the k-th row's go. What is left to
    be ranked by language is k rows and a part in 2^20 of its rows.
    """
    for shift in (54, 44):
        bins = rows.groupBy("lang", F.shiftright("h", shift).alias("b")).agg(F.count("*").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        last = bins.withColumn("before", before).where(F.col("before") < k).groupBy("lang").agg(F.max("b").alias("last"))
        rows = rows.join(F.broadcast(last), "lang").where(F.shiftright("h", shift) <= F.col("last")).drop("last")  # a row a language
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    return rows.withColumn("r", rank).where(F.col("r") <= k).select("lang", "doc_id")


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = SAMPLE_PER_LANG) -> ByteNet | None:
    """A network trained on at most `per_lang` texts of each language (by a hash of the id), WINDOWS_PER_TEXT windows of each.

    Where rows repeat an id, as many windows are taken in all, by the hash of the id and their bytes. Rows without text or language are not learned from; None if no row is left.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text rlike '[^\\\\s]'")
    hashed = cut(rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).distinct())
    chosen = _least(hashed, per_lang)
    pieces = rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").mapInArrow(_samples, "doc_id long, lang string, piece binary")
    # never cuts where ids are unique; rows that repeat an id are bounded by it
    few = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "piece")
    pieces = pieces.withColumn("r", F.row_number().over(few)).where(F.col("r") <= per_lang * WINDOWS_PER_TEXT).drop("r").toPandas()
    if not len(pieces):
        return None
    pieces = pieces.sort_values(["doc_id", "lang", "piece"])
    langs = sorted(pieces.lang.unique())
    net = ByteNet(langs)
    x = np.concatenate([windows_of(np.frombuffer(bytes(p), np.uint8)) for p in pieces.piece])
    net.fit(x, np.searchsorted(langs, pieces.lang.to_numpy()))
    return net


def predict(docs: DataFrame, net: ByteNet | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row: the language of the whole text and its probability.

    The softmax inputs of all windows of a text are averaged. `und` with score 0 where the text is null or has no
    letter, or nothing was learned. Ids pass through, null and repeated ones too; an empty table gives an empty one; other columns
    are not looked at.
    """

    def run(batches):
        for part in slices(batches, "text"):
            raw, ends = utf8(part.column("text"))
            texts = part.column("text")
            letter = np.concatenate([[0], np.cumsum((LOWER[raw] >= 97) & (LOWER[raw] <= 122))])[ends]
            known = letter[1:] > letter[:-1]
            for i in np.flatnonzero(~known):
                known[i] = any(c.isalpha() for c in texts[int(i)].as_py() or "")
            names, scores = np.full(len(known), "und", object), np.zeros(len(known))
            if net is not None and known.any():
                held = np.flatnonzero(known)
                rows = [windows_of(raw[ends[i] : ends[i + 1]]) for i in held]
                count = np.array([len(r) for r in rows])
                logits = np.add.reduceat(net.logits(np.concatenate(rows)).astype(np.float64), np.cumsum(count) - count, axis=0) / count[:, None]
                prob = np.exp(logits - logits.max(1, keepdims=True))
                prob /= prob.sum(1, keepdims=True)
                names[held] = np.array(net.langs, object)[prob.argmax(1)]
                scores[held] = prob.max(1)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, OUT_TYPE)
