"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel compares words by the ordered letter triples they share, also with letters in between: a triple that spans
s letters counts `DECAY` ** s, up to `SPAN` letters. So `stuxpid`, `s.t.u.p.i.d` and an inflected stem stay close to
the insult. Some words serve as landmarks; a word's kernel values with them, whitened by the landmarks' own kernel
matrix, are its features, on which a linear machine with squared hinge loss is trained in numpy. Labels are of
whole texts: the machine is trained on each text's most suspect word (multiple-instance learning).

The triples are an explicit feature space of the kernel, so the trained machine is one weight per triple, and scoring
all words of a corpus costs a few table look-ups per letter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from flowtables.llm.common import slices

SPAN, DECAY, LETTERS, LONG = 6, 0.75, 64, 24
SAMPLE_ROWS, SAMPLE_CHARS, NEGATIVES, LANDMARKS, ROUNDS = 1500, 8_000, 100_000, 512, 4
GRAMS, SLOPES, EVEN, FOLDS, PER_TEXT, SEED_TEXTS = range(4, 8), (2.6, 12.0), (0.0, 0.55), 2, 8, 300
STEPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
# (letters, step) of the stretches that a longer word is also looked at in; each holds any run of letters - step + 1 whole
STRETCHES, AT_ONCE = ((12, 4), (LONG, 8)), 20_000
# single characters set apart by white space are one word, and so are parts of one or two
SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)"), re.compile(r"(?<!\S)\S{1,2}(?:\s+\S{1,2}){2,}(?!\S)")


def tokens_of(text: str | None) -> set[str]:
    """The distinct words of a text, lower-cased; three or more single characters in a row are joined to one, also parts of up to two."""
    low = (text or "").lower()
    found = set(low.split())
    for pattern in SPACED:
        found.update("".join(m.split()) for m in pattern.findall(low))
    return found


def stretches(word: str) -> Iterator[str]:
    """Overlapping stretches of the letters of a word of more than LONG letters, as a whole word's norm hides an insult in it."""
    if len(word) <= LONG:
        return
    letters = "".join(filter(str.isalpha, word))
    if len(letters) > LONG:
        for size, step in STRETCHES:
            for at in range(0, len(letters) - size + step, step):
                yield letters[(start := min(at, len(letters) - size)) : start + size]


def words_of(text: str | None) -> set[str]:
    """The words of a text and the stretches of its long ones."""
    found = tokens_of(text)
    return found.union(*map(stretches, found))


class Alphabet:
    """Letters to numbers: the frequent ones have numbers of their own, others share by code point, all else is 0.

    The last two numbers mark a word's begin and end, so that a stem inside a longer word differs from the stem alone.
    """

    def __init__(self, letters: list[str]):
        own = letters[: LETTERS - 11]
        self.codes = {c: i + 1 for i, c in enumerate(own)}
        self.table = np.zeros(0x500, np.int16)
        for c in map(chr, range(0x500)):
            self.table[ord(c)] = self.code(c)

    def code(self, c: str) -> int:
        return self.codes.get(c) or (len(self.codes) + 1 + ord(c) % 8 if c.isalpha() else 0)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The letters of all words in one array, each word between its marks, and the length of each; 0 without letters."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        length = np.fromiter(map(len, words), np.int64, len(words))
        low = points < len(self.table)
        codes = self.table[np.where(low, points, 0)]
        for c in np.unique(points[~low]):
            codes[points == c] = self.code(chr(c))
        row = np.repeat(np.arange(len(words)), length)[codes > 0]
        count = np.bincount(row, minlength=len(words))
        marked = np.where(count > 0, count + 2, 0)
        ends = np.cumsum(marked)
        out = np.empty(marked.sum(), np.int64)
        out[np.arange(len(row)) + 2 * (np.cumsum(count > 0) - 1)[row] + 1] = codes[codes > 0]
        out[(ends - marked)[count > 0]] = LETTERS - 2
        out[ends[count > 0] - 1] = LETTERS - 1
        return out, marked


def triples(codes: np.ndarray, length: np.ndarray):
    """(word, triple number, kernel weight) of every gapped letter triple, for one pair of steps at a time."""
    row = np.repeat(np.arange(len(length)), length)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(codes))  # letters from here to the word's end
    for i, j in STEPS:
        at = np.flatnonzero(left > j)
        yield row[at], (codes[at] * LETTERS + codes[at + i]) * LETTERS + codes[at + j], DECAY ** (j + 1)


def norm(codes: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The root of the kernel of each word with itself; triples that repeat are added up only in words beyond LONG letters."""
    total = sum(DECAY ** (2 * (j + 1)) * np.maximum(length - j, 0) for _, j in STEPS)
    long = np.flatnonzero(length > LONG)
    if len(long):
        part = codes[np.repeat(length > LONG, length)]
        row, number, weight = (np.concatenate(x) for x in zip(*((r, n, np.full(len(r), w)) for r, n, w in triples(part, length[long])), strict=True))
        pair, at = np.unique(row * LETTERS**3 + number, return_inverse=True)
        total[long] = np.bincount(pair // LETTERS**3, np.bincount(at, weight) ** 2, len(long))
    return np.sqrt(np.maximum(total, 1e-9))


class Machine:
    def __init__(self, alphabet: Alphabet):
        self.alphabet = alphabet
        self.weights = np.zeros(LETTERS**3, np.float32)
        self.bias, self.slope, self.shift = -1.0, 1.0, 0.0

    def margins(self, words: list[str]) -> np.ndarray:
        """The machine's value of each word; its bias alone for words without letters."""
        if not words:
            return np.zeros(0)
        codes, length = self.alphabet.encode(words)
        total = np.zeros(len(words))
        for row, number, weight in triples(codes, length):
            total += np.bincount(row, self.weights[number], len(words)) * weight
        return total / norm(codes, length) + self.bias

    def top(self, texts: list[str | None]) -> list[tuple[float, str]]:
        """The most suspect word of each text and its value; (bias, "") for texts without words."""
        sets = [tokens_of(t) for t in texts]
        best = self.top_of(sets)
        # a long text without spaces has very many stretches: some at a time
        for part in batched(((n, x) for n, s in enumerate(sets) for w in s for x in stretches(w)), AT_ONCE):
            for (n, word), value in zip(part, self.margins([x for _, x in part]).tolist(), strict=True):
                best[n] = max(best[n], (value, word))
        return best

    def top_of(self, sets: list[set[str]]) -> list[tuple[float, str]]:
        every = list(set().union(*sets))
        value = dict(zip(every, self.margins(every).tolist(), strict=True))
        return [max(((value[w], w) for w in s), default=(self.bias, "")) for s in sets]

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def kernel_rows(words: list[str], alphabet: Alphabet, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, place in `known`, normalised weight) of the words' triples that are in the sorted list `known`."""
    codes, length = alphabet.encode(words)
    scale = norm(codes, length)
    parts = []
    for row, number, weight in triples(codes, length):
        at = np.searchsorted(known, number)
        hit = known[np.minimum(at, len(known) - 1)] == number
        parts.append((row[hit], at[hit], weight / scale[row[hit]]))
    row, place, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(row, kind="stable")
    return row[order], place[order], weight[order].astype(np.float32)


def train(machine: Machine, good: list[str], bad: list[str], ridge: float = 1e-4) -> None:
    """Landmarks from both classes, Nystroem features, and a squared-hinge machine by Newton steps."""
    alphabet = machine.alphabet
    landmarks = list(dict.fromkeys(bad))[: LANDMARKS * 2 // 3]
    landmarks += list(dict.fromkeys(good))[: LANDMARKS - len(landmarks)]
    numbers = [n for _, n, _ in triples(*alphabet.encode(landmarks))]
    known = np.unique(np.concatenate(numbers))
    if not len(known):
        return
    base = np.zeros((len(landmarks), len(known)), np.float32)
    row, place, weight = kernel_rows(landmarks, alphabet, known)
    np.add.at(base, (row, place), weight)
    own, vectors = np.linalg.eigh((base @ base.T).astype(np.float64))
    keep = own > 1e-6 * own.max()
    whiten = vectors[:, keep] / np.sqrt(own[keep])
    # a word that many texts have is one row that counts as often
    often = Counter(bad)
    words = [*often, *good]
    y = np.concatenate([np.ones(len(often)), -np.ones(len(good))])
    cost = np.concatenate([np.fromiter(often.values(), float, len(often)) / max(1, len(bad)), np.full(len(good), 3 / max(1, len(good)))])
    row, place, weight = kernel_rows(words, alphabet, known)
    kernel, columns = np.zeros((len(words), len(landmarks)), np.float32), np.ascontiguousarray(base.T)
    for at in range(0, len(words), 128):
        lo, hi = np.searchsorted(row, [at, at + 128])
        if hi > lo:
            first = np.flatnonzero(np.diff(row[lo:hi], prepend=-1))
            kernel[row[lo:hi][first]] = np.add.reduceat(columns[place[lo:hi]] * weight[lo:hi, None], first)
    x = np.column_stack([kernel @ whiten, np.ones(len(words))])
    w, eye = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    eye[-1, -1] = 1e-6
    for _ in range(15):
        active = y * (x @ w) < 1
        a = x[active] * cost[active, None]
        new = np.linalg.solve(eye + a.T @ x[active], a.T @ y[active])
        if np.allclose(new, w, atol=1e-5):
            break
        w = new
    primal = base.T @ (whiten @ w[:-1])
    machine.weights = np.zeros(LETTERS**3, np.float32)
    machine.weights[known] = primal
    machine.bias = float(w[-1])


def disguised(words: list[str], rng: np.random.Generator) -> list[str]:
    """Each word once with a letter of another word put in, once with a letter doubled."""
    letters = [c for w in words for c in w if c.isalpha()]
    out = []
    for w in words:
        at = int(rng.integers(1, len(w))) if len(w) > 1 else 0
        out += [w[:at] + letters[int(rng.integers(len(letters)))] + w[at:], w[: at + 1] + w[at:]] if letters else []
    return out


def calibrate(machine: Machine, margins: np.ndarray, labels: np.ndarray) -> None:
    """A logistic curve through the texts' values (Platt scaling): the least of a convex loss, found by Newton steps that are halved until
    the loss falls. The ridge pulls it to slope 3, and both are bounded, the slope to SLOPES and the value with even odds to EVEN: few
    texts, or texts that a value tells apart wholly, cannot make it arbitrarily steep, the machine's margin of 1 for an insult always
    scores above 0.7, and a text without suspect words low.
    """
    x = np.column_stack([margins, np.ones(len(margins))])
    goal = np.where(labels > 0, (labels.sum() + 1) / (labels.sum() + 2), 1 / (len(labels) - labels.sum() + 2))
    prior, ridge = np.array([3.0, 0.0]), np.diag([1.0, 0.01])
    loss = lambda w: np.logaddexp(0, x @ w).sum() - goal @ (x @ w) + (w - prior) @ ridge @ (w - prior) / 2
    w = prior
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - goal) + ridge @ (w - prior))
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        if size <= 1e-6 or abs(size * step).max() < 1e-8:
            break
        w = w - size * step
    slope = float(np.clip(w[0], *SLOPES))
    even = float(np.clip(-w[1] / w[0] if w[0] > 0 else EVEN[1], *EVEN))
    machine.slope, machine.shift = slope, -slope * even


def substrings(word: str) -> set[str]:
    """The runs of GRAMS letters of a word between its marks, and the whole of it: what inflected forms of a stem share."""
    marked = f"^{word}$"
    return {marked}.union(marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1))


def _trained(sets: list[set[str]], labels: np.ndarray) -> Machine:
    """A machine from texts' words and labels: rounds of training on the words that the last round found most suspect.

    The first round takes from each toxic text the words with the parts that most toxic and fewest clean texts have. From clean texts come the
    words with the highest values so far, and some others.
    """
    in_bad: dict[str, int] = {}
    in_good: dict[str, int] = {}
    grams_bad: dict[str, int] = {}
    grams_good: dict[str, int] = {}
    for s, label in zip(sets, labels, strict=True):
        counts = in_bad if label else in_good
        for w in s:
            counts[w] = counts.get(w, 0) + 1
    # parts are counted in the first SEED_TEXTS of each label: enough to begin with
    some = {k: [s for s, label in zip(sets, labels, strict=True) if label == k][:SEED_TEXTS] for k in (1, 0)}
    for s in some[1]:
        for g in set().union(*map(substrings, s)):
            grams_bad[g] = grams_bad.get(g, 0) + 1
    for s in some[0]:
        for g in set().union(*map(substrings, s)) & grams_bad.keys():
            grams_good[g] = grams_good.get(g, 0) + 1
    letters = Counter("".join([*in_good, *in_bad]))
    machine = Machine(Alphabet([c for c in sorted(letters, key=lambda c: (-letters[c], c)) if c.isalpha()]))
    toxic = [s for s, l in zip(sets, labels, strict=True) if l]
    rng = np.random.default_rng(1)
    every = sorted(in_good)
    every = [every[i] for i in rng.permutation(len(every))[:NEGATIVES]]
    telling = {g: n / (1 + 20 * grams_good.get(g, 0)) for g, n in grams_bad.items() if n > 1 + 20 * grams_good.get(g, 0)}
    lifts = {w: max((telling[g] for g in substrings(w) if g in telling), default=0.0) for w in in_bad if len(w) > 2}
    first = [sorted((w for w in s if len(w) > 2), key=lambda w: (-lifts[w], w))[:PER_TEXT] for s in toxic]
    # parts that so many toxic and no clean texts have are hardly there by chance; fewer where a third of the toxic texts has none
    share = max(len(some[1]), 1) / max(len(some[1]) + len(some[0]), 1)
    chance = min(8, max(2, int(np.ceil(np.log(100) / -np.log(min(share, 0.99)))) + 2))
    sure_lift = next((n for n in range(chance, 1, -1) if sum(any(lifts[w] >= n for w in words) for words in first) > len(toxic) / 3), 1)
    bad = [w for words in first for w in words if lifts[w] >= sure_lift]
    hard: dict[str, None] = {}
    pool = sorted(in_bad.keys() - in_good.keys())
    for turn in range(ROUNDS):
        repeated = sorted({w for w in bad if lifts.get(w, 0) >= sure_lift and w not in in_good}, key=lambda w: (-lifts[w], w))
        sure = bad if turn else [w for w in bad if w in set(repeated)]
        if not sure:
            break
        train(machine, [*hard, *every[:4000]], sure + [w for w in disguised(repeated, rng) if w not in in_good])
        value = dict(zip(pool, machine.margins(pool).tolist(), strict=True))
        told = [sorted((w for w in s if value.get(w, -9.0) > 0.25), key=lambda w: (-value[w], w))[:PER_TEXT] for s in toxic]
        # only words of which a part is in other toxic texts too, and in hardly a clean one
        bad = [w for words in told for w in words if lifts.get(w, 0) >= sure_lift]
        hard |= dict.fromkeys(every[i] for i in np.argsort(-machine.margins(every), kind="stable")[:1000])
    return machine


def learn(texts: list[str], labels: np.ndarray) -> Machine:
    """A machine trained on all texts, its probabilities fitted to texts that a machine learned from the other parts has not seen."""
    sets, labels = [words_of(t) for t in texts], np.asarray(labels)
    machine = _trained(sets, labels)
    if len(set(labels.tolist())) < 2:
        machine.shift = -3.0
        return machine
    part = np.zeros(len(sets), int)  # each label is dealt evenly
    for label in (0, 1):
        rows = np.flatnonzero(labels == label)
        part[rows] = np.arange(len(rows)) % FOLDS
    margins = np.zeros(len(sets))
    for k in range(FOLDS):
        other = _trained([s for s, p in zip(sets, part, strict=True) if p != k], labels[part != k])
        unseen = np.flatnonzero(part == k)
        margins[unseen] = [v for v, _ in other.top_of([sets[i] for i in unseen])]
    calibrate(machine, margins, labels)
    return machine


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Machine:
    """A machine learned from labelled texts: at most `sample_rows` ids of each label, by a hash of the id, and at most
    twice that many rows, of those of at most `sample_chars` characters. `labels` has the id under the same name; other labels than 0 and 1 and null texts are not learned from."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    rank = F.xxhash64("id")
    chosen = None
    for label in (1, 0):
        part = known.where(F.col("label") == label).distinct().orderBy(rank, "id").limit(sample_rows)
        chosen = part if chosen is None else chosen.union(part)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.length("text") <= sample_chars)
    # ids that many rows repeat give no more rows than the sample has, the first by a hash of id and text
    sample = rows.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id", "text"), "id", "text").limit(2 * sample_rows).toPandas().sort_values(["id", "text"])
    return learn(sample.text.tolist(), sample.label.to_numpy())


def score(docs: DataFrame, machine: Machine, *, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """`columns` of every row (all by default) and score (0 to 1): the calibrated value of the most suspect word of the whole text.

    Null, empty and blank texts have the score of a text without suspect words. Rows with null and repeated ids are rows like
    others; an empty table gives an empty one. An input column named score is replaced, others pass through.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c != "score"]

    def run(batches):
        for part in slices(batches, text_col):
            margin = np.array([v for v, _ in machine.top(part.column(text_col).to_pylist())])
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(machine.probability(margin))], [*columns, "score"])

    schema = StructType([*(docs.schema[c] for c in columns), StructField("score", DoubleType())])
    return docs.select(*dict.fromkeys([*columns, text_col])).mapInArrow(run, schema)
