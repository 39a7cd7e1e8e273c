import random

import numpy as np
import pyarrow as pa
import pytest

from flowtables.llm import pieces as P

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary()


def texts():
    rnd = random.Random(3)
    parts = ["a", "b", " ", "  ", "the", "ing", "\n", "\t", "é", "日本", "中文字", "1", "2024", "😀", " the", "ё", "aaaa", "    ", ".", "\u0000", "ﬁ"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120))) for _ in range(60)] + [None, "", " ", "abc" * 200, "中" * 150, "qwrtz" * 60]


@pytest.mark.parametrize("chunk", [40, 97, 1 << 16])
def test_same_as_the_library_and_back(spark, library, chunk):
    rows = texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, ids string")
    encoded = P.encode(df, chunk=chunk)
    assert encoded.columns == ["doc_id", "text", "ids"]
    got = {r.doc_id: r for r in P.decode(encoded).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(rows):
        assert got[i].ids == (library.encode(t) if t else [])
        assert got[i].text == (t or "")


def test_piece_sign_null_and_repeated_ids(spark):
    rows = [(None, "a ▁ b▁"), (1, "long words here " * 9), (1, "long words here " * 9), (None, "long words here " * 9), (2, "x")]
    encoded = P.encode(spark.createDataFrame(rows, "doc_id long, text string"), columns=["doc_id"], chunk=50)
    back = sorted(((r.doc_id, r.text) for r in P.decode(encoded).collect()), key=repr)
    assert back == sorted(rows, key=repr)


def test_empty(spark):
    assert P.encode(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_products_are_associative(vocabulary):
    raw = (" " + "undividedlongwordwithoutanyspace" * 5 + " and 日本語のテキスト some more" * 3).encode()
    encoder = P.Encoder(vocabulary)
    cuts = [0, 21, 45, 70, 120, 165, len(raw)]
    cuts = [c if c == len(raw) or raw[c] & 0xC0 != 0x80 else c + 1 for c in cuts]
    cuts = [c if c == len(raw) or raw[c] & 0xC0 != 0x80 else c + 1 for c in cuts]
    m = [P.Chunk(encoder, raw, a, b, True, True).matrix() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    left = m[0]
    for x in m[1:]:
        left = P.product(left, x)
    right = m[-1]
    for x in reversed(m[:-1]):
        right = P.product(x, right)
    assert left.tolist() == right.tolist() == P.product(P.product(m[0], m[1]), P.product(P.product(m[2], m[3]), P.product(m[4], m[5]))).tolist() == [[0.0]]
    assert any(x.shape[0] > 1 for x in m)


def test_units_are_forgotten_in_time(vocabulary, library, monkeypatch):
    monkeypatch.setattr(P, "KNOWN_UNITS", 20)
    encoder = P.Encoder(vocabulary)
    for seed in range(5):
        text = " ".join(f"w{random.Random(seed).random()}{i}" for i in range(40))
        buf, ends = P._spaced(pa.array([text, "", text[:9]]))
        ids, at = encoder.encode(buf, ends)
        assert ids[at[0] : at[1]].tolist() == library.encode(text) and ids[at[2] :].tolist() == library.encode(text[:9]) and at[1] == at[2]


def test_compatible_pairs_share_slots_rightly(vocabulary, monkeypatch):
    monkeypatch.setattr(P, "PAIR_BITS", 2)
    encoder, free = P.Encoder(vocabulary), P.Encoder(vocabulary)
    rng = np.random.default_rng(0)
    ids = np.array(list(vocabulary.ids.values()))
    for _ in range(5):
        p, t = rng.choice(ids, 50), rng.choice(ids, 50)
        assert encoder.compatible(p, t).tolist() == [free.fits(int(a), int(b)) for a, b in zip(p, t, strict=True)]
