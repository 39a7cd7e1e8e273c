import numpy as np
import pyarrow as pa

from flowtables.llm import decontaminate as D
from flowtables.llm.common import utf8

ITEMS = [(1, None), (2, ""), (3, "tiny"), (4, "x" * 30)]


def edited(text, places):
    out = list(text)
    for p, kind in places:
        out[p] = {"sub": "#", "del": "", "ins": out[p] + "@"}[kind]
    return "".join(out)


def test_finds_passages_and_leaves_the_rest(spark, prose):
    a, b = prose(1, 40), prose(2, 30)
    k = D.budget(D.WINDOW)
    rows = [
        (1, prose(10, 50) + " " + a + " " + prose(11, 50)),
        (2, prose(12, 30) + "\n" + a[60:160].upper().replace(" ", " \t\n")),  # part of it, other case and spaces
        (3, prose(13, 30) + edited(a, [(5 + 13 * j, ("sub", "del", "ins")[j % 3]) for j in range(k)])),
        (4, prose(14, 3000)),
        (5, prose(15, 30) + a[:40] + prose(16, 10) + a[60:100]),  # too little of it
        (6, prose(17, 20000) + b + prose(18, 20)),
        (7, None), (8, ""), (9, " "), (None, b), (10, b), (10, b), (11, a + b),
    ]
    docs = spark.createDataFrame([(i, t, "e") for i, t in rows], "doc_id long, text string, edits string").repartition(3)
    bench = spark.createDataFrame([(100, a), (200, b), *ITEMS], "item_id long, text string")
    found = D.contaminated(docs, bench).collect()
    assert sorted({(r.doc_id, r.item_id) for r in found}, key=repr) == sorted([(1, 100), (2, 100), (3, 100), (6, 200), (None, 200), (10, 200), (11, 100), (11, 200)], key=repr)
    assert len([r for r in found if r.doc_id == 10]) == 2
    assert all(r.edits == 0 for r in found if r.doc_id in (1, 2, 6, 11))
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 7, 8, 9]


def test_empty(spark):
    docs, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a text " * 30)], "doc_id long, text string")
    assert D.contaminated(docs, one.toDF("item_id", "text")).collect() == [] and D.contaminated(one, bench).collect() == []
    assert D.drop_contaminated(one, bench).count() == 1


def distance(pattern, text):
    """Fewest edits of the pattern anywhere in the text."""
    row = [0] * (len(text) + 1)
    for p in pattern:
        new = [row[0] + 1]
        for j, c in enumerate(text):
            new.append(min(row[j] + (p != c), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_alignment_against_full_table():
    rng = np.random.default_rng(3)
    for _ in range(60):
        pattern = rng.integers(97, 101, 40).astype(np.uint8)
        text = bytearray(rng.integers(97, 101, 30).astype(np.uint8).tobytes() + pattern.tobytes() + rng.integers(97, 101, 30).astype(np.uint8).tobytes())
        for _ in range(int(rng.integers(0, 6))):
            at = int(rng.integers(30, 70))
            if rng.random() < 0.3:
                del text[at]
            elif rng.random() < 0.5:
                text.insert(at, 120)
            else:
                text[at] = 121
        buf = np.frombuffer(bytes(text), np.uint8)
        found = D.aligned(pattern, buf, 27, 33, 0, 5)
        want = distance(pattern.tobytes(), bytes(text))
        assert (found[0] if found else None) == (want if want <= 5 else None)


def test_exact_passages_at_every_offset(prose):
    for a in (prose(1, 40), "é" + prose(2, 30).replace("e", "é"), prose(3, 30)[:81], prose(4, 30)[:80]):
        a = a.encode()
        index = D.Index([(1, prose(9, 50).encode()), (2, a)])
        places = range(len(a) - D.WINDOW + 1)
        texts = [b"before it |" + a[s : s + D.WINDOW] + b"| and after" for s in places]
        column = pa.array(texts, pa.binary()).view(pa.string())
        assert {row for row, n in D.matches(index, column) if n == 1} == set(places)


def test_windows_against_brute_force(prose):
    a = prose(1, 40)
    rng = np.random.default_rng(5)
    index = D.Index([(1, a.encode())])
    spans = D.windows(len(a))
    texts = []
    for _ in range(40):
        s, n = int(rng.integers(0, len(a) - 60)), int(rng.integers(70, 100))
        part = a[s : s + n]
        places = sorted(rng.choice(len(part), int(rng.integers(0, 8)), replace=False).tolist())
        texts.append(prose(20, 4) + "|" + edited(part, [(p, ("sub", "del", "ins")[p % 3]) for p in places]) + "|" + prose(21, 4))
    texts = [D.squeeze(*utf8(pa.array([t])))[0].tobytes().decode() for t in texts]
    found = D.matches(index, pa.array(texts))
    for row, text in enumerate(texts):
        edits, first = min((distance(a[s:e], text), s) for s, e in spans)
        got = found.get((row, 0))
        assert (got and got[:2]) == ((edits, first) if edits <= D.budget(D.WINDOW) else None)


def test_squeeze():
    texts = ["  A\t\nb ", "", " ", "cD", "e  ", "\xa0É x"]
    raw, ends = D.squeeze(*utf8(pa.array(texts)))
    assert [raw[a:b].tobytes().decode() for a, b in zip(ends[:-1], ends[1:], strict=True)] == ["a b", "", "", "cd", "e", "\xa0É x"]


def test_pieces_do_not_matter(prose, monkeypatch):
    a = prose(1, 40)
    buf = D.squeeze(*utf8(pa.array([prose(3, 4000) + a + prose(4, 4000) + a])))[0]
    index = D.Index([(1, a.encode())])
    whole = D.regions(index, buf)
    monkeypatch.setattr(D, "PIECE", 1000)
    assert whole and {w for w, _, _ in whole} == {w for w, _, _ in D.regions(index, buf)}
