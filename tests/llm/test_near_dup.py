import random
import re

import numpy as np
import pytest

from flowtables.llm import near_dup
from flowtables.llm.common import components, shingles, word_hashes

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent):
    s = {i: sets(t, k) for i, t in rows}
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in s:
        for b in s:
            both = len(s[a] & s[b])
            if a < b and s[a] and s[b] and 100 * both >= percent * (len(s[a]) + len(s[b]) - both):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(s[i]), find(i), find(i) == i) for i in s}


def corpus(prose):
    rnd = random.Random(5)
    rows, base = [], prose(1, 120).split(" ")
    for i in range(60):  # edits of one text, some of them linked through others only
        words = list(base)
        for _ in range(rnd.randrange(0, 14)):
            words[rnd.randrange(len(words))] = f"edit{rnd.randrange(1000)}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(i, prose(100 + i, 40)) for i in range(30)]
    rows += [(50 + i, rows[65][1].upper().replace(" ", "\n\t")) for i in range(4)]
    return rows + [(70, None), (71, ""), (72, " \n"), (73, "one"), (74, "ONE"), (75, "one two"), (76, "é È"), (77, "é è"), (78, " ".join(["same"] * 500))]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, prose, k, percent):
    rows = corpus(prose)
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, component_id string, bucket int").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in near_dup.near_duplicates(df, words=k, percent=percent).collect()}
    assert got == brute(rows, k, percent)


def test_null_and_repeated_ids(spark):
    text = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(None, text), (3, text), (3, text), (2, text), (9, "other words here")], "doc_id long, text string")
    got = sorted(map(tuple, near_dup.near_duplicates(df, words=3, percent=85).collect()), key=repr)
    assert got == sorted([(None, 28, None, False), (3, 28, 2, False), (3, 28, 2, False), (2, 28, 2, True), (9, 1, 9, True)], key=repr)


def test_empty(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_blocks_give_the_same(spark, prose, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rows = corpus(prose)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in near_dup.near_duplicates(df, words=3, percent=85).collect()}
    assert got == brute(rows, 3, 85)


def test_word_hashes_are_split_like_words():
    texts = ["a b", "", "  ", "x", " a\tb\n", "ab", "a" * 300]
    raw = "".join(texts).encode()
    ends = np.cumsum([0, *map(len, texts)])
    words, at = word_hashes(np.frombuffer(raw, np.uint8), ends)
    got = [words[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert list(map(len, got)) == [2, 0, 0, 1, 2, 1, 1] and got[0] == got[4] and len({*got[0], *got[3], *got[5], *got[6]}) == 5
    assert len(shingles(words[:1], 3)) == 1 and len(shingles(words, 3)) == 5


@pytest.mark.parametrize("similarity", [0.8, 0.85])
def test_sketch_limit_keeps_linked_pairs(similarity):
    rng = np.random.default_rng(1)
    limit, most = near_dup.sketch_limit(similarity), 0
    for _ in range(300):
        union = rng.integers(0, 1 << 63, 200).astype(np.uint64)
        gone = int(200 * (1 - similarity))
        a, b = union[gone // 2 :], np.concatenate([union[: gone // 2], union[gone:]])
        x, y = (near_dup.odd_sketch(near_dup.minhashes(np.sort(s))).view(np.uint64) for s in (a, b))
        most = max(most, int(np.bitwise_count(x ^ y).sum()))
    assert most <= limit < near_dup.SKETCH / 4


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5), (None, 4), *[(100 + i, 101 + i) for i in range(40)]]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in components(df, "a", "b").collect()}
    assert got == {**dict.fromkeys([1, 2, 3, 7, 8, 9], 1), 20: 20, 21: 20, **dict.fromkeys(range(100, 141), 100)}
