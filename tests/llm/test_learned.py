"""Toxicity, language and quality: held-out results, brute force, and odd rows."""

import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from flowtables.llm import language_id as L
from flowtables.llm import quality as Q
from flowtables.llm import toxicity as T
from flowtables.llm.common import mix

SF_DIR = "/root/testdata/sf0.01"


def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = {r.doc_id: r for r in entry.queries()["op7_toxicity"](spark, SF_DIR).collect()}
    rows = docs(spark)
    assert got.keys() == rows.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for i, r in got.items())
    held = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    found = Counter(held)
    assert found[1, 1] / (found[1, 1] + found[0, 1]) >= 0.5 and found[1, 0] <= 0.03 * len(held)


@pytest.fixture(scope="module")
def machine(prose):
    texts = [prose(i, 40) for i in range(150)]
    bad = [f"{prose(1000 + i, 20)} {('blorgface', 'zixnutter', 'Crumwad!')[i % 3]} {prose(2000 + i, 20)}" for i in range(60)]
    return T.learn(texts + bad, np.array([0] * 150 + [1] * 60))


def test_gapped_and_inserted_letters(machine, prose):
    base = prose(77, 30)
    p = lambda t: float(machine.probability(np.array([v for v, _ in machine.top([t])]))[0])
    for insult in ("blorgface", "BLORGFACE,", "b.l.o.r.g.f.a.c.e", "blo-rgface", "blorrgface", "z i x n u t t e r", "crumwads"):
        assert p(f"{base} {insult} {base}") >= 0.7, insult
    for text in (base, "", None, " ", "a", "...", "1 2 3 4", "x" * 3000, "日本語"):
        assert p(text) < 0.7, text


def test_insults_in_long_words(machine, prose):
    base = prose(77, 30)
    p = lambda t: float(machine.probability(np.array([v for v, _ in machine.top([t])]))[0])
    bare = "".join(filter(str.isalpha, prose(78, 60)))
    zero = "\u200b"
    for insult in ("blorgface", "zixnutter"):
        for text in (*(bare[:n] + insult + bare[n:] for n in (0, 7, 30, 101, len(bare))), ",".join([*prose(79, 20).split(), insult, *prose(80, 20).split()]), zero.join(bare[:40] + insult + bare[40:])):
            assert p(f"{base} {text} {base}") >= 0.7, text
    for text in ("b  l o\tr  g\nf a c e", "bl or g fa ce", "z ix nu tt er"):
        assert p(f"{base} {text} {base}") >= 0.7, text
    for text in (bare, ",".join(prose(79, 40).split()), zero.join(bare)):
        assert p(f"{base} {text} {base}") < 0.7, text


def test_stretches_hold_every_run():
    word = "".join(chr(0x4E00 + i) for i in range(97))
    for size, step in T.STRETCHES:
        run = size - step + 1
        parts = [x for x in T.stretches(word) if len(x) == size]
        assert all(any(word[i : i + run] in x for x in parts) for i in range(len(word) - run + 1))
    assert not list(T.stretches("x" * T.LONG)) and not list(T.stretches("1" * 500))


def test_margins_are_the_kernel_machine(machine):
    """The table of triple weights against triples counted one by one."""
    for word in ("blorgface", "harbor", "a", "ab", "...", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ééblorg"):
        codes = machine.alphabet.encode([word])[0].tolist()
        own = Counter()
        for i in range(len(codes)):
            for j in range(i + 1, len(codes)):
                for k in range(j + 1, min(len(codes), i + T.SPAN)):
                    own[(codes[i] * T.LETTERS + codes[j]) * T.LETTERS + codes[k]] += T.DECAY ** (k - i + 1)
        size = np.sqrt(sum(v * v for v in own.values())) if len(codes) > T.LONG else float(T.norm(np.array(codes), np.array([len(codes)]))[0])
        want = sum(float(machine.weights[n]) * v for n, v in own.items()) / max(size, 1e-5) + machine.bias
        assert machine.margins([word])[0] == pytest.approx(want, abs=1e-5)


def test_toxicity_rows(spark, machine):
    df = spark.createDataFrame([(1, "so blorgface", 9), (1, None, 9), (None, "", 9)], "doc_id long, text string, score int")
    got = T.score(df, machine)
    assert got.columns == ["doc_id", "text", "score"] and sorted(r.score >= 0.7 for r in got.collect()) == [False, False, True]
    assert T.score(df.where("doc_id > 5"), machine).collect() == []
    empty = T.fit(df.where("doc_id > 5"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 0.7 for r in T.score(df, empty).collect())


def test_language_held_out(spark):
    got = {r.doc_id: r for r in entry.queries()["op9_language_id"](spark, SF_DIR).collect()}
    rows = docs(spark)
    assert got.keys() == rows.keys() and all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [r.lang_pred == rows[i].lang for i, r in got.items() if r.held_out]
    assert np.mean(held) > 0.97


def test_network_against_plain_convolution():
    net = L.ByteNet(["a", "b"])
    x = np.random.default_rng(0).integers(0, 256, (5, L.LENGTH)).astype(np.uint8)
    hidden = []
    for w, table in zip(L.WIDTHS, net.tables, strict=True):
        hidden.append([[max(sum(table[o, row[t + o], f] for o in range(w)) for t in range(L.LENGTH - w + 1)) for f in range(L.FILTERS)] for row in x[:2]])
    want = np.maximum(np.concatenate(hidden, 1) + net.bias, 0) @ net.out + net.out_bias
    assert np.allclose(net.logits(x)[:2], want, atol=1e-4)


def test_language_rows(spark):
    net = L.ByteNet(["aa", "bb"])
    rows = [(1, "plain", "x"), (1, None, "x"), (None, "", "x"), (3, "123 !?", "x"), (4, "日本", "x"), (5, "words " * 20000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string").repartition(3)
    got = sorted(((r.doc_id, r.lang_pred == "und", r.score == 0) for r in L.predict(df, net).collect()), key=repr)
    assert got == sorted([(1, False, False), (1, True, True), (None, True, True), (3, True, True), (4, False, False), (5, False, False)], key=repr)
    assert {r.lang_pred for r in L.predict(df, L.fit(df.withColumnRenamed("lang_pred", "lang").where("doc_id > 9"))).collect()} == {"und"}
    assert L.predict(df.where("doc_id > 9"), net).collect() == []


def test_language_fit_is_bounded_by_rows(spark, monkeypatch):
    docs = spark.range(200).selectExpr("cast(7 as long) as doc_id", "if(id % 2 = 0, 'en', 'de') as lang", "concat('a text of some words, number ', id) as text")
    seen = []
    monkeypatch.setattr(L.ByteNet, "fit", lambda self, x, y: seen.append(np.bincount(y).tolist()))
    L.fit(docs, per_lang=5)
    assert seen == [[5 * L.WINDOWS_PER_TEXT] * 2]


def test_least_hashes_of_each_language(spark):
    rows = spark.range(3000).selectExpr("case when id % 10 = 0 then 'rare' when id = 7 then 'one' else 'en' end as lang", "id as doc_id", "xxhash64(id) as h")
    more = rows.union(rows.where("doc_id < 50")).union(spark.range(5).selectExpr("'en'", "cast(null as long)", "xxhash64(cast(null as long))"))
    for df in (rows, more.distinct(), more.where("false")):
        want = {}
        for lang, i, h in {tuple(r) for r in df.collect()}:
            want.setdefault(lang, []).append((h, i))
        got = sorted(map(tuple, L._least(df, 40).collect()), key=repr)
        assert got == sorted(((lang, i) for lang, ids in want.items() for _, i in sorted(ids)[:40]), key=repr)


def test_quality_against_brute_force(spark):
    rows = docs(spark)
    good = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").collect()}
    got = {r.doc_id: r for r in entry.queries()["op1_importance_resampling"](spark, SF_DIR).collect()}
    assert got.keys() == rows.keys()
    grams = {}
    for i, r in rows.items():
        raw = np.frombuffer(r.text.encode(), np.uint8)
        grams[i] = Q.buckets(raw, np.array([0, len(raw)]), Q.BUCKETS)[0]
    every, target = np.ones(Q.BUCKETS), np.ones(Q.BUCKETS)
    for i, b in grams.items():
        np.add.at(every, b, 1)
        if i in good:
            np.add.at(target, b, 1)
    ratio = np.log(target / target.sum()) - np.log(every / every.sum())
    keys = {}
    for i, b in grams.items():
        assert got[i].n_grams == len(b) and got[i].log_weight == pytest.approx(ratio[b].sum(), abs=1e-6)
        u = (int(mix(np.array([i], np.uint64) + np.array([Q.SEED], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0] >> 11) + 0.5) / 2**53
        keys[i] = got[i].gumbel_key
        assert keys[i] == pytest.approx(got[i].log_weight - np.log(-np.log(u)), abs=1e-9)
    first = sorted(keys, key=keys.get, reverse=True)[: -(-len(keys) * 8 // 10)]
    assert {i for i in got if got[i].selected} == set(first)


def test_quality_separates(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = {r.doc_id: r.quality for r in entry.queries()["op1_importance_resampling"](spark, SF_DIR).collect()}
    right = [(got[a] > got[b]) for a in list(labels) if labels[a] == 1 for b in labels if labels[b] == 0]
    assert np.mean(right) > 0.9


def test_quality_rows(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None), (2, ""), (3, "word " * 9000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    got = Q.resample(df, Q.fit(df, none), share=0.5).collect()
    assert len(got) == 5 and all(r.log_weight == 0 for r in got) and sum(r.selected for r in got) in (3, 4)
    empty = Q.resample(df.where("doc_id > 9"), Q.fit(df.where("doc_id > 9"), none))
    assert empty.collect() == []


def test_every_good_text_counts(spark):
    df = spark.range(25_000).selectExpr("id as doc_id", "if(id % 5 = 0, 'rare', 'word') as text").union(spark.sql("select cast(null as long), 'word'"))
    good = spark.range(25_000).where("id % 5 > 0 or id < 5000").unionAll(spark.sql("select cast(null as long)"))
    ratio = Q.fit(df, good.union(good))
    size = Q.BUCKETS
    for word, every, target in (("word", 20_001, 20_000), ("rare", 5_000, 1_000)):
        raw = np.frombuffer(word.encode(), np.uint8)
        b = Q.buckets(raw, np.array([0, len(raw)]), size)[0][0]
        assert ratio[b] == pytest.approx(np.log((target + 1) / (21_000 + size)) - np.log((every + 1) / (25_001 + size)))


def test_kth_largest(spark):
    values = [5, -3, 2**62, -(2**62), 0, 5, 7, -1]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    assert [Q.kth_largest(df, "x", k) for k in range(1, 9)] == sorted(values, reverse=True)


@pytest.mark.parametrize("sf, left_out", [("sf0.001", 1), ("sf0.001", None), ("sf0.01", 0), ("sf0.01", None)])
def test_toxicity_of_every_split(sf, left_out):
    """Whatever labels are learned from, texts without suspect words score low, few clean texts are taken for toxic, and insults are found."""
    import zlib

    import duckdb

    from flowtables.llm import toxicity as T

    texts = dict(duckdb.sql(f"select doc_id, text from '/root/testdata/{sf}/documents.parquet'").fetchall())
    labels = dict(duckdb.sql(f"select doc_id, toxic from '/root/testdata/{sf}/labels.parquet'").fetchall())
    rest = lambda i: zlib.crc32(str(i).encode()) % 3
    seen = [i for i in sorted(labels) if rest(i) != left_out and len(texts[i]) <= T.SAMPLE_CHARS]
    machine = T.learn([texts[i] for i in seen], np.array([labels[i] for i in seen]))
    asked = [i for i in sorted(labels) if left_out is None or rest(i) == left_out]
    got = machine.probability(np.array([v for v, _ in machine.top([texts[i] for i in asked])])) >= 0.7
    toxic = np.array([labels[i] for i in asked]) == 1
    assert machine.probability(np.array([v for v, _ in machine.top(["", None, " "])])).max() < 0.1
    assert got[~toxic].mean() <= 0.05
    assert got[toxic].mean() >= (0.5 if left_out is None else 0.3 if sf == "sf0.001" else 0.5)


def test_toxicity_calibration_is_bounded():
    from flowtables.llm import toxicity as T

    machine = T.Machine(T.Alphabet(list("abc")))
    apart = np.concatenate([np.full(500, -1.2), np.full(40, 1.0)])
    for margins, labels in ((apart, (apart > 0).astype(int)), (apart, np.ones(540, int)), (np.zeros(2), np.array([0, 1])), (apart, (np.arange(540) % 7 == 0).astype(int)), (-apart, (apart > 0).astype(int))):
        T.calibrate(machine, margins, labels)
        low, high = machine.probability(np.array([-1.0, 1.0]))
        assert low < 0.1 and high > 0.7 and T.SLOPES[0] <= machine.slope <= T.SLOPES[1]
