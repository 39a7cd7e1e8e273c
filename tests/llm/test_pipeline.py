"""The pipeline against its operators put together in plain Python."""

import re

import numpy as np
import pytest

import corpus_pipeline as pipeline
from flowtables.llm import toxicity as T
from tests.llm.test_line_dedup import UPPER, WHITE

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def folder(spark, prose, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('tables')}"
    item = prose(5000, 30)
    rows = [(i, prose(i, 60)) for i in range(120)]
    rows += [(200 + i, f"{prose(300 + i, 20)} {('blorgface', 'zixnutter')[i % 2]} {prose(400 + i, 20)}") for i in range(40)]
    rows += [(500, rows[3][1]), (501, rows[3][1].replace("the", "a", 1)), (502, f"a shared line of words\n{prose(502, 40)}"), (503, f"{prose(503, 40)}\nA shared line of words ")]
    rows += [(600, f"{prose(600, 30)} {item} {prose(601, 30)}"), (700, None), (701, ""), (702, "日本 " * 30000)]
    docs = [(i, t, "en", "s", len(t or ""), 1.5) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score double").write.parquet(f"{root}/documents.parquet")
    labels = [(i, 1, int(200 <= i < 240)) for i, _ in rows if i < 240 and i % 5]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, dict(rows), dict((i, t) for i, _, t in labels), item


def near(texts, k=5, percent=80):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    gone = set()
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                gone.add(b)
    return gone


def test_run_against_plain_python(spark, folder):
    root, rows, labels, item = folder
    known = sorted(i for i in labels if labels[i] == 1) + sorted(i for i in labels if labels[i] == 0)
    machine = T.learn([rows[i] for i in sorted(known)], np.array([labels[i] for i in sorted(known)]))
    margin = [v for v, _ in machine.top(list(rows.values()))]
    left = {i: t for (i, t), p in zip(rows.items(), machine.probability(np.array(margin)), strict=True) if p < pipeline.TOXIC}
    assert not any(200 <= i < 240 for i in left) and len(left) >= len(rows) - 45
    seen, lines = {}, {}
    for i in sorted(left):
        kept = []
        for x in (left[i] or "").split("\n"):
            key = x.strip(WHITE).translate(UPPER)
            if len(key) < 10 or seen.setdefault(key, i) == i:
                kept.append(x)
        if "\n".join(kept).strip(" ") or len(kept) == len((left[i] or "").split("\n")):
            lines[i] = "\n".join(kept)
    gone = near({i: rows[i] for i in lines}) | near(lines)
    want = {i: t for i, t in lines.items() if i not in gone and item not in t}
    got = {r.doc_id: r for r in pipeline.run(spark, root).collect()}
    assert {i: r.text for i, r in got.items()} == want
    library = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    assert all(r.ids == (library.encode(r.text) if r.text else []) and r.n_tokens == len(r.ids) and r.n_chars == len(r.text) and r.score == 1.5 for r in got.values())
    assert {501, 600} & got.keys() == set() and {502, 503, 700, 701, 702} <= got.keys()
    assert 500 not in got  # its only line stays in the first document


def test_near_copies_that_share_lines(spark, prose, tmp_path):
    """Copies whose shared lines have gone are still known for copies; what they have of their own does not save them."""
    root = f"file://{tmp_path}"
    body = [prose(i, 30) for i in range(12)]
    rows = [(1, "\n".join(body)), (2, "\n".join([*body[:11], prose(50, 20)])), (3, "\n".join([prose(51, 25), *body[1:]])), (4, prose(52, 60)), (5, "\n".join(body[:4]) + "\n" + prose(53, 300))]
    docs = spark.createDataFrame([(i, t, 7, len(t), 0.25, 1) for i, t in rows], "doc_id long, text string, n_lines int, n_chars long, score double, __score int")
    docs.write.parquet(f"{root}/documents.parquet")
    kept = pipeline.lines(spark, docs, root)
    assert kept.columns == docs.columns and {r.n_lines for r in kept.collect()} == {7}
    assert {r.doc_id for r in pipeline.near_duplicates(spark, kept, root).collect()} == {1, 4, 5}
    clash, taken = pipeline.aside(docs, ["score"])
    assert "score" not in clash.columns and pipeline.back(clash, docs.columns, taken).columns == docs.columns


def test_rows_that_each_stage_leaves(spark):
    """On given tables: clean documents stay, labelled toxic ones go, and no stage empties the corpus."""
    root = "/root/testdata/sf0.01"
    docs, seen = spark.read.parquet(f"{root}/documents.parquet"), {}
    for name, stage in pipeline.STAGES[:4]:
        docs = pipeline.cut(stage(spark, docs, root))
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    clean, toxic = ({i for i, t in labels.items() if t == k} for k in (0, 1))
    assert len(clean & seen["toxicity"]) >= 0.95 * len(clean) and len(toxic & seen["toxicity"]) <= 0.4 * len(toxic)
    assert len(seen["line_dedup"]) >= 0.85 * len(seen["toxicity"])
    assert len(seen["benchmark_decontamination"]) >= 0.7 * len(seen["toxicity"])


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).schema.names == docs.columns
    empty = docs.where("doc_id < 0")
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, folder[0]).count() == 0
