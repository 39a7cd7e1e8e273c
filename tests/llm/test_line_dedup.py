import pytest

from flowtables.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [
    (5, "A shared line here\nown line of five\nshort"),
    (2, "own line of two\n  a SHARED line here\t\nshort\nown line of two"),
    (9, "a shared line here"),
    (7, None),
    (8, ""),
    (10, "\n\n" + "long " * 5000 + "\nÀ shared line here"),
    (11, "À shared line here\nà shared line here"),
    (None, "own line of five\nlast one of null"),
    (12, "\xa0own line of five"),
]


def brute(rows, min_docs):
    seen = {}
    keyed = [(i, (t or "").split("\n")) for i, t in rows]
    for i, lines in keyed:
        for x in lines:
            if len(k := x.strip(WHITE).translate(UPPER)) >= 10:
                seen.setdefault(k, set()).add(i if i is not None else 1 << 63)
    out = []
    for i, lines in keyed:
        own = i if i is not None else 1 << 63
        kept = [x for x in lines if len(s := seen.get(x.strip(WHITE).translate(UPPER), ())) < min_docs or own == min(s)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_against_brute_force(spark, min_docs):
    df = spark.createDataFrame([(i, t, 1, "h") for i, t in ROWS], "doc_id long, text string, n_lines int, h1 string").repartition(4)
    got = line_dedup.dedup_lines(df, min_docs=min_docs)
    assert got.columns == ["doc_id", "text", "h1", "n_lines", "n_dropped"]
    assert sorted((tuple(r[c] for c in ("doc_id", "text", "n_lines", "n_dropped")) for r in got.collect()), key=repr) == brute(ROWS, min_docs)


def test_rows_of_one_id_are_one_document(spark):
    df = spark.createDataFrame([(1, "a line of some length"), (1, "a line of some length\nx"), (2, "y")], "doc_id long, text string")
    assert sorted(r.text for r in line_dedup.dedup_lines(df).collect()) == ["a line of some length", "a line of some length\nx", "y"]


def test_empty(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
