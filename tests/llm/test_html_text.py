import numpy as np
import pytest

from flowtables.llm import html_text as H


@pytest.fixture(scope="module")
def field():
    return H.learn([], made=200)


@pytest.mark.parametrize("page,want", [
    ("", []), ("<p>", []), ("just text", [((), "just text")]), ("<div><p>a<b", [(("div", "p"), "a<b")]),
    ("<p>a &amp; b&nbsp;c &#233;&copy <b>d<br>e</b>\n\t f<p>g", [(("p",), "a & b\xa0c é© d e f"), (("p",), "g")]),
    ("<script>var t='</p>';</script><p>x<!-- no --></p><style>p{}</style>", [(("p",), "x")]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>z", [(("ul", "li"), "a"), (("ul", "li"), "b"), (("ul", "li", "ul", "li"), "c"), ((), "z")]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", [(("table", "tr", "td"), x) for x in "abc"]),
    ('<div class="Top-Menu x2" id=navBar><a href="a>b">q</a></div>', [(("div top menu x 2 nav bar", "a"), "q")]),
    ("<div><p><b>open<br><p>next</div><footer>f", [(("div", "p", "b"), "open"), (("div", "p"), "next"), (("footer",), "f")]),
    ("<script>never ends", []), ("a<br/>b<hr>c</nothing>d", [((), "a b"), ((), "cd")]),
])
def test_blocks(page, want):
    got = [(p, t) for p, t, _ in H.blocks(page)]
    # inline elements that are still open belong to the ancestors
    assert [t for _, t in got] == [t for _, t in want]
    assert [tuple(x for x in p if x.split(" ")[0] in H.BREAKS) for p, _ in got] == [tuple(x for x in p if x.split(" ")[0] in H.BREAKS) for p, _ in want]


@pytest.mark.parametrize("page,want", [
    ('<article><p>a <svg width="3"/>b</p><p>c</p></article>', ["a b", "c"]),
    ("<article><p>a <math/>b</p><p>c</p></article>", ["a b", "c"]),
    ("<p>a <svg/>b <svg><title>no</title><path d='M0'/><g/></svg>c</p>", ["a b c"]),
    ("<article><p>so <math display='block'><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>", ["so x=2 holds"]),
    ("<article><p>never <math><mi>y</mi></p><p>next</p></article>", ["never y", "next"]),
    ("<p>a <SVG />b<script/>c</script>d</p>", ["a bd"]),
])
def test_drawings_and_formulas(page, want):
    assert [t for _, t, _ in H.blocks(page)] == want


def test_viterbi_and_marginals_against_all_labelings(field):
    rng = np.random.default_rng(1)
    for n in (1, 2, 6):
        scores = rng.normal(size=n)
        ways = [[k >> i & 1 for i in range(n)] for k in range(2**n)]
        value = np.array([sum(s for s, l in zip(scores, w, strict=True) if l) + sum(field.steps[a, b] for a, b in zip(w[:-1], w[1:], strict=True)) for w in ways])
        assert field.decode(scores.tolist()) == ways[int(value.argmax())]
        p = np.exp(value) / np.exp(value).sum()
        assert np.allclose(field.expected(scores)[0], (p[:, None] * np.array(ways)).sum(0))
    assert field.decode([]) == []


def test_made_pages_held_out(field):
    right = total = 0
    for found, labels in H.made_pages(60, ["Some other words of a text, held out.", "One more sentence here"], seed=99):
        got = field.decode(field.scores(found))
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert right / total > 0.93


@pytest.mark.parametrize(
    "page,texts",
    [
        ("<p title=don't>Hello</p><p>more</p>", ["Hello", "more"]),
        ("<div class=it's>In</div><p title='a>b'>Out</p>", ["In", "Out"]),
        ('<p title="x > y" data-a=1/2 hidden>Text</p>', ["Text"]),
        ('<p title="open>Text</p><p>more</p>', ["Text", "more"]),
        ("<p title= >Text</p>", ["Text"]),
        ("<p>one<!-- c --!>two</p><article><p>three", ["onetwo", "three"]),
        ("<p>one<!-->two<!--->three<!-- - -- >four-->five</p>", ["onetwothreefive"]),
        ("<p>1 < 2 and a <b c", ["1 < 2 and a <b c"]),
    ],
)
def test_quotes_and_comments(page, texts):
    assert [t for _, t, _ in H.blocks(page)] == texts


def test_fit_is_bounded_by_rows(spark):
    pages = spark.range(400).selectExpr("cast(7 as long) as page_id", "concat('<article><p>Page number ', id, ', with a text.</p></article>') as html")
    seen = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(H, "learn", lambda found: seen.append(len(found)))
        H.fit(pages, sample_pages=50)
    assert seen == [50]


def test_extract(spark, field):
    page = '<html><body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies.</div><main><h1>Title here</h1><p>First para &amp; more,\n with text.</p><div class="ad">Buy now!</div><p>Second para is a longer one, yes.</p><section class="comments"><p>I like this a lot, thanks.</p></section></main><aside><p>Related text here.</p></aside><form><label>Mail</label></form><footer>&copy; x</footer></body></html>'
    want = "Title here\nFirst para & more, with text.\nSecond para is a longer one, yes."
    rows = [(1, "u", page), (1, None, page), (None, "v", None), (3, "w", ""), (4, "x", "<p>" + "long, long text. " * 20000 + "</p>")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string").repartition(3)
    got = sorted((tuple(r) for r in H.extract(df, field).collect()), key=repr)
    assert [g for g in got if g[0] != 4] == sorted([(1, "u", want, len(want)), (1, None, want, len(want)), (None, "v", "", 0), (3, "w", "", 0)], key=repr)
    assert H.extract(df.where("page_id > 9"), field).collect() == []


def test_article_of_every_page(spark):
    import __spark_entry__ as entry

    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    got = entry.queries()["op4_html_extraction"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == "\n".join(t for p, t, _ in H.blocks(pages[r.page_id]) if "article" in p) and r.n_chars == len(r.text)
