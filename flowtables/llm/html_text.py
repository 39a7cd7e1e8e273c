"""Main text of web pages by a linear-chain conditional random field.

A page becomes its leaf blocks in page order: the text between two boundaries of block-level elements, with the tags and
class and id words of all of its ancestors. Each block is labelled main text or not; a block's score comes from its
ancestors and its text, and neighbours favour equal labels. The field is trained by gradient ascent on the likelihood
of labelled pages and decoded by the Viterbi algorithm.
"""

from __future__ import annotations

import html
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import slices

# Quotes count only where a value begins, as in HTML: an unquoted value may hold them. Comments also end at "--!>", and "<!-->" is one.
VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s<>"'][^\s<>]*+)?+"""
MARKUP = re.compile(rf"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>=]++|{VALUE})*+)>|<[!?][^>]*+>""", re.S)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))""", re.I)
BREAKS = frozenset("address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main nav noscript ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "title", "template", "textarea", "svg")}
CLOSABLE = frozenset(("svg", "math"))  # the tags in which "/>" ends an element, as in XML
ENDS_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("table ul ol dl div section article body aside main nav header footer form td th li dd select".split())
WHITE = re.compile(r"[\x20\x09-\x0D]+")
SAMPLE_PAGES, MADE_PAGES, EPOCHS = 300, 300, 6
OUT_TYPE = "page_id long, url string, text string, n_chars long"


def blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(ancestors, text, share of its characters in links) of every leaf block that has text; an ancestor is its tag and its class and id words."""
    out, stack, held = [], [], []
    links = linked = 0

    def close():
        nonlocal linked
        if held:
            text = WHITE.sub(" ", html.unescape("".join(held))).strip(" ")
            if text:
                out.append((tuple(stack), text, min(1.0, linked / max(1, sum(map(len, held))))))
            held.clear()
        linked = 0

    def pop(to: int):
        nonlocal links
        while len(stack) > to:
            if stack.pop().split(" ", 1)[0] == "a":
                links -= 1

    at = 0
    while m := MARKUP.search(page, at):
        if m.start() > at:
            held.append(page[at : m.start()])
            linked += (m.start() - at) * (links > 0)
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BREAKS:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if (name := stack[i].split(" ", 1)[0]) == tag:
                    pop(i)
                    break
                if name in SCOPES and tag not in SCOPES:
                    break
            continue
        if tag in CLOSABLE and m[3].endswith("/"):
            continue
        if tag in HIDDEN:
            end = HIDDEN[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in BREAKS:
            close()
            for i in range(len(stack) - 1, -1, -1):
                name = stack[i].split(" ", 1)[0]
                if name == "p" or name in ENDS_ITSELF.get(tag, ()):
                    pop(i)
                    break
                if name in SCOPES:
                    break
        elif tag == "br":
            held.append(" ")
        if tag in VOID or m[3].endswith("/") and tag not in BREAKS:
            continue
        words = " ".join(x for g in NAMED.findall(m[3]) for x in re.findall(r"[a-z]+|\d+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", "".join(g)).lower())) if m[3] else ""
        stack.append(f"{tag} {words}".rstrip())
        links += tag == "a"
    if at < len(page):
        held.append(page[at:])
    close()
    return out


def path_features(path: tuple[str, ...]) -> list[str]:
    names = [p.split(" ") for p in path]
    found = {f"in {n[0]}" for n in names} | {f"of {w}" for n in names for w in n[1:]}
    parts = [n for n in names if n[0] in BREAKS]
    last = [n[0] for n in parts[-2:]]
    return sorted(found | {f"leaf {' '.join(last)}", f"depth {min(8, len(parts))}"})


def text_features(text: str, links: float, at: int, n: int) -> list[str]:
    count = text.count(" ") + 1
    return [
        f"words {min(7, int(math.log2(count)))}",
        f"links {math.ceil(links * 3)}",
        "stop" if text[-1] in ".!?…\"'»”" else "open",
        f"commas {min(3, text.count(','))}",
        "sign" if "©" in text or "·" in text or "|" in text else "plain",
        "first" if at == 0 else "last" if at == n - 1 else "inner",
    ]


class Field:
    """Weights of the features for main text against the rest, and of the steps between labels."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.steps = np.zeros((2, 2))
        self.known: dict[tuple[str, ...], float] = {}

    def scores(self, page: list[tuple[tuple[str, ...], str, float]]) -> list[float]:
        out, w = [], self.weights
        for i, (path, text, links) in enumerate(page):
            if path not in self.known:
                if len(self.known) > 50_000:
                    self.known.clear()
                self.known[path] = sum(w.get(f, 0.0) for f in path_features(path))
            out.append(self.known[path] + sum(w.get(f, 0.0) for f in text_features(text, links, i, len(page))))
        return out

    def decode(self, scores: list[float]) -> list[int]:
        """The best labels (Viterbi); the first is ahead by its score alone."""
        (s00, s01), (s10, s11) = self.steps.tolist()
        back, a, b = [], 0.0, 0.0
        for i, s in enumerate(scores):
            if not i:
                a, b = 0.0, s
                continue
            stay, come, leave, keep = a + s00, b + s10, a + s01, b + s11
            back.append((come > stay, keep >= leave))
            a, b = max(stay, come), max(leave, keep) + s
        label = int(b > a)
        out = [label]
        for low, high in reversed(back):
            label = int(high if label else low)
            out.append(label)
        return out[::-1] if scores else []

    def expected(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each block's probability of being main text, and the expected number of each step (forward-backward)."""
        n, steps = len(scores), np.exp(self.steps)
        e = np.exp(np.stack([np.zeros(n), np.clip(scores, -30, 30)], 1))
        e /= e.sum(1, keepdims=True)
        ahead, behind = np.empty((n, 2)), np.empty((n, 2))
        ahead[0], behind[-1] = e[0], 1
        for i in range(1, n):
            ahead[i] = ahead[i - 1] @ steps * e[i]
            ahead[i] /= ahead[i].sum()
        for i in range(n - 2, -1, -1):
            behind[i] = steps @ (e[i + 1] * behind[i + 1])
            behind[i] /= behind[i].sum()
        both = ahead * behind
        pairs = ahead[:-1, :, None] * steps * (e[1:] * behind[1:])[:, None, :]
        return both[:, 1] / both.sum(1), (pairs / pairs.sum((1, 2), keepdims=True)).sum(0) if n > 1 else np.zeros((2, 2))

    def fit(self, pages: list[tuple[list, list[int]]], epochs: int = EPOCHS, rate: float = 0.3, ridge: float = 1e-4, seed: int = 2) -> None:
        """Adagrad on the log-likelihood of the labels, page by page."""
        rng = np.random.default_rng(seed)
        feats = [[path_features(p) + text_features(t, l, i, len(b)) for i, (p, t, l) in enumerate(b)] for b, _ in pages]
        seen: dict[str, float] = {}
        step_seen = np.full((2, 2), 1e-2)
        for _ in range(epochs):
            for k in rng.permutation(len(pages)):
                labels = np.array(pages[k][1])
                scores = np.array([sum(self.weights.get(f, 0.0) for f in fs) for fs in feats[k]])
                main, steps = self.expected(scores)
                grad: dict[str, float] = {}
                for fs, d in zip(feats[k], (labels - main).tolist(), strict=True):
                    if abs(d) > 1e-4:
                        for f in fs:
                            grad[f] = grad.get(f, 0.0) + d
                for f, g in grad.items():
                    w = self.weights.get(f, 0.0)
                    g -= ridge * w
                    seen[f] = seen.get(f, 1e-2) + g * g
                    self.weights[f] = w + rate * g / math.sqrt(seen[f])
                g = np.bincount(labels[:-1] * 2 + labels[1:], minlength=4).reshape(2, 2) - steps
                step_seen += g * g
                self.steps += rate * g / np.sqrt(step_seen)
        self.known.clear()


MAIN, REST = frozenset(("article", "main")), frozenset("nav header footer aside form menu dialog noscript button select".split())
REST_WORDS = frozenset("ad ads advert advertisement banner banners breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer header menu nav navbar navigation newsletter notice popup promo related share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())


def outline_label(path: tuple[str, ...]) -> int:
    """The label that a page's own outline gives: inside article or main, outside of what is named as something else."""
    names = [p.split(" ") for p in path]
    return int(any(n[0] in MAIN for n in names) and not any(n[0] in REST or REST_WORDS & set(n[1:]) for n in names))


def made_pages(n: int, sentences: list[str], seed: int = 4) -> list[tuple[list, list[int]]]:
    """Labelled pages put together from usual page parts around the given sentences; what a part is named gives its label.

    Their main text is marked by a character of its own, which is taken out again once the blocks are cut.
    """
    rng = np.random.default_rng(seed)
    pick = lambda x: x[int(rng.integers(len(x)))]
    said = lambda k: " ".join(pick(sentences) for _ in range(k))
    word = lambda: pick(pick(sentences).split() or ["more"])
    mark = ""
    listed = lambda k: "<ul>" + "".join(f'<li><a href="/{i}">{word()}</a></li>' for i in range(k)) + "</ul>"
    rest = [
        lambda: f"<nav>{listed(5)}</nav>",
        lambda: f'<div class="{pick(["menu", "navbar", "navigation", "top-menu", "breadcrumbs"])}">{listed(4)}</div>',
        lambda: f'<header><h2>{word()} {word()}</h2><p>{said(1)}</p></header>',
        lambda: f'<div id="{pick(["header", "page-header", "masthead"])}"><h1>{word()}</h1><a href="/">{word()}</a></div>',
        lambda: f'<aside><h3>{word()}</h3><p>{said(2)}</p>{listed(2)}</aside>',
        lambda: f'<div class="{pick(["sidebar", "widget", "related", "related-posts", "recommended", "promo"])}"><h3>{word()}</h3><p>{said(2)}</p>{listed(3)}</div>',
        lambda: f'<div class="{pick(["ad", "ads", "advert", "advertisement", "banner", "sponsored", "ad-slot"])}">{said(int(rng.integers(1, 4)))}</div>',
        lambda: f'<div class="{pick(["cookie-notice", "notice", "consent", "cookie-banner", "alert", "popup"])}"><p>{said(1)}</p><button>{word()}</button></div>',
        lambda: f'<form action="/s"><label>{word()}</label><input name="q"><button>{word()}</button><p>{said(1)}</p></form>',
        lambda: f'<div class="{pick(["newsletter", "subscribe", "signup"])}"><p>{said(1)}</p></div>',
        lambda: f'<div class="{pick(["share", "social", "sharing"])}"><a href="#">{word()}</a> <a href="#">{word()}</a></div>',
    ]
    comments = [
        lambda: f'<section id="comments"><h3>{word()}</h3>' + "".join(f'<div class="comment"><p class="author">{word()}</p><p>{said(int(rng.integers(1, 4)))}</p></div>' for _ in range(int(rng.integers(1, 5)))) + "</section>",
        lambda: f'<div class="{pick(["comments", "comment-list", "reader-comments", "disqus", "responses"])}">' + "".join(f"<p>{said(int(rng.integers(1, 3)))}</p>" for _ in range(int(rng.integers(1, 5)))) + "</div>",
        lambda: f'<ol class="comment-list"><li class="comment"><b>{word()}</b><p>{said(2)}</p></li><li class="comment">{said(1)}</li></ol>',
    ]
    foot = [lambda: f"<footer>&copy; {word()}.example &middot; {said(1)}</footer>", lambda: f'<div class="footer"><p>&copy; {word()} {said(1)}</p></div>', lambda: f'<div id="footer">{listed(3)}<p>{said(1)}</p></div>']
    out = []
    for _ in range(n):
        inner = [f"<h1>{mark}{said(1)[:60]}</h1>"] if rng.random() < 0.8 else []
        for _ in range(int(rng.integers(1, 9))):
            form = pick(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<p><b>{}<br>", "<div>{}</div>", "<pre>{}</pre>", "<figure><figcaption>{}</figcaption></figure>", "<table><tr><td>{}</td></tr></table>"])
            inner.append(form.format(mark + (said(1) if "h2" in form or "li>" in form or "fig" in form or "td" in form else said(int(rng.integers(1, 7))))))
            if rng.random() < 0.12:
                inner.append(pick(rest[4:])())
        before, after = pick([("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main-content">', "</div>"), ('<div class="post-body">', "</div>"), ('<section class="entry">', "</section>"), ('<div class="article-text">', "</div>"), ("<div>", "</div>"), ('<div class="story"><div>', "</div></div>")])
        if rng.random() < 0.3 and comments:
            inner.append(pick(comments)())
        parts = [pick(rest)() for _ in range(int(rng.integers(1, 4)))] + [before, *inner, after] + [pick(rest)() for _ in range(int(rng.integers(0, 3)))]
        parts += [pick(comments)()] if rng.random() < 0.4 else []
        found = blocks(f"<html><body>{''.join(parts)}{pick(foot)()}</body></html>")
        out.append(([(p, t.replace(mark, "").strip() or "-", l) for p, t, l in found], [int(mark in t) for _, t, _ in found]))
    return out


def learn(samples: list[str], made: int = MADE_PAGES) -> Field:
    """A field from sampled pages, labelled by their own outline, half of them with the outline's tags made plain
    divisions, and from `made` put-together pages whose text is the samples'."""
    pages, sentences = [], []
    for k, page in enumerate(samples):
        found = blocks(page)
        labels = [outline_label(p) for p, _, _ in found]
        sentences += [t[:300] for _, t, _ in found if len(t) > 20][:6]
        if not any(labels):
            continue
        if k % 2:
            found = [(tuple("div" if p.split(" ")[0] in MAIN else p for p in path), t, l) for path, t, l in found]
        pages.append((found, labels))
    field = Field()
    field.fit(pages + made_pages(made, sentences or ["The text of a page.", "More of it, in a second sentence."]))
    return field


def fit(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES, sample_chars: int = 50_000) -> Field:
    """A field learned from at most `sample_pages` pages of at most `sample_chars` characters, by a hash of the id; of rows that repeat an id, by the page."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).where(F.length("html").between(1, sample_chars))
    ids = rows.select("id").where("id is not null").orderBy(F.xxhash64("id"), "id").limit(sample_pages)
    sample = rows.join(F.broadcast(ids.distinct()), "id", "left_semi").orderBy(F.xxhash64("id"), "id", "html").limit(sample_pages).toPandas().sort_values(["id", "html"])
    return learn(sample.html.tolist())


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page or "")
    return "\n".join(t for (_, t, _), label in zip(found, field.decode(field.scores(found)), strict=True) if label)


def extract(pages: DataFrame, field: Field, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row: its main text, one block a line.

    Null, empty and blank pages and pages without main text give the empty text. Ids and urls pass through, null and
    repeated ones too; an empty table gives an empty one; other columns are not looked at.
    """

    def run(batches):
        for part in slices(batches, "html"):
            texts = [main_text(p, field) for p in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")).mapInArrow(run, OUT_TYPE)
