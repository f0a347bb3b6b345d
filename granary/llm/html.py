"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page."""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their role in HTML
BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul title head summary".split()
)
SKIPPED = frozenset("script style noscript template svg iframe object canvas textarea select option button".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES_P = BLOCKS - {"html", "body", "head", "title"}
_NAMES = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
BITS = 14
TRAIN_PAGES = 400  # labelled pages the field is fitted on


class Leaves(HTMLParser):
    """Text blocks of a page with the tags and the class, id and role names above them, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.blocks: list[tuple[str, tuple, int]] = []  # text, path, characters in links
        self.text: list[str] = []
        self.linked = 0
        self.silent = 0

    def flush(self):
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.blocks.append((text, tuple(self.open), self.linked))
        self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.silent += 1
            self.open.append((tag, ()))
            return
        if tag in BLOCKS:
            self.flush()
            if tag in CLOSES_P:
                self.close_to({"p"}, stop=("div", "article", "section", "td", "li", "body"))
            if tag == "li":
                self.close_to({"li"}, stop=("ul", "ol"))
        elif tag == "br":
            self.text.append(" ")
        if tag not in VOID:
            names = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role", "aria-label")).lower()
            self.open.append((tag, tuple(_NAMES.findall(names))))

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # of no known kind: a comment up to the next ">", as browsers take it
            return self.rawdata.find(">", i) + 1 or -1

    def close_to(self, tags, stop=()):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                self.silent -= sum(t in SKIPPED for t, _ in self.open[k:])
                del self.open[k:]
                return
            if self.open[k][0] in stop:
                return

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        self.close_to({tag})

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)
            if any(t == "a" for t, _ in self.open):
                self.linked += len(data)


def leaves(html: str | None) -> list[tuple[str, tuple, int]]:
    parser = Leaves()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.blocks


@lru_cache(100_000)
def slot(name: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(name) & ((1 << BITS) - 1)


def block_features(text: str, path: tuple, linked: int) -> list[int]:
    """Slots of ancestor tags, their names, and the form of the text; the words themselves are not used."""
    names = {"bias"}
    for tag, words in path:
        names.add(f"tag={tag}")
        names.update(f"name={w}" for w in words)
        if tag in ("article", "main", "p", "h1", "h2", "h3", "pre", "blockquote"):
            names.add("prose")
    if path:
        names.add(f"last={path[-1][0]}")
    n = text.count(" ") + 1
    names.add(f"words={min(int(np.log2(n)), 6)}")
    names.add(f"links={int(4 * linked / max(len(text), 1))}")
    names.add(f"stops={min(sum(text.count(c) for c in '.!?'), 3)}")
    return [slot(x) for x in names]


def fit(pages: list[tuple[list[list[int]], list[int]]], epochs: int = 25, rate: float = 0.3, l2: float = 1e-3):
    """Maximum-likelihood weights (2 x slots) and transitions (2 x 2) by gradient steps with forward-backward sums."""
    w, t = np.zeros((2, 1 << BITS)), np.zeros((2, 2))
    gw, gt = np.full_like(w, 1e-6), np.full_like(t, 1e-6)
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for k in order.permutation(len(pages)):
            feats, labels = pages[k]
            if not feats:
                continue
            e = np.array([w[:, f].sum(axis=1) for f in feats])
            n = len(e)
            fw, bw = np.zeros((n, 2)), np.zeros((n, 2))
            fw[0] = e[0]
            for i in range(1, n):
                fw[i] = e[i] + np.logaddexp(fw[i - 1, 0] + t[0], fw[i - 1, 1] + t[1])
            for i in range(n - 2, -1, -1):
                bw[i] = np.logaddexp(t[:, 0] + e[i + 1, 0] + bw[i + 1, 0], t[:, 1] + e[i + 1, 1] + bw[i + 1, 1])
            z = np.logaddexp(*fw[-1])
            p = np.exp(fw + bw - z)
            for i in range(n):
                g = -p[i]
                g[labels[i]] += 1
                f = np.array(feats[i])
                step = g[:, None] - l2 * w[:, f]
                gw[:, f] += step**2
                w[:, f] += rate * step / np.sqrt(gw[:, f])
            edge = np.zeros((2, 2))
            for i in range(1, n):
                edge -= np.exp(fw[i - 1][:, None] + t + e[i] + bw[i] - z)
                edge[labels[i - 1], labels[i]] += 1
            gt += edge**2
            t += rate * edge / np.sqrt(gt)
    return w, t


def viterbi(feats: list[list[int]], w: np.ndarray, t: np.ndarray) -> list[int]:
    if not feats:
        return []
    score, back = w[:, feats[0]].sum(axis=1), []
    for f in feats[1:]:
        ways = score[:, None] + t
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + w[:, f].sum(axis=1)
    out = [int(score.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


def labelled_page(rng) -> str:
    """A labelled page: blocks of the main text carry the name ``keepmark``, all other blocks do not.

    The layouts vary the elements and the usual class names of menus, notices, adverts, sidebars, forms and comments,
    since the given pages have no labels.
    """
    pick = lambda *xs: xs[rng.integers(len(xs))]

    def words(lo, hi, end="."):
        n = int(rng.integers(lo, hi))
        return " ".join("abcdefghijklmnopqrstuvwxyz"[rng.integers(20) :][: rng.integers(2, 7)] for _ in range(n)) + end

    def prose():
        return " ".join(words(4, 18) for _ in range(int(rng.integers(1, 6))))

    def other(kind):
        text = pick(words(1, 5, ""), words(4, 14), prose())
        if kind == "nav":
            items = "".join(f'<li><a href="#">{words(1, 3, "")}</a></li>' for _ in range(int(rng.integers(2, 9))))
            return pick(f"<nav><ul>{items}</ul></nav>", f'<div class="{pick("menu", "navbar", "nav", "breadcrumb", "pagination", "toc")}"><ul>{items}</ul></div>', f'<ul class="{pick("menu", "nav", "breadcrumbs", "tags", "share", "social")}">{items}</ul>')
        if kind == "head":
            return pick(f"<header>{text}</header>", f'<div id="{pick("header", "masthead", "top")}"><p>{text}</p></div>', f"<header><h1>{words(1, 4, '')}</h1><p>{text}</p></header>")
        if kind == "foot":
            return pick(f"<footer>{text}</footer>", f"<footer><p>&copy; {text}</p></footer>", f'<div class="{pick("footer", "copyright", "legal")}"><p>{text}</p></div>')
        if kind == "side":
            return pick(f"<aside><h3>{words(1, 4, '')}</h3><p>{text}</p></aside>", f'<div class="{pick("sidebar", "related", "widget", "recommended", "promo", "newsletter", "more")}"><h3>{words(1, 4, "")}</h3><p>{text}</p><a href="#">{words(1, 5, "")}</a></div>')
        if kind == "ad":
            return f'<{pick("div", "section", "aside")} class="{pick("ad", "ads", "advert", "advertisement", "sponsored", "banner", "promo")}">{pick(text, f"<p>{text}</p>")}</div>'.replace("</div>", "</div></section></aside>")
        if kind == "note":
            return f'<div {pick("class", "id")}="{pick("cookie", "cookie-notice", "consent", "notice", "banner", "gdpr", "popup", "modal", "alert", "subscribe")}">{pick(text, f"<p>{text}</p>")}</div>'
        if kind == "form":
            return f'<form><label>{words(1, 4, "")}</label><p>{text}</p><input><button>{words(1, 2, "")}</button></form>'
        body = "".join(f'<{pick("div", "li", "article")} class="{pick("comment", "reply", "comment-body")}"><p>{prose()}</p></div>' .replace("</div>", "</div></li>") for _ in range(int(rng.integers(1, 4))))
        return f'<{pick("section", "div")} {pick("class", "id")}="{pick("comments", "comment-list", "discussion", "replies", "responses")}"><h3>{words(1, 3, "")}</h3>{body}</div></section>'

    def main():
        out = []
        if rng.random() < 0.8:
            out.append(f"<h1>{words(2, 12, '')}</h1>")
        for _ in range(int(rng.integers(1, 9))):
            out.append(pick(
                f"<p>{prose()}</p>", f"<p>{prose()}</p>", f"<p>{words(1, 4)}</p>", f"<p><b>{words(3, 9)}<br><p>{prose()}</p>",
                f"<h2>{words(1, 6, '')}</h2>", f"<ul><li>{words(2, 12, '')}</li><li>{words(2, 12)}</li></ul>",
                f"<blockquote>{prose()}</blockquote>", f"<pre>{words(2, 12, '')}</pre>", f"<div>{prose()}</div>",
                f"<table><tr><td>{words(1, 4, '')}</td><td>{words(1, 4, '')}</td></tr></table>",
                f'<p>{prose()} <a href="#">{words(1, 4, "")}</a> {words(2, 8)}</p>', f"<figure><figcaption>{words(3, 9)}</figcaption></figure>",
            ))
            if rng.random() < 0.12:
                out.append("<i class='endmark'></i>" + other(pick("ad", "side", "note")) + "<i class='startmark'></i>")
        return "".join(out)

    shell = pick(("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main">', "</div>"), ('<div class="post">', "</div>"), ('<div class="article-body">', "</div>"), ("<section>", "</section>"))
    before = "".join(other(k) for k in ("nav", "head", "note", "ad", "side", "form") if rng.random() < 0.45)
    after = "".join(other(k) for k in ("side", "comment", "form", "nav", "ad", "foot", "note") if rng.random() < 0.45)
    title = f"<head><title>{words(2, 9, '')}</title></head>"
    return f"<html>{title}<body>{before}<i class='startmark'></i>{shell[0]}{main()}{shell[1]}<i class='endmark'></i>{after}</body></html>"


class LabelledLeaves(Leaves):
    """Leaves with the label of each block, from the marks of a labelled page."""

    def __init__(self):
        super().__init__()
        self.inside, self.labels = 0, []

    def flush(self):
        n = len(self.blocks)
        super().flush()
        self.labels += [self.inside] * (len(self.blocks) - n)

    def handle_starttag(self, tag, attrs):
        mark = dict(attrs).get("class")
        if mark in ("startmark", "endmark"):
            self.flush()
            self.inside = int(mark == "startmark")
            return
        super().handle_starttag(tag, attrs)


@lru_cache(1)
def trained(pages: int = TRAIN_PAGES):
    rng = np.random.default_rng(17)
    rows = []
    for _ in range(pages):
        parser = LabelledLeaves()
        parser.feed(labelled_page(rng))
        parser.close()
        parser.flush()
        rows.append(([block_features(*b) for b in parser.blocks], parser.labels))
    return fit(rows, epochs=8)


def main_text(html: str | None, w: np.ndarray, t: np.ndarray) -> str:
    blocks = leaves(html)
    labels = viterbi([block_features(*b) for b in blocks], w, t)
    return " ".join(b[0] for b, y in zip(blocks, labels) if y)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; null or empty html gives an empty text.  Repeated rows stay."""
    w, t = trained()
    model = pages.sparkSession.sparkContext.broadcast((w, t))  # fixed size: 2 x slots

    def run(batches):
        for b in batches:
            text = [main_text(h, *model.value) for h in b.html]
            yield pd.DataFrame({"page_id": b.page_id, "url": b.url, "text": text, "n_chars": [len(x) for x in text]})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
