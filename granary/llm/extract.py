"""Main text of web pages, by content marginals of a tree-structured model.

Training pages are labelled by markup: the sampled pages' own article elements give content,
the rest of them boilerplate, and both are laid out anew in many layouts, so that the model
learns what elements, class words, lengths and links say when a page has no article element.
The sample is bounded (SAMPLE pages, of at most SAMPLE_CHARS); every page is then extracted in
whole, row by row where it lies. The model has a few thousand weights and is broadcast.

Results: a null or empty html has an empty text; equal pages have equal texts; without any
labelled page the layouts are filled with built-in words; other columns are left behind.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from html import escape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import exact, known_longs
from granary.llm.dom import LABEL, blocks
from granary.llm.treemodel import Model, forest, train

SAMPLE = 200
SAMPLE_CHARS = 20_000
LAYOUTS = 600
#: Nodes that are worked on together.
BATCH_NODES = 100_000

CONTENT = "content article post entry story main body text blog news prose detail".split()
NOISE = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar tabs pagination pager links sitemap skip".split(),
    "header": "header masthead banner top logo branding hero site".split(),
    "footer": "footer foot bottom copyright legal colophon credits".split(),
    "sidebar": "sidebar side aside widget related recommended more popular trending rail secondary tags".split(),
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay message privacy disclaimer paywall".split(),
    "advert": "ad ads advert advertisement adverts advertising sponsored sponsor promo promotion banner outbrain taboola".split(),
    "form": "form newsletter subscribe signup search login contact register".split(),
    "comments": "comment comments commentlist discussion replies reply respond responses disqus thread reactions feedback".split(),
    "share": "share sharing social follow buttons meta".split(),
}
TAGS = {
    "menu": ("nav", "div", "ul"), "header": ("header", "div"), "footer": ("footer", "div"), "sidebar": ("aside", "div", "section"),
    "notice": ("div", "section", "aside", "dialog"), "advert": ("div", "aside", "section"), "form": ("form", "div"),
    "comments": ("div", "section", "ol", "ul"), "share": ("div", "ul"),
}
FILLER = "some words that fill a page when no labelled page is there to take a text from and end in a full stop."


class Layouts:
    """Draws labelled pages from a pool of texts."""

    def __init__(self, pool: list[str], seed: int = 7):
        self.draw = random.Random(seed)
        self.pool = [p for p in pool if p] or [FILLER]

    def text(self, long: bool = True) -> str:
        found = self.draw.choice(self.pool)
        words = found.split()
        if not long:
            i = self.draw.randrange(len(words))
            words = words[i : i + self.draw.randint(1, 5)]
        return escape(" ".join(words))

    def link(self) -> str:
        return f'<a href="/x">{self.text(False)}</a>'

    def attributes(self, words: list[str]) -> str:
        if self.draw.random() < 0.1:
            return ""
        word = self.draw.choice(words)
        if self.draw.random() < 0.3:
            word += self.draw.choice(["-", "_", ""]) + self.draw.choice(["wrap", "box", "inner", "container", "list", "area", "1"])
        return f' {self.draw.choice(["class", "class", "id"])}="{word}"'

    def noise(self, kind: str | None = None) -> str:
        kind = kind or self.draw.choice(list(NOISE))
        tag = self.draw.choice(TAGS[kind])
        said = self.attributes(NOISE[kind])
        if not said and tag in ("div", "section", "ul", "ol"):
            said = f' class="{self.draw.choice(NOISE[kind])}"'
        several = range(self.draw.randint(1, 5))
        if kind == "comments":
            inner = "".join(f"<{'li' if tag in ('ol', 'ul') else 'div'}{self.attributes(NOISE[kind])}><p>{self.text()}</p>" for _ in several)
            inner = self.draw.choice([f"<h3>{self.text(False)}</h3>", ""]) * (tag not in ("ol", "ul")) + inner
        elif kind in ("menu", "share") or tag == "ul" or (kind in ("sidebar", "footer") and self.draw.random() < 0.5):
            inner = "".join(f"<li>{self.link()}</li>" for _ in several)
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind == "form":
            inner = f"<p>{self.text(False)}</p><label>{self.text(False)}</label><input name=q><button>{self.text(False)}</button>"
        elif kind == "header":
            inner = self.draw.choice([self.link(), f"<h1>{self.text(False)}</h1><p>{self.text(False)}</p>", self.text(False)])
        else:
            inner = self.draw.choice([self.text(), self.text(False), f"<p>{self.text()}</p>", f"&copy; x &middot; {self.text()}", f"<h4>{self.text(False)}</h4><p>{self.text()}</p>"])
        return f'<{tag}{said} {LABEL}="0">{inner}</{tag}>'

    def block(self) -> str:
        which = self.draw.random()
        if which < 0.5:
            return f"<p>{self.text(self.draw.random() < 0.7)}</p>"
        if which < 0.6:
            return f"<p><b>{self.text()}<br>"
        if which < 0.7:
            return f"<h{self.draw.randint(2, 4)}>{self.text(False)}</h2>"
        if which < 0.8:
            return "<ul>" + "".join(f"<li>{self.text(self.draw.random() < 0.5)}</li>" for _ in range(3)) + "</ul>"
        if which < 0.85:
            return f"<blockquote><p>{self.text()}</p></blockquote>"
        if which < 0.9:
            return f"<p>{self.text()} {self.link()} {self.text(False)}</p>"
        if which < 0.95:
            return f"<table><tr><td>{self.text(False)}</td><td>{self.text()}</td></tr></table>"
        return f"<div>{self.text()}</div>"

    def page(self) -> str:
        draw = self.draw
        title = f"<h1>{self.text(draw.random() < 0.3)}</h1>"
        title = f"<header>{title}</header>" if draw.random() < 0.15 else title
        inner = [self.block() for _ in range(draw.randint(1, 10))]
        for _ in range(draw.choice([0, 0, 0, 1, 2])):
            inner.insert(draw.randint(0, len(inner)), self.noise(draw.choice(["advert", "sidebar", "form", "comments", "notice", "share"])))
        which = draw.random()
        body = "".join([title, *inner])
        if which < 0.45:
            body = f'<article {LABEL}="1">{body}</article>'
        elif which < 0.6:
            body = f'<main {LABEL}="1">{body}</main>'
        else:
            body = f'<div{self.attributes(CONTENT) or " class=content"} {LABEL}="1">{body}</div>'
        if draw.random() < 0.3:
            body = draw.choice(["<main>{}</main>", "<div id=page>{}</div>", "<div class=wrapper>{}</div>", "<section>{}</section>"]).format(body)
        before = [self.noise(k) for k in ("header", "menu", "advert", "notice") if draw.random() < 0.55]
        after = [self.noise(k) for k in ("sidebar", "comments", "form", "share", "advert", "footer") if draw.random() < 0.45]
        draw.shuffle(before)
        return "<html><body>" + "".join([*before, body, *after]) + "</body></html>"


def fit(pages: list[str]) -> Model:
    """The model from labelled layouts of the texts of ``pages``."""
    pool: list[str] = []
    for html in pages:
        nodes = blocks(html)
        inside = [False] * len(nodes)
        for k, node in enumerate(nodes):
            inside[k] = node.tag == "article" or (node.parent >= 0 and inside[node.parent])
            if node.tag == "#text" and inside[k]:
                pool.append(node.text)
    layouts = Layouts(sorted(set(pool)))
    return train(forest([blocks(layouts.page()) for _ in range(LAYOUTS)]))


def extract(model: Model, pages: list[str]) -> list[str]:
    """Main text of every page."""
    out, held, count = [], [], 0
    for html in pages:
        held.append(blocks(html))
        count += len(held[-1])
        if count >= BATCH_NODES:
            out += _texts(model, held)
            held, count = [], 0
    return out + _texts(model, held)


def _texts(model: Model, pages: list) -> list[str]:
    if not pages:
        return []
    content = model.marginals(forest(pages))[0][:, 1] > 0.5
    out, at = [], 0
    for nodes in pages:
        out.append("\n\n".join(n.text for n, yes in zip(nodes, content[at : at + len(nodes)]) if yes and n.text))
        at += len(nodes)
    return out


def labelled_sample(pages: DataFrame, html: str = "html") -> list[str]:
    """At most SAMPLE pages that have an article element, by a hash of their text."""
    some = pages.where(F.contains(F.col(html), F.lit("<article")) & (F.length(html) <= SAMPLE_CHARS))
    some = some.select(html, F.xxhash64(html).alias("h"))
    # hashes first, then the pages of the smallest ones, each once: few bytes leave a task
    last = some.select("h").distinct().orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    rows = some.where(F.col("h") <= F.lit(last)).groupBy("h").agg(F.min(html).alias("page")).orderBy("h").select("page").collect()
    return [r[0] for r in rows]


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, main text and its length for every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model or fit(labelled_sample(pages)))

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = extract(shared.value, batch["html"].tolist())
            yield pd.DataFrame(
                {"page_id": known_longs(batch, "page_id"), "url": batch["url"], "text": found, "n_chars": np.fromiter(map(len, found), np.int64, len(found))}
            )

    rows = pages.select(*exact("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInPandas(texts, "page_id long, url string, text string, n_chars long")
