"""Main text of web pages: gradient-boosted trees over the nodes of the page, decoded top down.

There are no labels. Pages whose markup names its parts (article, main, nav, footer ...) supply
texts; from those of a bounded sample, pages of many layouts are composed, with and without
telling names, whose parts are known. The trees learn from their nodes; every page is then
parsed, its nodes are scored, and the best consistent choice of nodes gives the text.
"""

from __future__ import annotations

import html
import random
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepull.functions.names import qcol
from tablepull.llm import boosting
from tablepull.llm.dom import FEATURES, Page

# Pages (the first ones by hash of their id) that the model learns from, and the layouts composed of each.
SAMPLE_PAGES = 240
LAYOUTS = 6
# How often a node of a given page counts beside those of composed pages.
GIVEN = 4
_MAIN = {"article", "main"}
_REST = {"nav", "aside", "footer", "header", "form"}


def named_parts(page: Page) -> list[bool]:
    """Whether each node is in the part that the markup names as the main one."""
    kept = [False] * len(page.tags)
    for i, tag in enumerate(page.tags):
        above = kept[page.parents[i]] if i else False
        kept[i] = tag in _MAIN or (above and tag not in _REST)
    return kept


class Composer:
    """Writes pages of random layouts around given texts. Parts carry data-main, which only training reads."""

    names = {
        "main": ("article", ["post", "entry-content", "article-body", "story", "content", "main-text"]),
        "menu": ("nav", ["menu", "navbar", "site-nav", "breadcrumb"]),
        "head": ("header", ["header", "masthead", "top", "brand"]),
        "foot": ("footer", ["footer", "site-footer", "colophon", "copyright"]),
        "side": ("aside", ["sidebar", "widget", "related", "recommended"]),
        "advert": ("div", ["ad", "ads", "advert", "banner", "sponsored"]),
        "notice": ("div", ["cookie-notice", "notice", "alert", "consent", "popup"]),
        "form": ("form", ["newsletter", "subscribe-form", "search", "login"]),
        "reader": ("section", ["comments", "replies", "discussion", "reader-comments"]),
        "share": ("div", ["share", "social", "byline", "tags"]),
    }

    def __init__(self, seed: int, main: list[str], rest: list[str], other: list[str]):
        self.draw, self.main, self.rest, self.other = random.Random(seed), main, rest or ["Home"], other or ["Text"]
        # Named by elements, by classes, or not at all.
        self.style = self.draw.choice(["element", "class", "class", "both", "plain"])

    def part(self, kind: str, inner: str, keep: bool) -> str:
        tag, names = self.names[kind]
        tag = tag if self.style in ("element", "both") or kind == "form" else self.draw.choice(["div", "div", "section"])
        named = self.style in ("class", "both") and self.draw.random() < 0.9
        name = f' {self.draw.choice(["class", "class", "id"])}="{self.draw.choice(names)}"' if named else ""
        return f'<{tag}{name} data-main="{int(keep)}">{inner}</{tag}>'

    def words(self, low: int, high: int, source: list[str]) -> str:
        words = self.draw.choice(source).split() or ["x"]
        start = self.draw.randrange(len(words))
        return html.escape(" ".join(words[start : start + self.draw.randint(low, high)]))

    def links(self, low: int, high: int) -> str:
        items = [f'<li><a href="#">{self.words(1, 4, self.rest)}</a></li>' for _ in range(self.draw.randint(low, high))]
        return f"<ul>{''.join(items)}</ul>" if self.draw.random() < 0.7 else " | ".join(i[4:-5] for i in items)

    def extra(self, kind: str) -> str:
        d = self.draw
        if kind in ("menu", "share"):
            inner = self.links(2, 9)
        elif kind == "head":
            inner = f"<div>{self.words(1, 4, self.rest)}</div>" + (self.links(2, 6) if d.random() < 0.5 else f"<p>{self.words(2, 8, self.rest)}</p>")
        elif kind == "foot":
            inner = d.choice(["<p>{}</p>", "{}", "<div>{}</div>"]).format("&copy; " + self.words(3, 25, self.rest)) + (self.links(0, 5) if d.random() < 0.4 else "")
        elif kind == "side":
            inner = f"<h3>{self.words(1, 3, self.rest)}</h3>" + "".join(f"<p>{self.words(4, 20, self.other)}</p>" for _ in range(d.randint(0, 3))) + self.links(1, 6)
        elif kind == "advert":
            inner = d.choice(["<p>{}</p>", "{}", '<a href="#">{}</a>']).format(self.words(3, 25, self.other + self.rest))
        elif kind == "notice":
            inner = f"<p>{self.words(5, 30, self.other)}</p>" + d.choice(["", '<a href="#">ok</a>', "<button>ok</button>"])
        elif kind == "form":
            inner = f"<label>{self.words(1, 6, self.rest)}</label><input><p>{self.words(2, 12, self.other)}</p>"
        else:
            inner = f"<h3>{self.words(1, 3, self.rest)}</h3>" + "".join(
                d.choice(["<div><b>{}</b><p>{}</p></div>", "<li><p>{}</p><p>{}</p></li>"]).format(self.words(1, 2, self.rest), self.words(4, 60, self.other)) for _ in range(d.randint(1, 6))
            )
        return self.part(kind, inner, False)

    def article(self) -> str:
        d, out = self.draw, []
        for place, text in enumerate(self.main):
            safe = html.escape(text, quote=False)
            if place == 0 and d.random() < 0.8:
                out.append(f"<h1>{safe}</h1>")
                continue
            kind = d.random()
            shape = "<p>{}</p>" if kind < 0.75 else "<div>{}</div>" if kind < 0.82 else "<blockquote><p>{}</p></blockquote>" if kind < 0.86 else "<ul><li>{}</li></ul>" if kind < 0.9 else "<h2>{}</h2>" if len(text) < 80 else "<p>{}<br>"
            out.append(shape.format(safe))
            if d.random() < 0.08:
                out.append(self.extra(d.choice(["advert", "share", "side", "notice"])))
        if d.random() < 0.3:
            out.append(self.extra("reader"))
        return self.part("main", "".join(out), True)

    def page(self) -> str:
        d = self.draw
        maybe = lambda kind, chance: self.extra(kind) if d.random() < chance else ""
        body = maybe("notice", 0.3) + maybe("head", 0.6) + maybe("menu", 0.8) + maybe("advert", 0.5) + maybe("form", 0.2)
        middle = self.article()
        for _ in range(d.randint(0, 2)):
            middle = f"<div>{middle}</div>"
        middle = maybe("side", 0.25) + middle + maybe("side", 0.35) + maybe("reader", 0.35) + maybe("share", 0.2)
        if d.random() < 0.4:
            middle = f"<div>{middle}</div>"
        body += middle + maybe("form", 0.25) + maybe("advert", 0.2) + maybe("foot", 0.85) + maybe("notice", 0.2)
        return f"<html><body>{body}</body></html>"


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and labels of the nodes of sampled pages and of pages composed of their texts."""
    pages = [Page(source or "") for batch in batches for source in batch.column("html").to_pylist()]
    parted = []
    for page in pages:
        kept = named_parts(page)
        parted.append(([t for node, t, _ in page.blocks if kept[node]], [t for node, t, _ in page.blocks if not kept[node]]))
    parted = [p for p in parted if p[0]]
    x, y = [], []

    def add(page: Page, kept: list[bool], times: int = 1) -> None:
        holds = [False] * len(kept)
        for i in range(len(kept) - 1, 0, -1):
            holds[i] |= kept[i]
            holds[page.parents[i]] |= holds[i]
        for row, keep, frame in zip(page.features(), kept, holds):
            # Frames around main text are neither.
            if keep or not frame:
                x.extend([row] * times)
                y.extend([float(keep)] * times)

    for page in pages:
        kept = named_parts(page)
        if any(kept):
            add(page, kept, GIVEN)
    for place, (main, rest) in enumerate(parted):
        other = parted[(place + 1) % len(parted)][0]
        for layout in range(LAYOUTS):
            page = Page(Composer(place * LAYOUTS + layout, main[: 3 + 9 * layout], rest, other).page(), marked=True)
            add(page, page.marks)
    if len(set(y)) == 2:
        yield pa.record_batch([pa.array([np.array(x, np.float32).tobytes()], pa.binary()), pa.array([np.array(y, np.float32).tobytes()], pa.binary())], names=["x", "y"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _examples(batches):
        x = np.frombuffer(batch.column("x")[0].as_py(), np.float32).reshape(-1, FEATURES)
        y = np.frombuffer(batch.column("y")[0].as_py(), np.float32)
        weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        model = boosting.fit(x, y, weight)
        yield pa.record_batch([pa.array([model[n].tobytes()], pa.binary()) for n in ("feature", "threshold", "value")], names=["feature", "threshold", "value"])


def train_extractor(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> boosting.Boosted | None:
    """Trees learnt from the named parts of a bounded sample, or None if no sampled page names any."""
    rows = pages.select(F.xxhash64(qcol(id_col)).alias("h"), qcol(html_col).alias("html")).where("html is not null")
    sample = rows.orderBy("h", "html").limit(SAMPLE_PAGES).repartition(1).sortWithinPartitions("h", "html").select("html")
    found = sample.mapInArrow(_fit, "feature binary, threshold binary, value binary").first()
    if found is None:
        return None
    inner = 2**boosting.DEPTH - 1
    return {
        "feature": np.frombuffer(found["feature"], np.int32).reshape(-1, inner),
        "threshold": np.frombuffer(found["threshold"], np.float32).reshape(-1, inner),
        "value": np.frombuffer(found["value"], np.float32).reshape(-1, inner + 1),
    }


def _extract(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                pages = [Page(source or "") for source in part.column("html").to_pylist()]
                rows = [page.features() for page in pages]
                logits = np.zeros(0)
                if shared.value is not None:
                    logits = boosting.margins(shared.value, np.array([r for page in rows for r in page], np.float32))
                out, seen = [], 0
                for page, own in zip(pages, rows):
                    if shared.value is not None:
                        kept = page.decode(logits[seen : seen + len(own)].tolist())
                    else:
                        kept = named_parts(page)
                    seen += len(own)
                    out.append(page.text(kept))
                yield pa.record_batch([*part.columns[:-1], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=[*part.schema.names[:-1], "text", "n_chars"])

    return run


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text and n_chars of every row.

    The text is that of the blocks in page order, one line each; white space inside a block is
    one space, character references are decoded. A null or empty page, or one without main
    text, gives an empty text. Unclosed and cut-off markup is read as far as it goes. Repeated rows come back as
    often as they occur; rows with a null id like others. If no sampled page names its parts,
    the parts that a page itself names are taken. An empty table gives an empty result; other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(train_extractor(pages, id_col, html_col))
    rows = pages.select(qcol(id_col), qcol(url_col), qcol(html_col).alias("html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_extract(shared), f"{kinds}, text string, n_chars long")
