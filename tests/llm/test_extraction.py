"""Main text: parsing, consistent decoding, boosted trees, and pages of known parts."""

import itertools
import random

import numpy as np
import pytest

from tablepull.llm import boosting, extraction
from tablepull.llm.dom import APART, Page

SCHEMA = "page_id long, url string, html string"
SF_DIR = "/root/testdata/sf0.01"


def blocks(source):
    return [t for _, t, _ in Page(source).blocks]


@pytest.mark.parametrize(
    "source, wanted",
    [
        ("<p>a  b\n c<p>d</p>e", ["a b c", "d", "e"]),
        ("<p>x<b>y</b>z<br>w &amp; &copy;&#233;&am", ["xyz w & ©é&am"]),
        ('<script>var t="</p><p>no";</script><style>p{}</style><p>yes', ["yes"]),
        ("<title>no</title><head><meta><title>no <p></title></head><body>yes", ["yes"]),
        ("<!-- <p>no</p> --><p>a<!-- b --->c</p><!doctype html>", ["ac"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
        ("<p title='a>b' class=\"x>y\">t</p><p a='unclosed>u</p>", ["t", "u"]),
        ("1 < 2 <3 & <p", ["1 < 2 <3 &"]),
        ("<p>cut off</", ["cut off"]),
        ("<textarea><p>no</textarea><button>no</button><select><option>no</select>yes", ["yes"]),
        ("<svg><g><text>no</text></g></svg><h1>a</h1><h2>b", ["a", "b"]),
        ("<html><head><title>t</title><meta><p>First</p><p>b", ["First", "b"]),
        ("<head><template><div>no</div></template><title>no</title><div>a", ["a"]),
        ("<div>a<button>no</div><p>b</p>", ["a", "b"]),
        ("<p>a</p><button>no<p>b</p><button>no</button>c", ["a", "b", "c"]),
        ("<button><div>no</div></button><p>a", ["a"]),
        ("<div>a<svg><path><g></div><p>b</p>", ["a", "b"]),
        ("<select><option>no<h1>a</h1>", ["a"]),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds", ["so x=1 holds"]),
        ("", []),
    ],
)
def test_parsing(source, wanted):
    assert blocks(source) == wanted


def test_unclosed_script_and_deep_nesting():
    assert blocks("<p>a</p><script>never ends <p>b</p>") == ["a"]
    assert blocks("<div>" * 3000 + "x" + "</div>" * 3000) == ["x"]


def test_decoding_is_the_best_consistent_choice():
    draw = random.Random(2)
    for _ in range(40):
        page = Page("<div>" + "".join(draw.choice(["<div>", "</div>", "<p>t</p>", "<section>"]) for _ in range(9)))
        n = len(page.tags)
        if n > 9:
            continue
        logits = [draw.uniform(-3, 3) for _ in range(n)]
        texts = {b[0] for b in page.blocks}

        def value(states):
            total = 0.0
            for i, s in enumerate(states):
                above = states[page.parents[i]] if i else 0
                if s < above or (above == 2 and s != 2):
                    return -1e18
                total += (-1e9 if i in texts else -0.1) if s == 0 else logits[i] if s == 1 else -logits[i]
                # Rejecting inside main text has its price.
                total -= APART * (above == 1 and s == 2)
            return total

        best = max(value(s) for s in itertools.product(range(3), repeat=n))
        kept = page.decode(logits)
        assert max(value(s) for s in itertools.product(range(3), repeat=n) if [x == 1 for x in s] == kept) == pytest.approx(best)


def test_boosted_trees_learn_an_interaction():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = boosting.fit(x[:2000], y[:2000], np.ones(2000))
    assert ((boosting.margins(model, x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.93
    assert boosting.margins(model, x[:0]).shape == (0,)


def test_given_pages_match_their_articles(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r["page_id"]: r for r in extraction.extract_text(pages).collect()}
    same = 0
    for r in pages.collect():
        page = Page(r["html"])
        same += page.text(extraction.named_parts(page)) == got[r["page_id"]]["text"]
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]
    assert same >= 0.97 * len(got)


def test_composed_layouts(spark):
    """Layouts that were not learnt from, most of them without any telling element."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    model, rows = extraction.train_extractor(pages), pages.orderBy("page_id").collect()
    right = 0
    for seed in range(120):
        main = blocks(rows[seed]["html"])[6:16] or ["Some text."]
        page = Page(extraction.Composer(10**6 + seed, main, ["Home", "About us", "Contact"], blocks(rows[seed + 100]["html"])).page(), marked=True)
        kept = page.decode(boosting.margins(model, np.array(page.features(), np.float32)).tolist())
        right += page.text(kept) == page.text(page.marks)
    assert right >= 100


def test_awkward_rows(spark):
    article = "<article><h1>T</h1>" + "<p>Some words of an article, long enough to count.</p>" * 5 + "</article>"
    html = [None, "", "plain", "<nav><a>x</a></nav>" + article, "<nav><a>x</a></nav>" + article, "<article>" + "<p>very long text here. </p>" * 20_000]
    rows = [(i, None if i == 2 else "u", h) for i, h in enumerate(html)] + [(None, "u", article)] * 2
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS h")
    out = extraction.extract_text(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 8 and by[0] == by[1] == "" and "x" not in by[3].split("\n") and by[3] == by[4]
    assert by[5].count("\n") == 19_999
    assert extraction.extract_text(pages.limit(0)).count() == 0
    # No page names its parts: nothing to learn from.
    assert {r["text"] for r in extraction.extract_text(pages.where("page_id < 3")).collect()} == {""}
