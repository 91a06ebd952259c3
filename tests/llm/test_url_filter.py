"""URL rules against a loop over all rules."""

import re

import pytest

from tablepull.llm import url_filter

SCHEMA = "page_id long, url string, html string"
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("a.b.net", "/es/x", "allow"),
         ("org", "", "block"), ("ORG", "/p", "allow"), ("tie.io", "/a", "allow"), ("tie.io", "/a", "block"), (None, "/", "block"), ("x.y", None, "block")]
URLS = ["http://Example.COM/en/1?q", "https://www.example.com/en/", "https://www.example.com/de/", "http://example.com", "http://notexample.com/en/", "http://m.a.b.net/es/xyz/1",
        "http://a.b.net/es/", "http://net/es/", "x.org/p", "ftp://x.org", "ftp://x.org/pp#f", "ftp://x.org?z", "http://tie.io/a/b", "://x.y", "http://", "", None, "no scheme",
        "http://É.com/ü/", "http://a..com/", "http://x.y/" + "s/" * 200, "a://b://c.com/", "http://u@h.com:80/\n/x"]


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def judged(url):
    host, path = parts(url)
    best = None
    for h, p, action in RULES:
        if h is None:
            continue
        h, p = h.lower(), p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(filter(None, [best, (len(h) + len(p), len(h), action, h + p)]))
    return host, path, best[3] if best else None, best[2] if best else "allow"


@pytest.mark.parametrize("limit", [url_filter.BROADCAST_BYTES, 0])
def test_rules(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", limit)
    rows = list(enumerate(URLS)) + [(None, URLS[0]), (None, URLS[0]), (3, URLS[3])]
    pages = spark.createDataFrame([(i, u, "x") for i, u in rows], SCHEMA).selectExpr("*", "'c' AS host", "'d' AS u_id", "1 AS rule")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = url_filter.filter_urls(pages, rules)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = [(i, *judged(u)) for i, u in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages, rules.limit(0), default="none").collect()} == {"none"}
