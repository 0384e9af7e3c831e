"""URL rules and the spread of trust over links."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm.linkgraph import filter_urls, host_and_path, host_links, rule_table, spread

RULES = [("allow", "org", "/"), ("block", "a.org", "/x"), ("allow", "good.net", "/"), ("block", "bad.net", "/")]


def anchors(*hosts):
    return "".join(f'<p><A class="c" HREF="https://{h}/p?q">x</a>' for h in hosts)


def test_hosts_and_paths(spark):
    urls = {
        "HTTP://Ä.Com:80/x/?y#z": ("Ä.com:80", "/x/"),
        "x://h?://b/c": ("h", ""),
        "x://h#/b": ("h", ""),
        "//h/p": ("", ""),
        "mailto:a": ("", ""),
        "": ("", ""),
        "://": ("", ""),
        "a\nb://h\n/p\nq": ("h\n", "/p\nq"),
    }
    host, path = host_and_path(F.col("u"))
    rows = spark.createDataFrame([(u,) for u in [*urls, None]], "u string").select("u", host.alias("h"), path.alias("p"))
    assert {r.u: (r.h, r.p) for r in rows.collect()} == urls | {None: ("", "")}


def test_links_between_hosts(spark):
    html = (
        '<a href="/rel">r</a><a id=1 href=http://B.org:8/x>b</a><a\nhref = \'//c.net\'>c</a><a name="x">n</a>'
        '<abbr href="http://no.net"></abbr><a data-href="http://no.net/">d</a><A HREF="HTTPS://www.a.org#t">w</a>'
        '<a href="ftp://no.net/">f</a><a href="http://a.org/self">s</a>' + anchors("B.org:8")
    )
    pages = spark.createDataFrame([("http://a.org/1", html), ("http://a.org/2", None), (None, html)], "url string, html string")
    got = {(r.source, r.target) for r in host_links(pages).collect()}
    assert got == {("a.org", "b.org:8"), ("a.org", "c.net"), ("a.org", "www.a.org")}


def test_longest_rule_wins(spark):
    rules = RULES + [("block", "org", "/x/y/long"), ("allow", "a.org", "/x"), ("block", "b.a.org", "/")]
    urls = {
        "http://a.org/": ("org/", "allow"),
        "http://a.org": (None, "allow"),
        "http://xa.org/x": ("org/", "allow"),
        "http://a.org/xyz": ("a.org/x", "block"),
        "http://c.a.org/x/y/long": ("org/x/y/long", "block"),
        "http://q.b.a.org/x": ("b.a.org/", "block"),
        "http://org.net/": (None, "allow"),
        "http://" + "s." * 20_000 + "org/" + "p" * 100_000: ("org/", "allow"),
        "": (None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: (r.rule, r.verdict) for r in filter_urls(pages, rule_table(spark, rules)).collect()}
    assert got == dict(enumerate(urls.values()))


def test_spread_equals_the_matrix_form(spark):
    rng = np.random.default_rng(3)
    n = 12
    adjacent = (rng.random((n, n)) < 0.25) & ~np.eye(n, dtype=bool)
    adjacent[3] = False
    trust, distrust = rng.random(n) * (rng.random(n) < 0.4), rng.random(n) * (rng.random(n) < 0.4)
    links = spark.createDataFrame([(f"h{i}", f"h{j}") for i, j in zip(*np.nonzero(adjacent), strict=True)], "source string, target string")
    seeds = spark.createDataFrame([(f"h{i}", float(trust[i]), float(distrust[i])) for i in range(n)], "host string, trust double, distrust double")
    got = {r.host: (r.trust, r.distrust) for r in spread(links, seeds, damping=0.5, rounds=40, least=1e-9).collect()}

    def walk(edges, start):
        ways = edges / np.maximum(edges.sum(1, keepdims=True), 1)
        return np.linalg.solve(np.eye(n) - 0.5 * ways.T, start)

    expected = np.stack([walk(adjacent, trust), walk(adjacent.T, distrust)], 1)
    for i in range(n):
        assert got.get(f"h{i}", (0, 0)) == pytest.approx(expected[i], abs=1e-7)


def test_verdicts_follow_the_links(spark):
    rows = [
        (1, "http://s.good.net/", anchors("friend.com", "friend.com")),
        (2, "http://friend.com/", anchors("second.com")),
        (3, "http://second.com/", None),
        (4, "http://farm.com/", anchors("bad.net", "farm2.com")),
        (5, "http://farm2.com/", anchors("farm.com")),
        (6, "http://mixed.com/", anchors("bad.net")),
        (7, "http://s2.good.net/", anchors("mixed.com")),
        (8, "http://s3.good.net/", anchors("mixed.com")),
        (9, "http://alone.com/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in filter_urls(pages, rule_table(spark, RULES)).collect()}
    assert {i: r.verdict for i, r in got.items()} == {
        1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "allow", 9: "allow",
    }
    assert got[3].trust == pytest.approx(0.85**2) and got[4].rule is None and got[4].distrust > 0.2
    assert got[6].trust == pytest.approx(1.7) and got[6].distrust == pytest.approx(0.85 / 2, abs=0.1)


def test_odd_pages(spark):
    rows = [
        (1, "http://a.org/x", anchors("b.com")),
        (1, "http://a.org/x", anchors("b.com")),
        (None, None, None),
        (2, "no url", anchors("b.com")),
        (3, "http://b.com/", "<a href='http://" + "q" * 1_000_000 + "/'>" + "<a " * 100_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumns({c: F.lit("own") for c in ("host", "path", "rule", "verdict", "kind", "mass", "trust", "rules")})
    rules = rule_table(spark, RULES)
    got = filter_urls(pages, rules)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"]
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in got.collect()) == [
        (0, None, "allow"), (1, "a.org/x", "block"), (1, "a.org/x", "block"), (2, None, "allow"), (3, None, "allow"),
    ]
    assert filter_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in filter_urls(pages, rule_table(spark, RULES).limit(0)).collect()} == {"allow"}


def test_no_python_on_the_way(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", anchors("b.com"))], "page_id long, url string, html string")
    plan = host_links(pages)._jdf.queryExecution().toString() + filter_urls(pages, rule_table(spark, RULES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
