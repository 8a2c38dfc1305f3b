"""Robots, sitemaps, paging, duplicates, walks, summaries, audit."""

import itertools
import random
import urllib.parse
import urllib.robotparser

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gondola.functions.urls import resolve_url, set_page_parameter
from gondola.operators import audit as A
from gondola.operators import paging as P
from gondola.operators import stats
from gondola.operators.dedup import dedup_details, dedup_listing, drop_exact, keep_first
from gondola.operators.robots import host_policies, robots_rules, robots_sitemaps, with_allowed
from gondola.operators.ranks import numbered, with_running
from gondola.operators.walk import follow_links
from gondola.plans.sitemap_products import audit, discover
from gondola.sources.pages import first_good_fetch
from gondola.sources.sitemaps import DEFAULT_SITEMAPS, index_locations, sitemap_locations
from tests.helpers import plan

ROBOTS = [
    "User-agent: *\nDisallow: /a\nAllow: /a/b\nDisallow: /z?x",
    "User-agent: Mozilla/5.0\nDisallow: /a\n\nUser-agent: *\nDisallow: /",
    "User-agent: *\nDisallow: /\n\nUSER-AGENT : mozilla\nALLOW : /a\nDisallow: /a/b # no\nDisallow: /a",
    "User-agent: moz\nUser-agent: *\nDisallow: /a\n\nUser-agent: zilla\nDisallow: /b",
    "Disallow: /a\nUser-agent: *\n\nDisallow: /b\nUser-agent: *\nDisallow:\nDisallow: /a",
    "User-agent: *\nCrawl-delay: 2\nUser-agent: mozilla\nDisallow: /b\nnonsense\n: /\nSitemap: https://s/1",
    "User-agent: *\nDisallow: /a%20b\nDisallow: /%C3%B1\nAllow: *\nDisallow: /",
    "User-agent: *\nDisallow: /a+b\nDisallow: /x%2Fy\n   \nDisallow: /b\nsitemap: https://s/2 # x",
    "",
    "User-agent: *\nDisallow: *",
    "User-agent: *\nAllow:\nDisallow: /",
    "User-agent: *\nDisallow: /a\n\nUser-agent: *\nDisallow: /b",
]
PATHS = ["/", "/a", "/a/b", "/a/b/c", "/b", "/c", "/z", "/a b", "/a%20b", "/ñ", "/%C3%B1/x", "/a+b", "/x/y", "/x%2Fy", ""]


@pytest.mark.parametrize("agent", ["Mozilla/5.0 (X11)", "other"])
def test_robots_like_the_standard_library(spark, agent):
    files = spark.createDataFrame([(f"h{i}.com", body) for i, body in enumerate(ROBOTS)], "host string, body string")
    urls = [(f"https://h{i}.com{p}",) for i in range(len(ROBOTS)) for p in PATHS] + [("https://none.com/a",)]
    allowed = with_allowed(spark.createDataFrame(urls, "url string"), host_policies(robots_rules(files), agent))
    got = {r.url: r.allowed for r in allowed.collect()}
    for i, body in enumerate(ROBOTS):
        parser = urllib.robotparser.RobotFileParser()
        parser.parse(body.splitlines())
        for p in PATHS:
            assert got[f"https://h{i}.com{p}"] == parser.can_fetch(agent, p or "/"), (body, p)
    assert got["https://none.com/a"] is True
    assert {r.sitemap_url for r in robots_sitemaps(files).collect()} == {"https://s/1", "https://s/2"}


def test_robots_join_keeps_urls(spark):
    files = spark.createDataFrame([("h.com", ROBOTS[0])], "host string, body string")
    urls = spark.createDataFrame([("https://H.com/a/q?x=1", 1), ("https://H.com/a/q?x=1", 1), (None, 2)], "url string, n int")
    rows = with_allowed(urls, host_policies(robots_rules(files), "x")).collect()
    assert sorted((r.n, r.allowed) for r in rows) == [(1, False), (1, False), (2, True)]


def test_urls_like_the_standard_library(spark):
    hrefs = ["a", "a/", "./a", "../a", "../../a", "/a/../b/./c", "/..", "..", ".", "?q", "#f", "a?b#c", "//o.org/x", "http://o.org", "a/./b/../c", "a//b/", "g;x=1/../y"]
    bases = ["https://h.com/c/x", "https://h.com/c/x/", "https://h.com", "https://h.com/", "http://h.com/c?q=/z#f"]
    rows = [(b, h) for b in bases for h in hrefs]
    got = spark.createDataFrame(rows, "b string, h string").select("b", "h", resolve_url("b", "h").alias("u")).collect()
    assert [(r.b, r.h, r.u) for r in got] == [(b, h, urllib.parse.urljoin(b, h)) for b, h in rows]

    def reference(url, n):
        p = urllib.parse.urlparse(url)
        qs = urllib.parse.parse_qs(p.query)
        qs["page"] = [str(n)]
        return p._replace(query=urllib.parse.urlencode(qs, doseq=True)).geturl()

    urls = [f"https://h.com/c?{q}" for q in ("a=1", "a=1&a=2&b=", "page=1&z=%20%2B", "x=a+b&page=&y=ñ", "a=b=c&&page=3&page=4", "=v", "k")]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(set_page_parameter("u", 7)).collect()
    assert [r[0] for r in got] == [reference(u, 7) for u in urls]


def test_sitemaps(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    index = [
        ("a", f"<sitemapindex {ns}><sitemap><loc> u1 </loc></sitemap><sitemap></sitemap><sitemap><loc>u2</loc></sitemap></sitemapindex>"),
        ("b", f"<sitemapindex {ns}><sitemap>"),
        ("c", "<html></html>"),
        ("d", f"<sitemapindex {ns}></sitemapindex>"),
        ("e", None),
    ]
    rows = index_locations(spark.createDataFrame(index, "host string, body string")).collect()
    by_host = {h: [r.sitemap_url for r in rows if r.host == h] for h, _ in index}
    assert by_host["a"] == ["u1", "u2"] and by_host["d"] == []
    for h in "bce":
        assert by_host[h] == [f"https://{h}{p}" for p in DEFAULT_SITEMAPS]
    maps = spark.createDataFrame(
        [("s", f"<urlset {ns}><url><loc>\n x&amp;y </loc><lastmod>1</lastmod></url><url><loc> </loc></url></urlset>"), ("t", "<urlset><url>"), ("u", None)],
        "s string, body string",
    )
    assert [(r.s, r.url) for r in sitemap_locations(maps, ["s"]).collect()] == [("s", "x&y")]


def test_discovery_order_and_limits(spark):
    loc = lambda u: f"<url><loc>{u}</loc></url>"
    index = spark.createDataFrame(
        [("h", "<sitemapindex>" + "".join(f"<sitemap><loc>m{i}</loc></sitemap>" for i in range(3)) + "</sitemapindex>")], "host string, body string"
    )
    bodies = [loc("b/p") + loc("c") + loc("a/p"), loc("a/p") + loc("d/p") + loc("c"), loc("z/p")]
    maps = spark.createDataFrame([(f"m{i}", f"<urlset>{b}</urlset>") for i, b in enumerate(bodies)], "sitemap_url string, body string")
    found = discover(index, maps, max_sitemaps=2, max_urls=2)
    assert [r.url for r in found.products.orderBy("ord").collect()] == ["b/p", "a/p"]
    assert [r.url for r in found.collections.collect()] == ["c", "c"]


def test_duplicates(spark):
    rows = [("t", "u", 2, "x"), ("t", "u", 1, "y"), (None, None, 5, "p"), (None, None, 4, "q"), ("t", None, 0, None)]
    df = spark.createDataFrame(rows, "title string, url string, n int, other string")
    got = {(r.title, r.url): (r.n, r.other) for r in dedup_listing(df, ["n"]).collect()}
    assert got == {("t", "u"): (1, "y"), (None, None): (4, "q"), ("t", None): (0, None)}
    assert dedup_listing(df, ["n"]).columns == df.columns
    assert "partial_min" in plan(dedup_listing(df, ["n"]))
    assert drop_exact(df.unionAll(df)).count() == 5
    details = df.withColumnRenamed("title", "product_name")
    assert dedup_details(details, ["n"]).count() == 3
    assert keep_first(df.select("url"), ["url"], []).count() == 2


def counts(spark, rows):
    return spark.createDataFrame(rows, "c string, page_no int, n_records int")


def test_listing_ends(spark):
    rows = [("a", 1, 3), ("a", 2, 1), ("a", 3, 0), ("a", 4, 9), ("b", 1, 0), ("b", 2, 5), ("c", 2, 5), ("d", 1, 1), ("d", 3, 1), ("e", 1, 0)]
    ends = {r.c: r.last_page for r in P.last_pages(counts(spark, rows), "c").collect()}
    assert ends == {"a": 2, "d": 1}
    ends = {r.c: r.last_page for r in P.last_pages(counts(spark, rows), "c", first_page_counts=False).collect()}
    assert ends == {"a": 2, "b": 2, "d": 1, "e": 1}
    kept = P.until_stop(counts(spark, rows), P.last_pages(counts(spark, rows), "c"), "c")
    assert sorted((r.c, r.page_no) for r in kept.collect()) == [("a", 1), ("a", 2), ("d", 1)]
    assert {r.page_no for r in P.first_pages(counts(spark, rows), 2).collect()} == {1, 2}


def test_category_cap(spark):
    df = spark.range(5000).select((F.col("id") % 10 == 9).cast("string").alias("c"), F.col("id").alias("k"))
    for cap in (3, 1500):
        got = P.first_per_category(df, "c", ["k"], cap)
        per = {r.c: (r.n, r.m) for r in got.groupBy("c").agg(F.count("*").alias("n"), F.max("k").alias("m")).collect()}
        everyone = {"true": sorted(range(9, 5000, 10)), "false": [i for i in range(5000) if i % 10 != 9]}
        assert per == {c: (min(cap, len(ks)), ks[:cap][-1]) for c, ks in everyone.items()}
    # a small cap is applied before the shuffle
    assert "WindowGroupLimit" in plan(P.first_per_category(df, "c", ["k"], 3))


def test_samples(spark):
    df = spark.createDataFrame([(f"u{i}",) for i in range(100)], "url string")
    one = [(r.url, r.ord) for r in P.sample_urls(df, 7, "s").orderBy("ord").collect()]
    two = [(r.url, r.ord) for r in P.sample_urls(df.repartition(5), 7, "s").orderBy("ord").collect()]
    assert one == two and [o for _, o in one] == list(range(7))
    assert one != [(r.url, r.ord) for r in P.sample_urls(df, 7, "t").orderBy("ord").collect()]


@pytest.mark.parametrize("done, target, want", [(0, 1, {1}), (3, 4, {1}), (4, 4, set()), (2, 5, {1, 3}), (0, 99, {1, 3, 4}), (0, 3, {1, 3})])
def test_top_up(spark, done, target, want):
    first = spark.createDataFrame([(f"f{i}", "x") for i in range(done)], "name string, extra string")
    rows = [(1, "a"), (1, "b"), (3, "c"), (4, "d"), (4, "e"), (4, "f")]
    more = spark.createDataFrame(rows, "collection int, name string")
    got = {r.name for r in P.topped_up(first, more, "collection", target).collect()}
    assert got == {f"f{i}" for i in range(done)} | {n for c, n in rows if c in want}


#: starts, links, and the visits as "url/hop", all written by hand
WALKS = [
    ("a b", {"a": "c", "b": "c", "c": "d", "d": "a"}, "a/0 b/0 c/1 d/2"),  # two ways to c, and a ring
    ("b a b", {"a": "a1", "b": "b1", "a1": "a2", "b1": None}, "b/0 a/0 b1/1 a1/1 a2/2"),  # starts in their order, one of them twice
    ("a", {"a": "a"}, "a/0"),  # a link to itself
    ("a x", {"a": "gone"}, "a/0 x/0 gone/1"),  # pages without a row are visited, and end there
    ("a c", {"a": "b", "b": "c", "c": "e", "e": "f"}, "a/0 c/0 b/1 e/1 f/2"),  # a start that is also met on the way
    ("p", {"p": "q", "q": "r", "r": "s", "s": "t", "t": "q"}, "p/0 q/1 r/2 s/3 t/4"),  # a chain into a ring
]


def test_walk(spark):
    for cap in (2, 30):
        for starts, links, visits in WALKS:
            s = spark.createDataFrame([(u, i) for i, u in enumerate(starts.split())], "url string, start_no int")
            e = spark.createDataFrame(list(links.items()), "url string, next_url string")
            got = follow_links(s, e, cap).orderBy("visit_no").collect()
            assert [f"{r.url}/{r.hop}" for r in got] == visits.split()[:cap]
            assert [r.visit_no for r in got] == list(range(1, len(got) + 1))


def test_walk_without_cap(spark):
    """Long chains, rings, meeting chains and a page that half of all others link to."""
    rng = random.Random(4)
    links = {f"c{i}": f"c{i + 1}" for i in range(900)} | {f"r{i}": f"r{(i + 1) % 70}" for i in range(70)}
    links |= {f"x{i}": rng.choice(["hub", f"x{rng.randrange(400)}", f"c{rng.randrange(900)}", None]) for i in range(400)} | {"hub": "c880"}
    starts = ["c0", "r5", "c700", "x3", "nowhere", *[f"x{rng.randrange(400)}" for _ in range(80)]]
    visited, hop, front = {}, 0, list(dict.fromkeys(starts))
    while front:
        visited |= dict.fromkeys(front, hop)
        front = [u for u in dict.fromkeys(links.get(u) for u in front) if u and u not in visited]
        hop += 1
    s = spark.createDataFrame([(u, i) for i, u in enumerate(starts)], "url string, start_no int")
    e = spark.createDataFrame(list(links.items()), "url string, next_url string").repartition(5)
    got = follow_links(s, e).orderBy("visit_no").collect()
    assert [(r.url, r.hop) for r in got] == list(visited.items()) and max(r.hop for r in got) > 100
    assert [r.visit_no for r in got] == list(range(1, len(got) + 1))
    assert follow_links(s.limit(0), e).collect() == []


def test_numbered(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("x"), (F.col("id") * 7919 % 3000 % 3).alias("n"))
    assert all(r.x == r.at for r in numbered(df, ["x"], "at", "numbers").collect())
    got = sorted((r.x, r.b) for r in with_running(df, ["x"], "n", "b", "sums").collect())
    assert [b for _, b in got] == [0, *itertools.accumulate(x % 3 for x in range(2999))]


def test_quantiles(spark, monkeypatch):
    monkeypatch.setattr(stats, "ACCURACY", 100)
    rng = np.random.default_rng(1)
    skewed = np.concatenate([np.full(700, 5.0), rng.lognormal(0, 3, 1300)])
    for data in (rng.random(3000), skewed, np.arange(3.0), np.array([7.0]), rng.integers(0, 4, 400).astype(float)):
        df = spark.createDataFrame([(float(v),) for v in data] + [(None,)], "price double")
        got = stats.price_summary(df).first()
        want = np.quantile(data, [0.25, 0.5, 0.75])
        assert np.allclose([got.p25, got.p50, got.p75], want, rtol=1e-12)
        assert got["count"] == len(data) and np.isclose(got["mean"], data.mean()) and (got["min"], got["max"]) == (data.min(), data.max())
    empty = spark.createDataFrame([(None,)], "price double")
    assert stats.price_summary(empty).count() == 0
    assert stats.has_values(empty, "price").first()[0] is False


def test_quantiles_at_every_size(spark):
    """One algorithm from one row on; sizes around those at which the sketch stops being exact."""
    rng = np.random.default_rng(2)
    shares = {"a": 0.0, "b": 0.001, "c": 0.5, "d": 0.9, "e": 1.0}
    for n in (1, 2, 3, 5, 12, 9_999, 10_001, 19_999, 250_000):
        data = np.round(rng.lognormal(0, 2, n), 2)
        df = spark.createDataFrame(pd.DataFrame({"x": data})).repartition(3)
        got = stats.quantiles(df, "x", shares).first()
        assert np.allclose(list(got), np.quantile(data, list(shares.values())), rtol=1e-12), n


def test_top_values(spark):
    df = spark.createDataFrame([(b,) for b in ["a", "a", None, "b", "b", "c", None, None]], "brand string")
    top = stats.top_values(df, "brand", 3)
    assert [(r.brand, r.products) for r in top.collect()] == [("Sin marca", 3), ("a", 2), ("b", 2)]
    assert [r.brand for r in stats.ascending(top, "brand").collect()] == ["b", "a", "Sin marca"]
    assert stats.shape(df, "brand").first() == (8, 1, 3)
    both = stats.union_all([df, df.select(F.lit(1).alias("n"))])
    assert both.columns == ["brand", "n"] and both.count() == 16


def test_first_good_fetch(spark):
    log = [("a", 1, 503, "x"), ("a", 3, 200, "y"), ("a", 2, 200, "z"), ("b", 4, 200, "late"), ("c", 1, 404, "")]
    got = first_good_fetch(spark.createDataFrame(log, "url string, attempt int, status int, html string")).collect()
    assert [(r.url, r.attempt, r.html) for r in got] == [("a", 2, "z")]


def test_audit(spark):
    schema = (
        "ord int, url string, html_is_product boolean, bad_price boolean, name string, sku string, brand string, price_online double, "
        "price_regular double, subcategory string, images_count int, availability string"
    )
    rows = [
        (1, "h/col", False, False, "n", "s", "b", 1.0, 2.0, "c", 1, "in_stock"),
        (2, "h/a/p", None, None, None, None, None, None, None, None, None, None),
        (3, "h/b/p", False, True, "n", "s", "b", 0.0, 2.0, "c", 1, "in_stock"),
        (4, "h/x", True, False, " Pan  6 un ", None, None, 8.0, 10.0, "", 0, "in_stock"),
        (5, "h/c/p", False, False, "None", "s", "b", 1.0, 0.0, "c", 1, "in_stock"),
        (6, "h/d", False, False, "n", "s", "b", 1.0, 0.0, "c", 1, "in_stock"),
    ]
    audited = A.with_reason(spark.createDataFrame(rows, schema))
    reasons = {r.ord: r.reason for r in audited.collect()}
    assert reasons == {1: "no_es_producto", 2: "sin_nombre_o_detalle", 3: "bad_price", 4: None, 5: None, 6: "no_es_producto"}
    products, discards = audit(audited, as_of=F.lit("2024-01-02").cast("timestamp"))
    first = products.orderBy("ord").first()
    assert (first.name, first.brand, first.subcategory, first.presentation, first.discount_percent, first.sku[:11]) == (
        "Pan 6 un", "Wong", "Sin subcategoria", "6 un", 20.0, "WONG_PAN6UN",
    )
    assert [r.name for r in A.named_only(products).collect()] == ["Pan 6 un"]
    assert {r.ord: r.detail is None for r in discards.collect()} == {1: True, 2: False, 3: False, 6: True}
    products, discards = audit(audited, target=1)
    assert [r.ord for r in products.collect()] == [4] and {r.ord for r in discards.collect()} == {1, 2, 3}
    assert {r.ord for r in audit(audited, target=9)[1].collect()} == {1, 2, 3, 6}


def test_partitioning_does_not_matter(spark):
    rows = [(f"t{i % 7}", f"u{i % 3}", i, float(i % 11)) for i in range(500)]
    df = spark.createDataFrame(rows, "title string, url string, n int, price double")
    seen = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        kept = sorted(dedup_listing(df.repartition(int(n)), ["n"]).collect())
        seen.append((kept, stats.price_summary(df).first(), sorted(P.first_per_category(df, "title", ["n"], 4).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1]
