"""Page trees and element selection."""

import random
import time

from pyspark.sql import functions as F

from gondola.functions.columns import let
from gondola.operators import select as S
from gondola.operators.cards import card_pages, cards
from gondola.operators.details import jsonld_details
from gondola.operators.listings import pod_records
from gondola.operators.nodes import element_rows
from gondola.operators.select import page_scope, sel
from gondola.operators.template import next_links
from tests.helpers import nodes_of, plan, values


def pick(spark, html, expr):
    return values(nodes_of(spark, html).select("page_id", expr.alias("x")))[0]


def test_tree(spark):
    html = "<div id=1><p>a &lt; b<p class=' x  y '>c<br/>d</div>e</b><!-- f --><script>'</p>' < 1</script> <style>g</style>h < i"
    rows = element_rows(nodes_of(spark, html)).orderBy("pre").collect()
    shape = [(r.tag, r.text, r.parent, r.last, r.depth) for r in rows]
    assert shape == [
        ("#document", None, None, 13, 0),
        ("div", None, 0, 7, 1),
        ("p", None, 1, 7, 2),
        ("#text", "a < b", 2, 3, 3),
        ("p", None, 2, 7, 3),
        ("#text", "c", 4, 5, 4),
        ("br", None, 4, 6, 4),
        ("#text", "d", 4, 7, 4),
        ("#text", "e", 0, 8, 1),
        ("script", None, 0, 10, 1),
        ("#raw", "'</p>' < 1", 9, 10, 2),
        ("style", None, 0, 12, 1),
        ("#raw", "g", 11, 12, 2),
        ("#text", "h < i", 0, 13, 1),
    ]
    assert rows[4].classes == ["x", "y"] and rows[4].attrs == {"class": "x y"} and rows[1].attrs == {"id": "1"}


def test_refused_markup_stays_in_its_page(spark):
    nodes = nodes_of(spark, "<b>1</b>", "<b>2</b><![foo[x]]>", "", None, "<b>5")
    rows = nodes.select("page_id", S.first_text(page_scope(), sel("b")).alias("b"), "parse_error").orderBy("page_id").collect()
    assert [r.b for r in rows] == ["1", "2", None, None, "5"]
    assert [r.parse_error is not None for r in rows] == [False, True, False, False, False]


def test_nothing_is_lost_behind_refused_markup(spark):
    item = '<div class="product"><h3>{0}</h3><a class="next" href="/{0}">x</a></div>'
    bad = ["<![foo[x]]>", "<![foo[<b>x</b>]]>", "<![ ]>", "<![foo", "<![1", "&#" + "9" * 5000 + ";", "&#" + "0" * 5000 + "65;"]
    script = '<script type="application/ld+json">{"@type": "Product", "name": "n"}</script>'
    nodes = nodes_of(spark, *[item.format(1) + b + item.format(2) + script for b in bad], "<p>a<![foo[x]]> b &amp; c</p>d")
    rows = nodes.select("page_id", S.find_all(page_scope(), sel("h3")).alias("names"), "parse_error").orderBy("page_id").collect()
    assert [len(r.names) for r in rows] == [2] * len(bad) + [0]
    assert [r.parse_error is not None for r in rows] == [True] * 5 + [False, False, True]
    assert values(nodes.select("page_id", S.text(F.lit(0)).alias("t")))[-1] == "a<![foo[x]]> b & cd"
    found = cards(card_pages(nodes, ["page_id"]), ["page_id"], F.lit("https://h.com"))
    assert found.filter("name = '2'").count() == len(bad)
    assert jsonld_details(nodes, ["page_id"]).filter("name = 'n'").count() == len(bad)
    assert next_links(nodes, [sel("a", equals={"href": "/2"})], ["url"]).filter("next_url is not null").count() == len(bad)


def test_batches_are_cut_and_whole(spark, monkeypatch):
    from gondola.operators import nodes as N

    monkeypatch.setattr(N, "NODES_PER_BATCH", 7)
    htmls = [f"<p>{i}<b>x</b></p>" for i in range(50)]
    got = values(nodes_of(spark, *htmls).coalesce(1).select("page_id", S.text(F.lit(0)).alias("t")))
    assert got == [f"{i}x" for i in range(50)]


def test_simple_selectors(spark):
    html = '<a href="/x/1" class="b a"></a><a data-k="" id="testId-pod-9"></a><i class="my-price-tag big">t</i>'
    nodes = nodes_of(spark, html)
    tests = {
        "a": sel("a"), ".a": sel(cls="a"), ".ab": sel(cls=["a", "b"]), "[data-k]": sel(has="data-k"), "[href]": sel("a", has="href"),
        "=": sel(equals={"href": "/x/1"}), "^=": sel("a", starts={"id": "testId-pod-"}), "*=": sel(contains={"class": "price"}),
        "* space": sel(contains={"class": "tag big"}), ".price": sel(cls="price"), "any": sel(),
    }
    row = nodes.select(*[S.find_all(page_scope(), s).alias(k) for k, s in tests.items()]).first().asDict()
    assert row == {
        "a": [1, 2], ".a": [1], ".ab": [1], "[data-k]": [2], "[href]": [1], "=": [1], "^=": [2], "*=": [3], "* space": [3],
        ".price": [], "any": [1, 2, 3],
    }


def test_first_rules(spark):
    html = "<p class=b>1</p><p class=a>2</p><p class=c title=' T '>3</p><p class=d title=''>4</p><p class=e> </p>"
    scope = page_scope()
    a, b, c, d, e = (sel(cls=x) for x in "abcde")
    assert pick(spark, html, S.first_text(scope, [a, b])) == "1"  # document order
    assert pick(spark, html, S.first_clean_text(scope, [a, b])) == "2"  # list order
    assert pick(spark, html, S.first_clean_text(scope, [sel("x"), e, c])) == "T"
    assert pick(spark, html, S.first_clean_text(scope, [d])) == "4"
    assert pick(spark, html, S.first_clean_text(scope, [e])) is None
    card = "<div title=own data-name=n><p class=e></p></div><div data-name=n></div><div></div>"
    of = lambda i, groups: S.first_present_text(F.lit(i), S.below(F.lit(i)), groups)
    assert pick(spark, card, of(1, [e, a])) == ""  # exists, though blank
    assert pick(spark, card, of(1, [a])) == "own"
    assert pick(spark, card, of(3, [a])) == "n"
    assert pick(spark, card, of(4, [a])) == ""


def test_scopes_and_ancestors(spark):
    html = "<h3><div id=c class=k><i><a>in</a></i><b class=k>x</b></div></h3><div id=d><a>out</a><h3><a>deep</a></h3></div>"
    assert pick(spark, html, S.find_all(S.below(F.lit(2)), sel(cls="k"))) == [6]  # the scope node is not in it
    within = sel("a", within=sel("h3"))
    # an ancestor outside the scope counts
    assert pick(spark, html, S.first_text(S.below(F.lit(2)), within)) == "in"
    assert pick(spark, html, S.first_text(S.below(F.lit(8)), within)) == "deep"
    assert pick(spark, html, S.first_text(page_scope(), sel("a", within=sel(cls="k", within=sel("h3"))))) == "in"
    assert pick(spark, html, S.first_text(page_scope(), sel("a", within=sel("nav")))) is None
    assert pick(spark, html, S.has_any(page_scope(), sel("h3"))) is True


def test_texts(spark):
    html = "<b>Arroz <i>Extra</i><!-- no --><script>no</script></b><p></p>"
    assert pick(spark, html, S.first_text(page_scope(), sel("b"))) == "ArrozExtra"
    assert pick(spark, html, S.first_text(page_scope(), sel("b"), " > ")) == "Arroz > Extra"
    assert pick(spark, html, S.first_text(page_scope(), sel("p"))) == ""
    assert pick(spark, html, S.first_text(page_scope(), sel("q"))) is None
    crumbs = "<ul><a>1</a><a>2 <i>x</i></a><a> </a></ul>"
    assert pick(spark, crumbs, S.last_text(page_scope(), sel("a"))) == "2x"
    assert pick(spark, "<ul></ul>", S.last_text(page_scope(), sel("a"))) is None
    assert pick(spark, "<img><p><img></p>", S.count_all(page_scope(), sel("img"))) == 2


def test_links_and_ranks(spark):
    html = "<a class=n></a><a class=m href=''></a><a href=/1 class=z></a><p class=q><p class=q></p></p>"
    assert pick(spark, html, S.first_href(page_scope(), [sel(cls="n"), sel(cls="m"), sel(cls="z")])) == "/1"
    # nested hits count; the first selector with any hit decides
    assert pick(spark, html, S.find_ranked(page_scope(), [sel("x"), sel(cls="q"), sel("a")])) == [4, 5]
    assert pick(spark, html, S.find_ranked(page_scope(), [sel("x"), sel("y")])) == []


def test_climb(spark):
    stop = lambda i: S.has_any(S.below(i), sel(cls="m"))
    at = lambda steps: S.climb(S.find_first(page_scope(), sel("a")), stop, steps)
    deep = "<i><u><b><s><q><a></a></q></s></b></u></i>"
    assert pick(spark, deep, at(4)) == 2  # nothing found: four parents up
    assert pick(spark, "<i><a></a></i>", at(4)) == 2  # past the root: back to the start
    assert pick(spark, "<i><u><a></a></u><p class=m></p></i>", at(4)) == 1
    assert pick(spark, "<a><p class=m></p></a>", at(4)) == 1


def test_selection_stays_within_the_row(spark):
    nodes = nodes_of(spark, "<p>1</p>")
    text = plan(nodes.select("page_id", S.first_text(page_scope(), sel("p"))))
    assert text.count("MapInArrow") == 1 and "Exchange" not in text


def test_index_equals_search(spark):
    """Matches below every node of random pages, by an index and by looking through the subtree."""
    rng = random.Random(11)

    def some(depth):
        inner = "".join(some(depth + 1) for _ in range(rng.randrange(0, 4 if depth < 4 else 1)))
        return f"<{(t := rng.choice(['div', 'p', 'b', 'br']))} class='{rng.choice('abc')}'>{rng.choice(['', 'x'])}{inner}</{t}>"

    nodes = nodes_of(spark, *["<body>" + some(0) + some(0) + "</body>" for _ in range(12)], "", "text")

    def same(x, i, group):
        return (
            S.all_below(x, i).eqNullSafe(S.find_all(S.below(i), group))
            & S.first_below(x, i).eqNullSafe(S.find_first(S.below(i), group))
            & (S.hits_below(x, i) > 0).eqNullSafe(S.has_any(S.below(i), group))
        )

    everywhere = F.sequence(F.lit(0), F.size("nodes") - 1)
    for group in (sel(cls="a"), [sel("b"), sel(cls="c")], sel("none"), sel("p", within=sel("div"))):
        alike = let(S.hit_index(group), lambda x, group=group: F.forall(everywhere, lambda i: same(x, i, group)))
        assert all(values(nodes.select("page_id", alike)))


def test_anchors_without_pods_take_linear_time(spark):
    def seconds(n):
        anchors = "".join(f'<div><p><a class="pod-link" href="/{i}">x{i}</a></p></div>' for i in range(n))
        nodes = nodes_of(spark, f"<body>{anchors}</body>")
        began = time.perf_counter()
        assert nodes.select(F.size(pod_records()).alias("n")).first().n == n
        return time.perf_counter() - began

    seconds(100)  # compiles
    assert seconds(20_000) < 12  # a search of the page for each would take an hour
