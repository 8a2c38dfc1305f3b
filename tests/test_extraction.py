"""Records of listing, detail and template pages: the odd cases."""

import json

from pyspark.sql import functions as F

from gondola.operators.cards import card_pages, card_products, cards, join_details
from gondola.operators.details import detail_nodes, detail_prices, detail_records, jsonld_details, page_sku, span_price
from gondola.operators.jsonld import refused_scripts
from gondola.operators.listings import category_pages, json_window_listing, pod_listing, summary_listing
from gondola.operators.nodes import element_rows
from gondola.operators.select import sel
from gondola.operators.template import DEFAULT_TEMPLATE, Template, extract_template, next_links
from gondola.plans.saved_pages import saved_page_listing, saved_page_products
from tests.helpers import nodes_of, plan, values

def shop():
    return F.lit("https://shop.com")


def ld(*objects):
    return "".join(f'<script type="application/ld+json">{o if isinstance(o, str) else json.dumps(o)}</script>' for o in objects)


def test_pods(spark):
    pod = "<div><div class=pod-details>{}</div><a data-pod data-key=1 {}></a></div>"
    html = (
        pod.format("<li data-internet-price=''><b class=pod-subTitle> A  b</b>", "href=/p")
        + pod.format("<i class=x-price>S/ <u>5</u></i>", "")
        + "<a class=pod-link></a>"  # nothing to read: dropped
        + "<section><div class=pod-summary></div><p><p><p><p><a id=testId-pod-7 href='../q'></a></p></p></p></p></section>"
    )
    rows = pod_listing(nodes_of(spark, f"<body>{html}</body>"), ["page_id"], shop()).orderBy("item_no").collect()
    assert [(r.title, r.price_text, r.price, r.url) for r in rows][:2] == [
        ("A b", "", None, "https://shop.com/p"),
        (None, "S/ 5", 5.0, None),
    ]
    # a pod.-link alone climbs to the body and reads the first price there
    assert [(r.title, r.price_text) for r in rows][2:] == [("A b", ""), (None, None)]
    assert rows[3].url == "https://shop.com/q"


def test_json_windows(spark):
    far = '"displayName":"A"' + "x" * 2000 + '"brand":"Z"'
    name = "N" * 2500
    html = far + f' "displayName" : "{name}","brand":"late" "displayName":" ñ\\u2003é ","url":"","url":"/u","price":["1,5"]'
    pages = spark.createDataFrame([(1, html), (2, "none")], "page_id long, html string")
    rows = json_window_listing(pages, ["page_id"]).orderBy("item_no").collect()
    assert [(r.title, r.brand, r.url, r.price_text, r.price) for r in rows] == [
        ("A", None, None, None, None),
        (name, None, None, None, None),
        ("ñ\\u2003é", None, "/u", "1,5", 15.0),
    ]
    assert {r.origin for r in rows} == {"JSON"}
    assert "MapInArrow" not in plan(json_window_listing(pages, ["page_id"]))


def test_fallback_is_per_page(spark):
    pods = "<a class=pod-link href=/1></a>"
    text = '"displayName":"J","url":"/j"'
    pages = spark.createDataFrame([(1, pods + text), (2, text), (3, "")], "page_id long, html string")
    rows = saved_page_listing(pages, ["page_id"], shop()).orderBy("page_id").collect()
    assert [(r.page_id, r.origin, r.url) for r in rows] == [(1, "DOM", "https://shop.com/1"), (2, "JSON", "/j")]
    twice = pages.withColumn("page_id", F.col("page_id") + 10).unionByName(pages)
    assert saved_page_products(twice, ["page_id"], shop()).count() == 2


def test_summary_cards(spark):
    html = (
        "<div class=breadcrumb>  </div>"
        "<div class=product-card><h3><a href=>t</a></h3><a href=x title=' '></a><b class=price title='S/ 3'>9</b></div>"
        "<div data-component=productSummary><p class=price></p><b class=zprice>S/ 4</b><a></a></div>"
    )
    found = category_pages(nodes_of(spark, html, ""), ["page_id", "url"])
    rows = summary_listing(found, ["page_id", "url"]).collect()
    # the second card has neither title nor link
    assert [(r.title, r.price_text, r.url, r.category) for r in rows] == [("t", "S/ 3", None, None)]


def test_jsonld_lists(spark):
    item = lambda **k: {"@type": "ListItem", "item": {"@type": "Thing", **k}}
    html = ld(
        "{bad",
        {"@type": "ItemList", "itemListElement": item(name=" A ", url="/a", brand={"name": "B"}, offers={"price": 12.0})},
        {"@type": "ItemList", "itemListElement": [item(name="C", offers=[{"price": 1}]), {"item": "no"}, 7, item(url="/d", brand="E", offers={"price": None})]},
        [{"@type": "Product", "name": "F", "offers": {"price": "1.234,5"}}, {"@type": ["Product"]}, {"@type": "Offer"}, "x"],
        {"@type": "Product", "offers": {"price": 3}},
        {"@type": "ItemList"},
        5,
    )
    found = category_pages(nodes_of(spark, html, "<p class=product-card></p>" + html), ["page_id", "url"])
    rows = summary_listing(found, ["page_id", "url"]).orderBy("page_id", "item_no").collect()
    assert [(r.title, r.url, r.brand, r.price_text, r.price) for r in rows] == [
        ("A", "/a", "B", "12.0", 12.0),
        ("C", None, None, None, None),
        (None, "/d", "E", None, None),
        ("F", None, None, "1.234,5", 1234.5),
    ]  # the second page has a card, though an empty one
    assert {r.page_id for r in rows} == {0}


def test_jsonld_that_is_nearly_json(spark):
    """The last of repeated keys counts, and NaN is a number that is not there."""
    script = lambda t: f'<script type="application/ld+json">{t}</script>'
    texts = [
        '{"@type":"Product","name":"a","name":"b"}',
        '{"@type":"Product","name":"c","offers":{"price":NaN,"x":[Infinity,-Infinity]}}',
        '{"@type":"Product","name":"d","offers":{"price":2},"offers":{"price":12.90}}',
        '{"@type":"Product","name":"e",}',
        "[" * 20_000,
        '{"@type":"Product","name":"f","price":1.50, "big":123456789012345678901234567890}',
    ]
    nodes = nodes_of(spark, "".join(map(script, texts)), '<script>{"a":1,"a":2}</script>')
    rows = summary_listing(category_pages(nodes, ["page_id", "url"]), ["page_id", "url"]).orderBy("item_no").collect()
    assert [(r.title, r.price) for r in rows] == [("b", None), ("c", None), ("d", 12.9), ("f", None)]
    refused = refused_scripts(nodes, ["page_id"]).orderBy("script_no").collect()
    assert [(r.page_id, r.script_no, r.text, r.reason) for r in refused] == [(0, 3, texts[3], "bad_json"), (0, 4, texts[4], "bad_json")]
    details = jsonld_details(nodes_of(spark, *map(script, texts)), ["page_id"]).orderBy("page_id").collect()
    assert [(r.name, r.price_online, r.bad_price) for r in details] == [
        ("b", 0.0, False), ("c", 0.0, False), ("d", 12.9, False), (None, 0.0, False), (None, 0.0, False), ("f", 0.0, False),
    ]
    raw = element_rows(nodes).filter("tag = '#raw'").collect()
    assert raw[-2].text == texts[5] and raw[-1].text == '{"a":1,"a":2}'  # other texts stay as they are


def test_jsonld_detail_choice(spark):
    p = lambda n, t="Product", **k: {"@type": t, "name": n, **k}
    pages = [
        ld([p("list")], p("single"), p("later")),
        ld([p("first"), p("second")], [p("last list")], [p("x", "Thing")]),
        ld(p("no", "Thing"), "{", {"@type": "Offer", "headline": "H", "mpn": 5, "brand": {"name": None}}),
        ld({"@type": ["Product"], "name": "typed twice"}),
        "",
        ld(p("", headline="H", sku="", mpn="M", brand="")),
    ]
    rows = jsonld_details(nodes_of(spark, *pages), ["page_id"]).orderBy("page_id").collect()
    assert [r.name for r in rows] == ["single", "last list", "H", None, None, "H"]
    assert [r.sku for r in rows] == [None, None, "5", None, None, "M"]


def test_jsonld_detail_prices(spark):
    cases = [
        ({"price": 0, "priceSpecification": {"price": "7"}}, 7.0, 7.0, False),
        ({"price": "5.5", "listPrice": 9}, 5.5, 9.0, False),
        ([{"price": 4, "listPrice": 0}, {"price": 1}], 4.0, 4.0, False),
        ([], 0.0, 0.0, False),
        ("x", 0.0, 0.0, False),
        ({"price": "call us"}, 0.0, 0.0, True),
        ({"price": 2, "listPrice": "ask"}, 2.0, 0.0, True),
        (None, 0.0, 0.0, False),
    ]
    pages = [ld({"@type": "Product", "name": "n", "offers": o}) for o, *_ in cases]
    rows = jsonld_details(nodes_of(spark, *pages), ["page_id"]).orderBy("page_id").collect()
    assert [(r.price_online, r.price_regular, r.bad_price) for r in rows] == [tuple(c[1:]) for c in cases]


def test_detail_fallbacks(spark):
    frac = "<span class=z-currencyDecimal>.5 </span>"
    pages = [
        "<span class=xcurrencyIntegerx>S/ 1.0<b>2</b></span>" + frac,
        frac,
        "<span class=currencyInteger>12</span>",
        "<p data-sku=''></p><p data-product-sku=P></p><meta name=sku content=M>",
        "<meta name=sku content=M><meta property=product:retailer_part_no content=R>",
        "<p data-sku='' data-product-sku=Q>",
    ]
    nodes = nodes_of(spark, *pages)
    assert values(nodes.select("page_id", span_price().alias("x"))) == [102.5, 0.0, 12.0, 0.0, 0.0, 0.0]
    assert values(nodes.select("page_id", page_sku().alias("x")))[3:] == [None, "R", "Q"]


def test_detail_records(spark):
    html = ld({"@type": "Product", "name": "LD", "offers": {"price": 0}}) + (
        "<h1>no</h1><p class=brand>B</p><span class=currencyInteger>8</span><div class=breadcrumb><a>x</a></div><img><img> Out of STOCK"
    )
    pages = spark.createDataFrame([(1, html), (2, "<![x[ "), (3, "<h1> </h1>")], "page_id long, html string")
    rows = detail_records(detail_nodes(pages, "page_id"), ["page_id"]).orderBy("page_id").collect()
    r = rows[0]
    assert (r.name, r.sku, r.brand, r.price_online, r.price_regular) == ("LD", None, "B", 8.0, 0.0)
    assert (r.subcategory, r.images_count, r.availability, r.html_is_product) == ("x", 2, "out_of_stock", True)
    assert [x.name for x in rows[1:]] == [None, None] and rows[2].availability == "in_stock"


def test_exact_details(spark):
    span = "<span class='vtex-product-price-1-x-currency{}--PDPPrice'>{}</span>"
    html = "<span class='vtex-store-components-3-x-productBrand q'>A <b>b</b></span>" + span.format("Integer", "1.2") + span.format("Fraction", "5")
    rows = detail_prices(nodes_of(spark, html, "<p>"), "s", F.lit("2024-01-02 03:04:05").cast("timestamp")).collect()
    assert rows[0].asDict() == {
        "source": "s", "product_name": "Ab", "price_web_integer": "1.2", "price_web_fraction": "5", "price_store_integer": None,
        "price_store_fraction": None, "url": "https://h.com/c/x", "timestamp_scrape": "2024-01-02T03:04:05",
        "category_total_products": None, "price_web": 12.05, "price_store": None,
    }
    assert rows[1].product_name is None


def test_card_products(spark):
    html = (
        "<div class=product data-product-sku=K title=Own><a href=''>x</a><p class=price>S/ 1,5</p></div>"
        "<div class=product><h3> </h3></div>"
    )
    pages = card_pages(nodes_of(spark, html), ["page_id"])
    found = cards(pages, ["page_id"], shop())
    details = spark.createDataFrame(
        [("https://shop.com", "N", "S", "", 0.0, 20.0, "")],
        "url string, name string, sku string, brand string, price_online double, price_regular double, subcategory string",
    )
    done = card_products(join_details(found, details), ["page_id", "item_no"], F.lit("2024-01-02").cast("timestamp"))
    a, b = done.orderBy("item_no").collect()
    assert (a.name, a.sku, a.brand, a.price_online, a.price_regular, a.discount_percent) == ("Own", "S", "Own", 15.0, 20.0, 25.0)
    assert (b.name, b.brand, b.subcategory, b.url, b.sku[:10]) == ("", "Wong", "Sin subcategoria", "", "WONG_ITEM_")
    barred = join_details(found, details, F.lit(False)).filter("detail is not null")
    assert barred.count() == 0


def test_template(spark):
    html = "<div class=title>out</div><li class=producto><p class=breadcrumb><b class=active>c</b></p><i class=title> a <b>b</b></i><a href=/1></a></li><li class=job-card></li>"
    rows = extract_template(nodes_of(spark, html), DEFAULT_TEMPLATE, ["url"], "url").orderBy("item_no").collect()
    assert [(r.titulo, r.precio, r.detalle_url, r.categoria, r.tienda_o_empresa) for r in rows] == [
        ("ab", None, "https://h.com/1", "c", None),
        (None, None, None, None, None),
    ]
    local = extract_template(nodes_of(spark, html), Template(sel("li"), {"x_url": sel("a")}), [])
    assert [r.x_url for r in local.orderBy("item_no").collect()] == ["/1", None]


def test_next_links(spark):
    pages = [
        "<a class=next href=/2>", "<a aria-label=Siguiente href=n></a><a class=next href=/3>", "<p class=pagination-next><b><a href='?p=2'>",
        "<a class=next></a><a class=next href=/4></a>", "",
    ]
    got = values(next_links(nodes_of(spark, *pages), DEFAULT_TEMPLATE.pagination, ["page_id"]))
    assert got == ["https://h.com/2", "n", "?p=2", None, None]


def test_one_parse_per_extraction(spark):
    nodes = nodes_of(spark, "<p>")
    for df in (pod_listing(nodes, ["page_id"], shop()), extract_template(nodes, DEFAULT_TEMPLATE, ["page_id"])):
        text = plan(df)
        assert text.count("MapInArrow") == 1 and "Exchange" not in text and "BatchEvalPython" not in text
