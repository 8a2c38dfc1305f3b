"""Golden values of the scalar rules."""

import datetime
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gondola.functions import columns, price, text, urls


def run(spark, rows, schema, *exprs):
    out = spark.createDataFrame(rows, schema).select(*exprs).collect()
    return [r[0] if len(r) == 1 else tuple(r) for r in out]


def test_clean_text(spark):
    rows = [("a  b",), (" \t  ",), (None,), ("x",), ("a\x1fb\n\rc ",)]
    assert run(spark, rows, "s string", text.clean_text("s")) == ["a b", None, None, "x", "a b c"]
    assert run(spark, rows[1:4], "s string", text.clean_text_or_blank("s")) == ["", "", "x"]


LAST = {
    "S/ 12.90": 12.9, "S/. 12.90": 12.9, "1.234,56": 1234.56, "1,234.56": 1.23456, "12,90": 1290.0,
    "gratis": None, "1234": 1234.0, "": None, None: None, "S/ 12.90 c/u.": None, "S/ 12.90 x 5 kg": 5.0,
    "1.234.567": None, "S/10.90 - S/ 15.90": 15.9,
}
FIRST = {
    "S/ 12.90": 12.9, "S/. 12.90": 12.9, "1.234,56": 1234.56, "1,234.56": 1234.56, "12,90": 1290.0,
    "gratis": 0.0, "2 x S/ 9.90": 2.0, "S/. 1,234": 1.234, "US$ 5": 5.0, "": 0.0, None: 0.0, "5.": 5.0,
}


def test_price_last_number(spark):
    rows = [(k,) for k in LAST]
    assert run(spark, rows, "s string", price.price_last_number("s")) == list(LAST.values())
    sane = run(spark, [("1,234.56",), ("1.234,56",), ("12.5",)], "s string", price.price_last_number("s", "last_separator"))
    assert sane == [1234.56, 1234.56, 12.5]
    with pytest.raises(ValueError):
        price.price_last_number("s", "other")


def test_price_first_number(spark):
    assert run(spark, [(k,) for k in FIRST], "s string", price.price_first_number("s")) == list(FIRST.values())


def test_price_from_parts(spark):
    rows = [("12", "90"), ("S/ 1.234", "5"), ("12", None), ("12", ""), (None, "90"), ("S/", "90")]
    assert run(spark, rows, "i string, f string", price.price_from_parts("i", "f")) == [12.9, 1234.5, 12.0, 12.0, 0.0, 0.0]


def test_price_decimal(spark):
    rows = [("12", "90"), ("1.234", "5"), ("12", "905"), ("12", None), ("", "90"), ("S/", "90"), ("7", "00"), ("7", "x"), ("007", "005")]
    want = ["12.90", "1234.05", "12.91", None, None, None, "7.00", None, "7.05"]
    got = run(spark, rows, "i string, f string", price.price_decimal("i", "f"))
    assert got == [None if w is None else Decimal(w) for w in want]


def test_discount(spark):
    rows = [(8.66, 10.0), (2.0, 3.0), (10.0, 8.0), (0.0, 5.0), (5.0, 0.0), (None, 5.0)]
    assert run(spark, rows, "c double, r double", price.discount_percent("c", "r")) == [13.4, 33.33, 0.0, 0.0, 0.0, 0.0]


def test_presentation(spark):
    want = {
        "Arroz 12 x 500g": "500g", "Huevos 3 unidades": "3 un", "Leche 1.5 L": "5 L", "Pack 6 un": "6 un",
        "Pack 6 cervezas": "Pack 6", "10 galletas": "10 g", "Caja 12": "Caja 12", "Pan": "Unidad", "": "Unidad", None: "Unidad",
    }
    assert run(spark, [(k,) for k in want], "n string", text.presentation("n")) == list(want.values())


def test_keys(spark):
    rows = [("Arroz", "1"), (None, None), (" A", None)]
    want = [hashlib.md5(s.encode()).hexdigest() for s in ("Arroz|1", "|", " A|")]
    assert run(spark, rows, "n string, s string", text.row_key("n", "s")) == want
    rows = [("Arroz ñandú extra", "https://h/1"), (None, "https://h/1"), ("--", None)]
    got = run(spark, rows, "n string, u string", text.fallback_sku("n", "u"))
    assert [g.rsplit("_", 1)[0] for g in got] == ["WONG_ARROZÑANDÚ", "WONG_ITEM", "WONG_ITEM"]
    assert all(1000 <= int(g.rsplit("_", 1)[1]) <= 9999 for g in got)
    assert got == run(spark, rows, "n string, u string", text.fallback_sku("n", "u"))


def test_last_segment(spark):
    rows = [("/a/b/c.html",), ("/a/b/",), ("x",), ("/",)]
    assert run(spark, rows, "p string", text.last_segment("p")) == ["c.html", "b", "x", ""]


RESOLVED = {
    "/p/1": "https://h.com/p/1", "d/2": "https://h.com/c/d/2", "?page=2": "https://h.com/c/x?page=2",
    "//cdn/q": "https://cdn/q", "../e": "https://h.com/e", "#t": "https://h.com/c/x#t", "": "https://h.com/c/x",
    "https://o.org/../x": "https://o.org/../x", "/a/./b/../c?x=..#y": "https://h.com/a/c?x=..#y", "../../..": "https://h.com/",
    "./": "https://h.com/c/", "mailto:a@b": "mailto:a@b", "a//b": "https://h.com/c/a/b", " /p": "https://h.com/p", None: None,
}


def test_resolve(spark):
    rows = [("https://h.com/c/x", h) for h in RESOLVED]
    assert run(spark, rows, "b string, h string", urls.resolve_url("b", "h")) == list(RESOLVED.values())
    rows = [("https://h.com/c/x", "/p"), ("https://h.com/c/x", "p"), (None, "/p"), ("https://h.com", "q"), ("https://h.com/c/x", None)]
    assert run(spark, rows, "b string, h string", urls.resolve_rooted("b", "h")) == ["https://h.com/p", "p", "/p", "q", None]
    assert run(spark, [("https://h.com", "q")], "b string, h string", urls.resolve_url("b", "h")) == ["https://h.com/q"]


def test_page_parameter(spark):
    rows = [("https://h/c?x=&y=1&y=2&page=9&z=a b#f",), ("https://h/c",), ("https://h/c?y=1",), ("https://h/c?a=1&b=2&a=3&page=1&page=2",), ("https://h/c?q=%C3%B1+o",)]
    want = [
        "https://h/c?y=1&y=2&page=3&z=a+b#f", "https://h/c?page=3", "https://h/c?y=1&page=3", "https://h/c?a=1&a=3&b=2&page=3", "https://h/c?q=%C3%B1+o&page=3",
    ]
    assert run(spark, rows, "u string", urls.set_page_parameter("u", 3)) == want


def test_listing_pages(spark):
    df = spark.createDataFrame([("https://h/c?a=1",)], "u string")
    kept = [r.page_url for r in urls.listing_pages(df, "u", 3).orderBy("page_no").collect()]
    assert kept == ["https://h/c?a=1", "https://h/c?a=1&page=2", "https://h/c?a=1&page=3"]
    plain = [r.page_url for r in urls.listing_pages(df, "u", 2, keep_parameters=False).orderBy("page_no").collect()]
    assert plain == ["https://h/c?a=1", "https://h/c?a=1?page=2"]


def test_url_tests(spark):
    rows = [("https://h/x-1/p",), ("https://h/x/p?a=1",), ("https://h/12345/pan",), ("https://h/pan",), ("https://h/col",)]
    got = run(spark, rows, "u string", urls.is_product_url("u"), urls.has_product_mark("u"))
    assert got == [(True, True), (True, True), (True, True), (False, True), (False, False)]
    rows = [("https://h/X/P", None), ("https://h/x", '{"@type": "Product"}'), ("https://h/x", "<i class=PRODUCT__title>"), ("https://h/x", "no"), ("https://h/x", None)]
    got = run(spark, rows, "u string, h string", urls.looks_like_product("u", urls.html_is_product("h")))
    assert got == [True, True, True, False, False]
    paths = run(spark, [("https://h",), ("https://h/a/b?x#y",), ("https://h.com/a/b/",)], "u string", urls.url_path("u"), urls.url_slug("u"))
    assert paths == [("/", ""), ("/a/b", "b"), ("/a/b/", "b")]
    assert run(spark, [("/sitemap/product-1.xml",), ("/sitemap/x",)], "u string", urls.is_product_sitemap("u")) == [True, False]
    yes, no = urls.split_products(spark.createDataFrame([("https://h/a/p",), ("https://h/b",)], "url string"))
    assert [r.url for r in yes.collect()] == ["https://h/a/p"] and [r.url for r in no.collect()] == ["https://h/b"]


def test_dates_and_columns(spark):
    now = F.lit(datetime.datetime(2024, 5, 6, 7, 8, 9))
    got = run(spark, [(1,)], "k int", columns.as_of_date(now), columns.as_of_seconds(now))
    assert got == [("2024-05-06", "2024-05-06T07:08:09")]
    df = columns.with_constants(spark.createDataFrame([(1, 2)], "a int, b int"), {"source": "s", "b": 9})
    assert df.columns == ["source", "b", "a"]
    assert columns.order_columns(df, ["a", "zzz", "source"]).columns == ["a", "source"]
