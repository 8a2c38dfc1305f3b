"""Products of listing pages.

Each strategy is a Column giving the page's records as an array of structs
``(title, brand, presentation, price_text, href, origin)``, so a fallback is a choice between two arrays
of the same row (J6) and needs no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions.columns import falsy_to_null, let
from gondola.functions.text import clean_text
from gondola.functions.urls import resolve_url
from gondola.operators import jsonld
from gondola.operators.records import RECORDS, record_rows, with_price
from gondola.operators.select import (
    attr,
    below,
    climb,
    find_all,
    find_first,
    first_below,
    first_clean_text,
    first_href,
    hit_index,
    hits_below,
    node,
    page_scope,
    sel,
    text,
)
from gondola.session import materialise

PART_NO = "part_no"
#: What a page shows first, whichever part of it that is in
WHOLE = ["titles", "brands", "units", "items", "prices", "n_titles", "marks"]

# The pod layout.
POD_ANCHORS = [sel("a", has=["data-pod", "data-key"]), sel("a", cls="pod-link"), sel("a", starts={"id": "testId-pod-"})]
POD_MARKS = [sel(contains={"class": "pod-details"}), sel(contains={"class": "pod-summary"})]
POD_TITLES = [sel("b", starts={"id": "testId-pod-displaySubTitle"}), sel(cls="pod-subTitle")]
POD_BRAND = sel(cls="pod-title")
POD_UNIT = sel(cls="pod-subtitle-unit")
POD_PRICE_ITEM = sel("li", has="data-internet-price")
POD_PRICES = [sel(cls="prices"), sel(contains={"class": "price"})]
POD_CLIMB = 4

# The summary layout; titles, prices, links and brands are tried in list order.
SUMMARY_CARDS = [
    sel(equals={"data-component": "productSummary"}),
    sel(cls="product-card"),
    sel(cls="vtex-product-summary-2-x-container"),
]
SUMMARY_TITLES = [
    sel("a", has="title"),
    sel(cls="product-title"),
    sel(cls="vtex-product-summary-2-x-productBrand"),
    sel("a", within=sel("h3")),
]
SUMMARY_PRICES = [
    sel(cls="price"),
    sel(cls="sellingPrice"),
    sel(cls="vtex-store-components-3-x-sellingPrice"),
    sel("span", contains={"class": "sellingPrice"}),
    sel(contains={"class": "price"}),
]
SUMMARY_LINKS = [sel("a", has="href")]
SUMMARY_BRANDS = [sel(cls="brand"), sel(cls="vtex-product-summary-2-x-brandName"), sel(has="data-brand")]
BREADCRUMBS = [sel("nav", cls="breadcrumb"), sel(cls="breadcrumb"), sel(equals={"aria-label": "breadcrumb"})]
DEFAULT_CATEGORY = "Arroz"
DEFAULT_STORE = "Tottus"

# JSON-like text. A product is looked for in this many characters from its name on.
WINDOW_CHARS = 2000
NAME_MARK = '"displayName"'
# (the word is looked at first, so that windows are read at names only)
NAME_WITH_WINDOW = rf'(?s)(?="displayName")(?=(.{{0,{WINDOW_CHARS}}}))"displayName"(?U:\s*):(?U:\s*)"[^"]+"'
NAME = r'(?U)"displayName"\s*:\s*"([^"]+)"'
BRAND = r'(?U)"brand"\s*:\s*"([^"]+)"'
LINK = r'(?U)"url"\s*:\s*"([^"]+)"'
PRICE = r'(?U)"price"\s*:\s*\[\s*"?([\d.,]+)"?\s*\]'

_RECORD_TYPE = (
    "array<struct<title:string,brand:string,presentation:string,price_text:string,href:string,origin:string>>"
)


def _with_pods(result) -> Column:
    """``result(x, is_pod, of)``: an index of each pod selector, the test for a pod, and the record of an anchor and its pod.

    Every selector is looked for once a page. An anchor then finds its pod, and the pod its fields, in these indexes, so
    anchors without a pod of their own, which climb to the whole page, cost no more than others.
    """
    groups = {
        "marks": POD_MARKS, "titles": POD_TITLES, "brands": POD_BRAND, "units": POD_UNIT, "items": POD_PRICE_ITEM, "prices": POD_PRICES,
    }

    def with_index(x: Column) -> Column:
        def is_pod(i: Column) -> Column:
            return (node(i)["tag"] == "body") | (hits_below(x["marks"], i) > 0)

        def of(pod: Column, anchor: Column) -> Column:
            title = F.coalesce(first_below(x["titles"], pod), first_below(x["titles"], anchor))
            # the attribute counts as soon as it is present; the text is only a fallback
            listed = attr(first_below(x["items"], pod), "data-internet-price")
            return F.struct(
                clean_text(let(title, text)).alias("title"),
                clean_text(let(first_below(x["brands"], pod), text)).alias("brand"),
                clean_text(let(first_below(x["units"], pod), text)).alias("presentation"),
                F.coalesce(listed, clean_text(let(first_below(x["prices"], pod), lambda i: text(i, " ")))).alias("price_text"),
                falsy_to_null(attr(anchor, "href")).alias("href"),
                F.lit("DOM").alias("origin"),
            )

        return result(x, is_pod, of)

    return let(F.struct(*[hit_index(g).alias(name) for name, g in groups.items()]), with_index)


def _named(r: Column) -> Column:
    """F9"""
    return F.coalesce(r["title"], r["brand"], falsy_to_null(r["price_text"]), r["href"]).isNotNull()


def pod_records() -> Column:
    """Cards of the pod layout; kept if title, brand, price or link is there."""

    def records(x: Column, is_pod, of) -> Column:
        def record(anchor: Column) -> Column:
            return let(climb(anchor, is_pod, POD_CLIMB), lambda pod: of(pod, anchor))

        return F.filter(F.transform(find_all(page_scope(), POD_ANCHORS), record), _named).cast(_RECORD_TYPE)

    return _with_pods(records)


def _pod_candidates() -> Column:
    """X2 of a part of a page: ``found``, what anchors show by themselves or their pods inside the part, and the part's first
    match of each selector.

    Of an anchor that climbs to the root, which is the whole page, ``far`` tells the steps; it is taken for its own pod.
    """

    def candidates(x: Column, is_pod, of) -> Column:
        def candidate(anchor: Column) -> Column:
            def of_pod(pod: Column) -> Column:
                far = F.when(pod == 0, node(anchor)["depth"])
                return F.struct(let(F.when(pod > 0, pod).otherwise(anchor), lambda i: of(i, anchor)).alias("record"), far.alias("far"))

            return let(climb(anchor, lambda i: is_pod(i) | (i == 0), POD_CLIMB), of_pod)

        def first(name: str, value) -> Column:
            i = F.get(x[name]["hits"], F.lit(0))
            return F.when(i.isNotNull(), F.struct(F.col(PART_NO).alias("at"), let(i, value).alias("value"))).alias(name)

        return F.struct(
            F.transform(find_all(page_scope(), POD_ANCHORS), candidate).alias("found"),
            (F.size(x["marks"]["hits"]) > 0).alias("marks"),
            *[first(name, lambda i: clean_text(text(i))) for name in ("titles", "brands", "units")],
            first("items", lambda i: attr(i, "data-internet-price")),
            first("prices", lambda i: clean_text(text(i, " "))),
        )

    return _with_pods(candidates)


def json_window_records(html: Column | str) -> Column:
    """Products in JSON-like text, without parsing the page.

    Each name opens a window; the first brand, link and price in it count, even if they belong
    to the next product.
    """
    html = F.col(html) if isinstance(html, str) else html
    windows = F.regexp_extract_all(html, F.lit(NAME_WITH_WINDOW), F.lit(1))
    names = F.regexp_extract_all(html, F.lit(NAME), F.lit(1))
    zipped = F.arrays_zip(names.alias("name"), windows.alias("window"))

    def first(window: Column, pattern: str) -> Column:
        return falsy_to_null(F.regexp_extract(window, pattern, 1))

    found = F.transform(
        zipped,
        lambda z: F.struct(
            clean_text(z["name"]).alias("title"),
            clean_text(first(z["window"], BRAND)).alias("brand"),
            F.lit(None).cast("string").alias("presentation"),
            first(z["window"], PRICE).alias("price_text"),
            first(z["window"], LINK).alias("href"),
            F.lit("JSON").alias("origin"),
        ),
    )
    none = F.array().cast(_RECORD_TYPE)
    return F.when(F.contains(html, F.lit(NAME_MARK)), found.cast(_RECORD_TYPE)).otherwise(none)


def summary_records() -> Column:
    """Cards of the summary layout, all of them."""

    def record(card: Column) -> Column:
        scope = below(card)
        return F.struct(
            first_clean_text(scope, SUMMARY_TITLES).alias("title"),
            first_clean_text(scope, SUMMARY_BRANDS).alias("brand"),
            F.lit(None).cast("string").alias("presentation"),
            first_clean_text(scope, SUMMARY_PRICES).alias("price_text"),
            first_href(scope, SUMMARY_LINKS).alias("href"),
            F.lit("DOM").alias("origin"),
        )

    return F.transform(find_all(page_scope(), SUMMARY_CARDS), record).cast(_RECORD_TYPE)


def jsonld_records() -> Column:
    """Products of JSON-LD scripts: list elements and single products. Links stay as they are."""

    def record(product: Column) -> Column:
        return F.struct(
            clean_text(jsonld.text_at(product, "$.name")).alias("title"),
            clean_text(jsonld.brand_text(product)).alias("brand"),
            F.lit(None).cast("string").alias("presentation"),
            clean_text(jsonld.text_at(product, "$.offers.price")).alias("price_text"),
            jsonld.text_at(product, "$.url").alias("href"),
            F.lit("JSON-LD").alias("origin"),
        )

    return F.transform(jsonld.listed_products(jsonld.scripts(page_scope())), record).cast(_RECORD_TYPE)


def breadcrumb_category(default: str = DEFAULT_CATEGORY) -> Column:
    """Category of the whole page; the default only if there is no breadcrumb at all."""
    return let(
        find_first(page_scope(), BREADCRUMBS),
        lambda i: F.when(i.isNull(), F.lit(default)).otherwise(clean_text(text(i, " > "))),
    )


def or_else(first: Column, fallback: Column) -> Column:
    """The fallback strategy, for pages where the first one finds nothing."""
    return let(first, lambda found: F.when(F.size(found) > 0, found).otherwise(fallback))


def pod_listing(pages: DataFrame, keep: Sequence[str], base: Column | None = None, records: Column | None = None) -> DataFrame:
    """X2 as rows. Links found in the page are made absolute, links in JSON text are not."""
    with_records = pages.select(*keep, (pod_records() if records is None else records).alias(RECORDS))
    return _listing(record_rows(with_records, keep), keep, base)


def pod_part_listing(parts: DataFrame, keep: Sequence[str], base: Column | None = None) -> DataFrame:
    """X2 as rows, of pages that come in parts: ``keep`` names the page, ``part_no`` orders its parts.

    The rows are those of ``pod_listing`` over whole pages, but no task sees more of a page than a part. All that an anchor can
    see of other parts is the root: as its pod it has the page's first title, brand, unit and price.
    ``item_no`` goes on from part to part.
    """
    once = materialise(parts.select(*keep, PART_NO, _pod_candidates().alias("x")), "pod-parts")
    firsts = [F.min(F.col("x")[name])["value"].alias(name) for name in ("titles", "brands", "units", "items", "prices")]
    found = [F.count(F.col("x")["titles"]).alias("n_titles"), F.max(F.col("x")["marks"]).alias("marks")]
    whole = once.groupBy(*keep).agg(*firsts, *found).select(*keep, F.struct(*WHOLE).alias("whole"))

    def settled(c: Column) -> Column:
        r, w = c["record"], F.col("whole")
        page = F.struct(
            F.when(w["n_titles"] > 0, w["titles"]).otherwise(r["title"]).alias("title"),
            w["brands"].alias("brand"),
            w["units"].alias("presentation"),
            F.coalesce(w["items"], w["prices"]).alias("price_text"),
            r["href"].alias("href"),
            r["origin"].alias("origin"),
        )
        return F.when(c["far"].isNotNull() & (w["marks"] | (c["far"] == POD_CLIMB)), page).otherwise(r)

    # a row for each page
    joined = once.join(F.broadcast(whole), list(keep))
    settle = F.filter(F.transform(F.col("x")["found"], settled), _named).cast(_RECORD_TYPE)
    records = materialise(joined.select(*keep, PART_NO, settle.alias(RECORDS)), "pod-records")
    # a row for each part
    earlier = Window.partitionBy(*keep).orderBy(PART_NO).rowsBetween(Window.unboundedPreceding, -1)
    sizes = records.select(*keep, PART_NO, F.size(RECORDS).alias("_n"))
    before = sizes.select(*keep, PART_NO, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("int").alias("_before"))
    kept = [*keep, "_before"]
    rows = record_rows(records.join(F.broadcast(before), [*keep, PART_NO]), kept)
    return _listing(rows.withColumn("item_no", F.col("item_no") + F.col("_before")), keep, base)


def _listing(records: DataFrame, keep: Sequence[str], base: Column | None) -> DataFrame:
    rows = with_price(records)
    absolute = resolve_url(F.col("url") if base is None else base, "href")
    link = F.when(F.col("origin") == "DOM", absolute).otherwise(F.col("href"))
    columns = [c for c in keep if c != "url"]
    return rows.withColumn("link", link).select(
        *columns, "item_no", "title", "brand", "presentation", "price_text", "price", F.col("link").alias("url"), "origin"
    )


def json_window_listing(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """X4 as rows."""
    return pod_listing(pages.withColumn(RECORDS, json_window_records(html)), keep, F.lit(None).cast("string"), F.col(RECORDS))


def category_pages(nodes: DataFrame, keep: Sequence[str], fallback: bool = True) -> DataFrame:
    """Per page its records and its category; pages without records stay.

    JSON-LD records carry the default category.
    """
    strategies = or_else(summary_records(), jsonld_records()) if fallback else summary_records()
    found = nodes.select(*keep, strategies.alias(RECORDS), breadcrumb_category().alias("crumbs"))
    # a title or a link is needed
    usable = F.filter(RECORDS, lambda r: F.coalesce(r["title"], falsy_to_null(r["href"])).isNotNull())
    return found.withColumn(RECORDS, usable)


def summary_listing(
    pages: DataFrame, keep: Sequence[str], base: Column | None = None, store: str = DEFAULT_STORE
) -> DataFrame:
    """The rows of ``category_pages``, with prices, absolute links and the store."""
    kept = [*keep, "crumbs"]
    rows = with_price(record_rows(pages, kept))
    in_page = F.col("origin") == "DOM"
    absolute = resolve_url(F.col("url") if base is None else base, "href")
    columns = [c for c in keep if c not in ("url", "category")]
    return rows.select(
        *columns,
        "item_no",
        "title",
        "price_text",
        "price",
        F.when(in_page, absolute).otherwise(F.col("href")).alias("url"),
        "brand",
        F.when(in_page, F.col("crumbs")).otherwise(F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.lit(store).alias("store"),
    )
