"""Product detail pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import as_of_seconds, evaluated_once, falsy_to_null, let, with_constants, zero_to_null
from gondola.functions.price import price_decimal, price_from_parts
from gondola.functions.urls import html_is_product
from gondola.operators import jsonld
from gondola.operators.nodes import PARSE_ERROR, page_nodes
from gondola.operators.select import (
    attr,
    below,
    count_all,
    find_first,
    first_attr,
    first_text,
    last_text,
    page_scope,
    sel,
    text,
)

# Where a detail page keeps what.
INTEGER_SPAN = sel("span", contains={"class": "currencyInteger"})
FRACTION_SPANS = [sel("span", contains={"class": "currencyFraction"}), sel("span", contains={"class": "currencyDecimal"})]
NAMES = [
    sel("h1"),
    sel(cls="product__title"),
    sel(cls="vtex-product-summary-2-x-productBrand"),
    sel(equals={"data-testid": "product-name"}),
]
BRANDS = [sel(equals={"data-testid": "brand"}), sel(cls="brand"), sel(cls="product__brand")]
CRUMBS = [sel(cls="breadcrumb"), sel(cls="breadcrumbs")]
OUT_OF_STOCK_WORDS = ["out of stock", "agotado"]

# Exact class names of the rendered detail page.
EXACT_NAME = sel("span", cls="vtex-store-components-3-x-productBrand")
EXACT_PRICES = {
    "price_web_integer": sel("span", cls="vtex-product-price-1-x-currencyInteger--PDPPrice"),
    "price_web_fraction": sel("span", cls="vtex-product-price-1-x-currencyFraction--PDPPrice"),
    "price_store_integer": sel("span", cls="vtex-product-price-1-x-currencyInteger--PDPListPrice"),
    "price_store_fraction": sel("span", cls="vtex-product-price-1-x-currencyFraction--PDPListPrice"),
}


def is_out_of_stock(html: Column | str) -> Column:
    """words in the page text, markup included."""
    low = F.lower(F.col(html) if isinstance(html, str) else html)
    found = F.lit(False)
    for words in OUT_OF_STOCK_WORDS:
        found = found | F.contains(low, F.lit(words))
    return found


def detail_nodes(pages: DataFrame, *keep: str) -> DataFrame:
    """Detail pages as nodes, with the tests that need the page text made before it is dropped."""
    flagged = pages.withColumns({"out_of_stock": is_out_of_stock("html"), "html_is_product": html_is_product("html")})
    return page_nodes(flagged, *keep, "out_of_stock", "html_is_product")


def span_price() -> Column:
    """Price from the integer and fraction spans; 0.0 without an integer."""
    scope = page_scope()
    return price_from_parts(first_text(scope, INTEGER_SPAN), first_text(scope, FRACTION_SPANS))


def page_sku() -> Column:
    """SKU attributes in order of preference; a meta tag only if no element has one."""
    scope = page_scope()

    def of(holder: Column) -> Column:
        own = F.coalesce(falsy_to_null(attr(holder, "data-sku")), attr(holder, "data-product-sku"))
        by_property = find_first(scope, sel("meta", equals={"property": "product:retailer_part_no"}))
        by_name = find_first(scope, sel("meta", equals={"name": "sku"}))
        return F.when(holder.isNotNull(), own).otherwise(let(F.coalesce(by_property, by_name), lambda m: attr(m, "content")))

    return let(F.coalesce(find_first(scope, sel(has="data-sku")), find_first(scope, sel(has="data-product-sku"))), of)


def page_subcategory() -> Column:
    """Last breadcrumb link with text."""
    return let(find_first(page_scope(), CRUMBS), lambda i: last_text(below(i), sel("a")))


def jsonld_details(nodes: DataFrame, keep: Sequence[str]) -> DataFrame:
    """What JSON-LD says about each page; ``bad_price`` marks price texts that are no numbers."""
    found = evaluated_once(nodes, keep, jsonld.detail_fields(jsonld.detail_object(jsonld.scripts(page_scope()))).alias("ld"))
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    bad = lambda c: F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()
    return found.select(
        *keep,
        "ld.name",
        "ld.sku",
        "ld.brand",
        number("ld.price").alias("price_online"),
        number("ld.regular").alias("price_regular"),
        (bad("ld.price") | bad("ld.regular")).alias("bad_price"),
    )


def detail_records(nodes: DataFrame, keep: Sequence[str]) -> DataFrame:
    """JSON-LD first, then price spans and selectors, field by field.

    Takes ``detail_nodes`` output. A page without JSON-LD name and heading has a null name.
    """
    scope = page_scope()
    seen = evaluated_once(
        nodes,
        [*keep, PARSE_ERROR, "html_is_product", "out_of_stock"],
        jsonld.detail_fields(jsonld.detail_object(jsonld.scripts(scope))).alias("ld"),
        span_price().alias("span_price"),
        first_text(scope, NAMES).alias("page_name"),
        first_text(scope, BRANDS).alias("page_brand"),
        page_sku().alias("page_sku"),
        page_subcategory().alias("subcategory"),
        count_all(scope, sel("img")).alias("images_count"),
    )
    number = lambda c: F.col(c).try_cast("double")
    bad = lambda c: F.col(c).isNotNull() & number(c).isNull()
    return seen.select(
        *keep,
        PARSE_ERROR,
        "html_is_product",
        falsy_to_null(F.coalesce(falsy_to_null("ld.name"), F.col("page_name"))).alias("name"),
        falsy_to_null(F.coalesce(falsy_to_null("ld.sku"), F.col("page_sku"))).alias("sku"),
        falsy_to_null(F.coalesce(falsy_to_null("ld.brand"), F.col("page_brand"))).alias("brand"),
        F.coalesce(zero_to_null(number("ld.price")), F.col("span_price")).alias("price_online"),
        F.coalesce(number("ld.regular"), F.lit(0.0)).alias("price_regular"),
        "subcategory",
        "images_count",
        F.when(F.col("out_of_stock"), "out_of_stock").otherwise("in_stock").alias("availability"),
        (bad("ld.price") | bad("ld.regular")).alias("bad_price"),
    )


def detail_prices(nodes: DataFrame, source: str, as_of: Column | None = None) -> DataFrame:
    """The rendered detail page, by exact class names. Takes nodes with ``url``."""
    scope = page_scope()
    prices = [first_text(scope, s).alias(name) for name, s in EXACT_PRICES.items()]
    parts = evaluated_once(nodes, ["url"], first_text(scope, EXACT_NAME).alias("product_name"), *prices)
    priced = parts.select(
        "product_name",
        *EXACT_PRICES,
        "url",
        as_of_seconds(as_of).alias("timestamp_scrape"),
        F.lit(None).cast("int").alias("category_total_products"),
        price_decimal("price_web_integer", "price_web_fraction").cast("double").alias("price_web"),
        price_decimal("price_store_integer", "price_store_fraction").cast("double").alias("price_store"),
    )
    return with_constants(priced, {"source": source})
