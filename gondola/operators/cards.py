"""Category cards and their detail pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import as_of_date, falsy_to_null, let, order_columns, zero_to_null
from gondola.functions.price import discount_percent, price_first_number
from gondola.functions.text import clean_text_or_blank, fallback_sku, presentation, row_key
from gondola.functions.urls import resolve_url
from gondola.operators.records import RECORDS, record_rows
from gondola.operators.select import attr, below, find_first, find_ranked, first_present_text, page_scope, sel
from gondola.schemas import PRODUCT_ORDER

# Card selectors, tried in this order, and what a card keeps where.
CARDS = [
    sel(contains={"data-testid": "product"}),
    sel(cls="vtex-product-summary"),
    sel(contains={"class": "product-item"}),
    sel(contains={"class": "shelf-item"}),
    sel(cls="product"),
]
CARD_NAMES = [
    sel(equals={"data-testid": "product-name"}),
    sel("h3"),
    sel(cls="product__title"),
    sel(cls="shelf-item__title"),
    sel("a", has="title"),
]
CARD_PRICES = [sel(equals={"data-testid": "price-online"}), sel(cls="product__price"), sel(cls="price")]
CARD_BRANDS = [sel(equals={"data-testid": "brand"}), sel(cls="brand"), sel(cls="product__brand")]
DEFAULT_BRAND = "Wong"
DEFAULT_SUBCATEGORY = "Sin subcategoria"

DETAIL_FIELDS = ["name", "sku", "brand", "price_online", "price_regular", "subcategory"]


def card_records() -> Column:
    """The cards of a page as structs."""

    def record(card: Column) -> Column:
        scope = below(card)
        link = find_first(scope, sel("a", has="href"))
        return F.struct(
            first_present_text(card, scope, CARD_NAMES).alias("name"),
            let(link, lambda i: attr(i, "href")).alias("href"),
            first_present_text(card, scope, CARD_PRICES).alias("price_text"),
            first_present_text(card, scope, CARD_BRANDS).alias("brand"),
            F.coalesce(falsy_to_null(attr(card, "data-sku")), attr(card, "data-product-sku")).alias("sku"),
        )

    return F.transform(find_ranked(page_scope(), CARDS), record)


def card_pages(nodes: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Listing pages with their cards; pages without cards stay."""
    return nodes.select(*keep, card_records().alias(RECORDS))


def cards(pages: DataFrame, keep: Sequence[str], base: Column) -> DataFrame:
    """Card rows with absolute links; ``''`` for a card without one."""
    rows = record_rows(pages, keep)
    return rows.withColumn("url", F.coalesce(resolve_url(base, "href"), F.lit(""))).drop("href")


def join_details(cards: DataFrame, details: DataFrame, allowed: Column | None = None) -> DataFrame:
    """Look up each card's detail page by URL, where ``allowed`` lets us.

    ``details`` has one row per URL. Cards that may not look anything up get a key of their
    own, so that they spread over the tasks and meet nothing.
    """
    usable = F.col("url") != ""
    if allowed is not None:
        usable = usable & allowed
    own = F.concat(F.lit("\x00"), F.xxhash64(*cards.columns).cast("string"))
    keyed = cards.withColumn("_url", F.when(usable, F.col("url")).otherwise(own))
    found = details.select(F.col("url").alias("_url"), F.struct(*DETAIL_FIELDS).alias("detail"))
    return keyed.join(found, "_url", "left").drop("_url")


def card_products(joined: DataFrame, keep: Sequence[str], as_of: Column | None = None) -> DataFrame:
    """The detail's value, else the card's, else a default, field by field."""
    d = lambda field: F.col("detail")[field]
    name = F.coalesce(falsy_to_null("name"), d("name"), F.lit(""))
    known = joined.select(
        *keep,
        "url",
        name.alias("raw_name"),
        F.coalesce(zero_to_null(d("price_online")), price_first_number("price_text")).alias("price_online"),
        F.coalesce(d("price_regular"), F.lit(0.0)).alias("price_regular"),
        F.coalesce(falsy_to_null(d("brand")), falsy_to_null("brand"), F.lit(DEFAULT_BRAND)).alias("raw_brand"),
        F.coalesce(falsy_to_null(d("subcategory")), F.lit(DEFAULT_SUBCATEGORY)).alias("subcategory"),
        # the made-up SKU comes from the card's own name
        F.coalesce(falsy_to_null(d("sku")), falsy_to_null("sku"), fallback_sku("name", "url")).alias("sku"),
    )
    return finish_products(known, keep, as_of)


def finish_products(known: DataFrame, keep: Sequence[str], as_of: Column | None = None) -> DataFrame:
    """Derived product columns: clean texts, discount, presentation, row key, date (F13 order)."""
    full = known.withColumns(
        {
            "name": clean_text_or_blank("raw_name"),
            "brand": clean_text_or_blank("raw_brand"),
            "discount_percent": discount_percent("price_online", "price_regular"),
            "presentation": presentation("raw_name"),
            "extracted_on": as_of_date(as_of),
            "hash_id": row_key("raw_name", "sku"),
        }
    )
    return order_columns(full, [*[c for c in keep if c not in PRODUCT_ORDER], *PRODUCT_ORDER])
