"""A category's stored listing pages to one clean listing table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.operators.dedup import dedup_listing
from gondola.operators.listings import DEFAULT_STORE, category_pages, summary_listing
from gondola.operators.nodes import page_nodes
from gondola.operators.paging import first_pages, last_pages, until_stop
from gondola.operators.records import rows_per_page
from gondola.operators.stats import price_summary, top_values
from gondola.session import materialise

PAGE = ["category_id", "page_no", "url"]


def category_crawl(
    pages: DataFrame, max_pages: int | None = None, base: Column | None = None, store: str = DEFAULT_STORE
) -> DataFrame:
    """Pages ``(category_id, page_no, url, html)`` to first-wins products of all categories.

    Records per page are written once; paging rules and rows are then read from that table, so
    pages are parsed once.
    """
    wanted = pages.select(*PAGE, "html")
    if max_pages is not None:
        wanted = first_pages(wanted, max_pages)
    found = materialise(category_pages(page_nodes(wanted, *PAGE), PAGE), "category-pages")
    # one short row per category; as a table its size is known to the join
    stop = last_pages(rows_per_page(found, PAGE), "category_id", first_page_counts=False)
    stop = materialise(stop, "last-pages")
    rows = until_stop(summary_listing(found, PAGE, base, store), stop, "category_id")
    once = dedup_listing(rows, ["category_id", "page_no", "item_no"])
    return once.select("title", "price_text", "price", "url", "brand", "category", "store")


def describe_listing(listing: DataFrame) -> dict[str, DataFrame]:
    """Summaries of a written listing table: price summary and most frequent brands."""
    return {"price_summary": price_summary(listing), "top_brands": top_values(listing.select(F.col("brand")), "brand")}
