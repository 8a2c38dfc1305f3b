"""Records by template, from crawled pages or from a folder of saved pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.functions.price import price_last_number
from gondola.operators.dedup import drop_exact
from gondola.operators.nodes import page_nodes
from gondola.operators.template import Template, extract_template, next_links
from gondola.operators.walk import follow_links
from gondola.session import materialise

PRICE_FIELD = "precio"


def finish(rows: DataFrame) -> DataFrame:
    """G1, then N1 where there is a price field."""
    once = drop_exact(rows)
    return once.withColumn("precio_num", price_last_number(PRICE_FIELD)) if PRICE_FIELD in rows.columns else once


def template_crawl(pages: DataFrame, starts: DataFrame, template: Template, max_pages: int | None = None) -> DataFrame:
    """Follow next-page links from ``starts (url, start_no)`` through ``pages (url, html)``.

    Links are read from every page once, which is one scan; looking pages up hop by hop would be a scan a hop.
    """
    links = next_links(page_nodes(pages, "url"), template.pagination, ["url"])
    visited = materialise(follow_links(starts, links, max_pages).select("url"), "visited")
    # only the visited pages are parsed again
    reached = pages.join(visited, "url", "left_semi")
    return finish(extract_template(page_nodes(reached, "url"), template, ["url"], "url").drop("url", "item_no"))


def template_pages(pages: DataFrame, template: Template, base: str | None = None) -> DataFrame:
    """All given pages; saved pages have no base URL."""
    keep = [] if base is None else [base]
    rows = extract_template(page_nodes(pages, *keep), template, keep, base)
    return finish(rows.drop(*keep, "item_no"))
