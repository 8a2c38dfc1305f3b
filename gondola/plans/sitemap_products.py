"""Sitemaps to audited products, and category listings to products; ``sitemap_run`` puts them together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.urls import html_is_product, looks_like_product, split_products
from gondola.operators.audit import accepted, discarded, named_only, with_reason
from gondola.operators.cards import card_pages, card_products, cards, join_details
from gondola.operators.dedup import dedup_products, keep_first
from gondola.operators.details import detail_nodes, detail_records
from gondola.operators.nodes import page_nodes
from gondola.operators.paging import first_per_category, first_rows, last_pages, until_stop
from gondola.operators.prefilter import only_wanted
from gondola.operators.records import rows_per_page
from gondola.operators.robots import with_allowed
from gondola.session import materialise
from gondola.sources.sitemaps import distinct_urls, index_locations, sitemap_locations


@dataclass(frozen=True)
class Discovered:
    """URLs found in sitemaps, in order: products each once, collections as they come."""

    products: DataFrame
    collections: DataFrame


def discover(
    index: DataFrame, sitemaps: DataFrame, max_sitemaps: int | None = None, max_urls: int | None = None
) -> Discovered:
    """Index ``(host, body)`` and sitemaps ``(sitemap_url, body)`` to URLs."""
    listed = index_locations(index, limit=max_sitemaps).join(sitemaps, "sitemap_url")
    found = sitemap_locations(listed, ["host", "sitemap_no"])
    # place of an entry; structs compare field by field
    place = F.struct("host", "sitemap_no", "loc_no")
    products, collections = split_products(found.select(place.alias("ord"), "url"))
    return Discovered(distinct_urls(products, ["ord"], max_urls), collections)


def visit(urls: DataFrame, corpus: DataFrame, policies: DataFrame | None) -> DataFrame:
    """Allowed URLs with their details and, where they give no product, the reason.

    ``corpus`` has one HTTP-OK page per URL and is cut down to the allowed URLs before parsing: by a bitmap at the
    scan, so that hardly any other page text is shuffled where the list is too long to broadcast.
    """
    allowed = urls if policies is None else with_allowed(urls, policies).filter("allowed").drop("allowed")
    # written first, so that its size is known when the join is planned
    allowed = materialise(allowed, "allowed")
    details = detail_records(detail_nodes(only_wanted(corpus, allowed.select("url"), "url"), "url"), ["url"])
    return with_reason(allowed.join(details, "url", "left"))


def audit(visited: DataFrame, target: int | None = None, as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The first ``target`` products, and the rows discarded until then.

    Both results come from the same rows: pass a written table.
    """
    products, discards = accepted(visited, as_of), discarded(visited)
    if target is None:
        return products, discards
    products = first_rows(products, ["ord"], target)
    stop = products.agg(F.when(F.count(F.lit(1)) == target, F.max("ord")).alias("ord"))
    return products, discards.filter(stop.scalar().isNull() | (F.col("ord") < stop.scalar()))


def category_products(
    pages: DataFrame,
    corpus: DataFrame,
    base: Column,
    policies: DataFrame | None = None,
    max_products: int | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Cards of listing pages ``(category, page_no, url, html)`` as products.

    A category ends at its first barred, missing or empty page. Robots rules are joined to the
    short card rows, not to the pages, so that no page text is shuffled. Of the ``corpus`` of detail pages only those that
    an allowed card links to are parsed.
    """
    place = ["category", "page_no"]
    found = materialise(card_pages(page_nodes(pages, *place, "url"), [*place, "url"]), "card-pages")
    if policies is not None:
        found = with_allowed(found, policies).filter("allowed").drop("allowed")
    stop = materialise(last_pages(rows_per_page(found, place), "category"), "last-pages")
    rows = until_stop(cards(found, place, base), stop, "category")
    if max_products is not None:
        rows = first_per_category(rows, "category", ["page_no", "item_no"], max_products)
    allowed = None
    if policies is not None:
        rows, allowed = with_allowed(rows, policies), F.col("allowed")
    rows = materialise(rows, "card-rows")
    looked_up = join_details(rows, lookup_details(corpus, rows if allowed is None else rows.filter(allowed)), allowed)
    return card_products(looked_up, [*place, "item_no"], as_of)


def lookup_details(corpus: DataFrame, linked: DataFrame | None = None) -> DataFrame:
    """Detail pages by URL, for ``join_details``: pages that look like products (F3), of the URLs in ``linked`` if given.

    Both tests are made on URL and text, so no other page is parsed. The table is written, so that the join with the cards
    can be split where many cards share one URL.
    """
    if linked is not None:
        wanted = materialise(linked.filter("url <> ''").select("url").distinct(), "linked")
        corpus = only_wanted(corpus, wanted, "url")
    pages = corpus.filter(looks_like_product("url", html_is_product("html")))
    details = detail_records(detail_nodes(pages, "url"), ["url"]).filter(~F.col("bad_price"))
    once = keep_first(details.drop("parse_error", "html_is_product", "bad_price"), ["url"], [])
    return materialise(once, "details")


def final_products(products: DataFrame, order: list[str]) -> DataFrame:
    """Named products, each once."""
    return dedup_products(named_only(products), order)
