"""The whole sitemap run: products of sitemaps, topped up from category listings, and written."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.urls import url_slug
from gondola.operators.paging import topped_up
from gondola.operators.ranks import numbered
from gondola.plans.sitemap_products import audit, category_products, discover, final_products, visit
from gondola.session import materialise
from gondola.sources.tables import export_products

ORDER = ["turn", "ord", "page_no", "item_no"]
# so many collections are read at first; then those that should be enough, with something to spare
BATCH, SPARE = 16, 1.25


def sitemap_run(
    index: DataFrame,
    sitemaps: DataFrame,
    corpus: DataFrame,
    listings: DataFrame,
    base: Column,
    target: int,
    policies: DataFrame | None = None,
    per_category: int | None = None,
    as_of: Column | None = None,
    path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Products and discards, exported where a ``path`` is given.

    ``listings`` has the listing pages ``(category, page_no, url, html)``; a category is the slug of its collection URL.
    While fewer than ``target`` products are there, whole collections follow in the order of the sitemaps. Their
    listings are read in batches, the next one as large as the products so far suggest, so few are read beyond the
    last one that is needed.
    """
    found = discover(index, sitemaps)
    visited = materialise(visit(found.products, corpus, policies), "visited")
    products, discards = audit(visited, target, as_of)
    products = materialise(products.withColumn("turn", F.lit(0).cast("long")), "products")
    n_products = products.count()
    if n_products < target:
        named = found.collections.select("ord", url_slug("url").alias("category"))
        named = materialise(numbered(named, ["ord", "category"], "turn", "collections"), "turns")
        n_named, shelf, begin, batch = named.count(), None, 0, BATCH
        while begin < n_named and n_products < target:  # ever more collections, until they have enough
            turns = named.filter((F.col("turn") >= begin) & (F.col("turn") < begin + batch)).select("category", (F.col("turn") + 1).alias("turn"))
            pages = listings.join(turns.select("category").distinct(), "category", "left_semi")
            cards = category_products(pages, corpus, base, policies, per_category, as_of)
            cards = materialise(cards.join(turns, "category").withColumn("collection", F.col("turn")), "shelf")
            shelf = cards if shelf is None else shelf.unionByName(cards)
            n_cards = cards.count()
            n_products, begin = n_products + n_cards, begin + batch
            # as many more as should be enough if they are like these
            batch = max(BATCH, math.ceil((target - n_products) * batch * SPARE / n_cards) if n_cards else batch * 4)
        products = products if shelf is None else topped_up(products, shelf, "collection", target)
    once = materialise(final_products(products, ORDER).drop(*ORDER), "final")
    if path is not None:
        export_products(once, discards.drop("ord"), path)
    return once, discards
