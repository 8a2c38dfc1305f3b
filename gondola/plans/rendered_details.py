"""Sitemaps to price records of rendered detail pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from gondola.functions.urls import has_product_mark, is_product_sitemap
from gondola.operators.dedup import dedup_details
from gondola.operators.details import detail_prices
from gondola.operators.nodes import page_nodes
from gondola.operators.paging import sample_urls
from gondola.session import materialise
from gondola.sources.sitemaps import index_locations, sitemap_locations


def discovered_urls(index: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """Product URLs of all product sitemaps, each once.

    S12: write the result before details are read, and start again from there.
    """
    wanted = index_locations(index, limit=None).filter(is_product_sitemap("sitemap_url")).select("sitemap_url")
    found = sitemap_locations(wanted.join(sitemaps, "sitemap_url"), [])
    return found.filter(has_product_mark("url")).select("url").dropDuplicates()


def rendered_details(
    urls: DataFrame, corpus: DataFrame, source: str, seed: str, target: int, as_of: Column | None = None
) -> DataFrame:
    """Details of a repeatable sample of ``target`` URLs that were fetched."""
    fetched = urls.join(corpus.select("url"), "url", "left_semi")
    sample = materialise(sample_urls(fetched, target, seed).select("url"), "sample")
    # the sample is small by its limit; the corpus is cut down to it before parsing
    pages = corpus.join(sample, "url", "left_semi")
    return dedup_details(detail_prices(page_nodes(pages, "url"), source, as_of), [])
