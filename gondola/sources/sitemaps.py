"""Sitemap indexes and sitemaps, from their stored XML text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import falsy_to_null
from gondola.operators.dedup import keep_first

CORRUPT = "_corrupt_record"
INDEX_SHAPE = f"sitemap array<struct<loc string>>, {CORRUPT} string"
SITEMAP_SHAPE = "url array<struct<loc string>>"

# elements count by their own name, whatever prefix their namespace has
ANY_PREFIX = {"ignoreNamespace": "true"}

# Where to look when there is no usable index.
DEFAULT_SITEMAPS = ["/sitemap.xml", "/arquivos/colecciones-wong-sitemap.xml"]


def _locations(body: Column, shape: str, field: str) -> Column:
    # malformed text gives no fields
    locs = F.transform(F.from_xml(body, shape, ANY_PREFIX)[field], lambda e: falsy_to_null(F.trim(e["loc"])))
    return F.filter(locs, lambda loc: loc.isNotNull())


def index_locations(index: DataFrame, host: str = "host", body: str = "body", limit: int | None = None) -> DataFrame:
    """Child sitemaps of each index, in file order.

    An index that cannot be read gives the default sitemaps of its host.
    """
    found = _locations(F.col(body), INDEX_SHAPE, "sitemap")
    defaults = F.transform(F.array(*map(F.lit, DEFAULT_SITEMAPS)), lambda p: F.concat(F.lit("https://"), F.col(host), p))
    parsed = F.from_xml(body, INDEX_SHAPE, {"columnNameOfCorruptRecord": CORRUPT, **ANY_PREFIX})
    usable = F.col(body).rlike(r"<(?:[\w.-]+:)?sitemapindex[\s>]") & parsed.isNotNull() & parsed[CORRUPT].isNull()
    locs = F.when(usable, F.coalesce(found, F.array().cast("array<string>"))).otherwise(defaults)
    if limit is not None:
        locs = F.slice(locs, 1, limit)
    return index.select(host, F.posexplode(locs).alias("sitemap_no", "sitemap_url"))


def sitemap_locations(sitemaps: DataFrame, keep: list[str], body: str = "body") -> DataFrame:
    """Page URLs of each sitemap, in file order; malformed sitemaps give none."""
    return sitemaps.select(*keep, F.posexplode(_locations(F.col(body), SITEMAP_SHAPE, "url")).alias("loc_no", "url"))


def distinct_urls(urls: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """Each URL once, at its first place; the first ``limit`` of them."""
    once = keep_first(urls, ["url"], order)
    return once if limit is None else once.orderBy(*order).limit(limit)
