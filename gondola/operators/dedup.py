"""Duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_exact(df: DataFrame) -> DataFrame:
    """G1: one of each fully equal row."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the row that comes first by ``order``; null equals null.

    Aggregated on the map side, so a key that many rows share costs one row per task.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    # the other columns break ties, so the outcome never depends on row order
    ranked = F.struct(*[c for c in order if c in others], *[c for c in others if c not in order])
    firsts = df.groupBy(*keys).agg(F.min(ranked).alias("first"))
    return firsts.select(*[F.col(c) if c in keys else F.col("first")[c].alias(c) for c in df.columns])


def dedup_listing(listing: DataFrame, order: list[str]) -> DataFrame:
    """First of each (title, url)."""
    return keep_first(listing, ["title", "url"], order)


def dedup_products(products: DataFrame, order: list[str]) -> DataFrame:
    """First of each row key."""
    return keep_first(products, ["hash_id"], order)


def dedup_details(details: DataFrame, order: list[str]) -> DataFrame:
    """First of each (url, product_name)."""
    return keep_first(details, ["url", "product_name"], order)
