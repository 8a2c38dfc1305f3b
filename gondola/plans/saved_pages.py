"""Saved listing pages (S1) to one listing table: pods, else JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.operators.dedup import dedup_listing
from gondola.operators.listings import NAME_MARK, json_window_records, or_else, pod_listing, pod_records
from gondola.operators.nodes import page_nodes


def saved_page_listing(pages: DataFrame, keep: Sequence[str], base: Column) -> DataFrame:
    """Records found in JSON text stand in for pages without any pod record.

    Only the texts of pages that name products in JSON travel along with the nodes, and they are searched only
    where no pod was found.
    """
    named = F.when(F.contains("html", F.lit(NAME_MARK)), F.col("html"))
    nodes = page_nodes(pages.withColumn("_named", named), *keep, "_named")
    return pod_listing(nodes, keep, base, or_else(pod_records(), json_window_records("_named")))


def saved_page_products(pages: DataFrame, keep: Sequence[str], base: Column) -> DataFrame:
    """The listing with duplicates gone, first in ``keep`` order."""
    rows = saved_page_listing(pages, keep, base)
    order = [c for c in keep if c != "url"] + ["item_no"]
    return dedup_listing(rows, order).drop(*order)
