"""Records of a page: from an array of structs to rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.price import price_last_number

RECORDS = "records"


def records_of(items: Column, record: Callable[[Column], Column]) -> Column:
    """One struct per item of a page."""
    return F.transform(items, record)


def record_rows(pages: DataFrame, keep: Sequence[str], records: str = RECORDS) -> DataFrame:
    """One row per record, numbered by ``item_no`` within its page."""
    # for an inner explode Spark would first test the size of the array, by computing it again
    rows = pages.select(*keep, F.posexplode_outer(records).alias("item_no", "record"))
    return rows.filter("record is not null").select(*keep, "item_no", "record.*")


def with_price(listing: DataFrame, mode: str = "literal") -> DataFrame:
    """N1 over ``price_text`` (Y1: a rule applied to a column)."""
    return listing.withColumn("price", price_last_number("price_text", mode))


def rows_per_page(pages: DataFrame, keep: Sequence[str], records: str = RECORDS) -> DataFrame:
    """Number of records of each page; empty pages count 0."""
    return pages.select(*keep, F.coalesce(F.size(records), F.lit(0)).alias("n_records"))
