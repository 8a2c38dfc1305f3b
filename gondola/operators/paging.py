"""Where listings stop, caps, top-up, ordered limits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# so many tasks hand what they have kept to one
FAN = 32


def last_pages(counts: DataFrame, category: str, first_page_counts: bool = True) -> DataFrame:
    """Last page of each category before its first empty or missing one, as ``last_page``.

    ``counts`` holds ``(category, page_no, n_records)``. With ``first_page_counts=False`` page 1
    is read even if it is empty. The end of a run is a page whose successor is not there: an
    anti-join on (category, page), which no big category can skew.
    """
    good = F.col("n_records") > 0
    if not first_page_counts:
        good = good | (F.col("page_no") == 1)
    full = counts.filter(good).select(category, "page_no").distinct()
    before = full.select(category, (F.col("page_no") - 1).alias("page_no"))
    ends = full.join(before, [category, "page_no"], "left_anti")
    last = ends.groupBy(category).agg(F.min("page_no").alias("last_page"))
    # a run that does not start at page 1 is never reached
    starts = full.filter("page_no = 1").select(category)
    return last.join(starts, category, "left_semi")


def until_stop(rows: DataFrame, last: DataFrame, category: str) -> DataFrame:
    """The rows of pages up to the stop."""
    kept = rows.join(last, category).filter(F.col("page_no") <= F.col("last_page"))
    return kept.select(*rows.columns)


def first_pages(pages: DataFrame, cap: int) -> DataFrame:
    """A cap on page numbers; pushed into the scan."""
    return pages.filter(F.col("page_no") <= cap)


def first_per_category(rows: DataFrame, category: str, order: Sequence[str], cap: int) -> DataFrame:
    """The first ``cap`` rows of each category.

    A tree of partial tops: every task keeps its own first rows, ``FAN`` of them meet in one, ``FAN`` of those in the
    next, and only what is left then meets by category. So no task reads more than some ``FAN`` tasks keep,
    however large a category is.
    """
    kept = partial_tops(rows.withColumn("_task", F.spark_partition_id()), category, order, cap)
    return _top(kept, [category], order, cap).drop("_task")


def partial_tops(rows: DataFrame, category: str, order: Sequence[str], cap: int) -> DataFrame:
    """Rows that may be among the first ``cap`` of their category, by ``_task``, after two levels of the tree."""
    for width in (FAN, FAN * FAN):
        rows = _top(rows, [category, F.floor(F.col("_task") / width)], order, cap)
    return rows


def _top(rows: DataFrame, group: Sequence[str | Column], order: Sequence[str], cap: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= cap).drop("_rank")


def first_rows(rows: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows by an order."""
    return rows.orderBy(*order).limit(n)


def seeded_order(url: str, seed: str) -> Column:
    """L3: a repeatable pseudo-random order."""
    return F.md5(F.concat(F.lit(seed), F.col(url)))


def sample_urls(urls: DataFrame, n: int, seed: str, url: str = "url") -> DataFrame:
    """L3, L1: ``n`` URLs in pseudo-random order, numbered by ``ord`` from 0."""
    keyed = urls.withColumn("_key", seeded_order(url, seed)).orderBy("_key", url).limit(n)
    # the window sees n rows
    numbered = keyed.withColumn("ord", F.row_number().over(Window.orderBy("_key", url)) - 1)
    return numbered.drop("_key")


def topped_up(first_phase: DataFrame, collections: DataFrame, collection_ord: str, target: int) -> DataFrame:
    """O2: add whole collections, in order, while the total before them is below ``target``.

    At most ``target`` non-empty collections can be needed, so only that many counts are
    summed up. Both inputs are read twice: pass written tables.
    """
    phase = F.col("_phase")
    done = first_phase.agg(F.count(F.lit(1)).alias("n")).select(F.lit(-1).cast("long").alias("_phase"), "n")
    sizes = collections.groupBy(F.col(collection_ord).cast("long").alias("_phase")).agg(F.count(F.lit(1)).alias("n"))
    needed = done.unionByName(sizes.orderBy("_phase").limit(target))
    before = Window.orderBy("_phase").rowsBetween(Window.unboundedPreceding, -1)
    taken = needed.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    taken = taken.filter((phase >= 0) & (F.col("before") < target)).select("_phase")
    added = collections.withColumn("_phase", F.col(collection_ord).cast("long")).join(taken, "_phase", "left_semi")
    return first_phase.unionByName(added.drop("_phase", collection_ord), allowMissingColumns=True)
