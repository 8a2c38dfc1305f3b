"""Positions in a global order, without a task that holds more than its range of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.session import materialise


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """The written rows with ``rank``, their position from 0 in the ascending order of these columns.

    Rows are dealt by range and written with their place in their partition; partition sizes, of which there are no
    more than shuffle partitions, are summed up to the ranks the partitions begin at. Rows equal in
    all columns of ``order`` are one after another in any order, and are dealt to one task.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = materialise(dealt.withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", 33)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    begins = dealt.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    begins = begins.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__begin"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        dealt.withColumn("__part", part)
        .join(F.broadcast(begins), "__part")  # a row for each partition
        .select(*df.columns, (inside + F.col("__begin")).alias("rank"))
    )
