"""Running sums and positions in a global order, without a task that holds more than its range of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.session import materialise

_PART = "_part"


def with_running(df: DataFrame, order: Sequence[str], count: str, before: str, name: str) -> DataFrame:
    """The written rows with ``before``: the sum of ``count`` over all rows that come earlier by ``order``.

    Rows are dealt by range and written with the number of their range. Summed up over the ranges, of which there are
    no more than shuffle partitions, the counts say what each range begins at; inside it a window adds up.
    Rows that ``order`` does not tell apart follow one another in any order.
    """
    dealt = df.repartitionByRange(*order)
    dealt = materialise(dealt.withColumn(_PART, F.spark_partition_id()), name)
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)  # sees a row for each range
    begins = dealt.groupBy(_PART).agg(F.sum(count).alias("_n"))
    begins = begins.select(_PART, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"))
    inside = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("_inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    # no more rows than shuffle partitions
    summed = summed.join(F.broadcast(begins), _PART)
    return summed.select(*df.columns, (F.col("_begin") + F.col("_inside")).alias(before))


def numbered(df: DataFrame, order: Sequence[str], number: str, name: str) -> DataFrame:
    """The written rows with their position by ``order``, from 0."""
    rows = with_running(df.withColumn("_one", F.lit(1).cast("long")), order, "_one", number, name)
    return rows.drop("_one")
