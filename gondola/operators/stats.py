"""Summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.operators.ranks import with_running

NO_BRAND = "Sin marca"
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
# rank error of the approximate quantiles is one part in this many
ACCURACY = 10_000


def quantiles(df: DataFrame, column: str, wanted: dict[str, float]) -> DataFrame:
    """Exact, interpolated quantiles, as one row with a column each; null without values.

    The input is read twice. Approximate quantiles (a bounded sketch, exact for few rows) give a bracket around each wanted
    one. The second time, values inside a bracket are counted each, and all below and all above it together, with the
    largest and the smallest of them: a few in ten thousand of the rows, equal ones merged before the shuffle. Running
    counts over ranges of these tell which value has the wanted rank, so no task sees more than its range of a bracket.
    """
    values = df.select(F.col(column).alias("v")).filter("v is not null")
    margin = 2 / ACCURACY
    shares = [max(p - margin, 0.0) if low else min(p + margin, 1.0) for p in wanted.values() for low in (True, False)]
    bounds = values.agg(F.percentile_approx("v", F.array(*map(F.lit, shares)), ACCURACY).alias("bounds")).scalar()
    low, high = (lambda j: F.get(bounds, F.lit(2 * j))), (lambda j: F.get(bounds, F.lit(2 * j + 1)))

    def placed(j: int) -> Column:
        side = F.when(F.col("v") < low(j), -1).when(F.col("v") > high(j), 1).otherwise(0)
        return F.struct(F.lit(j).alias("j"), side.alias("side"), F.when(side == 0, F.col("v")).alias("inside"))

    spread = values.select("v", F.inline(F.array(*map(placed, range(len(wanted))))))
    merged = spread.groupBy("j", "side", "inside").agg(
        F.count(F.lit(1)).alias("n"), F.when(F.col("side") < 0, F.max("v")).otherwise(F.min("v")).alias("v")
    )
    ranked = with_running(merged, ["j", "side", "inside"], "n", "before", "brackets")
    # all rows come once for each wanted quantile
    total = ranked.agg((F.sum("n") / len(wanted)).cast("long")).scalar()
    share = F.get(F.array(*map(F.lit, wanted.values())), F.col("j"))
    first = F.col("before") - F.col("j") * total
    ranked = ranked.select("j", "side", "v", "n", first.alias("first"), ((total - 1) * share).alias("at"))
    # of those below a bracket only the last is known, of those above only the first
    known = lambda rank: F.when(F.col("side") < 0, rank == F.col("first") + F.col("n") - 1).when(
        F.col("side") > 0, rank == F.col("first")
    ).otherwise((rank >= F.col("first")) & (rank < F.col("first") + F.col("n")))
    found = ranked.groupBy("j").agg(
        F.max(F.when(known(F.floor("at")), F.col("v"))).alias("lo"),
        F.max(F.when(known(F.ceil("at")), F.col("v"))).alias("hi"),
        F.max("at").alias("at"),
    )
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))
    return found.agg(*[F.max(F.when(F.col("j") == j, value)).alias(k) for j, k in enumerate(wanted)])


def price_summary(df: DataFrame, column: str = "price") -> DataFrame:
    """Count, mean, std, min, quartiles and max; no row if there is no value at all."""
    moments = df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    ).filter("count > 0")
    quartiles = quantiles(df, column, QUARTILES).select(F.struct(*QUARTILES).alias("q")).scalar()
    both = moments.withColumn("q", quartiles)
    return both.select("count", "mean", "std", "min", *[f"q.{k}" for k in QUARTILES], "max")


def top_values(df: DataFrame, column: str, n: int = 10, missing: str = NO_BRAND, count: str = "products") -> DataFrame:
    """The ``n`` most frequent values; names break ties."""
    counts = df.groupBy(F.coalesce(column, F.lit(missing)).alias(column)).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.desc(count), column).limit(n)


def ascending(top: DataFrame, column: str, count: str = "products") -> DataFrame:
    """The same rows for display, the smallest first."""
    return top.orderBy(count, F.desc(column))


def shape(df: DataFrame, category: str | None = None) -> DataFrame:
    """Number of rows, of columns and of categories."""
    counts = [F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns")]
    if category is not None:
        counts.append(F.count_distinct(category).alias("n_categories"))
    return df.agg(*counts)


def rows_by(df: DataFrame, *keys: str, count: str = "n_rows") -> DataFrame:
    """Rows per page, file or category."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))


def has_values(df: DataFrame, column: str) -> DataFrame:
    """Is any value present?"""
    return df.agg((F.count(column) > 0).alias("has_values"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """O1: append batches; columns that one of them lacks are null."""
    result = frames[0]
    for f in frames[1:]:
        result = result.unionByName(f, allowMissingColumns=True)
    return result
