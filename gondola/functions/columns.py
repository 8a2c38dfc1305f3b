"""Small Column helpers shared by the other modules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def evaluated_once(df: DataFrame, keep: Sequence[str], *columns: Column) -> DataFrame:
    """Select ``keep`` and costly ``columns`` so that later filters do not compute them again.

    Spark moves a filter below a projection by copying the projected expressions into it. It
    does not move one below a generator, and this one gives exactly one row.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def falsy_to_null(c: Column | str) -> Column:
    """Blank text counts as missing."""
    return F.nullif(as_col(c), F.lit(""))


def zero_to_null(c: Column | str) -> Column:
    """A price of 0 counts as missing."""
    return F.nullif(as_col(c), F.lit(0.0))


def with_constants(df: DataFrame, first: dict[str, object]) -> DataFrame:
    """put constant columns in front of the others."""
    kept = [c for c in df.columns if c not in first]
    return df.select(*[F.lit(v).alias(k) for k, v in first.items()], *kept)


def order_columns(df: DataFrame, order: list[str]) -> DataFrame:
    """the listed columns, in that order, as far as they are present."""
    return df.select(*[c for c in order if c in df.columns])


def as_of_date(as_of: Column | None = None) -> Column:
    """Extraction date as ISO text."""
    return F.date_format(F.current_timestamp() if as_of is None else as_of, "yyyy-MM-dd")


def as_of_seconds(as_of: Column | None = None) -> Column:
    """Extraction time as ISO text, to the second."""
    return F.date_format(F.current_timestamp() if as_of is None else as_of, "yyyy-MM-dd'T'HH:mm:ss")
