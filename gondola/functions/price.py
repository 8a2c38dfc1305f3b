"""Price rules N1-N5. All give null (or 0.0 where stated) instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.functions.columns import as_col, falsy_to_null

# Currency marks taken off a price text.
CURRENCY_MARKS = ["S/", "S/.", "US$", "$"]


def _drop(c: Column, what: str) -> Column:
    return F.replace(c, F.lit(what), F.lit(""))


def _decimal_comma(c: Column) -> Column:
    return F.replace(_drop(c, "."), F.lit(","), F.lit("."))


def _has_both(c: Column) -> Column:
    return F.contains(c, F.lit(",")) & F.contains(c, F.lit("."))


def _comma_is_last(c: Column) -> Column:
    back = F.reverse(c)
    return F.locate(",", back) < F.locate(".", back)


def _by_last_separator(c: Column) -> Column:
    """The separator that comes last marks the decimals."""
    return F.when(_has_both(c) & _comma_is_last(c), _decimal_comma(c)).otherwise(_drop(c, ","))


def price_last_number(c: Column | str, mode: str = "literal") -> Column:
    """The last number of a text, or null.

    ``literal`` reads every text with both separators as ``1.234,56``;
    ``last_separator`` lets the separator that comes last decide.
    """
    if mode not in ("literal", "last_separator"):
        raise ValueError(f"unknown mode {mode!r}")
    number = F.try_element_at(F.regexp_extract_all(as_col(c), F.lit(r"[\d.,]+"), F.lit(0)), F.lit(-1))
    if mode == "last_separator":
        plain = _by_last_separator(number)
    else:
        plain = F.when(_has_both(number), _decimal_comma(number)).otherwise(_drop(number, ","))
    return plain.try_cast("double")


def price_first_number(c: Column | str) -> Column:
    """The first number of a text once currency marks are gone, else 0.0."""
    text = as_col(c)
    for mark in CURRENCY_MARKS:
        text = _drop(text, mark)
    number = F.regexp_extract(_by_last_separator(text), r"\d+\.?\d*", 0)
    return F.coalesce(number.try_cast("double"), F.lit(0.0))


def _digits(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), r"\D", "")


def price_from_parts(integer: Column | str, fraction: Column | str) -> Column:
    """Integer and fraction texts to a double; no integer digits give 0.0."""
    whole = falsy_to_null(F.coalesce(_digits(integer), F.lit("")))
    cents = falsy_to_null(F.coalesce(_digits(fraction), F.lit("")))
    # concat_ws skips a missing fraction
    joined = F.when(whole.isNotNull(), F.concat_ws(".", whole, cents))
    return F.coalesce(joined.try_cast("double"), F.lit(0.0))


def price_decimal(integer: Column | str, fraction: Column | str) -> Column:
    """Integer and fraction texts to decimal(12,2), half up; both are needed.

    The fraction is read as a number and padded to two digits: ``5`` is ``.05``.
    """
    whole = falsy_to_null(_digits(integer))
    cents = falsy_to_null(F.ltrim(_digits(fraction), F.lit("0")))
    has_cents = falsy_to_null(_digits(fraction)).isNotNull()
    cents = F.coalesce(cents, F.lit("0"))
    cents = F.when(F.length(cents) < 2, F.lpad(cents, 2, "0")).otherwise(cents)
    joined = F.when(whole.isNotNull() & has_cents, F.concat(whole, F.lit("."), cents))
    return F.round(joined.try_cast("decimal(20,6)"), 2).try_cast("decimal(12,2)")


def discount_percent(current: Column | str, regular: Column | str) -> Column:
    """Percentage off the regular price, 0.0 where there is none."""
    now, before = as_col(current), as_col(regular)
    off = F.round((before - now) / before * 100, 2)
    return F.when((before > 0) & (now > 0) & (before > now), off).otherwise(F.lit(0.0))
