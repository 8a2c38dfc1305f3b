"""Text rules T1-T7."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.functions.columns import as_col, falsy_to_null

# Unicode white space, including the four ASCII separators.
WHITE_SPACE = r"(?U)[\s\x1c-\x1f]+"

# Pack-size patterns, tried in this order. Those that the first one always precedes are left out.
PRESENTATION_PATTERNS = [
    r"(\d+\s*(?:kg|g|ml|l|un|und|unidades?))",
    r"(pack\s*\d+)",
    r"(caja\s*\d+)",
]
DEFAULT_PRESENTATION = "Unidad"


def clean_text(c: Column | str) -> Column:
    """One blank between words, none at the ends, null when nothing is left."""
    return falsy_to_null(F.trim(F.regexp_replace(as_col(c), WHITE_SPACE, " ")))


def clean_text_or_blank(c: Column | str) -> Column:
    """As T1, with ``''`` for missing."""
    return F.coalesce(clean_text(c), F.lit(""))


def presentation(name: Column | str) -> Column:
    """Pack size found in a product name."""
    name = as_col(name)
    hits = [falsy_to_null(F.regexp_extract(name, "(?iU)" + p, 1)) for p in PRESENTATION_PATTERNS]
    return F.coalesce(*hits, F.lit(DEFAULT_PRESENTATION))


def row_key(name: Column | str, sku: Column | str) -> Column:
    """T4: md5 over name and SKU."""
    blank = F.lit("")
    return F.md5(F.concat(F.coalesce(as_col(name), blank), F.lit("|"), F.coalesce(as_col(sku), blank)))


def fallback_sku(name: Column | str, url: Column | str, prefix: str = "WONG") -> Column:
    """T5: made-up SKU; its four digits come from the URL, so reruns give the same key."""
    head = F.upper(F.regexp_replace(F.coalesce(as_col(name), F.lit("")), r"(?U)\W+", ""))
    head = F.coalesce(falsy_to_null(F.substring(head, 1, 10)), F.lit("ITEM"))
    digest = F.md5(F.coalesce(as_col(url), F.lit("")))
    number = F.conv(F.substring(digest, 1, 7), 16, 10).cast("int") % 9000 + 1000
    return F.concat(F.lit(prefix + "_"), head, F.lit("_"), number.cast("string"))


def matches_any_case(c: Column | str, pattern: str) -> Column:
    """Pattern test ignoring case."""
    return as_col(c).rlike("(?i)" + pattern)


def last_segment(path: Column | str) -> Column:
    """File base name, or slug of a URL path."""
    bare = F.regexp_replace(as_col(path), "^/+|/+$", "")
    return F.element_at(F.split(bare, "/"), -1)
