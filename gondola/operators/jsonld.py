"""JSON-LD scripts as VARIANT values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import falsy_to_null, let
from gondola.operators.nodes import JSONLD_TYPE, RAW_TEXT
from gondola.operators.select import find_all, node, page_scope, sel

BAD_JSON = "bad_json"
JSONLD_SCRIPT = sel("script", equals={"type": JSONLD_TYPE})
TYPE_PATH = "$['@type']"


def contents(scope: Column) -> Column:
    """Texts of the JSON-LD scripts of a page, in order; null for an empty script.

    Repeated keys and numbers like NaN are gone from them since the page was parsed (``nodes.plain_json``).
    """

    def content(i: Column) -> Column:
        child = node(i + 1)
        return F.when((node(i)["last"] > i) & (child["tag"] == RAW_TEXT), child["text"])

    return F.transform(find_all(scope, JSONLD_SCRIPT), content)


def scripts(scope: Column) -> Column:
    """Parsed JSON-LD scripts of a page, in order; those that are not JSON are left out."""
    parsed = F.transform(contents(scope), F.try_parse_json)
    return F.filter(parsed, lambda v: v.isNotNull())


def refused_scripts(nodes: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The JSON-LD scripts that are not JSON, as ``(script_no, text, reason)``, so that their loss is seen."""
    found = nodes.select(*keep, F.posexplode_outer(contents(page_scope())).alias("script_no", "text"))
    refused = found.filter(F.col("text").isNotNull() & F.try_parse_json("text").isNull())
    return refused.withColumn("reason", F.lit(BAD_JSON))


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def as_list(v: Column) -> Column:
    """A1: a list as it is, anything else as a list of one."""
    listed = F.try_variant_get(v, "$", "array<variant>")
    return F.coalesce(listed, F.when(v.isNotNull(), F.array(v)), F.array().cast("array<variant>"))


def at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def text_at(v: Column, path: str) -> Column:
    """A value as text; null for null and missing. Fractions read like 12.9, whatever their zeros."""
    found = at(v, path)
    plain = F.try_variant_get(found, "$", "string")
    # schema_of_variant tells a fraction from a text that looks like one
    kind = F.schema_of_variant(found)
    fraction = kind.startswith("DECIMAL") | (kind == "DOUBLE")
    return F.when(fraction, F.try_variant_get(found, "$", "double").cast("string")).otherwise(plain)


def brand_text(product: Column) -> Column:
    """Brand given as an object with a name, or as plain text."""
    return F.when(is_object(at(product, "$.brand")), text_at(product, "$.brand.name")).otherwise(text_at(product, "$.brand"))


def type_of(v: Column) -> Column:
    return F.try_variant_get(v, TYPE_PATH, "string")


def listed_products(parsed: Column) -> Column:
    """Product objects of all scripts: elements of item lists, and products on their own."""

    def products(o: Column) -> Column:
        elements = as_list(at(o, "$.itemListElement"))
        items = F.filter(F.transform(elements, lambda e: at(e, "$.item")), is_object)
        none = F.array().cast("array<variant>")
        return F.when(type_of(o) == "ItemList", items).when(type_of(o) == "Product", F.array(o)).otherwise(none)

    per_script = F.transform(parsed, lambda v: F.flatten(F.transform(as_list(v), products)))
    return F.flatten(per_script)


def detail_object(parsed: Column) -> Column:
    """The product or offer a detail page describes.

    The first script that is such an object wins. Failing that, the last script that is a list
    holding one gives its first.
    """
    wanted = lambda o: type_of(o).isin("Product", "Offer") & is_object(o)
    single = F.get(F.filter(parsed, wanted), F.lit(0))
    lists = F.transform(parsed, lambda v: F.get(F.filter(F.try_variant_get(v, "$", "array<variant>"), wanted), F.lit(0)))
    from_list = F.try_element_at(F.filter(lists, lambda o: o.isNotNull()), F.lit(-1))
    return F.coalesce(single, from_list)


def _first_given(*texts: Column) -> Column:
    """The first text that is neither missing, blank nor zero."""
    return F.coalesce(*[F.when(t.isin("", "0", "0.0", "false"), None).otherwise(t) for t in texts])


def detail_fields(o: Column) -> Column:
    """Name, sku, brand and the two price texts of a detail object, as a struct."""

    def of(v: Column) -> Column:
        offers = at(v, "$.offers")
        first = F.try_variant_get(offers, "$[0]", "variant")
        spec = text_at(offers, "$.priceSpecification.price")
        listed = F.try_variant_get(offers, "$", "array<variant>").isNotNull()
        price = F.when(listed, text_at(first, "$.price")).otherwise(_first_given(text_at(offers, "$.price"), spec))
        regular = F.when(listed, _first_given(text_at(first, "$.listPrice"), text_at(first, "$.price"))).otherwise(
            _first_given(text_at(offers, "$.listPrice"), spec)
        )
        return F.struct(
            F.coalesce(falsy_to_null(text_at(v, "$.name")), text_at(v, "$.headline")).alias("name"),
            F.coalesce(falsy_to_null(text_at(v, "$.sku")), text_at(v, "$.mpn")).alias("sku"),
            brand_text(v).alias("brand"),
            falsy_to_null(price).alias("price"),
            falsy_to_null(regular).alias("regular"),
        )

    return let(o, of)
