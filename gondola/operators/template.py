"""Records by a configured template, and the link to the next page."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import evaluated_once, falsy_to_null, let
from gondola.functions.text import clean_text
from gondola.functions.urls import resolve_rooted
from gondola.operators.records import RECORDS, record_rows, records_of
from gondola.operators.select import Group, attr, below, find_all, find_first, page_scope, sel, text


@dataclass(frozen=True)
class Template:
    """What an item is, the selector of each field, and the link to the next page.

    Fields whose name ends in ``_url`` are read from ``href``; the others are texts.
    """

    item: Group
    fields: dict[str, Group] = field(default_factory=dict)
    pagination: Group | None = None


# The stock template.
DEFAULT_TEMPLATE = Template(
    item=[sel(cls="product-card"), sel(cls="producto"), sel(cls="job-card"), sel(cls="resultado")],
    fields={
        "titulo": [sel(cls="product-title"), sel(cls="title"), sel(cls="job-title")],
        "precio": [sel(cls="price"), sel(cls="product-price"), sel(cls="monto"), sel(cls="salary")],
        "detalle_url": sel("a", has="href"),
        "categoria": [sel(cls="active", within=sel(cls="breadcrumb")), sel(cls="category-name")],
        "tienda_o_empresa": [sel(cls="brand"), sel(cls="company"), sel(cls="store-name")],
    },
    pagination=[
        sel("a", cls="next"),
        sel("a", equals={"aria-label": "Siguiente"}),
        sel("a", within=sel(cls="pagination-next")),
    ],
)


def extract_template(
    nodes: DataFrame, template: Template, keep: Sequence[str], base: str | None = None
) -> DataFrame:
    """One row per item and one column per field; ``base`` names the column with the page URL."""

    def value(scope: Column, name: str, group: Group) -> Column:
        if name.endswith("_url"):
            return let(find_first(scope, group), lambda i: attr(i, "href"))
        return let(find_first(scope, group), lambda i: clean_text(text(i)))

    def record(item: Column) -> Column:
        return F.struct(*[value(below(item), n, g).alias(n) for n, g in template.fields.items()])

    items = find_all(page_scope(), template.item)
    rows = record_rows(nodes.select(*keep, records_of(items, record).alias(RECORDS)), keep)
    links = [n for n in template.fields if n.endswith("_url")]
    if base is None:
        return rows
    return rows.withColumns({n: resolve_rooted(base, n) for n in links})


def next_links(nodes: DataFrame, pagination: Group, keep: Sequence[str], base: str = "url") -> DataFrame:
    """X11: ``next_url`` of each page, null on the last one."""
    href = let(find_first(page_scope(), pagination), lambda i: falsy_to_null(attr(i, "href")))
    linked = evaluated_once(nodes, dict.fromkeys([*keep, base]), href.alias("_href"))
    return linked.select(*keep, resolve_rooted(base, "_href").alias("next_url"))
