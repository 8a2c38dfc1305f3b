"""Element selection as Column expressions over the ``nodes`` array of a page.

A *scope* is an array of node indexes in document order. A *group* is one selector or a list
of selectors joined by "or". Selection looks nodes up by index in the page's own array, so a
page never meets another page and nothing is copied per item.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.functions.columns import falsy_to_null, let
from gondola.functions.text import clean_text
from gondola.operators.nodes import NODES, TEXT


@dataclass(frozen=True)
class Sel:
    """A simple selector; ``within`` names an ancestor."""

    tag: str | None = None
    classes: tuple[str, ...] = ()
    attrs: tuple[tuple[str, str, str], ...] = ()
    within: Sel | None = None


Group = Sel | Sequence[Sel]


def sel(
    tag: str | None = None,
    cls: str | Sequence[str] = (),
    within: Sel | None = None,
    has: str | Sequence[str] = (),
    equals: dict[str, str] | None = None,
    starts: dict[str, str] | None = None,
    contains: dict[str, str] | Sequence[tuple[str, str]] = (),
) -> Sel:
    """Build a selector: tag, class names, and attribute tests by presence, value, prefix or part."""
    classes = (cls,) if isinstance(cls, str) else tuple(cls)
    tests = [(a, "has", "") for a in ([has] if isinstance(has, str) else has)]
    tests += [(a, "equals", v) for a, v in (equals or {}).items()]
    tests += [(a, "starts", v) for a, v in (starts or {}).items()]
    tests += [(a, "contains", v) for a, v in (contains.items() if isinstance(contains, dict) else contains)]
    return Sel(tag, classes, tuple(tests), within)


def as_group(group: Group) -> list[Sel]:
    return [group] if isinstance(group, Sel) else list(group)


def node(i: Column) -> Column:
    return F.get(F.col(NODES), i)


def _attr(n: Column, name: str) -> Column:
    return F.try_element_at(n["attrs"], F.lit(name))


def attr(i: Column, name: str) -> Column:
    """Attribute of the node at ``i``, null where it is absent."""
    return _attr(node(i), name)


_TESTS = {
    "has": lambda found, value: found.isNotNull(),
    "equals": lambda found, value: found == value,
    "starts": lambda found, value: F.startswith(found, F.lit(value)),
    "contains": lambda found, value: F.contains(found, F.lit(value)),
}


def _matches_one(i: Column, s: Sel) -> Column:
    # ordered from cheap to dear; & stops at the first false
    n = node(i)
    tests = [n["tag"] == s.tag] if s.tag else []
    tests += [F.array_contains(n["classes"], c) for c in s.classes]
    tests += [_TESTS[op](_attr(n, name), value) for name, op, value in s.attrs]
    if s.within:
        tests.append(has_ancestor(i, s.within))
    if not tests:
        tests.append(~F.startswith(n["tag"], F.lit("#")))
    result = tests[0]
    for t in tests[1:]:
        result = result & t
    return result


def matches(i: Column, group: Group) -> Column:
    """Does the node at ``i`` match any selector of the group? Null counts as no."""
    result = None
    for s in as_group(group):
        one = _matches_one(i, s)
        result = one if result is None else result | one
    return result


def has_ancestor(i: Column, group: Group) -> Column:
    """Climb from ``i`` to the root. Ancestors outside the scope count, as in CSS."""
    n = node(i)
    start = F.struct(n["parent"].alias("at"), F.lit(False).alias("hit"))
    climbed = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n["depth"], F.lit(1))),
        start,
        lambda acc, _: F.when(acc["hit"] | acc["at"].isNull(), acc).otherwise(
            F.struct(node(acc["at"])["parent"].alias("at"), F.coalesce(matches(acc["at"], group), F.lit(False)).alias("hit"))
        ),
    )
    return climbed["hit"]


def below(i: Column) -> Column:
    """The descendants of the node at ``i`` as a scope; the node itself is not in it."""
    last = node(i)["last"]
    none = F.array().cast("array<int>")
    return F.when(i.isNull(), None).when(last > i, F.sequence(i + 1, last)).otherwise(none)


def page_scope() -> Column:
    return below(F.lit(0))


def find_all(scope: Column, group: Group) -> Column:
    """All matches in document order."""
    return F.filter(scope, lambda i: matches(i, group))


def find_first(scope: Column, group: Group) -> Column:
    """The first match in document order, whichever selector of the group it meets."""
    return F.get(find_all(scope, group), F.lit(0))


def has_any(scope: Column, group: Group) -> Column:
    """Descendant test."""
    return F.exists(scope, lambda i: matches(i, group))


def find_ranked(scope: Column, groups: Sequence[Group]) -> Column:
    """All matches of the first selector that has any."""

    def or_next(rest: Sequence[Group]) -> Column:
        if len(rest) == 1:
            return find_all(scope, rest[0])
        return let(find_all(scope, rest[0]), lambda hits: F.when(F.size(hits) > 0, hits).otherwise(or_next(rest[1:])))

    return or_next(list(groups))


def text(i: Column, separator: str = "") -> Column:
    """Trimmed text pieces below ``i``, joined; null if there is no such node.

    Without a separator the words of neighbouring elements fuse.
    """
    pieces = F.filter(below(i), lambda j: node(j)["tag"] == TEXT)
    return F.array_join(F.transform(pieces, lambda j: node(j)["text"]), separator)


def first_text(scope: Column, group: Group, separator: str = "") -> Column:
    return let(find_first(scope, group), lambda i: text(i, separator))


def first_clean_text(scope: Column, groups: Sequence[Group]) -> Column:
    """E5: the first selector in list order with text; its ``title`` attribute is read first."""

    def of(i: Column) -> Column:
        return clean_text(F.coalesce(falsy_to_null(attr(i, "title")), text(i)))

    return F.coalesce(*[let(find_first(scope, g), of) for g in groups])


def first_present_text(i: Column, scope: Column, groups: Sequence[Group]) -> Column:
    """Text of the first selector that exists, even if blank; else own attributes, else ``''``."""
    own = [falsy_to_null(attr(i, name)) for name in ("title", "alt", "data-name")]
    return F.coalesce(*[first_text(scope, g) for g in groups], *own, F.lit(""))


def first_href(scope: Column, groups: Sequence[Group]) -> Column:
    """The first selector in list order whose match has a non-empty ``href``."""
    return F.coalesce(*[let(find_first(scope, g), lambda i: falsy_to_null(attr(i, "href"))) for g in groups])


def first_attr(scope: Column, group: Group, name: str) -> Column:
    """Attribute of the first match."""
    return attr(find_first(scope, group), name)


def last_text(scope: Column, group: Group) -> Column:
    """The last non-empty text among all matches."""
    texts = F.transform(find_all(scope, group), lambda i: falsy_to_null(text(i)))
    return F.try_element_at(F.filter(texts, lambda t: t.isNotNull()), F.lit(-1))


def count_all(scope: Column, group: Group) -> Column:
    """Number of matches."""
    return F.coalesce(F.size(find_all(scope, group)), F.lit(0))


def hit_index(group: Group) -> Column:
    """All matches on the page, and for every node how many of them are at or before it.

    Built by one look at every node. The matches below a node are then those between two numbers, whatever the size of its
    subtree; without an index every search looks at the whole subtree again.
    """

    def of(hits: Column) -> Column:
        last = F.size(F.col(NODES)) - 1
        # k matches are at or before the nodes from match k - 1 up to the one before match k
        begins = F.concat(F.array(F.lit(0)), hits)
        ends = F.concat(hits, F.array(last + 1))
        runs = F.transform(F.arrays_zip(begins.alias("a"), ends.alias("z")), lambda r, k: F.array_repeat(k, r["z"] - r["a"]))
        return F.struct(hits.alias("hits"), F.flatten(runs).alias("upto"))

    return let(find_all(page_scope(), group), of)


def hits_below(index: Column, i: Column) -> Column:
    """How many matches of an index are below the node at ``i``."""
    return F.get(index["upto"], node(i)["last"]) - F.get(index["upto"], i)


def first_below(index: Column, i: Column) -> Column:
    """E4 by an index: the first match below the node at ``i``."""
    return F.when(hits_below(index, i) > 0, F.get(index["hits"], F.get(index["upto"], i)))


def all_below(index: Column, i: Column) -> Column:
    """E2 by an index: the matches below the node at ``i``, in document order."""
    return F.when(i.isNotNull(), F.slice(index["hits"], F.get(index["upto"], i) + 1, hits_below(index, i)))


def climb(i: Column, stop, steps: int) -> Column:
    """Go up from ``i`` until ``stop`` holds, at most ``steps`` parents; past the root, back to ``i``."""
    start = F.struct(i.alias("at"), F.lit(False).alias("done"))
    climbed = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        start,
        lambda acc, _: F.when(acc["done"] | acc["at"].isNull() | stop(acc["at"]), F.struct(acc["at"].alias("at"), F.lit(True).alias("done")))
        .otherwise(F.struct(node(acc["at"])["parent"].alias("at"), F.lit(False).alias("done"))),
    )
    return F.coalesce(climbed["at"], i)
