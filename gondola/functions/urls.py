"""URL rules U1-U6 and URL tests F1-F5, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import as_col, falsy_to_null, let
from gondola.functions.text import last_segment

# Signs of a product page.
PRODUCT_URL = r"/p($|\?)"
PRODUCT_URL_BY_NUMBER = r"/\d{5,}/p"
PRODUCT_MARKUP = r"(?i)vtex-product-summary|vtex-product-price|product__title|productName"
PRODUCT_SITEMAP = "/sitemap/product-"

# scheme, //authority, path, ?query, #fragment (the split of RFC 3986, appendix B)
_URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URL_PARTS, group)


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    steps = F.split(path, "/")
    ends_in_dots = path.rlike(r"/\.{1,2}$")
    kept = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == ".", done)
        # the first, empty segment stands for the root and stays
        .when(step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.array_append(done, step)),
    )
    joined = F.array_join(kept, "/")
    slashed = F.when(ends_in_dots, F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), slashed).otherwise(path)


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute form of ``href`` as seen from the page ``base``."""
    base = as_col(base)
    href = F.regexp_replace(as_col(href), r"^[\x00-\x20]+|[\t\r\n]", "")
    origin = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    no_fragment = F.regexp_replace(base, r"#.*$", "")
    no_query = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.regexp_replace(base_path, r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)

    path = F.regexp_extract(href, r"^[^?#]*", 0)
    tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    # doubled slashes go from a relative path only
    relative = F.regexp_replace(F.concat(folder, path), "/{2,}", "/")
    full = F.when(F.startswith(href, F.lit("/")), path).otherwise(relative)
    return (
        F.when(href.isNull() | base.isNull(), href)
        .when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(origin == "", href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("#")), F.concat(no_fragment, href))
        .when(F.startswith(href, F.lit("?")), F.concat(no_query, href))
        .otherwise(F.concat(origin, _without_dots(full), tail))
    )


def resolve_rooted(base: Column | str, href: Column | str) -> Column:
    """As U1, only for an ``href`` that starts with ``/`` where a base is known."""
    base, href = as_col(base), as_col(href)
    rooted = F.startswith(href, F.lit("/")) & base.isNotNull() & (base != "")
    return F.when(rooted, resolve_url(base, href)).otherwise(href)


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _encoded(c: Column) -> Column:
    """Percent-encoding that leaves ``~`` and encodes ``*``."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def set_page_parameter(url: Column | str, page: Column | int) -> Column:
    """Set ``page=N`` and keep the other parameters, grouped at first appearance."""
    url = as_col(url)
    number = (F.lit(page) if isinstance(page, int) else page).cast("string")
    head = F.regexp_extract(url, r"^[^?#]*", 0)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"^[^#]*(#.+)$", 1)

    # parameters without a value are dropped
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike(r"^[^=]*=.+"))
    pairs = F.transform(
        pairs,
        lambda p: F.struct(
            _decoded(F.regexp_extract(p, r"^([^=]*)=", 1)).alias("k"),
            _encoded(_decoded(F.regexp_extract(p, r"^[^=]*=(.*)$", 1))).alias("v"),
        ),
    )

    def rebuilt(ps: Column) -> Column:
        keys = F.array_distinct(F.transform(ps, lambda p: p["k"]))
        keys = F.when(F.array_contains(keys, "page"), keys).otherwise(F.array_append(keys, F.lit("page")))

        def one_key(k: Column) -> Column:
            same = F.filter(ps, lambda p: p["k"] == k)
            values = F.when(k == "page", F.array(number)).otherwise(F.transform(same, lambda p: p["v"]))
            return F.array_join(F.transform(values, lambda v: F.concat(_encoded(k), F.lit("="), v)), "&")

        return F.array_join(F.transform(keys, one_key), "&")

    return F.concat(head, F.lit("?"), let(pairs, rebuilt), fragment)


def append_page(url: Column | str, page: Column) -> Column:
    """U4: ``?page=N`` at the end for N > 1."""
    url = as_col(url)
    return F.when(page > 1, F.concat(url, F.lit("?page="), page.cast("string"))).otherwise(url)


def url_path(url: Column | str) -> Column:
    """Path of a URL without the parameters of its last segment, ``/`` if it has none."""
    path = F.regexp_replace(_part(as_col(url), 3), r";[^/]*$", "")
    return F.coalesce(falsy_to_null(path), F.lit("/"))


def url_host(url: Column | str) -> Column:
    return F.lower(_part(as_col(url), 2))


def url_slug(url: Column | str) -> Column:
    """T7 on U5: last segment of the URL path."""
    return last_segment(url_path(url))


def listing_pages(listings: DataFrame, url: str, max_pages: int, keep_parameters: bool = True) -> DataFrame:
    """One row per listing page 1..max_pages; page 1 is the bare URL."""
    numbered = listings.withColumn("page_no", F.explode(F.sequence(F.lit(1), F.lit(max_pages))))
    page = F.col("page_no")
    if keep_parameters:
        target = F.when(page == 1, F.col(url)).otherwise(set_page_parameter(url, page))
    else:
        target = append_page(url, page)
    return numbered.withColumn("page_url", target)


def is_product_url(url: Column | str) -> Column:
    """product test on the URL alone."""
    url = as_col(url)
    return url.rlike(PRODUCT_URL) | url.rlike(PRODUCT_URL_BY_NUMBER)


def has_product_mark(url: Column | str) -> Column:
    """the wider test, any ``/p``."""
    return F.contains(as_col(url), F.lit("/p"))


def html_is_product(html: Column | str) -> Column:
    """F3, second half: product signs in the page text."""
    html = as_col(html)
    typed = F.contains(html, F.lit('"@type"')) & F.contains(html, F.lit("Product"))
    return F.coalesce(typed | html.rlike(PRODUCT_MARKUP), F.lit(False))


def looks_like_product(url: Column | str, html_says: Column) -> Column:
    """the URL decides; the page text (``html_says``) is asked only where it does not."""
    return F.when(F.lower(as_col(url)).rlike(PRODUCT_URL), F.lit(True)).otherwise(F.coalesce(html_says, F.lit(False)))


def is_product_sitemap(url: Column | str) -> Column:
    """child sitemaps that list products."""
    return F.contains(as_col(url), F.lit(PRODUCT_SITEMAP))


def split_products(urls: DataFrame, url: str = "url") -> tuple[DataFrame, DataFrame]:
    """product URLs and the other (collection) URLs."""
    flagged = urls.withColumn("is_product", is_product_url(url))
    products = flagged.filter("is_product").drop("is_product")
    collections = flagged.filter(~F.col("is_product")).drop("is_product")
    return products, collections
