"""Queries that apply the scalar rules to texts made from ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.functions.price import (
    discount_percent,
    price_decimal,
    price_first_number,
    price_from_parts,
    price_last_number,
)
from gondola.functions.text import fallback_sku, presentation, row_key
from gondola.functions.urls import has_product_mark, html_is_product, is_product_url, looks_like_product
from workload.registry import PARTS, query
from workload.render import SHOP, fmt, parts

# whole and decimal part of the price text
SPLIT = ", cut AS (SELECT *, split_part(price_text, '.', 1) AS w, split_part(price_text, '.', 2) AS c FROM parts)"


def cut(spark, sf_dir):
    whole, cents = F.substring_index("price_text", ".", 1), F.substring_index("price_text", ".", -1)
    return parts(spark, sf_dir).withColumns({"w": whole, "c": cents})


def by_key(*variants):
    out = F.when(F.col("k") % len(variants) == 0, variants[0])
    for i, v in enumerate(variants[1:], 1):
        out = out.when(F.col("k") % len(variants) == i, v)
    return out


@query(
    f"""
WITH {PARTS}{SPLIT}
SELECT k, CASE k % 8 WHEN 0 THEN price WHEN 1 THEN CAST('1' || w || '.' || c AS DOUBLE)
                     WHEN 2 THEN CAST('1.' || w || c AS DOUBLE) WHEN 3 THEN CAST(w || c AS DOUBLE)
                     WHEN 5 THEN 5.0 WHEN 6 THEN price END AS literal,
       CASE k % 8 WHEN 0 THEN price WHEN 1 THEN CAST('1' || w || '.' || c AS DOUBLE)
                  WHEN 2 THEN CAST('1' || w || '.' || c AS DOUBLE) WHEN 3 THEN CAST(w || c AS DOUBLE)
                  WHEN 5 THEN 5.0 WHEN 6 THEN price END AS by_last_separator
FROM cut"""
)
def price_last(spark, sf_dir):
    """N1 Y1"""
    text = by_key(
        fmt("S/. ~", "price_text"), fmt("1.~,~", "w", "c"), fmt("1,~.~", "w", "c"), fmt("~,~", "w", "c"),
        F.lit("gratis"), fmt("S/ ~ x 5 kg", "price_text"), fmt("S/10.90 - S/ ~", "price_text"), fmt("S/ ~ c/u.", "price_text"),
    )
    texts = cut(spark, sf_dir).select("k", text.alias("t"))
    return texts.select("k", price_last_number("t").alias("literal"), price_last_number("t", "last_separator").alias("by_last_separator"))


@query(
    f"""
WITH {PARTS}{SPLIT}
SELECT k, CASE k % 7 WHEN 0 THEN price WHEN 1 THEN CAST('1' || w || '.' || c AS DOUBLE)
                     WHEN 2 THEN CAST('1' || w || '.' || c AS DOUBLE) WHEN 3 THEN CAST(w || c AS DOUBLE)
                     WHEN 4 THEN 0.0 WHEN 5 THEN 2.0 ELSE CAST('1.' || w AS DOUBLE) END AS price
FROM cut"""
)
def price_first(spark, sf_dir):
    """N2"""
    text = by_key(
        fmt("S/. ~", "price_text"), fmt("US$1.~,~", "w", "c"), fmt("1,~.~", "w", "c"), fmt("~,~", "w", "c"),
        F.lit("gratis"), fmt("2 x S/ ~", "price_text"), fmt("S/. 1,~", "w"),
    )
    return cut(spark, sf_dir).select("k", price_first_number(text).alias("price"))


@query(
    f"""
WITH {PARTS}{SPLIT}
SELECT k, CASE k % 4 WHEN 0 THEN price WHEN 1 THEN CAST(w AS DOUBLE) WHEN 2 THEN 0.0
                     ELSE CAST('1' || w || '.' || c AS DOUBLE) END AS joined,
       CASE k % 4 WHEN 0 THEN CAST(price AS DECIMAL(12,2))
                  WHEN 3 THEN CAST('1' || w || '.' || lpad(CAST(CAST(c AS INTEGER) AS VARCHAR), 2, '0') AS DECIMAL(12,2)) END AS exact,
       CAST(CAST(w || '.905' AS DECIMAL(20,6)) AS DECIMAL(12,2)) AS half_up,
       CAST(w || '.05' AS DECIMAL(12,2)) AS short_fraction
FROM cut"""
)
def price_int_frac(spark, sf_dir):
    """N3 N4"""
    whole = by_key(fmt("S/ ~", "w"), F.col("w"), F.lit("S/"), fmt("1.~", "w"))
    cents = by_key(F.col("c"), F.lit(None), F.col("c"), fmt(".~ ", "c"))
    return cut(spark, sf_dir).select(
        "k",
        price_from_parts(whole, cents).alias("joined"),
        price_decimal(whole, cents).alias("exact"),
        price_decimal("w", F.lit("905")).alias("half_up"),
        price_decimal("w", F.lit("5")).alias("short_fraction"),
    )


@query(
    f"""
WITH {PARTS}, pairs AS (SELECT k, price, CASE k % 5 WHEN 0 THEN 0.0 WHEN 1 THEN price - 10 ELSE price * 1.25 END AS regular FROM parts)
SELECT k, CASE WHEN price > 0 AND regular > price THEN round((regular - price) / regular * 100, 2) ELSE 0.0 END AS discount
FROM pairs"""
)
def discounts(spark, sf_dir):
    """N5"""
    regular = F.when(F.col("k") % 5 == 0, 0.0).when(F.col("k") % 5 == 1, F.col("price") - 10).otherwise(F.col("price") * 1.25)
    return parts(spark, sf_dir).select("k", discount_percent("price", regular).alias("discount"))


@query(
    f"""
WITH {PARTS}
SELECT k, CASE k % 9 WHEN 0 THEN size || ' kg' WHEN 1 THEN size || 'ML' WHEN 2 THEN size || ' un' WHEN 3 THEN 'PACK ' || size
                     WHEN 4 THEN 'caja  ' || size WHEN 5 THEN 'Unidad' WHEN 6 THEN '500g' WHEN 7 THEN '5 L' ELSE size || ' G' END AS pack
FROM parts"""
)
def presentations(spark, sf_dir):
    """T3"""
    name = by_key(
        fmt("arroz ~ kg", "size"), fmt("Leche ~ML x", "size"), fmt("huevos ~ unidades", "size"), fmt("PACK ~ cervezas", "size"),
        fmt("caja  ~", "size"), F.lit("pan"), fmt("arroz ~ x 500g", "size"), fmt("leche ~.5 L", "size"), fmt("~ Galletas", "size"),
    )
    return parts(spark, sf_dir).select("k", presentation(name).alias("pack"))


@query(
    f"""
WITH {PARTS}, named AS (SELECT k, CASE WHEN k % 10 <> 3 THEN name END AS name, CASE WHEN k % 3 <> 0 THEN 'S' || k END AS sku, 'https://shop.example.com/' || k AS url FROM parts)
SELECT k, md5(coalesce(name, '') || '|' || coalesce(sku, '')) AS hash_id,
       'WONG_' || coalesce(nullif(upper(substr(regexp_replace(coalesce(name, ''), '[^A-Za-z0-9_]+', '', 'g'), 1, 10)), ''), 'ITEM') || '_' ||
       (CAST('0x' || substr(md5(url), 1, 7) AS INTEGER) % 9000 + 1000) AS made_up
FROM named"""
)
def row_keys(spark, sf_dir):
    """T4 T5"""
    k = F.col("k")
    name, sku = F.when(k % 10 != 3, F.col("name")), F.when(k % 3 != 0, fmt("S~", "k"))
    return parts(spark, sf_dir).select(
        "k", row_key(name, sku).alias("hash_id"), fallback_sku(name, fmt(SHOP + "/~", "k")).alias("made_up")
    )


@query(
    f"""
WITH {PARTS}
SELECT k, k % 6 IN (0, 1, 2, 4) AS by_url, k % 6 <> 5 AS by_mark,
       k % 6 IN (0, 1, 4) OR (k % 6 IN (2, 3, 5) AND k % 4 IN (0, 1)) AS by_content
FROM parts"""
)
def url_classes(spark, sf_dir):
    """F1 F2 F3 F4"""
    url = by_key(
        fmt(SHOP + "/x-~/p", "k"), fmt(SHOP + "/x-~/p?a=1", "k"), fmt(SHOP + "/12345/pan-~", "k"),
        fmt(SHOP + "/pan-~", "k"), fmt(SHOP + "/X-~/pan/p", "k"), fmt(SHOP + "/col-~", "k"),
    )
    html = by_key(
        F.lit('<script>{"@type": "Product"}</script>'), F.lit("<div class='PRODUCT__title'>"), F.lit('{"@type": "Offer"}'), F.lit(None)
    )
    made = parts(spark, sf_dir).select("k", url.alias("url"), html.alias("html"))
    return made.select(
        "k",
        is_product_url("url").alias("by_url"),
        has_product_mark("url").alias("by_mark"),
        looks_like_product("url", html_is_product("html")).alias("by_content"),
    )
