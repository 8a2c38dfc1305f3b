"""Valid products, and discarded rows with their reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import falsy_to_null
from gondola.functions.text import fallback_sku
from gondola.functions.urls import looks_like_product
from gondola.operators.cards import DEFAULT_BRAND, DEFAULT_SUBCATEGORY, finish_products

# Reasons, default values, and names that stand for "no name".
NOT_A_PRODUCT = "no_es_producto"
NO_NAME = "sin_nombre_o_detalle"
BAD_PRICE = "bad_price"
SITEMAP_CATEGORY = "sitemap_producto"
UNKNOWN = "unknown"
NULL_NAMES = ["null", "None", ""]


def with_reason(visited: DataFrame) -> DataFrame:
    """F8: why a visited URL gives no product; null if it does.

    Takes allowed URLs left-joined to their detail records.
    """
    is_product = looks_like_product("url", F.col("html_is_product"))
    reason = (
        F.when(~is_product, NOT_A_PRODUCT)
        .when(F.coalesce(F.col("bad_price"), F.lit(False)), BAD_PRICE)
        .when(F.col("name").isNull(), NO_NAME)
    )
    return visited.withColumn("reason", reason)


def discarded(audited: DataFrame) -> DataFrame:
    """Rows for the audit file; the detail found so far goes along as JSON."""
    detail = F.to_json(F.struct("sku", "brand", "price_online", "price_regular", "subcategory", "images_count", "availability"))
    rows = audited.filter(F.col("reason").isNotNull())
    return rows.select("ord", "url", "reason", F.when(F.col("reason") != NOT_A_PRODUCT, detail).alias("detail"))


def accepted(audited: DataFrame, as_of: Column | None = None) -> DataFrame:
    """product rows with default values."""
    known = audited.filter(F.col("reason").isNull()).select(
        "ord",
        "url",
        F.col("name").alias("raw_name"),
        F.coalesce("price_online", F.lit(0.0)).alias("price_online"),
        F.coalesce("price_regular", F.lit(0.0)).alias("price_regular"),
        F.coalesce(falsy_to_null("brand"), F.lit(DEFAULT_BRAND)).alias("raw_brand"),
        F.lit(SITEMAP_CATEGORY).alias("category"),
        F.coalesce(falsy_to_null("subcategory"), F.lit(DEFAULT_SUBCATEGORY)).alias("subcategory"),
        F.coalesce("sku", fallback_sku("name", "url")).alias("sku"),
        F.coalesce("images_count", F.lit(0)).alias("images_count"),
        F.coalesce("availability", F.lit(UNKNOWN)).alias("availability"),
    )
    return finish_products(known, ["ord"], as_of)


def named_only(products: DataFrame, name: str = "name") -> DataFrame:
    """drop rows whose name is missing or a stand-in for that."""
    real = F.when(F.col(name).isin(*NULL_NAMES), None).otherwise(F.col(name))
    return products.withColumn(name, real).na.drop(subset=[name])
