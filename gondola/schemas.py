"""Record schemas and column orders."""

from __future__ import annotations

from pyspark.sql import types as T

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("presentation", T.StringType()),
        T.StructField("price_text", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("url", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("store", T.StringType()),
        T.StructField("origin", T.StringType()),
    ]
)

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("price_online", T.DoubleType()),
        T.StructField("price_regular", T.DoubleType()),
        T.StructField("brand", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("discount_percent", T.DoubleType()),
        T.StructField("presentation", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("extracted_on", T.StringType()),
        T.StructField("hash_id", T.StringType()),
        T.StructField("images_count", T.IntegerType()),
        T.StructField("availability", T.StringType()),
    ]
)
PRODUCT_ORDER = PRODUCT_SCHEMA.names

DETAIL_PRICE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("price_web_integer", T.StringType()),
        T.StructField("price_web_fraction", T.StringType()),
        T.StructField("price_store_integer", T.StringType()),
        T.StructField("price_store_fraction", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("timestamp_scrape", T.StringType()),
        T.StructField("category_total_products", T.IntegerType()),
        T.StructField("price_web", T.DoubleType()),
        T.StructField("price_store", T.DoubleType()),
    ]
)
