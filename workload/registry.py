"""Queries by name, each beside its check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, or another."""

    def add(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return run

    return add


# what the rendered pages show, straight from the table
PARTS = """
parts AS (
  SELECT p_partkey AS k, p_brand AS brand, p_type AS kind, p_size AS size, p_retailprice AS price,
         p_name || CASE WHEN p_partkey % 9 = 0 THEN ' & cia' ELSE '' END || ' ' || p_size || ' kg' AS name,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS price_text
  FROM part)"""

SLOTS = (
    PARTS
    + """,
placed AS (
  SELECT *, k // 10 AS page, 0 AS dup FROM parts
  UNION ALL
  SELECT *, k // 10 + 1 AS page, 1 AS dup FROM parts WHERE k % 50 = 0),
slots AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY page ORDER BY dup, k) - 1 AS INTEGER) AS item_no FROM placed)"""
)

SHOP_SQL = "'https://shop.example.com'"
