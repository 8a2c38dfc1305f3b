"""Queries over catalogue pages rendered from ``part``; their check SQL never sees a page."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators.cards import card_pages, card_products, cards, join_details
from gondola.operators.dedup import dedup_details, dedup_listing, dedup_products, drop_exact
from gondola.operators.details import detail_nodes, detail_prices, detail_records, jsonld_details
from gondola.operators.jsonld import refused_scripts
from gondola.operators.listings import (
    category_pages,
    json_window_listing,
    pod_listing,
    pod_part_listing,
    summary_listing,
)
from gondola.operators.nodes import page_nodes
from gondola.operators.paging import first_pages, first_per_category, last_pages, until_stop
from gondola.operators.records import rows_per_page
from gondola.operators.stats import has_values, price_summary, rows_by, shape, top_values
from gondola.operators.template import DEFAULT_TEMPLATE, next_links
from gondola.operators.walk import follow_links
from gondola.plans.saved_pages import saved_page_listing, saved_page_products
from gondola.plans.sitemap_products import lookup_details
from gondola.session import materialise
from gondola.sources.pages import read_saved_folder, read_saved_page, saved_discards
from workload.registry import PARTS, SHOP_SQL, SLOTS, query
from workload import render
from workload.render import SHOP

BASE = F.lit  # base URLs are literals
AS_OF = "2024-05-06"


def as_of():
    return F.lit(f"{AS_OF} 07:08:09").cast("timestamp")


# What the pod layout shows
POD = f"""
pods AS (
  SELECT page, item_no, name AS title, brand, size || ' kg' AS presentation,
         CASE WHEN k % 7 = 0 THEN 'S/ ' || price_text ELSE price_text END AS price_text, price,
         {SHOP_SQL} || '/p/' || k AS url, 'DOM' AS origin
  FROM slots)"""

# A missing brand is read from the next product on the page, if that lies within the window
JSON_TEXT = """
texts AS (
  SELECT page, item_no, name AS title,
         CASE WHEN k % 13 <> 0 THEN brand
              WHEN page % 5 <> 4 THEN first_value(CASE WHEN k % 13 <> 0 THEN brand END IGNORE NULLS) OVER (
                PARTITION BY page ORDER BY item_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS brand,
         CAST(NULL AS VARCHAR) AS presentation, price_text, price, '/p/' || k AS url, 'JSON' AS origin
  FROM slots)"""

LISTING = "title, brand, presentation, price_text, price, url, origin"


def pods(spark, sf_dir):
    nodes = page_nodes(render.pod_pages(spark, sf_dir), "page_id", "url")
    return pod_listing(nodes, ["page_id"], BASE(SHOP))


FILE = "'p' || page || CASE WHEN page % 4 = 0 THEN '.HTM' ELSE '.html' END"


@query(f"WITH {SLOTS}, {POD} SELECT {FILE} AS file_name, item_no, {LISTING} FROM pods WHERE page % 9 <> 4")
def saved_folder(spark, sf_dir):
    """A folder of files, some with bad bytes, among empty ones and others"""
    files = read_saved_folder(spark, render.saved_folder(spark, sf_dir))
    return pod_listing(page_nodes(files, "file_name"), ["file_name"], BASE(SHOP))


@query(f"WITH {SLOTS} SELECT DISTINCT {FILE} AS file_name, 'bad_bytes' AS reason FROM slots WHERE page % 9 <> 4 AND page % 5 = 2")
def saved_folder_discards(spark, sf_dir):
    """The files of which something is lost"""
    return saved_discards(spark, render.saved_folder(spark, sf_dir)).select("file_name", "reason")


@query(
    f"""
WITH {SLOTS}, {POD}
SELECT CAST(row_number() OVER (ORDER BY page, item_no) - 1 AS INTEGER) AS item_no, {LISTING} FROM pods"""
)
def saved_file(spark, sf_dir):
    """One file with the whole catalogue"""
    page = read_saved_page(spark, render.saved_file(spark, sf_dir))
    return pod_part_listing(page_nodes(page, "file_name", "part_no"), ["file_name"], BASE(SHOP)).drop("file_name")


@query(f"WITH {SLOTS}, {POD} SELECT page AS page_id, item_no, {LISTING} FROM pods")
def pod_cards(spark, sf_dir):
    """X2 E9 E12 F9 J5"""
    return pods(spark, sf_dir)


@query(f"WITH {SLOTS}, {JSON_TEXT} SELECT page AS page_id, item_no, {LISTING} FROM texts")
def json_window_cards(spark, sf_dir):
    """X4"""
    return json_window_listing(render.json_text_pages(spark, sf_dir), ["page_id"])


@query(
    f"""
WITH {SLOTS}, {POD}, {JSON_TEXT}
SELECT page AS page_id, item_no, {LISTING} FROM pods WHERE page % 3 <> 0
UNION ALL
SELECT page AS page_id, item_no, {LISTING} FROM texts WHERE page % 3 = 0"""
)
def strategy_fallback(spark, sf_dir):
    """J6 O1"""
    return saved_page_listing(render.mixed_pages(spark, sf_dir), ["page_id"], BASE(SHOP))


@query(
    f"""
WITH {SLOTS}, {POD}, {JSON_TEXT},
chosen AS (SELECT * FROM pods WHERE page % 3 <> 0 UNION ALL SELECT * FROM texts WHERE page % 3 = 0)
SELECT {LISTING} FROM chosen
QUALIFY row_number() OVER (PARTITION BY title, url ORDER BY page, item_no) = 1"""
)
def saved_pages(spark, sf_dir):
    """Saved pages to a listing without duplicates: S1 X2 X4 J6 G2"""
    return saved_page_products(render.mixed_pages(spark, sf_dir), ["page_id"], BASE(SHOP))


# What the summary layout shows; every 17th part has neither title nor link
SUMMARY = f"""
summaries AS (
  SELECT page, k, row_number() OVER (PARTITION BY page ORDER BY dup, k) - 1 AS item_no, name AS title,
         CASE WHEN k % 5 = 0 THEN 'S/ ' || price_text ELSE 'S/ ' || price_text || 'c/u' END AS price_text, price,
         CASE WHEN k % 2 = 0 THEN {SHOP_SQL} || '/p/' || k ELSE {SHOP_SQL} || '/list/d/' || k || '?x=1' END AS url,
         brand, CASE WHEN page % 4 <> 0 THEN 'Inicio > Cat' || page ELSE 'Arroz' END AS category, 'Tottus' AS store
  FROM slots WHERE k % 17 <> 0)"""
SUMMARY_COLUMNS = "title, price_text, price, url, brand, category, store"


@query(f"WITH {SLOTS}, {SUMMARY} SELECT page AS page_id, CAST(item_no AS INTEGER) AS item_no, {SUMMARY_COLUMNS} FROM summaries")
def summary_cards(spark, sf_dir):
    """X3 E5 E11 E13 F10 F12"""
    nodes = page_nodes(render.summary_pages(spark, sf_dir), "page_id", "url")
    found = category_pages(nodes, ["page_id", "url"])
    return summary_listing(found, ["page_id", "url"]).drop("page_url")


# What JSON-LD lists say
JSONLD = """
listed AS (
  SELECT page, item_no, k, name AS title,
         CASE WHEN k % 5 IN (0, 1) THEN NULL WHEN k % 3 = 0 THEN CAST(price AS VARCHAR) ELSE 'S/ ' || price_text END AS price_text,
         CASE WHEN k % 5 NOT IN (0, 1) THEN price END AS price,
         '/p/' || k AS url, brand, 'Arroz' AS category, 'Tottus' AS store
  FROM slots)"""


@query(f"WITH {SLOTS}, {JSONLD} SELECT page AS page_id, item_no, {SUMMARY_COLUMNS} FROM listed")
def jsonld_list(spark, sf_dir):
    """X5 A1 J6"""
    nodes = page_nodes(render.jsonld_list_pages(spark, sf_dir), "page_id", "url")
    return summary_listing(category_pages(nodes, ["page_id", "url"]), ["page_id", "url"])


@query(
    f"""
WITH {PARTS}
SELECT k AS page_id, name AS title, CASE WHEN k % 4 < 2 THEN price_text END AS price_text, CASE WHEN k % 4 < 2 THEN price END AS price
FROM parts WHERE k % 4 < 3"""
)
def jsonld_loose(spark, sf_dir):
    """Scripts with repeated keys and without numbers"""
    nodes = page_nodes(render.loose_jsonld_pages(spark, sf_dir), "page_id", "url")
    rows = summary_listing(category_pages(nodes, ["page_id", "url"]), ["page_id", "url"])
    return rows.select("page_id", "title", "price_text", "price")


@query(
    f"""
WITH {PARTS}
SELECT k AS page_id, 0 AS script_no, '{{"@type":"Product" "name":"' || name || '"}}' AS text, 'bad_json' AS reason
FROM parts WHERE k % 4 = 3"""
)
def jsonld_refused(spark, sf_dir):
    """Scripts that are no JSON"""
    return refused_scripts(page_nodes(render.loose_jsonld_pages(spark, sf_dir), "page_id"), ["page_id"])


# What JSON-LD says about a part
JSONLD_DETAIL = """
ld AS (
  SELECT k, CASE WHEN k % 4 <> 0 THEN name END AS name,
         CASE k % 4 WHEN 1 THEN 'S' || k WHEN 2 THEN 'M' || k END AS sku,
         CASE WHEN k % 4 IN (1, 2) THEN brand END AS brand,
         CASE WHEN k % 4 = 1 AND k % 37 <> 5 OR k % 4 = 2 THEN price ELSE 0.0 END AS price_online,
         CASE k % 4 WHEN 1 THEN CAST(CAST(price * 1.25 AS DECIMAL(10,2)) AS DOUBLE) WHEN 2 THEN price ELSE 0.0 END AS price_regular,
         k % 4 = 1 AND k % 37 = 5 AS bad_price
  FROM parts)"""


@query(f"WITH {PARTS}, {JSONLD_DETAIL} SELECT k AS page_id, name, sku, brand, price_online, price_regular, bad_price FROM ld")
def jsonld_detail(spark, sf_dir):
    """X6"""
    nodes = page_nodes(render.detail_pages(spark, sf_dir), "page_id")
    return jsonld_details(nodes, ["page_id"])


# A detail record with its fallbacks
DETAIL = (
    JSONLD_DETAIL
    + """,
details AS (
  SELECT parts.k, 'https://shop.example.com/prod-' || parts.k || '/p' AS url,
         CASE WHEN parts.k % 4 = 0 AND parts.k % 19 = 0 THEN NULL ELSE parts.name END AS name,
         coalesce(ld.sku, CASE WHEN parts.k % 8 = 0 THEN 'D' ELSE 'C' END || parts.k) AS sku,
         parts.brand, price AS price_online, price_regular,
         CASE WHEN parts.k % 10 <> 3 THEN kind END AS subcategory, CAST(parts.k % 4 AS INTEGER) AS images_count,
         CASE WHEN parts.k % 11 = 0 THEN 'out_of_stock' ELSE 'in_stock' END AS availability, bad_price, size
  FROM parts JOIN ld USING (k))"""
)
DETAIL_COLUMNS = "name, sku, brand, price_online, price_regular, subcategory, images_count, availability, bad_price"


@query(f"WITH {PARTS}, {DETAIL} SELECT k AS page_id, {DETAIL_COLUMNS} FROM details", name="detail_records")
def detail_pages(spark, sf_dir):
    """X7 X8 E14 E15 E16 F15"""
    nodes = detail_nodes(render.detail_pages(spark, sf_dir), "page_id")
    return detail_records(nodes, ["page_id"]).drop("parse_error", "html_is_product")


# Exact-class pages; a one-digit fraction reads as hundredths, a three-digit one is rounded half up
EXACT = """
cut AS (SELECT *, split_part(price_text, '.', 1) AS w, split_part(price_text, '.', 2) AS c FROM parts),
shown AS (SELECT *, CASE k % 6 WHEN 0 THEN '5' WHEN 1 THEN c || '9' ELSE c END AS f FROM cut),
exact AS (
  SELECT k, 'shop' AS source, CASE WHEN k % 23 <> 0 THEN brand || name END AS product_name,
         w AS price_web_integer, f AS price_web_fraction,
         CASE WHEN k % 5 <> 0 THEN '1,099' END AS price_store_integer, CASE WHEN k % 5 <> 0 THEN '90' END AS price_store_fraction,
         'https://shop.example.com/prod-' || k || '/p' AS url, '2024-05-06T07:08:09' AS timestamp_scrape,
         CAST(NULL AS INTEGER) AS category_total_products,
         CAST(CAST(CASE WHEN k % 6 = 0 THEN w || '.05'
                        WHEN k % 6 = 1 AND c = '00' THEN w || '.09'
                        WHEN k % 6 = 1 THEN w || '.' || CAST(CAST(f AS INTEGER) AS VARCHAR)
                        ELSE price_text END AS DECIMAL(12,2)) AS DOUBLE) AS price_web,
         CASE WHEN k % 5 <> 0 THEN 1099.9 END::DOUBLE AS price_store
  FROM shown)"""


@query(f"WITH {PARTS}, {EXACT} SELECT * EXCLUDE (k) FROM exact", name="detail_prices")
def exact_details(spark, sf_dir):
    """X9 N4 G4 D1"""
    nodes = page_nodes(render.rendered_pages(spark, sf_dir), "url")
    # every page twice
    both = detail_prices(nodes, "shop", as_of())
    return dedup_details(both.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2)))), ["n"]).drop("n")


# Category cards with the detail's fields first; parts 1 mod 12 link to a page that is gone
CARD = (
    DETAIL
    + """,
cards AS (
  SELECT s.page // 5 AS category, s.page % 5 + 1 AS page_no, s.item_no, s.k,
         CASE s.k % 12 WHEN 0 THEN '' WHEN 1 THEN 'https://shop.example.com/gone-' || s.k || '/p'
                       ELSE 'https://shop.example.com/prod-' || s.k || '/p' END AS url,
         s.name, CASE WHEN s.k % 5 <> 0 THEN s.brand END AS card_brand, s.price, s.price_text, s.size,
         CASE WHEN s.k % 2 = 0 THEN 'K' || s.k END AS card_sku
  FROM slots s WHERE NOT (s.page // 5 % 2 = 1 AND s.page % 5 = 2)),
products AS (
  SELECT c.category, c.page_no, c.item_no, c.name,
         c.price AS price_online, coalesce(d.price_regular, 0.0) AS price_regular,
         coalesce(d.brand, c.card_brand, 'Wong') AS brand, coalesce(d.subcategory, 'Sin subcategoria') AS subcategory,
         coalesce(d.sku, c.card_sku,
           'WONG_' || upper(substr(regexp_replace(c.name, '[^A-Za-z0-9_]+', '', 'g'), 1, 10)) || '_' ||
           (CAST('0x' || substr(md5(c.url), 1, 7) AS INTEGER) % 9000 + 1000)) AS sku,
         c.size || ' kg' AS presentation, c.url
  FROM cards c LEFT JOIN (SELECT * FROM details WHERE NOT bad_price) d ON c.k % 12 > 1 AND c.k = d.k),
full_products AS (
  SELECT *, CASE WHEN price_regular > price_online THEN round((price_regular - price_online) / price_regular * 100, 2) ELSE 0.0 END AS discount_percent,
         '2024-05-06' AS extracted_on, md5(name || '|' || sku) AS hash_id
  FROM products)"""
)
PRODUCT_COLUMNS = (
    "name, price_online, price_regular, brand, category, subcategory, sku, discount_percent, presentation, url, extracted_on, hash_id"
)


def shop_cards(spark, sf_dir):
    nodes = page_nodes(render.category_card_pages(spark, sf_dir), "category", "page_no")
    return card_pages(nodes, ["category", "page_no"])


@query(f"WITH {SLOTS}, {CARD} SELECT page_no, item_no, {PRODUCT_COLUMNS} FROM full_products")
def card_detail_join(spark, sf_dir):
    """X10 J1 E6 E17 F14 N2"""
    found = materialise(cards(shop_cards(spark, sf_dir), ["category", "page_no"], BASE(SHOP)), "cards")
    details = lookup_details(render.detail_pages(spark, sf_dir), found)
    return card_products(join_details(found, details), ["category", "page_no", "item_no"], as_of())


@query(
    f"""
WITH {SLOTS}, {CARD}
SELECT category, page_no, item_no, url FROM cards
WHERE (category % 2 = 0 OR page_no < 3) AND page_no <= 4
QUALIFY row_number() OVER (PARTITION BY category ORDER BY page_no, item_no) <= 25"""
)
def listing_stop(spark, sf_dir):
    """W1 W2 W3"""
    keep = ["category", "page_no"]
    pages = first_pages(render.category_card_pages(spark, sf_dir), 4)
    found = materialise(card_pages(page_nodes(pages, *keep), keep), "cards")
    stop = materialise(last_pages(rows_per_page(found, keep), "category"), "last-pages")
    rows = until_stop(cards(found, keep, BASE(SHOP)), stop, "category")
    return first_per_category(rows, "category", ["page_no", "item_no"], 25).select(*keep, "item_no", "url")


@query(
    f"""
WITH {SLOTS}
SELECT page // 5 AS category, page % 5 + 1 AS page_no,
       CAST(CASE WHEN page // 5 % 2 = 1 AND page % 5 = 2 THEN 0 ELSE count(*) END AS INTEGER) AS n_records
FROM slots GROUP BY page"""
)
def cards_per_page(spark, sf_dir):
    """G10"""
    return rows_per_page(shop_cards(spark, sf_dir), ["category", "page_no"])


# links of the chains: page k leads to page k+1, or back in a loop, or nowhere
LINK = f"""
edges AS (
  SELECT k, {SHOP_SQL} || '/page/' || k AS url,
         CASE WHEN k % 2100 = 2 THEN {SHOP_SQL} || '/page/' || (k - 1)
              WHEN k % 700 = 699 THEN NULL
              WHEN k % 2 = 1 AND k % 700 = 361 THEN CAST(k + 1 AS VARCHAR)
              ELSE {SHOP_SQL} || '/page/' || (k + 1) END AS next_url
  FROM parts)"""


@query(f"WITH {PARTS}, {LINK} SELECT url, next_url FROM edges")
def next_page_links(spark, sf_dir):
    """X11 U2 E3 E4"""
    nodes = page_nodes(render.link_pages(spark, sf_dir), "url")
    return next_links(nodes, DEFAULT_TEMPLATE.pagination, ["url"])


def walk_starts(pages, links):
    """Pages that no other page links to."""
    linked = links.select(F.col("next_url").alias("url")).hint("merge")  # as many rows as pages: not to be broadcast
    return pages.select("url", F.col("page_id").alias("start_no")).join(linked, "url", "left_anti")


WALK = """
starts AS (
  SELECT url, k AS start_no FROM edges WHERE url NOT IN (SELECT next_url FROM edges WHERE next_url IS NOT NULL)
  ORDER BY start_no LIMIT 30),
walk AS (
  SELECT url, start_no, 0 AS hop, [url] AS trail FROM starts
  UNION ALL
  SELECT e.next_url, w.start_no, w.hop + 1, list_append(w.trail, e.next_url)
  FROM walk w JOIN edges e ON e.url = w.url
  WHERE w.hop < 29 AND e.next_url IS NOT NULL AND NOT list_contains(w.trail, e.next_url)),
visits AS (
  SELECT url, CAST(row_number() OVER (ORDER BY hop, start_no) AS INTEGER) AS visit_no, CAST(hop AS INTEGER) AS hop
  FROM (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY url ORDER BY hop, start_no) = 1)
  QUALIFY visit_no <= 30)"""


@query(f"WITH RECURSIVE {PARTS}, {LINK}, {WALK} SELECT url, visit_no, hop FROM visits")
def next_page_walk(spark, sf_dir):
    """R1 X11"""
    pages = render.link_pages(spark, sf_dir)
    links = materialise(next_links(page_nodes(pages, "url"), DEFAULT_TEMPLATE.pagination, ["url"]), "links")
    return follow_links(walk_starts(pages, links), links, 30)


@query(
    f"""
WITH RECURSIVE {PARTS}, {LINK},
starts AS (SELECT url, k AS start_no FROM edges WHERE url NOT IN (SELECT next_url FROM edges WHERE next_url IS NOT NULL)),
walk AS (
  SELECT url, start_no, 0 AS hop, [url] AS trail FROM starts
  UNION ALL
  SELECT e.next_url, w.start_no, w.hop + 1, list_append(w.trail, e.next_url)
  FROM walk w JOIN edges e ON e.url = w.url
  WHERE e.next_url IS NOT NULL AND NOT list_contains(w.trail, e.next_url)),
visits AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY url ORDER BY hop, start_no) = 1)
SELECT url, row_number() OVER (ORDER BY hop, start_no) AS visit_no, CAST(hop AS INTEGER) AS hop FROM visits"""
)
def chain_walk(spark, sf_dir):
    """R1 X11 over all chains, without a cap"""
    pages = render.link_pages(spark, sf_dir)
    links = materialise(next_links(page_nodes(pages, "url"), DEFAULT_TEMPLATE.pagination, ["url"]), "links")
    return follow_links(walk_starts(pages, links), links)


@query(
    f"""
WITH {SLOTS}, {POD}
SELECT 'exact' AS rule, count(*) AS n_rows FROM (SELECT DISTINCT title, brand, price_text, url FROM pods)
UNION ALL SELECT 'listing', count(*) FROM (SELECT DISTINCT title, url FROM pods)
UNION ALL SELECT 'products', count(*) FROM (SELECT DISTINCT title FROM pods)"""
)
def catalogue_dedup(spark, sf_dir):
    """G1 G2 G3 O1"""
    from gondola.functions.text import row_key
    from gondola.operators.stats import union_all

    listing = materialise(pods(spark, sf_dir), "pods")
    keyed = listing.withColumn("hash_id", row_key("title", F.lit("")))
    counted = lambda rule, df: df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(rule).alias("rule"), "n_rows")
    return union_all(
        [
            counted("exact", drop_exact(listing.select("title", "brand", "price_text", "url"))),
            counted("listing", dedup_listing(listing, ["page_id", "item_no"])),
            counted("products", dedup_products(keyed, ["page_id", "item_no"])),
        ]
    )


@query(
    f"""
WITH {SLOTS}, {POD}, once AS (SELECT DISTINCT title, url, brand FROM pods),
named AS (SELECT CASE WHEN brand <> 'Brand#7' THEN brand ELSE 'Sin marca' END AS brand FROM once)
SELECT brand, count(*) AS products FROM named GROUP BY brand ORDER BY products DESC, brand LIMIT 10"""
)
def top_brands(spark, sf_dir):
    """One brand counts as missing"""
    once = dedup_listing(pods(spark, sf_dir), ["page_id", "item_no"])
    return top_values(once.select(F.nullif("brand", F.lit("Brand#7")).alias("brand")), "brand")


@query(
    f"""
WITH {SLOTS}, {POD}
SELECT count(price) AS count, round(avg(price), 6) AS mean, round(stddev_samp(price), 6) AS std, min(price) AS min,
       round(quantile_cont(price, 0.25), 6) AS p25, round(quantile_cont(price, 0.5), 6) AS p50,
       round(quantile_cont(price, 0.75), 6) AS p75, max(price) AS max
FROM pods""",
    name="price_summary",
)
def price_statistics(spark, sf_dir):
    """G6 G8"""
    listing = materialise(pods(spark, sf_dir), "pods")
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "std", "p25", "p50", "p75")]
    return price_summary(listing).select("count", "min", "max", *rounded)


@query(
    """
SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
       min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.75), 6) AS p75,
       max(l_extendedprice) AS max
FROM lineitem"""
)
def lineitem_prices(spark, sf_dir):
    """G6 over many distinct values"""
    items = render.read(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").cast("double").alias("price"))
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "std")] + [F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")]
    return price_summary(items).select("count", "min", "max", *rounded)


@query(
    f"""
WITH {SLOTS}, {POD}
SELECT count(*) AS n_rows, CAST(9 AS BIGINT) AS n_columns, count(DISTINCT brand) AS n_categories, count(price) > 0 AS has_values FROM pods"""
)
def table_shape(spark, sf_dir):
    """G8 G9"""
    listing = materialise(pods(spark, sf_dir), "pods")
    return shape(listing, "brand").withColumn("has_values", has_values(listing, "price").scalar())


@query(f"WITH {SLOTS}, {POD} SELECT page AS page_id, origin, count(*) AS n_rows FROM pods GROUP BY ALL")
def rows_by_page(spark, sf_dir):
    """G10 F12"""
    return rows_by(pods(spark, sf_dir), "page_id", "origin")
