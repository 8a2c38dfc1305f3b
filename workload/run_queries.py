"""Whole runs: crawls, sitemap discovery, audits, top-up, and result tables in and out."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.functions.urls import is_product_sitemap, url_slug
from gondola.operators.nodes import page_nodes
from gondola.operators.paging import first_rows, topped_up
from gondola.operators.robots import host_policies, robots_rules
from gondola.operators.template import DEFAULT_TEMPLATE, next_links
from gondola.plans.category_crawl import category_crawl as crawl_categories
from gondola.plans.rendered_details import discovered_urls as all_discovered
from gondola.plans.rendered_details import rendered_details as details_of_sample
from gondola.plans.sitemap_products import (
    audit,
    category_products,
    discover,
    final_products,
    visit,
)
from gondola.plans.sitemap_run import sitemap_run as run_sitemaps
from gondola.plans.template_crawl import template_crawl as crawl_by_template
from gondola.plans.template_crawl import template_pages
from gondola.schemas import LISTING_SCHEMA
from gondola.session import fresh_dir, materialise
from gondola.sources.pages import HTTP_OK, good_pages
from gondola.sources.sitemaps import index_locations
from gondola.sources.tables import export_products, read_csv, write_if_any
from workload import render
from workload.catalogue_queries import (
    CARD,
    DETAIL,
    EXACT,
    JSONLD,
    LINK,
    LISTING,
    POD,
    PRODUCT_COLUMNS,
    SUMMARY,
    SUMMARY_COLUMNS,
    WALK,
    as_of,
    pods,
    walk_starts,
)
from workload.registry import PARTS, SLOTS, query
from workload.render import SHOP


def crawl_pages(spark, sf_dir):
    """Every third category has JSON-LD pages. In every fourth one page 1 is empty, in every second page 4."""
    cards = render.summary_pages(spark, sf_dir).withColumnRenamed("html", "cards")
    lists = render.jsonld_list_pages(spark, sf_dir).select("page_id", F.col("html").alias("lists"))
    c, n = F.col("category"), F.col("page_no")
    empty = ((c % 4 == 1) & (n == 1)) | ((c % 2 == 1) & (n == 4))
    html = F.when(empty, "<html></html>").when(c % 3 == 2, F.col("lists")).otherwise(F.col("cards"))
    return cards.join(lists, "page_id").select(c.alias("category_id"), "page_no", "url", html.alias("html"))


@query(
    f"""
WITH {SLOTS}, {SUMMARY}, {JSONLD},
shown AS (
  SELECT page, item_no, {SUMMARY_COLUMNS} FROM summaries WHERE page // 5 % 3 <> 2
  UNION ALL
  SELECT page, item_no, {SUMMARY_COLUMNS} FROM listed WHERE page // 5 % 3 = 2)
SELECT {SUMMARY_COLUMNS} FROM shown
WHERE NOT (page // 5 % 4 = 1 AND page % 5 = 0) AND NOT (page // 5 % 2 = 1 AND page % 5 >= 3)
QUALIFY row_number() OVER (PARTITION BY title, url ORDER BY page, item_no) = 1"""
)
def category_crawl(spark, sf_dir):
    """Listing pages to a clean table: X3 X5 J6 W1 W2 F10 G2"""
    return crawl_categories(crawl_pages(spark, sf_dir), 8)


# what the sitemaps of index h list, with the place of each part
SITEMAPS = """
listed AS (
  SELECT k, k // 50 AS m, k // 50 // 5 AS h, 'h' || (k // 50 // 5) || '.example.com' AS host, CAST(k // 50 % 5 AS INTEGER) AS sitemap_no,
         CASE WHEN k % 5 = 4 THEN 'https://shop.example.com/col-' || k
              WHEN k % 25 = 12 THEN 'https://shop.example.com/10000' || k || '/pan'
              ELSE 'https://shop.example.com/prod-' || k || '/p' END AS url
  FROM parts),
reached AS (SELECT * FROM listed WHERE m % 11 <> 2 AND h % 7 <> 6)"""


@query(
    f"""
WITH {PARTS}, {SITEMAPS}
SELECT DISTINCT host, sitemap_no, 'https://' || host || '/sitemap/' || CASE WHEN m % 4 = 3 THEN 'other' ELSE 'product' END || '-' || m || '.xml' AS sitemap_url,
       m % 4 <> 3 AS for_products
FROM listed WHERE h % 7 <> 6 AND sitemap_no < 4
UNION ALL SELECT DISTINCT host, 0, 'https://' || host || '/sitemap.xml', false FROM listed WHERE h % 7 = 6
UNION ALL SELECT DISTINCT host, 1, 'https://' || host || '/arquivos/colecciones-wong-sitemap.xml', false FROM listed WHERE h % 7 = 6"""
)
def sitemap_index(spark, sf_dir):
    """S5 F5 O3 L2"""
    index, _ = render.sitemap_files(spark, sf_dir)
    return index_locations(index, limit=4).withColumn("for_products", is_product_sitemap("sitemap_url"))


@query(
    f"""
WITH {PARTS}, {SITEMAPS}
SELECT host, sitemap_no, url FROM reached WHERE sitemap_no < 4 AND k % 5 <> 4 ORDER BY host, sitemap_no, k LIMIT 700"""
)
def sitemap_urls(spark, sf_dir):
    """S5 S6 F1 F4 G5 L2"""
    found = discover(*render.sitemap_files(spark, sf_dir), max_sitemaps=4, max_urls=700)
    return found.products.select("ord.host", "ord.sitemap_no", "url")


@query(f"WITH {PARTS}, {SITEMAPS} SELECT host, sitemap_no, url, 'col-' || k AS slug FROM reached WHERE k % 5 = 4")
def sitemap_collections(spark, sf_dir):
    """F4 T7"""
    found = discover(*render.sitemap_files(spark, sf_dir), max_urls=None)
    return found.collections.select("ord.host", "ord.sitemap_no", "url", url_slug("url").alias("slug"))


@query(f"WITH {PARTS}, {SITEMAPS} SELECT DISTINCT url FROM reached WHERE k % 5 <> 4 AND m % 4 <> 3")
def discovered_urls(spark, sf_dir):
    """S5 S6 S12 F2 F5 G5"""
    path = fresh_dir(spark, "discovered")
    write_if_any(all_discovered(*render.sitemap_files(spark, sf_dir)), path, "parquet")
    return spark.read.parquet(path)


def corpus(spark, sf_dir):
    """Detail pages that were fetched well (S3); one in thirteen was not found."""
    status = F.when(F.col("page_id") % 13 == 4, 404).otherwise(HTTP_OK)
    pages = render.detail_pages(spark, sf_dir).withColumn("status", status)
    return good_pages(pages).select("url", "html")


def policies(spark, rule):
    """One robots file, for the shop."""
    files = spark.createDataFrame([("shop.example.com", f"User-agent: *\nDisallow: {rule}\n")], "host string, body string")
    return host_policies(robots_rules(files), "Mozilla/5.0")


AUDIT = (
    DETAIL
    + f""", {SITEMAPS},
visits AS (
  SELECT r.k, r.host, r.sitemap_no, r.url,
         CASE WHEN r.k % 25 = 12 THEN 'no_es_producto' WHEN r.k % 13 = 4 THEN 'sin_nombre_o_detalle'
              WHEN d.bad_price THEN 'bad_price' WHEN d.name IS NULL THEN 'sin_nombre_o_detalle' END AS reason,
         d.* EXCLUDE (k, url)
  FROM reached r JOIN details d USING (k)
  WHERE r.k % 5 <> 4 AND (r.k % 25 = 12 OR NOT starts_with('/prod-' || r.k || '/p', '/prod-7')))"""
)


def visited(spark, sf_dir):
    found = discover(*render.sitemap_files(spark, sf_dir), max_urls=None)
    return materialise(visit(found.products, corpus(spark, sf_dir), policies(spark, "/prod-7")), "visited")


@query(
    f"""
WITH {PARTS}, {AUDIT}
SELECT name, price_online, price_regular, brand, 'sitemap_producto' AS category, coalesce(subcategory, 'Sin subcategoria') AS subcategory,
       sku, CASE WHEN price_regular > price_online THEN round((price_regular - price_online) / price_regular * 100, 2) ELSE 0.0 END AS discount_percent,
       size || ' kg' AS presentation, url, '2024-05-06' AS extracted_on, md5(name || '|' || sku) AS hash_id, images_count, availability
FROM visits WHERE reason IS NULL"""
)
def sitemap_products(spark, sf_dir):
    """Sitemaps to products: S5 S6 J2 J3 X8 F8 F11 F13 F14 G3"""
    products, _ = audit(visited(spark, sf_dir), as_of=as_of())
    return final_products(products, ["ord"]).drop("ord")


@query(
    f"""
WITH {PARTS}, {AUDIT},
stop AS (SELECT host, sitemap_no, k FROM visits WHERE reason IS NULL ORDER BY host, sitemap_no, k LIMIT 1 OFFSET 99)
SELECT v.url, v.reason FROM visits v LEFT JOIN stop s ON true
WHERE v.reason IS NOT NULL AND (s.k IS NULL OR (v.host, v.sitemap_no, v.k) < (s.host, s.sitemap_no, s.k))"""
)
def audit_split(spark, sf_dir):
    """Rows discarded until the hundredth product"""
    _, discards = audit(visited(spark, sf_dir), target=100, as_of=as_of())
    return discards.select("url", "reason")


@query(
    f"""
WITH {PARTS}, {AUDIT}
SELECT reason, count(*) AS n_rows FROM (SELECT coalesce(reason, 'product') AS reason FROM visits) GROUP BY reason"""
)
def audit_export(spark, sf_dir):
    """Products and discards written side by side, counted from the files"""
    path = fresh_dir(spark, "export")
    products, discards = audit(visited(spark, sf_dir), as_of=as_of())
    export_products(products.drop("ord"), discards.drop("ord"), path)
    kept = spark.read.parquet(f"{path}/products.parquet").select(F.lit("product").alias("reason"))
    schema = "url string, reason string, detail string"
    dropped = read_csv(spark, f"{path}/discards.csv", schema).select("reason")
    return kept.unionByName(dropped).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


# a category ends at its first barred or empty page; at most 30 products of each are taken
BARRED = "starts_with('/list/' || ((category * 5) + page_no - 1), '/list/13')"
TAKEN = (
    CARD
    + f""",
open_pages AS (SELECT * FROM full_products WHERE category % 2 = 0 OR page_no < 3),
ends AS (
  SELECT category, min(CAST(page_no AS INTEGER)) AS stop FROM (SELECT DISTINCT category, page_no FROM cards) WHERE {BARRED} GROUP BY category),
taken AS (
  SELECT p.* FROM open_pages p LEFT JOIN ends e USING (category) WHERE e.stop IS NULL OR p.page_no < e.stop
  QUALIFY row_number() OVER (PARTITION BY category ORDER BY page_no, item_no) <= 30)"""
)


@query(f"WITH {SLOTS}, {TAKEN} SELECT {PRODUCT_COLUMNS}, page_no, item_no FROM taken")
def category_cards(spark, sf_dir):
    """Category listings to products: U4 E17 F6 W1 W3 X10 J1"""
    pages, corpus = render.category_card_pages(spark, sf_dir), render.detail_pages(spark, sf_dir)
    return category_products(pages, corpus, F.lit(SHOP), policies(spark, "/list/13"), 30, as_of())


@query(
    f"""
WITH {SLOTS}, {CARD},
sizes AS (SELECT category, count(*) AS n FROM cards GROUP BY category),
totals AS (SELECT category, 7 + coalesce(sum(n) OVER (ORDER BY category ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sizes)
SELECT name, url, 'sitemap' AS phase FROM (SELECT name, 'https://shop.example.com/prod-' || k || '/p' AS url FROM parts ORDER BY k LIMIT 7)
UNION ALL
SELECT c.name, c.url, NULL AS phase FROM cards c JOIN totals t USING (category) WHERE t.before < 60"""
)
def top_up(spark, sf_dir):
    """O2 O1: seven products, topped up by whole categories while fewer than 60 are there"""
    from gondola.operators.cards import cards
    from workload.catalogue_queries import shop_cards

    first = first_rows(render.parts(spark, sf_dir), ["k"], 7)
    first = first.select("name", render.detail_url().alias("url"), F.lit("sitemap").alias("phase"))
    rows = cards(shop_cards(spark, sf_dir), ["category", "page_no"], F.lit(SHOP))
    collections = materialise(rows.select("name", "url", F.col("category").alias("collection")), "collections")
    return topped_up(first, collections, "collection", 60)


RUN_COLUMNS = PRODUCT_COLUMNS + ", images_count, availability"


@query(
    f"""
WITH {SLOTS}, {CARD}{AUDIT.removeprefix(DETAIL)},
first_phase AS (
  SELECT 0 AS turn, host, sitemap_no, k AS col, 0 AS page_no, 0 AS item_no, name, price_online, price_regular, brand,
         'sitemap_producto' AS category, coalesce(subcategory, 'Sin subcategoria') AS subcategory, sku, size || ' kg' AS presentation, url,
         images_count, availability
  FROM visits WHERE reason IS NULL ORDER BY host, sitemap_no, k LIMIT 1500),
shelf AS (
  SELECT 1 AS turn, r.host, r.sitemap_no, r.k AS col, CAST(c.page_no AS INTEGER) AS page_no, c.item_no, c.name, c.price AS price_online,
         coalesce(d.price_regular, 0.0) AS price_regular, coalesce(d.brand, c.card_brand, 'Wong') AS brand, 'col-' || r.k AS category,
         coalesce(d.subcategory, 'Sin subcategoria') AS subcategory,
         coalesce(d.sku, c.card_sku,
           'WONG_' || upper(substr(regexp_replace(c.name, '[^A-Za-z0-9_]+', '', 'g'), 1, 10)) || '_' ||
           (CAST('0x' || substr(md5(c.url), 1, 7) AS INTEGER) % 9000 + 1000)) AS sku,
         c.size || ' kg' AS presentation, c.url, CAST(NULL AS INTEGER) AS images_count, CAST(NULL AS VARCHAR) AS availability
  FROM cards c JOIN reached r ON r.k = c.category * 50 + 4
  LEFT JOIN (SELECT * FROM details WHERE NOT bad_price AND k % 13 <> 4 AND NOT starts_with('/prod-' || k || '/p', '/prod-7')) d
    ON c.k % 12 > 1 AND c.k = d.k
  WHERE c.category % 2 = 0 OR c.page_no < 3),
sizes AS (SELECT host, sitemap_no, col, count(*) AS n FROM shelf GROUP BY ALL),
totals AS (
  SELECT col, (SELECT count(*) FROM first_phase)
         + coalesce(sum(n) OVER (ORDER BY host, sitemap_no, col ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes),
run AS (
  SELECT *, md5(name || '|' || sku) AS hash_id, '2024-05-06' AS extracted_on,
         CASE WHEN price_regular > price_online THEN round((price_regular - price_online) / price_regular * 100, 2) ELSE 0.0 END AS discount_percent
  FROM (SELECT * FROM first_phase UNION ALL SELECT shelf.* FROM shelf JOIN totals USING (col) WHERE before < 1500))
SELECT {RUN_COLUMNS} FROM run
QUALIFY row_number() OVER (PARTITION BY hash_id ORDER BY turn, host, sitemap_no, col, page_no, item_no) = 1"""
)
def sitemap_run(spark, sf_dir):
    """The whole sitemap run, topped up from collections to 1,500: S5 S6 F4 T7 J2 F8 L1 X10 W1 O2 F11 G3 S8 S10 S11"""
    pages = render.category_card_pages(spark, sf_dir)
    pages = pages.withColumn("category", F.concat(F.lit("col-"), (F.col("category") * 50 + 4).cast("string")))
    path = fresh_dir(spark, "run")
    products, _ = run_sitemaps(
        *render.sitemap_files(spark, sf_dir), corpus(spark, sf_dir), pages, F.lit(SHOP), 1500, policies(spark, "/prod-7"), as_of=as_of(), path=path
    )
    return spark.read.schema(products.schema).parquet(f"{path}/products.parquet").select(*RUN_COLUMNS.split(", "))


@query(
    f"""
WITH {PARTS}, {EXACT}, {SITEMAPS},
sample AS (SELECT DISTINCT r.k, r.url FROM reached r WHERE k % 5 <> 4 AND m % 4 <> 3 AND k % 25 <> 12 ORDER BY md5('s2' || r.url) LIMIT 50)
SELECT e.* EXCLUDE (k) FROM exact e JOIN sample USING (k)"""
)
def rendered_details(spark, sf_dir):
    """Sitemaps to price records: S5 S6 F2 F5 L1 L3 J3 X9 G4"""
    urls = all_discovered(*render.sitemap_files(spark, sf_dir))
    return details_of_sample(urls, render.rendered_pages(spark, sf_dir).drop("page_id"), "shop", "s2", 50, as_of())


@query(
    f"""
WITH RECURSIVE {PARTS}, {LINK}, {WALK}
SELECT DISTINCT CAST(NULL AS VARCHAR) AS titulo, 'S/ ' || price_text AS precio, 'https://shop.example.com/p/' || parts.k AS detalle_url,
       CAST(NULL AS VARCHAR) AS categoria, CAST(NULL AS VARCHAR) AS tienda_o_empresa, price AS precio_num
FROM visits JOIN edges USING (url) JOIN parts USING (k)"""
)
def template_crawl(spark, sf_dir):
    """Pages reached by next links to template records: R1 X11 X1 G1 N1"""
    pages = render.link_pages(spark, sf_dir)
    links = next_links(page_nodes(pages, "url"), DEFAULT_TEMPLATE.pagination, ["url"])
    return crawl_by_template(pages.drop("page_id"), walk_starts(pages, links), DEFAULT_TEMPLATE, 30)


@query(
    f"""
WITH {PARTS}
SELECT DISTINCT CAST(NULL AS VARCHAR) AS titulo, 'S/ ' || price_text AS precio, '/p/' || k AS detalle_url,
       CAST(NULL AS VARCHAR) AS categoria, CAST(NULL AS VARCHAR) AS tienda_o_empresa, price AS precio_num
FROM parts"""
)
def template_saved(spark, sf_dir):
    """Pages to template records, without a base URL: X1 G1 N1"""
    return template_pages(render.link_pages(spark, sf_dir), DEFAULT_TEMPLATE)


ROUND = f"WITH {SLOTS}, {POD} SELECT {LISTING}, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS store FROM pods"


def written(spark, sf_dir, form):
    path = fresh_dir(spark, f"listing-{form}")
    none = F.lit(None).cast("string")
    listing = pods(spark, sf_dir).withColumns({"category": none, "store": none}).select(*LISTING_SCHEMA.names)
    write_if_any(listing, path, form)
    return path


@query(ROUND)
def roundtrip_csv(spark, sf_dir):
    """S7 S8 S13"""
    return read_csv(spark, written(spark, sf_dir, "csv"), LISTING_SCHEMA)


@query(ROUND)
def roundtrip_json(spark, sf_dir):
    """S9 S13"""
    return spark.read.schema(LISTING_SCHEMA).json(written(spark, sf_dir, "json"))


@query(ROUND)
def roundtrip_parquet(spark, sf_dir):
    """S10 S13"""
    return spark.read.schema(LISTING_SCHEMA).parquet(written(spark, sf_dir, "parquet"))


@query(
    f"""
WITH {SLOTS}, {POD} SELECT title, url, price FROM pods ORDER BY title, url, page, item_no LIMIT 10"""
)
def listing_preview(spark, sf_dir):
    """L4 L5"""
    return first_rows(pods(spark, sf_dir), ["title", "url", "page_id", "item_no"], 10).select("title", "url", "price")
