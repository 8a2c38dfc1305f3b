"""Queries over the ``pages`` table as it is."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.functions.text import clean_text
from gondola.functions.urls import (
    append_page,
    listing_pages,
    resolve_url,
    set_page_parameter,
    url_host,
    url_path,
    url_slug,
)
from gondola.operators.dedup import keep_first
from gondola.operators.nodes import element_rows, page_nodes
from gondola.operators.paging import sample_urls
from gondola.operators.records import RECORDS, record_rows, records_of, rows_per_page
from gondola.operators.robots import host_policies, robots_rules, robots_sitemaps, with_allowed
from gondola.operators.select import attr, count_all, find_all, first_href, first_text, page_scope, sel, text
from gondola.operators.stats import rows_by
from gondola.operators.template import Template, extract_template
from gondola.sources.pages import first_good_fetch, read_corpus
from workload.registry import query

# a cut-off title may end in an entity without its semicolon
UNESCAPED = "regexp_replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;?', '&', 'g')"
LINK_PATTERN = '<li><a href="([^"]*)">([^<]*)</a></li>'

# links of a page as (page_id, url, link_no, href, text) in SQL
LINKS = f"""
hits AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '{LINK_PATTERN}', 1)) AS href,
         unnest(regexp_extract_all(html, '{LINK_PATTERN}', 2)) AS text,
         unnest(range(len(regexp_extract_all(html, '{LINK_PATTERN}')))) AS link_no
  FROM pages),
links AS (
  SELECT page_id, url, CAST(link_no AS INTEGER) AS link_no, {UNESCAPED.format("href")} AS href,
         nullif(trim({UNESCAPED.format("text")}), '') AS text
  FROM hits)"""


def corpus(spark, sf_dir):
    return read_corpus(spark, f"{sf_dir}/pages.parquet")


def links(spark, sf_dir):
    nodes = page_nodes(corpus(spark, sf_dir), "page_id", "url")
    anchors = find_all(page_scope(), sel("a", within=sel("li")))
    record = lambda i: F.struct(attr(i, "href").alias("href"), clean_text(text(i)).alias("text"))
    keep = ["page_id", "url"]
    rows = record_rows(nodes.select(*keep, records_of(anchors, record).alias(RECORDS)), keep)
    return rows.withColumnRenamed("item_no", "link_no")


@query(
    f"""
SELECT page_id,
       nullif(trim(regexp_replace({UNESCAPED.format("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")}, '\\s+', ' ', 'g')), '') AS heading,
       regexp_extract(html, 'href="([^"]+)"', 1) AS first_link
FROM pages"""
)
def page_headings(spark, sf_dir):
    """E1 E4 E7 E10 T1"""
    nodes = page_nodes(corpus(spark, sf_dir), "page_id")
    scope = page_scope()
    return nodes.select(
        "page_id",
        clean_text(first_text(scope, [sel("h1"), sel("h2")])).alias("heading"),
        first_href(scope, [sel("a", cls="next"), sel("a")]).alias("first_link"),
    )


@query(
    f"""
WITH {LINKS}
SELECT page_id, link_no, text, href, regexp_extract(url, '^[a-z]+://[^/]+', 0) || href AS target FROM links"""
)
def page_links(spark, sf_dir):
    """E2 E3 E7 U1"""
    found = links(spark, sf_dir)
    return found.select("page_id", "link_no", "text", "href", resolve_url("url", "href").alias("target"))


@query(
    f"""
WITH {LINKS}
SELECT page_id, link_no AS item_no, text AS texto, regexp_extract(url, '^[a-z]+://[^/]+', 0) || href AS detalle_url
FROM links"""
)
def template_records(spark, sf_dir):
    """X1 E8 U2 Y2"""
    template = Template(item=sel("li"), fields={"texto": sel("a"), "detalle_url": sel("a", has="href")})
    nodes = page_nodes(corpus(spark, sf_dir), "page_id", "url")
    return extract_template(nodes, template, ["page_id", "url"], "url").drop("url")


@query(
    """
SELECT page_id,
       CAST(len(regexp_extract_all(html, '<p>')) AS INTEGER) AS n_p,
       CAST(len(regexp_extract_all(html, '<a href')) AS INTEGER) AS n_a,
       CAST(len(regexp_extract_all(html, '<img')) AS INTEGER) AS n_img,
       CAST(len(regexp_extract_all(html, '<li>')) AS INTEGER) AS n_records
FROM pages"""
)
def element_counts(spark, sf_dir):
    """E15 G10"""
    nodes = page_nodes(corpus(spark, sf_dir), "page_id")
    scope = page_scope()
    counted = nodes.select(
        "page_id",
        count_all(scope, sel("p")).alias("n_p"),
        count_all(scope, sel("a")).alias("n_a"),
        count_all(scope, sel("img")).alias("n_img"),
        find_all(scope, sel("li")).alias(RECORDS),
    )
    return rows_per_page(counted, ["page_id", "n_p", "n_a", "n_img"])


@query(
    """
SELECT tag, count(*) AS n_rows
FROM (SELECT unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)[ >]', 1)) AS tag FROM pages)
GROUP BY tag"""
)
def tag_counts(spark, sf_dir):
    """E1 as rows, G10"""
    rows = element_rows(page_nodes(corpus(spark, sf_dir), "page_id"))
    return rows_by(rows.filter(~F.startswith("tag", F.lit("#"))), "tag")


@query(
    f"""
WITH {LINKS}
SELECT text, href, page_id, link_no FROM links
QUALIFY row_number() OVER (PARTITION BY text, href ORDER BY page_id, link_no) = 1"""
)
def link_first_seen(spark, sf_dir):
    """G2 G5"""
    found = links(spark, sf_dir).select("text", "href", "page_id", "link_no")
    return keep_first(found, ["text", "href"], ["page_id", "link_no"])


@query(
    """
WITH split AS (
  SELECT page_id, url, regexp_extract(url, '^[^?#]*', 0) AS head, regexp_extract(url, '\\?([^#]*)', 1) AS query,
         regexp_extract(url, '#.*$', 0) AS fragment, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
         regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path
  FROM pages)
SELECT page_id, host, path,
       list_extract(string_split(trim(path, '/'), '/'), -1) AS slug,
       head || '?' || CASE WHEN query = '' THEN 'page=3' WHEN query LIKE '%page=%' THEN regexp_replace(query, 'page=[^&]*', 'page=3')
                           ELSE query || '&page=3' END || fragment AS page_three,
       url || '?page=2' AS appended,
       'https://' || host || '/x/y' AS moved
FROM split"""
)
def url_paging(spark, sf_dir):
    """U1 U3 U4 U5 T7"""
    return corpus(spark, sf_dir).select(
        "page_id",
        url_host("url").alias("host"),
        url_path("url").alias("path"),
        url_slug("url").alias("slug"),
        set_page_parameter("url", 3).alias("page_three"),
        append_page("url", F.lit(2)).alias("appended"),
        resolve_url(F.concat(F.lit("https://"), url_host("url"), F.lit("/x/z/")), F.lit("../a/.././y")).alias("moved"),
    )


@query(
    """
SELECT page_id, CAST(n AS INTEGER) AS page_no,
       CASE WHEN n = 1 THEN url
            WHEN url LIKE '%page=2%' THEN replace(url, 'page=2', 'page=' || n)
            WHEN url LIKE '%?%' THEN url || '&page=' || n
            ELSE regexp_extract(url, '^[^#]*', 0) || '?page=' || n || regexp_extract(url, '#.*$', 0) END AS page_url
FROM pages, range(1, 9) AS r(n)"""
)
def listing_urls(spark, sf_dir):
    """Eight page URLs for each listing"""
    return listing_pages(corpus(spark, sf_dir).select("page_id", "url"), "url", 8).drop("url")


# Robots files by length of the host name mod 4; hosts of kind 3 have none.
ROBOTS = [
    "User-agent: *\nDisallow: /en/7 # half\nDisallow: /fr/\nAllow: /\nSitemap: https://a.example.com/sitemap.xml\n",
    "User-agent: Googlebot\nDisallow: /\n\nUser-Agent: Mozilla\nUser-agent: other\n"
    "Allow: /en/1\nDisallow: /en/\nDisallow:\n\nUser-agent: *\nDisallow: /\n",
    "# blank line ends a group\nUser-agent: mozilla\n\nDisallow: /\nUser-agent: *\nCrawl-delay: 3\nDisallow: /de/%36\nDisallow: /es/?x\n",
]
MOZILLA = "Mozilla/5.0 (X11; Linux x86_64)"


def robots_files(spark, sf_dir):
    hosts = corpus(spark, sf_dir).select(url_host("url").alias("host")).distinct()
    body = F.get(F.array(*map(F.lit, ROBOTS)), F.length("host") % 4)
    return hosts.withColumn("body", body).filter("body is not null")


HOSTS = "hosts AS (SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages)"


@query(
    f"""
WITH {HOSTS},
rules(kind, group_no, agent, rule_no, prefix, allow) AS (VALUES
  (0, 1, '*', 1, '/en/7', false), (0, 1, '*', 2, '/fr/', false), (0, 1, '*', 3, '/', true),
  (1, 1, 'googlebot', 1, '/', false),
  (1, 2, 'mozilla', 5, '/en/1', true), (1, 2, 'mozilla', 6, '/en/', false), (1, 2, 'mozilla', 7, '', true),
  (1, 2, 'other', 5, '/en/1', true), (1, 2, 'other', 6, '/en/', false), (1, 2, 'other', 7, '', true),
  (1, 3, '*', 10, '/', false),
  (2, 2, '*', 5, NULL, false), (2, 2, '*', 6, '/de/6', false), (2, 2, '*', 7, '/es/?x', false))
SELECT host, CAST(group_no AS BIGINT) AS group_no, agent, CAST(rule_no AS INTEGER) AS rule_no, prefix, allow
FROM hosts JOIN rules ON length(host) % 4 = kind"""
)
def robots_table(spark, sf_dir):
    """F7"""
    return robots_rules(robots_files(spark, sf_dir))


@query(f"WITH {HOSTS} SELECT host, 'https://a.example.com/sitemap.xml' AS sitemap_url FROM hosts WHERE length(host) % 4 = 0")
def robots_sitemap_lines(spark, sf_dir):
    """Sitemap lines"""
    return robots_sitemaps(robots_files(spark, sf_dir)).select("host", "sitemap_url")


@query(
    """
WITH paths AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
         regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path
  FROM pages)
SELECT page_id,
       CASE length(host) % 4
         WHEN 0 THEN NOT (path LIKE '/en/7%' OR path LIKE '/fr/%')
         WHEN 1 THEN path LIKE '/en/1%' OR path NOT LIKE '/en/%'
         WHEN 2 THEN path NOT LIKE '/de/6%'
         ELSE true END AS allowed
FROM paths"""
)
def robots_allowed(spark, sf_dir):
    """F6 J2"""
    policies = host_policies(robots_rules(robots_files(spark, sf_dir)), MOZILLA)
    urls = corpus(spark, sf_dir).select("page_id", "url")
    return with_allowed(urls, policies).select("page_id", "allowed")


@query(
    """
SELECT url, CAST(row_number() OVER (ORDER BY md5('s1' || url), url) - 1 AS INTEGER) AS ord
FROM pages QUALIFY ord < 20"""
)
def url_sample(spark, sf_dir):
    """L1 L3: the first 20 URLs in a repeatable pseudo-random order"""
    return sample_urls(corpus(spark, sf_dir).select("url"), 20, "s1")


def fetch_log(spark, sf_dir):
    """Four tries per page; in every fifth round a try succeeds."""
    tries = corpus(spark, sf_dir).withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(4))))
    status = F.when((F.col("page_id") + F.col("attempt") * 2) % 5 == 0, 200).otherwise(503)
    return tries.select("page_id", "url", "attempt", status.alias("status"), "html")


GOOD = """
log AS (
  SELECT page_id, url, CAST(a AS INTEGER) AS attempt, length(html) AS n_chars FROM pages, range(1, 5) AS r(a)
  WHERE (page_id + a * 2) % 5 = 0 AND a <= 3),
good AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY url ORDER BY attempt) = 1)"""


@query(f"WITH {GOOD} SELECT page_id, url, attempt, CAST(200 AS INTEGER) AS status, CAST(n_chars AS INTEGER) AS n_chars FROM good")
def best_fetch(spark, sf_dir):
    """S3 S4"""
    best = first_good_fetch(fetch_log(spark, sf_dir))
    return best.select("page_id", "url", "attempt", "status", F.length("html").alias("n_chars"))


@query(f"WITH {GOOD} SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM good)")
def pending_urls(spark, sf_dir):
    """Discovered URLs still to fetch"""
    found = corpus(spark, sf_dir).select("page_id", "url")
    # only the URL of the log is read
    return found.join(first_good_fetch(fetch_log(spark, sf_dir).drop("html")), "url", "left_anti").select("page_id", "url")


@query(
    """
SELECT doc_id, nullif(trim(regexp_replace(text, '[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+', ' ', 'g')), '') AS clean,
       lower(text) LIKE '%out of stock%' OR lower(text) LIKE '%agotado%' AS out_of_stock,
       regexp_matches(text, '(?i)price|product') AS mentions
FROM documents"""
)
def document_texts(spark, sf_dir):
    """T1 T6 F15 over whole free texts"""
    from gondola.functions.text import matches_any_case
    from gondola.operators.details import is_out_of_stock

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(
        "doc_id",
        clean_text("text").alias("clean"),
        is_out_of_stock("text").alias("out_of_stock"),
        matches_any_case("text", "price|product").alias("mentions"),
    )
