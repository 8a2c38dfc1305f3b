"""Catalogue pages rendered from ``part`` by Spark, one function per page layout.

The size of every corpus follows the table. Each listing page shows ten parts; every fiftieth
part is also shown on the next page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.session import fresh_dir
from gondola.sources.pages import spread

SHOP = "https://shop.example.com"
PER_PAGE = 10
PAGES_PER_CATEGORY = 5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fmt(pattern: str, *columns: str | Column) -> Column:
    """Each ``~`` in the pattern stands for the next column."""
    pieces = pattern.split("~")
    out = [F.lit(pieces[0])]
    for c, piece in zip(columns, pieces[1:], strict=True):
        out += [(F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(piece)]
    return F.concat(*out)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    # rendering makes much of little, so even a small table is spread over the cores
    part = spread(read(spark, sf_dir, "part"))
    return part.select(
        k.alias("k"),
        fmt("~~ ~ kg", "p_name", F.when(k % 9 == 0, " & cia").otherwise(""), "p_size").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("kind"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
        F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("price_text"),
    )


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = F.floor(F.col("k") / PER_PAGE)
    here = F.struct(home.alias("page"), F.lit(0).alias("dup"))
    again = F.struct((home + 1).alias("page"), F.lit(1).alias("dup"))
    spots = F.when(F.col("k") % 50 == 0, F.array(here, again)).otherwise(F.array(here))
    return parts(spark, sf_dir).withColumn("spot", F.explode(spots)).select("*", "spot.*").drop("spot")


def html_text(c: str) -> Column:
    return F.replace(F.col(c), F.lit("&"), F.lit("&amp;"))


def pages_of(items: DataFrame, card: Column, head: Column | str, tail: str, between: str = "") -> DataFrame:
    """Ten cards (eleven with a repeated part) to a page; ``head`` may use ``page``."""
    cards = items.select("page", "dup", "k", card.alias("card"))
    # parsing is what costs: keep as many partitions as the session asks for, however small the cards
    spark = items.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    cards = cards.repartition(n, "page")
    pages = cards.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("dup", "k", "card"))).alias("cards"))
    body = F.array_join(F.transform("cards", lambda c: c["card"]), between)
    return pages.select(
        F.col("page").alias("page_id"),
        fmt(SHOP + "/list/~", "page").alias("url"),
        F.floor(F.col("page") / PAGES_PER_CATEGORY).alias("category"),
        (F.col("page") % PAGES_PER_CATEGORY + 1).alias("page_no"),
        F.concat(F.lit(head) if isinstance(head, str) else head, body, F.lit(tail)).alias("html"),
    )


# pages begin with a declaration that the tokenizer refuses
HEAD = "<!DOCTYPE html><html><head><title>Lista</title><![foo[x]]><style>.price{x:1}</style></head><body><!-- <a class='pod-link'> -->"
TAIL = "</body></html>"


def pod_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    link = F.when(k % 4 == 0, fmt(SHOP + "/p/~", "k")).otherwise(fmt("/p/~", "k"))
    anchor = fmt('<a data-pod="x" data-key="~" href="~"><b class="pod-title"> ~\n</b></a>', "k", link, "brand")
    anchor = F.when(k % 6 == 1, fmt("<i><u>~</u></i>", anchor)).otherwise(anchor)
    price = F.when(
        k % 7 == 0, fmt('<div class="prices"><span>S/</span><span>~</span></div>', "price_text")
    ).otherwise(fmt('<ol><li data-internet-price="~">S/ ~</li></ol>', "price_text", "price_text"))
    card = fmt(
        '<div class="grid"><div class="wrap">~<div class="pod-details x"><b id="testId-pod-displaySubTitle-~">~</b>'
        '<span class="pod-subtitle-unit">~ kg</span>~</div></div></div>',
        anchor, "k", html_text("name"), "size", price,
    )
    return pages_of(placed(spark, sf_dir), card, HEAD, TAIL)


def json_text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    brand = F.when(k % 13 == 0, "").otherwise(fmt('"brand":"~",', "brand"))
    price = F.when(k % 3 == 0, fmt('"price" : [ ~ ]', "price_text")).otherwise(fmt('"price":["~"]', "price_text"))
    filler = F.when(F.col("page") % 5 == 4, F.repeat(F.lit("-"), F.lit(2500))).otherwise("")
    card = fmt('{"displayName" : "~",~"url":"/p/~",~,"f":"~"}', "name", brand, "k", price, filler)
    return pages_of(placed(spark, sf_dir), card, "<html><body><script>var s=[", "]</script></body></html>", ",")


def mixed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third page has JSON text instead of pods; the others have both."""
    pods = pod_pages(spark, sf_dir).withColumnRenamed("html", "pod_html")
    texts = json_text_pages(spark, sf_dir).select("page_id", F.col("html").alias("json_html"))
    html = F.when(F.col("page_id") % 3 == 0, F.col("json_html")).otherwise(F.concat("pod_html", "json_html"))
    return pods.join(texts, "page_id").withColumn("html", html).drop("pod_html", "json_html")


def summary_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, page = F.col("k"), F.col("page")
    crumbs = F.when(
        page % 4 != 0, fmt('<nav class="x breadcrumb"><a href="/">Inicio</a> <a href="/c">Cat~</a></nav>', "page")
    ).otherwise("")
    title = (
        F.when(k % 17 == 0, "")
        .when(k % 2 == 0, fmt('<a title=" ~ " href="/p/~"><img src="a.png"></a>', html_text("name"), "k"))
        .otherwise(fmt('<h3><a href="d/~?x=1">~</a></h3>', "k", html_text("name")))
    )
    price = F.when(k % 5 == 0, fmt('<span class="a-sellingPrice-b">S/ ~</span>', "price_text")).otherwise(
        fmt('<div class="price">S/ ~ <s> c/u</s></div>', "price_text")
    )
    brand = F.when(k % 3 == 0, fmt("<i data-brand='z'>~</i>", "brand")).otherwise(fmt('<p class="brand">~</p>', "brand"))
    card = fmt('<div class="product-card" data-brand="no">~~~</div>', title, price, brand)
    return pages_of(placed(spark, sf_dir), card, F.concat(F.lit(HEAD), crumbs), TAIL)


def jsonld_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd pages hold a list of products, even pages an ItemList; each has a broken script too."""
    k, page = F.col("k"), F.col("page")
    brand = F.when(k % 2 == 0, fmt('"~"', "brand")).otherwise(fmt('{"@type":"Brand","name":"~"}', "brand"))
    price = F.when(k % 3 == 0, F.col("price").cast("string")).otherwise(fmt('"S/ ~"', "price_text"))
    offers = (
        F.when(k % 5 == 0, "")
        .when(k % 5 == 1, fmt(',"offers":[{"price":~}]', price))
        .otherwise(fmt(',"offers":{"price":~}', price))
    )
    product = fmt('{"@type":"Product","name":" ~ ","url":"/p/~","brand":~~}', "name", "k", brand, offers)
    card = F.when(page % 2 == 0, fmt('{"@type":"ListItem","item":~}', product)).otherwise(product)
    open_list = F.when(page % 2 == 0, '{"@type":"ItemList","itemListElement":[').otherwise('[{"@type":"WebPage"},')
    script = '<script type="application/ld+json">'
    head = F.concat(F.lit(HEAD + script + '{"@type":"Product",</script>' + script), open_list)
    pages = pages_of(placed(spark, sf_dir), card, head, "", ",")
    close = F.when(F.col("page_id") % 2 == 0, "]}").otherwise("]")
    return pages.withColumn("html", F.concat("html", close, F.lit("</script>" + TAIL)))


def loose_jsonld_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each part, with one script: in turn strict JSON, a repeated name and price, a price that is no number,
    and no JSON at all.
    """
    k = F.col("k")
    script = (
        F.when(k % 4 == 0, fmt('{"@type":"Product","name":"~","offers":{"price":"~"}}', "name", "price_text"))
        .when(k % 4 == 1, fmt('{"@type":"Thing","name":"old","@type":"Product","name":"~","offers":{"price":1,"price":"~"}}', "name", "price_text"))
        .when(k % 4 == 2, fmt('[{"@type":"Product","name":"~","offers":{"price":NaN}}]', "name"))
        .otherwise(fmt('{"@type":"Product" "name":"~"}', "name"))
    )
    html = F.concat(F.lit(HEAD + '<script type="application/ld+json">'), script, F.lit("</script>" + TAIL))
    return parts(spark, sf_dir).select(k.alias("page_id"), detail_url().alias("url"), html.alias("html"))


def detail_url(k: str = "k") -> Column:
    return fmt(SHOP + "/prod-~/p", k)


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per part; by key mod 4: no JSON-LD, an object, a list, an object without price."""
    k = F.col("k")
    regular = (F.col("price") * 1.25).cast("decimal(10,2)").cast("string")
    price = F.when(k % 37 == 5, '"consultar"').otherwise(fmt('"~"', "price_text"))
    script = '<script type="application/ld+json">~</script>'
    jsonld = (
        F.when(k % 4 == 0, "<script type='application/ld+json'>{oops</script>")
        .when(
            k % 4 == 1,
            fmt(script, fmt('{"@type":"Product","name":"~","sku":"S~","brand":{"name":"~"},"offers":{"price":~,"listPrice":~}}', "name", "k", "brand", price, regular)),
        )
        .when(
            k % 4 == 2,
            fmt(script, fmt('[{"@type":"BreadcrumbList"},{"@type":"Product","headline":"~","mpn":"M~","brand":"~","offers":[{"price":~,"listPrice":0},{"price":1}]}]', "name", "k", "brand", "price_text")),
        )
        .otherwise(fmt(script, fmt('{"@type":"Product","name":"~","offers":{"priceSpecification":{}}}', "name")))
    )
    spans = fmt(
        '<span class="vtex-product-price currencyInteger">~</span><span class="x-currencyFraction">~</span>',
        F.substring_index("price_text", ".", 1), F.substring_index("price_text", ".", -1),
    )
    heading = F.when((k % 4 == 0) & (k % 19 == 0), "").otherwise(fmt("<h1>~</h1>", html_text("name")))
    sku = F.when(k % 8 == 0, fmt('<div data-product-sku="D~"></div>', "k")).otherwise(fmt('<meta name="sku" content="C~">', "k"))
    crumbs = F.when(k % 10 == 3, "").otherwise(fmt('<ul class="breadcrumbs"><li><a>Inicio</a><li><a>~</a><li><a> </a></ul>', "kind"))
    images = F.repeat(F.lit("<img src=x>"), (k % 4).cast("int"))
    stock = F.when(k % 11 == 0, "<b>AGOTADO</b>").otherwise("")
    html = F.concat(F.lit("<html><![foo[x]]><body>"), jsonld, heading, fmt('<p class="brand">~</p>', "brand"), sku, spans, crumbs, images, stock, F.lit(TAIL))
    return parts(spark, sf_dir).select(k.alias("page_id"), detail_url().alias("url"), html.alias("html"))


def rendered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages in the exact-class layout; some without store price, some with odd fractions."""
    k = F.col("k")
    integer = F.substring_index("price_text", ".", 1)
    cents = F.substring_index("price_text", ".", -1)
    cents = F.when(k % 6 == 0, "5").when(k % 6 == 1, F.concat(cents, F.lit("9"))).otherwise(cents)
    span = '<span class="x vtex-product-price-1-x-currency~--PDP~Price">~</span>'
    store = F.when(k % 5 == 0, "").otherwise(
        F.concat(fmt(span, F.lit("Integer"), F.lit("List"), F.lit("1,099")), fmt(span, F.lit("Fraction"), F.lit("List"), F.lit("90")))
    )
    name = F.when(k % 23 == 0, "").otherwise(
        fmt('<span class="vtex-store-components-3-x-productBrand vtex">~ <b>~</b></span>', "brand", html_text("name"))
    )
    html = F.concat(
        F.lit(HEAD), name, fmt(span, F.lit("Integer"), F.lit(""), integer), fmt(span, F.lit("Fraction"), F.lit(""), cents), store, F.lit(TAIL)
    )
    return parts(spark, sf_dir).select(k.alias("page_id"), detail_url().alias("url"), html.alias("html"))


def category_card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five pages per category; the third page of every other category is empty."""
    k, page = F.col("k"), F.col("page")
    link = F.when(k % 12 == 0, "").when(k % 12 == 1, fmt('<a href="/gone-~/p">x</a>', "k")).otherwise(fmt('<a href="/prod-~/p">x</a>', "k"))
    sku = F.when(k % 2 == 0, fmt(' data-sku="K~"', "k")).otherwise("")
    brand = F.when(k % 5 == 0, "").otherwise(fmt('<em class="brand">~</em>', "brand"))
    card = fmt('<div class="product"~><h3>~</h3>~<i class="price">S/ ~</i>~</div>', sku, html_text("name"), link, "price_text", brand)
    empty = (F.floor(page / PAGES_PER_CATEGORY) % 2 == 1) & (page % PAGES_PER_CATEGORY == 2)
    return pages_of(placed(spark, sf_dir), F.when(empty, "").otherwise(card), HEAD, TAIL)


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of up to 700 pages. Every third begins with a loop; in each one a link is relative
    and stays so, which ends the walk there.
    """
    k = F.col("k")
    back = fmt('<div class="pagination-next"><a href="/page/~">back</a></div>', k - 1)
    onward = (
        F.when(k % 2 == 0, fmt('<a class="next" href="/page/~">next</a>', k + 1))
        .when(k % 700 == 361, fmt('<a class="next" href="~">next</a>', k + 1))
        .otherwise(fmt('<a aria-label="Siguiente" href="' + SHOP + '/page/~">next</a>', k + 1))
    )
    link = F.when(k % 2100 == 2, back).when(k % 700 == 699, '<a class="next">end</a>').otherwise(onward)
    item = fmt('<div class="resultado"><a href="/p/~">~</a><b class="salary">S/ ~</b></div>', "k", html_text("name"), "price_text")
    html = F.concat(F.lit(HEAD + '<a href="/home">home</a>'), item, link, F.lit(TAIL))
    return parts(spark, sf_dir).select(k.alias("page_id"), fmt(SHOP + "/page/~", "k").alias("url"), html.alias("html"))


def sitemap_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sitemap indexes ``(host, body)`` and sitemaps ``(sitemap_url, body)``.

    A sitemap holds 50 parts; an index holds 5 sitemaps. Every fourth sitemap is not for
    products, every eleventh is malformed, and every seventh index is broken.
    """
    k = F.col("k")
    loc = (
        F.when(k % 5 == 4, fmt("<url><loc>~/col-~</loc></url>", F.lit(SHOP), "k"))
        .when(k % 25 == 12, fmt("<url><loc>~/10000~/pan</loc></url>", F.lit(SHOP), "k"))
        .when(k % 10 == 0, fmt("<url><loc>\n ~/prod-~/p </loc></url><url><loc> </loc></url><url><loc>~/prod-~/p</loc></url>", F.lit(SHOP), "k", F.lit(SHOP), "k"))
        .otherwise(fmt("<url><loc>~/prod-~/p</loc></url>", F.lit(SHOP), "k"))
    )
    maps = parts(spark, sf_dir).select(F.floor(k / 50).alias("m"), "k", loc.alias("loc"))
    maps = maps.groupBy("m").agg(F.array_sort(F.collect_list(F.struct("k", "loc"))).alias("locs"))
    m = F.col("m")
    kind = F.when(m % 4 == 3, "other").otherwise("product")
    body = F.concat(
        F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
        F.array_join(F.transform("locs", lambda x: x["loc"]), ""),
        F.when(m % 11 == 2, "<url>").otherwise("</urlset>"),
    )
    host = fmt("h~.example.com", F.floor(m / 5))
    sitemaps = maps.select("m", host.alias("host"), fmt("https://~/sitemap/~-~.xml", host, kind, "m").alias("sitemap_url"), body.alias("body"))
    entries = sitemaps.select("m", "host", fmt("<sitemap><loc> ~ </loc></sitemap>", "sitemap_url").alias("entry"))
    entries = entries.groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("m", "entry"))).alias("entries"), F.min(F.floor(F.col("m") / 5)).alias("h")
    )
    index = entries.select(
        "host",
        F.concat(
            F.lit('<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
            F.array_join(F.transform("entries", lambda x: x["entry"]), ""),
            F.when(F.col("h") % 7 == 6, "").otherwise("</sitemapindex>"),
        ).alias("body"),
    )
    return index, sitemaps.select("sitemap_url", "body")


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and its class of paths."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_files(files: DataFrame, path: str) -> None:
    """Each row's ``body`` as a file of its own, ``name`` below ``path``. Tasks write them, so the driver handles none; ``path``
    is a folder that executors share, in a store that Arrow knows.
    """

    def write(batches):
        from urllib.parse import urlsplit

        import pyarrow as pa
        from pyarrow import fs

        local = urlsplit(path).scheme in ("", "file")
        if local:
            store, top = fs.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:")
        else:
            store, top = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
        made = set()
        for batch in batches:
            for name, body in zip(batch.column("name").to_pylist(), batch.column("body").to_pylist(), strict=True):
                at = f"{top}/{name}"
                folder = at.rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(at) as out:
                    out.write(body)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    files.select("name", F.col("body").cast("binary").alias("body")).mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()


def saved_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a file for each pod page: ``.html``, every fourth ``.HTM`` in a folder of its own, every ninth with a name
    that is no page's and an empty page beside it. Every fifth begins with bytes that are no UTF-8.
    """
    page = F.col("page_id")
    folder = F.when(page % 4 == 0, "old").otherwise("new")
    name = fmt("~/p~~", folder, "page_id", F.when(page % 9 == 4, ".htmlx").when(page % 4 == 0, ".HTM").otherwise(".html"))
    body = F.when(page % 5 == 2, F.concat(F.unhex(F.lit("FFFE")), F.encode("html", "UTF-8"))).otherwise(F.encode("html", "UTF-8"))
    file = F.struct(name.alias("name"), body.alias("body"))
    empty = F.struct(fmt("new/e~.html", "page_id").alias("name"), F.lit(b"").alias("body"))
    files = F.when(page % 9 == 4, F.array(file, empty)).otherwise(F.array(file))
    path = fresh_dir(spark, "saved")
    write_files(pod_pages(spark, sf_dir).select(F.inline(files)), path)
    return path


def saved_file(spark: SparkSession, sf_dir: str) -> str:
    """One file with all pod pages, one after another."""
    path = fresh_dir(spark, "saved-file")
    pod_pages(spark, sf_dir).repartition(1).sortWithinPartitions("page_id").select("html").write.text(path)
    fs, at = _hadoop(spark, path)
    return fs.globStatus(at(f"{path}/part-*"))[0].getPath().toString()
