"""Saved HTML files, page corpora, fetch logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gondola.functions.text import last_segment
from gondola.operators.nodes import PART, PART_SCHEMA, outside_again, parts_of
from gondola.session import materialise

HTML_GLOB = "*.[hH][tT][mM]*"
HTTP_OK = 200
TASKS_IN_ONE = 32
#: Files larger than this are read in parts, where they hold several documents
PART_BYTES = 1 << 20
PART_END = "</html>"


def spread(pages: DataFrame) -> DataFrame:
    """Give a freshly scanned corpus at least one partition per core.

    Parsing is heavy for its input size, so a few small files would leave cores idle. A large
    corpus has more splits than cores and passes unchanged, without a shuffle.
    """
    cores = pages.sparkSession.sparkContext.defaultParallelism
    # a bare scan has no exchange, so asking for its partitions runs nothing
    return pages.repartition(cores) if pages.rdd.getNumPartitions() < cores else pages


def fewer_tasks(files: DataFrame) -> DataFrame:
    """Many small files in fewer tasks, without a shuffle.

    Spark counts each file as some megabytes and so gives a task a few dozen, which take less time than to start it. Of more
    tasks than four a core, up to ``TASKS_IN_ONE`` become one. Rows are read one after another, whatever a task's share.
    """
    n = files.rdd.getNumPartitions()
    fewer = max(4 * files.sparkSession.sparkContext.defaultParallelism, -(-n // TASKS_IN_ONE))
    return files.coalesce(fewer) if fewer < n else files


def good_pages(pages: DataFrame) -> DataFrame:
    """S3: pages answered with HTTP OK; a table without ``status`` holds only those."""
    return pages.filter(F.col("status") == HTTP_OK) if "status" in pages.columns else pages


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """S3: a table of fetched pages."""
    return spread(good_pages(spark.read.parquet(path)))


def read_saved_page(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """One saved file, as ``path, part_no, html, file_name``; no row if it is empty. A file that cannot be read is an error.

    A file has one row, unless it is larger than ``part_bytes`` and holds several documents: then it has a row for each part,
    in the order of ``part_no``. Parts end behind an ``</html>`` with which, by the rules of E1, every element is closed, so
    the nodes of the file are those of its parts, one after another. What has no such end inside stays one row, whatever its size.

    Spark deals the file out by blocks and reads each up to such an end tag. A tag that proves to be in a comment, a script
    or an open element is no end: its part is joined with the parts behind it, twice as many each round.
    """
    files = spark.read.option("lineSep", PART_END).text(path)
    place = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    pieces = files.select(*place, valid_text(F.col("value")).alias("html"), F.octet_length("value").alias("n_bytes"))
    parts = materialise(pieces.mapInArrow(parts_of(PART_END, part_bytes), PART_SCHEMA), "parts")
    size = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    total, last = parts.agg(F.sum("n_bytes"), F.max("part_no")).first()
    if total is None:
        return _named(parts)
    reach = 1
    while not parts.filter((F.col("part_no") < last) & ~F.col("outside")).isEmpty():
        parts, last = joined_parts(parts, last, reach)
        reach *= 2
    if total > size:  # the last piece has no end tag of its own
        html = F.when(F.col("part_no") == last, F.substr("html", F.lit(1), F.length("html") - len(PART_END)))
        parts = parts.withColumn("html", F.coalesce(html, "html")).filter("html <> ''")
    return _named(parts)


def joined_parts(parts: DataFrame, last: int, reach: int) -> tuple[DataFrame, int]:
    """Every part that does not end outside of all elements, joined with the next ``reach`` parts; and the new last part."""
    order = Window.orderBy("part_no")  # sees a row for each part, without its text
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    flags = parts.select("part_no", F.when(~F.col("outside"), F.row_number().over(order) + reach).alias("to"), F.row_number().over(order).alias("n"))
    begins = F.coalesce(F.max("to").over(before) < F.col("n"), F.lit(True))
    groups = flags.select("part_no", F.when(begins, F.col("part_no")).alias("begin"))
    groups = materialise(groups.select("part_no", F.max("begin").over(order).alias("first")), "part-groups")
    several = groups.groupBy("first").agg(F.count("*").alias("n")).filter("n > 1").select("first")
    # no text but that of joined parts is shuffled
    moved = parts.join(F.broadcast(groups.join(several, "first")), "part_no")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("part_no", "html"))), lambda p: p["html"])
    joined = moved.groupBy("path", F.col("first").alias("part_no")).agg(
        F.array_join(texts, "").alias("html"), F.sum("n_bytes").alias("n_bytes"), F.lit(False).alias("outside")
    )
    kept = parts.join(F.broadcast(moved.select("part_no")), "part_no", "left_anti").select(*PART)
    again = materialise(kept.unionByName(joined.select(*PART).mapInArrow(outside_again, PART_SCHEMA)), "parts")
    return again, groups.agg(F.max("first")).first()[0]


def _named(parts: DataFrame) -> DataFrame:
    return parts.select("path", "part_no", "html", last_segment("path").alias("file_name"))


def read_saved_folder(spark: SparkSession, path: str) -> DataFrame:
    """All ``.html`` and ``.htm`` files below a folder, as ``path, html, file_name``. They have no base URL.

    Sort by ``path`` where order matters. Empty files give no row. One that cannot be read gives none either but is told
    by ``saved_discards``, and the others are read on.
    """
    return _texts(_saved_files(spark, path))


def saved_discards(spark: SparkSession, path: str) -> DataFrame:
    """``path, file_name, reason`` of the ``.html`` and ``.htm`` files that are ``unreadable``, and of those that
    were read but for their ``bad_bytes``. Empty files have nothing to lose and are not listed.

    The folder is listed without opening files; what reading them does not return could not be read.
    """
    files = _saved_files(spark, path)  # listed once
    listed = fewer_tasks(files.select(_path()))
    read = fewer_tasks(files.select(_path(), F.is_valid_utf8(F.col("content").cast("string")).alias("valid")))
    reason = F.when(F.col("valid").isNull(), "unreadable").otherwise("bad_bytes").alias("reason")
    lost = listed.join(read, "path", "left").filter("valid IS NULL OR NOT valid")
    return lost.select("path", last_segment("path").alias("file_name"), reason)


def _path() -> Column:
    return F.col("_metadata.file_path").alias("path")


def _saved_files(spark: SparkSession, path: str) -> DataFrame:
    options = {"recursiveFileLookup": True, "pathGlobFilter": HTML_GLOB, "ignoreCorruptFiles": True}
    files = spark.read.format("binaryFile").options(**options).load(path)
    return files.filter(F.col("_metadata.file_path").rlike(r"(?i)\.html?$"))


def valid_text(raw: Column) -> Column:
    """Text without the bytes that are no UTF-8. (With them go replacement characters of the same text.)"""
    return F.when(F.is_valid_utf8(raw), raw).otherwise(F.replace(F.make_valid_utf8(raw), F.lit("\ufffd"), F.lit("")))


def _texts(files: DataFrame) -> DataFrame:
    html = valid_text(F.col("content").cast("string"))
    rows = fewer_tasks(files.filter(F.octet_length("content") > 0).select(_path(), html.alias("html")))
    return rows.withColumn("file_name", last_segment("path"))


def first_good_fetch(log: DataFrame, max_tries: int = 3) -> DataFrame:
    """Per URL the first HTTP-OK attempt among the allowed tries."""
    good = log.filter((F.col("attempt") <= max_tries) & (F.col("status") == HTTP_OK))
    others = [c for c in log.columns if c != "url"]
    best = good.groupBy("url").agg(F.min_by(F.struct(*others), "attempt").alias("best"))
    return best.select("url", "best.*")
