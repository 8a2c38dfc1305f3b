"""Sources, sinks, session helpers."""

import pytest
from pyspark.sql import functions as F

from gondola.plans.category_crawl import describe_listing
from gondola.schemas import DETAIL_PRICE_SCHEMA, LISTING_SCHEMA, PRODUCT_ORDER
from gondola.session import fresh_dir, materialise, shared_dir
from gondola.sources.pages import read_corpus, read_saved_folder, read_saved_page, saved_discards, spread
from gondola.sources.tables import export_products, read_csv, write_if_any

ROW = ("ñandú, \"x\"\nline", "", None, "S/ 1", 1.5, "https://h/p", "c", None, "DOM")


def test_saved_pages(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    files = {"b.html": "<b>1\n2</b>", "sub/a.HTM": "a", "c.txt": "no", "d.html": "", "e.htmlx": "no", "sub/f.htm.bak": "no"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "bad.html").write_bytes(b"<p>\xff ok</p>")
    rows = read_saved_folder(spark, str(tmp_path)).orderBy("path").collect()
    assert [(r.file_name, r.html) for r in rows][0] == ("b.html", "<b>1\n2</b>")
    assert [r.file_name for r in rows] == ["b.html", "bad.html", "a.HTM"] and "ok" in rows[1].html
    assert rows[1].html == "<p> ok</p>"  # as if the byte were not there
    assert [(r.file_name, r.reason) for r in saved_discards(spark, str(tmp_path)).collect()] == [("bad.html", "bad_bytes")]
    assert [r.html for r in read_saved_page(spark, str(tmp_path / "b.html")).collect()] == ["<b>1\n2</b>"]
    assert read_saved_page(spark, str(tmp_path / "d.html")).count() == 0


def test_a_file_that_cannot_be_read_is_reported(spark, tmp_path):
    spark.createDataFrame([("<b>1</b>",)], "value string").coalesce(1).write.text(str(tmp_path / "w"))
    part = next((tmp_path / "w").glob("part-*"))
    crc = part.with_name(f".{part.name}.crc").read_bytes()
    (tmp_path / "in").mkdir()
    (tmp_path / "in/bad.html").write_text("<b>other</b>")
    (tmp_path / "in/.bad.html.crc").write_bytes(crc)  # a checksum that is not the file's
    (tmp_path / "in/good.html").write_text("<b>\u00f1</b>")
    folder = str(tmp_path / "in")
    assert [(r.file_name, r.html) for r in read_saved_folder(spark, folder).collect()] == [("good.html", "<b>\u00f1</b>")]
    assert [(r.file_name, r.reason) for r in saved_discards(spark, folder).collect()] == [("bad.html", "unreadable")]


def test_corpus(spark, tmp_path):
    rows = [(1, "a", 200), (2, "b", 404), (3, "c", None)]
    spark.createDataFrame(rows, "page_id int, html string, status int").coalesce(1).write.parquet(str(tmp_path / "c"))
    pages = read_corpus(spark, str(tmp_path / "c"))
    assert [r.page_id for r in pages.collect()] == [1]
    assert pages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 32)
    assert spread(many) is many


@pytest.mark.parametrize("form", ["csv", "json", "parquet"])
def test_round_trips(spark, tmp_path, form):
    df = spark.createDataFrame([ROW], LISTING_SCHEMA)
    path = str(tmp_path / form)
    assert write_if_any(df, path, form)
    reader = {"csv": lambda: read_csv(spark, path, LISTING_SCHEMA)}.get(form, lambda: spark.read.schema(LISTING_SCHEMA).format(form).load(path))
    # a blank text is missing in CSV
    want = tuple(None if v == "" and form == "csv" else v for v in ROW)
    assert [tuple(r) for r in reader().collect()] == [want]
    assert not write_if_any(df.limit(0), path + "-none", form)


def test_missing_result(spark, tmp_path):
    assert read_csv(spark, str(tmp_path / "none"), LISTING_SCHEMA).count() == 0


def test_export(spark, tmp_path):
    df = spark.createDataFrame([ROW], LISTING_SCHEMA)
    export_products(df, df.limit(0), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["products.csv", "products.parquet"]
    text = "".join(p.read_text() for p in (tmp_path / "out/products.csv").glob("*.csv"))
    assert text.startswith("title,brand") and "ñandú" in text


def test_written_tables(spark):
    df = spark.range(3).withColumn("a", F.array("id"))
    again = materialise(df, "x")
    assert sorted(again.collect()) == sorted(df.collect()) and again.schema.names == df.schema.names
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
    assert fresh_dir(spark, "x").startswith(shared_dir(spark))


def test_cluster_needs_a_shared_folder():
    class Fake:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master = "yarn"

            class getConf:  # noqa: N801
                get = staticmethod(lambda *_: None)

    with pytest.raises(RuntimeError):
        shared_dir(Fake())


def test_describe(spark):
    got = describe_listing(spark.createDataFrame([ROW, ROW], LISTING_SCHEMA))
    assert got["price_summary"].first()["p50"] == 1.5 and got["top_brands"].first().products == 2
    assert len(PRODUCT_ORDER) == 14 and DETAIL_PRICE_SCHEMA.names[0] == "source"
