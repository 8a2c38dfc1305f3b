"""Folders of many small files: nothing is done file by file on the driver, and tasks are few."""

import pathlib

from gondola.sources import pages as P
from tests.conftest import SF_SMALL
from workload import render


def test_tasks_write_the_folder(spark, monkeypatch):
    def on_the_driver(*_):
        raise AssertionError("a file handled on the driver")

    monkeypatch.setattr(render, "_hadoop", on_the_driver)
    top = pathlib.Path(render.saved_folder(spark, SF_SMALL))
    found = {str(f.relative_to(top)): f.read_bytes() for f in top.rglob("*.*")}
    want = {}
    for r in render.pod_pages(spark, SF_SMALL).collect():
        n, body = r.page_id, r.html.encode()
        ending = "htmlx" if n % 9 == 4 else "HTM" if n % 4 == 0 else "html"
        want[f"{'old' if n % 4 == 0 else 'new'}/p{n}.{ending}"] = b"\xff\xfe" + body if n % 5 == 2 else body
        if n % 9 == 4:
            want[f"new/e{n}.html"] = b""
    assert found == want


def test_many_files_are_read_in_few_tasks(spark, tmp_path):
    for i in range(90):
        (tmp_path / f"{i}.html").write_bytes(b"<p>%d</p>" % i if i % 3 else b"\xff")
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a file a task
    try:
        rows = P.read_saved_folder(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
        assert sorted(r.html for r in rows.collect() if r.html) == sorted(f"<p>{i}</p>" for i in range(90) if i % 3)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)


def test_discards_list_the_folder_once(spark, tmp_path, monkeypatch):
    (tmp_path / "a.html").write_bytes(b"\xff")
    (tmp_path / "b.html").write_text("b")
    listed = []
    files = P._saved_files
    monkeypatch.setattr(P, "_saved_files", lambda *a: listed.append(a) or files(*a))
    assert [r.file_name for r in P.saved_discards(spark, str(tmp_path)).collect()] == ["a.html"] and len(listed) == 1
