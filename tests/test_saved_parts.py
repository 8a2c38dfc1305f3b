"""One saved file in parts: the nodes and the listing of the whole."""

import pytest
from pyspark.sql import functions as F

from gondola.operators.listings import pod_listing, pod_part_listing
from gondola.operators.nodes import element_rows, ends_outside, page_nodes
from gondola.sources import pages as P

POD = '<a data-pod="x" data-key="1" href="/{0}">t{0}</a><div><b class="pod-title">brand {0}</b></div>'
DOC = "<!DOCTYPE html><html><body><div><div class='pod-details'>" + POD + "</div></div></body></html>\n"
ROOT = '<p><a class="pod-link" href="/root{0}">r</a></p>'  # climbs to the whole page
DEEP = '<i><i><i><a class="pod-link" href="/deep{0}">r</a></i></i></i>'  # four steps below it
TITLE = "<b class='pod-subTitle'>Title {0}</b><b class='prices'>S/ {0}</b>"

FILES = {
    "plain": "".join(DOC.format(i) for i in range(60)),
    "no end": DOC.format(1) + "<p>rest",
    "open comment": DOC.format(1) + "<!-- " + DOC.format(2) + "--> " + "".join(DOC.format(i) for i in range(3, 9)),
    "never closed": DOC.format(1) + "<script>" + "".join(DOC.format(i) for i in range(9)),
    "inside": "<table>" + "".join(DOC.format(i) for i in range(7)) + "</table>" + "".join(DOC.format(i) for i in range(7, 12)),
    "attribute": "<a title='</html>" + DOC.format(1) + "'>x</a>" + DOC.format(2),
    "end in an attribute at last": DOC.format(1) + "<a href='</html>",
    "cut end": DOC.format(1) + "<p>x</htm",
    "roots": ROOT.format(0) + "</html>" + DOC.format(1) + DEEP.format(2) + "</html>" + TITLE.format(3) + "</html>" + TITLE.format(4) + "</html>" + ROOT.format(5),
    "roots without marks": "".join(f(i) + "</html>" for i, f in enumerate([ROOT.format, DEEP.format, TITLE.format, ROOT.format, DEEP.format, POD.format])),
    "text across": "a</html>b &am</html>p; <![foo[x</html>" + DOC.format(1),
}


def whole(spark, path):
    """The file as one row."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.lit("f").alias("file_name"), P.valid_text(F.col("content").cast("string")).alias("html"))


def listed(rows):
    return sorted(map(str, rows.drop("file_name").collect()))


@pytest.mark.parametrize("name", FILES)
def test_parts_give_the_listing_of_the_whole_file(spark, tmp_path, name):
    at = tmp_path / "f.html"
    at.write_text(FILES[name])
    parts = P.read_saved_page(spark, str(at), part_bytes=1)
    got = parts.orderBy("part_no").collect()
    assert "".join(r.html for r in got) == FILES[name] and len({r.part_no for r in got}) == len(got)
    one = page_nodes(whole(spark, str(at)), "file_name")
    many = page_nodes(parts, "file_name", "part_no")
    node = ["tag", "classes", F.col("attrs").cast("string"), "text", "depth"]
    flat = lambda rows, *order: [tuple(r)[len(order):] for r in element_rows(rows).orderBy(*order, "pre").select(*order, *node).collect()]
    assert [n for n in flat(many, "part_no") if n[0] != "#document"] == flat(one)[1:]
    assert listed(pod_part_listing(many, ["file_name"], F.lit("https://h"))) == listed(pod_listing(one, ["file_name"], F.lit("https://h")))
    assert len(P.read_saved_page(spark, str(at)).collect()) == 1
    if name in ("plain", "roots"):
        assert len(got) >= 5


def test_a_large_file_is_read_by_blocks(spark, tmp_path):
    """No task holds the file: it is read by blocks, and every row is a part of it."""
    at = tmp_path / "f.html"
    at.write_bytes(b"\xef\xbb\xbf" + "".join(DOC.format(f"{i} ñ" * (1 + i % 50)) for i in range(2000)).encode() + b"\xff</html>")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30007")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        parts = P.read_saved_page(spark, str(at), part_bytes=5000)
        rows = parts.orderBy("part_no").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "".join(r.html for r in rows) == at.read_bytes()[3:].decode("utf-8", "ignore")  # but for the byte order mark
    assert len(rows) > 100 and max(len(r.html) for r in rows) < 12000
    one = pod_listing(page_nodes(whole(spark, str(at)), "file_name"), ["file_name"], F.lit("https://h"))
    assert listed(pod_part_listing(page_nodes(parts, "file_name", "part_no"), ["file_name"], F.lit("https://h"))) == listed(one)


def test_ends_outside():
    assert ends_outside("<html><p>x</html>") and ends_outside("<html><script>a</script></html>") and ends_outside("</html>")
    assert not any(map(ends_outside, ["<p></html>", "<!-- </html>", "<html><script></html>", "<a href='</html>", "x", "<b></b>x"]))
