"""Shared by the tests."""

from gondola.operators.nodes import page_nodes


def nodes_of(spark, *htmls, url="https://h.com/c/x"):
    pages = spark.createDataFrame([(i, url, h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    return page_nodes(pages, "page_id", "url")


def values(df, column=None):
    """First (or named) column in page order."""
    rows = df.orderBy("page_id").collect() if "page_id" in df.columns else df.collect()
    return [r[column] if column else r[-1] for r in rows]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
