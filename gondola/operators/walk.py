"""Follow next-page links from start pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.operators.dedup import keep_first
from gondola.operators.ranks import numbered
from gondola.session import materialise


def follow_links(starts: DataFrame, links: DataFrame, max_pages: int | None = None) -> DataFrame:
    """The URLs visited breadth-first, as ``(url, visit_no, hop)``: all, or the first ``max_pages``.

    ``starts`` has ``(url, start_no)``, ``links`` has ``(url, next_url)`` with one row per page. A URL is visited
    once, on the fewest hops; of chains that reach it on as many, the one from the first start counts. Rings and pages without
    a link end a chain; a page that is linked but has no row is visited.

    A page has one next page, so the walk doubles its reach each round: all pages visited so far jump as many
    hops as have been made, and the table of jumps is joined with itself. A chain of n pages takes log2(n)
    rounds, and the driver reads only how many pages have been visited. Both tables are written each round: the
    visited ones have one row per URL, and jumps to a page that many others link to can be split. Neither is ever broadcast: the
    written files say less than a tenth of what the URLs take in memory, and each round would pass them through the driver.
    """
    first = keep_first(starts.select("url", "start_no"), ["url"], ["start_no"])
    reached = materialise(first.withColumn("hop", F.lit(0).cast("long")), "reached")
    jumps = materialise(links.filter("next_url is not null").select("url", F.col("next_url").alias("to")), "jumps-0")
    made, n_reached = 1, reached.count()
    while max_pages is None or n_reached < max_pages:
        met = reached.join(jumps.hint("merge"), "url").select(F.col("to").alias("url"), "start_no", (F.col("hop") + made).alias("hop"))
        reached = materialise(keep_first(reached.unionByName(met), ["url"], ["hop", "start_no"]), f"reached-{made}")
        before, n_reached = n_reached, reached.count()
        if n_reached == before:  # no page is that many hops away, so none is farther
            break
        onward = jumps.withColumnsRenamed({"url": "from", "to": "url"}).join(jumps.hint("merge"), "url")
        jumps, made = materialise(onward.select(F.col("from").alias("url"), "to"), f"jumps-{made}"), made * 2
    if max_pages is not None:
        reached = reached.orderBy("hop", "start_no", "url").limit(max_pages)
    kind = "long" if max_pages is None else "int"
    visits = numbered(reached, ["hop", "start_no", "url"], "_no", "visits")
    return visits.select("url", (F.col("_no") + 1).cast(kind).alias("visit_no"), F.col("hop").cast("int").alias("hop"))
