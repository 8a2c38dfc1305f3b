"""Link walks: no table of them goes through the driver."""

from gondola.operators import walk
from tests.helpers import plan
from workload.catalogue_queries import walk_starts


def test_walk_tables_are_not_broadcast(spark, monkeypatch):
    plans = []
    write = walk.materialise

    def spy(df, name):
        plans.append(plan(df))
        return write(df, name)

    monkeypatch.setattr(walk, "materialise", spy)
    links = spark.createDataFrame([(f"u{i}", f"u{i + 1}") for i in range(20)], "url string, next_url string")
    pages = spark.createDataFrame([(f"u{i}", i) for i in range(20)], "url string, page_id int")
    starts = walk_starts(pages, links)
    assert [r.hop for r in walk.follow_links(starts, links).orderBy("visit_no").collect()] == list(range(21))
    joins = [p for p in [*plans, plan(starts)] if "Join" in p]
    assert len(joins) > 8 and not any("Broadcast" in p for p in joins)
