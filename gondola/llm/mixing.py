"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions alone.

The words of a source are dealt to shards, laid end to end in a seeded order of documents and cut into
blocks of equally many words. The blocks of the mix go to the sources by highest quotients target / (2k - 1), those
of a source to its shards by highest quotients blocks / (2k - 1). A shard takes each of its blocks as often as its
quota goes into them; the rest of the quota are blocks at equal distances, counted from a seeded one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.ranks import ranked
from gondola.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating; and how often a word may be taken
WEIGHTS = 3
MOST = 3


def number(digest: Column, first: int) -> Column:
    """Eight digits of a hexadecimal digest as a number."""
    return F.conv(F.substring(digest, first, 8), 16, 10).cast("long")


def apportioned(parties: DataFrame, houses: DataFrame, name: str) -> DataFrame:
    """house, party, quota: seats by highest quotients.

    ``parties`` has house, party, weight (above 0) and most, ``houses`` house and n_seats. A house gives its seats
    to the largest weight / (2k - 1), k = 1, 2 ...; of equal ones the smaller party comes first. No party gets more
    than its ``most``.

    Rounding every fair share misses the number of seats by half a seat a party at most. Only the quotients between
    that rounding and one of larger (or smaller) shares that covers the miss are ranked, each house apart from the others.
    """
    weights = parties.groupBy("house").agg(F.sum("weight").alias("weights"), F.count("*").alias("n_parties"))
    weights = materialise(weights.join(houses, "house"), f"{name}-houses")
    rounded = lambda share: F.least(F.greatest(F.lit(0), F.floor(share + 0.5)), F.col("most"))
    share = F.col("n_seats") / F.col("weights") * F.col("weight")
    near = materialise(parties.join(weights, "house").withColumn("near", rounded(share)), f"{name}-near")
    given = near.groupBy("house", "n_seats", "n_parties").agg(F.sum("near").alias("given"))
    missing = given.select("house", (F.col("n_seats") - F.col("given")).alias("missing")).filter("missing <> 0")
    missing = materialise(missing, f"{name}-missing")
    open_ = near.join(missing, "house")
    reach = 1
    while True:
        shift = F.signum("missing") * reach * (F.col("n_parties") + 1) / 2.0
        far = open_.withColumn("far", rounded((F.col("n_seats") + shift) / F.col("weights") * F.col("weight")))
        covered = far.groupBy("house", "missing").agg(
            F.sum(F.abs(F.col("far") - F.col("near"))).alias("found"),
            F.min((F.col("far") == F.col("most")) | (F.col("missing") < 0) & (F.col("far") == 0)).alias("all"),
        )
        if covered.filter("found < abs(missing) AND NOT all").isEmpty():
            break
        reach *= 2
    seat = F.explode(F.sequence(F.least("near", "far") + 1, F.greatest("near", "far"))).alias("seat")
    sign = -F.signum("missing")  # best quotients first where seats are missing, worst first where they are too many
    seats = far.filter("far <> near").select("house", "party", "weight", "missing", seat)
    seats = seats.select(
        "house", "party", "missing", (sign * (F.col("weight") / (2 * F.col("seat") - 1))).alias("turn"), (-sign * F.col("party")).alias("tie")
    )
    seats = ranked(seats, ["house", "turn", "tie"], f"{name}-seats")
    first = seats.groupBy("house").agg(F.min("rank").alias("first"))
    moved = seats.join(materialise(first, f"{name}-first"), "house").filter(F.col("rank") - F.col("first") < F.abs("missing"))
    moved = moved.groupBy("house", "party").agg(F.sum(F.signum("missing")).cast("long").alias("moved"))
    quota = (F.col("near") + F.coalesce("moved", F.lit(0))).alias("quota")
    return materialise(near.join(moved, ["house", "party"], "left").select("house", "party", quota), f"{name}-quotas")


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (rank, source_size) with ``target``.

    Weights 1, 2, 3, repeating, share the sum of all sizes; a target stops at MOST times its source's size and the excess
    goes to the others by weight. Each step stops all sources above, of which only two sums are read, until none is.
    """
    weighted = sources.withColumn("weight", F.col("rank") % WEIGHTS + 1)
    most = F.lit(float(MOST)) * F.col("source_size")
    whole = weighted.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    level, stopped = (whole.size or 0) / (whole.weight or 1), 0
    while True:
        full = weighted.filter(most / F.col("weight") < F.lit(level))
        held = full.agg(F.count("*").alias("n"), F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
        if held.n <= stopped:
            return weighted.withColumn("target", F.least(most, F.lit(level) * F.col("weight")))
        stopped = held.n
        level = (whole.size - MOST * held.size) / (whole.weight - held.weight)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = 32,
    shard_words: int = 1 << 18,
    shard_docs: int = 1 << 16,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, spans.

    ``size`` is the number of words [^\\x20\\x09-\\x0D]+ (null text: 0). Sources are ordered by code point, null last.
    ``spans`` are the parts of the document in the mix: first word (from 0), words, and times (1 to 3); ``taken`` is
    the sum of their words, repeats counted. The mix has as many words as all documents, but for a block.

    A shard's last block has up to one and a half times ``block_words``, or is all of a shard that has fewer, so a
    source's words miss its target by a block a shard at most, and shards have some ``shard_words``. The result
    depends on ids, texts and ``seed`` alone, not on partitions. Rows that repeat id and text are documents of their own
    that may change places. A null id is a value like others. Documents without words have no
    spans; a source without words has the target 0. Other columns are not read. An empty table gives no rows.

    Documents move without their text, hot sources in many shards, none of which grows with the table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("-"), F.col(source_col)), F.lit("=")).alias("source_key"),  # null is last
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), name, F.md5(text))).alias("order_key"),
    )
    rows = materialise(rows, "sized")
    sources = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = targets(ranked(sources, ["source_key"], "sources"))
    n_shards = F.ceil(F.greatest(F.col("source_size") / shard_words, F.col("n_docs") / shard_docs, F.lit(1.0)))
    sources = sources.select("source_key", F.col("rank").alias("house"), "source_size", "target", n_shards.alias("n_shards"))
    sources = materialise(sources, "targets")
    shard = (number(F.col("order_key"), 1) % F.col("n_shards")).alias("shard")
    placed = rows.join(sources.select("source_key", "house", "n_shards"), "source_key").select("house", shard, "doc_id", "size", "order_key")
    words = placed.groupBy("house", "shard").agg(F.sum("size").alias("words")).filter("words > 0")
    shards = materialise(words.withColumn("n_blocks", F.greatest(F.lit(1), F.floor(F.col("words") / block_words + 0.5))), "shards")

    seats = shards.groupBy("house").agg((MOST * F.sum("n_blocks")).alias("most"))
    parties = sources.join(seats, "house").select(F.lit(0).alias("house"), F.col("house").alias("party"), F.col("target").alias("weight"), "most")
    whole = sources.agg(F.floor(F.sum("source_size") / block_words + 0.5).alias("n_seats")).select(F.lit(0).alias("house"), "n_seats")
    blocks = apportioned(parties, whole, "of-sources").select(F.col("party").alias("house"), F.col("quota").alias("n_seats"))
    parties = shards.select("house", F.col("shard").alias("party"), F.col("n_blocks").alias("weight"), (MOST * F.col("n_blocks")).alias("most"))
    quotas = apportioned(parties, blocks, "of-shards").withColumnRenamed("party", "shard")
    quotas = materialise(shards.join(quotas, ["house", "shard"]), "quotas")

    along = Window.partitionBy("house", "shard").orderBy("order_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = placed.withColumn("start", F.coalesce(F.sum("size").over(along), F.lit(0)))
    laid = laid.join(quotas, ["house", "shard"], "left")
    begun = F.md5(F.concat_ws(":", F.lit(seed), F.col("house").cast("string"), F.col("shard").cast("string")))
    laid = laid.withColumn("first", number(begun, 1) % F.col("n_blocks")).withColumn("rest", F.col("quota") % F.col("n_blocks"))
    end = F.col("start") + F.col("size")
    block_at = lambda word: F.least(F.floor(word / block_words), F.col("n_blocks") - 1)

    def span(j: Column) -> Column:
        from_word = F.greatest(F.col("start"), j * block_words)
        until = F.least(end, F.when(j == F.col("n_blocks") - 1, F.col("words")).otherwise((j + 1) * block_words))
        again = F.pmod((j + F.col("first")) * F.col("rest"), F.col("n_blocks")) >= F.col("n_blocks") - F.col("rest")
        times = F.floor(F.col("quota") / F.col("n_blocks")) + again.cast("long")
        return F.struct((from_word - F.col("start")).alias("first_word"), (until - from_word).alias("n_words"), times.alias("times"))

    spans = F.transform(F.sequence(block_at(F.col("start")), block_at(end - 1)), span)
    spans = F.filter(spans, lambda s: s["times"] > 0)
    spans = F.when(F.col("size") > 0, spans).otherwise(F.slice(spans, 1, 0))
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["n_words"] * s["times"])
    found = laid.withColumn("spans", F.coalesce(spans, F.array().cast("array<struct<first_word:bigint,n_words:bigint,times:bigint>>")))
    return found.join(sources.select("house", "source_size", "target"), "house").select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), "spans"
    )
