"""Exact duplicates by progressive refinement, in DataFrame functions alone.

Texts are equal when they are identical after deleting white space ([\\x20\\x09-\\x0D]). Rows are
told apart by what costs least: the length and a hash of the beginning, taken in one pass; only rows
that share both with another row have their full content compared, by its hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.session import materialise

WHITE_CHARS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def without_white(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for c in WHITE_CHARS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64, digest_all: bool = False
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    Of equal texts the one with the most code points before deletion stays, then the one with the
    smallest id. ``digest`` is the SHA-256 of the text without white space, for rows whose full content
    was compared, or for all with ``digest_all``.

    Null texts count as empty. A null id sorts before the others of equal length. Rows that repeat an id all come
    out; of equal texts one row stays and no other, even if its id is theirs too (of rows equal in id and length, the one
    written first).
    Other columns are neither read nor returned, so their names don't matter. An empty table gives none.

    The first pass leaves only (length, hash) behind, counted with partial sums. The second reads
    contents; it joins on those two, never on ids, and a join splits hot keys.
    """
    bare = without_white(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("points"), bare.alias("bare")
    )
    sized = rows.select(F.length("bare").alias("size"), F.xxhash64(F.substring("bare", 1, prefix)).alias("beginning"))
    starts = materialise(sized.groupBy("size", "beginning").agg(F.count("*").alias("n")), "starts")
    doubtful = starts.filter("n > 1").select("size", "beginning", F.lit(True).alias("doubtful"))
    read = (
        rows.withColumn("size", F.length("bare"))
        .withColumn("beginning", F.xxhash64(F.substring("bare", 1, prefix)))
        .join(doubtful, ["size", "beginning"], "left")
    )
    wanted = F.lit(True) if digest_all else F.col("doubtful")
    digested = materialise(
        read.select(
            "doc_id",
            "points",
            F.coalesce("doubtful", F.lit(False)).alias("doubtful"),
            F.when(wanted, F.sha2("bare", 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    groups = (
        digested.filter("doubtful")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.min(F.struct(-F.col("points"), "doc_id", "row")).alias("best"))
        .select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), F.lit(True).alias("found"))
    )
    groups = materialise(groups, "groups")  # so that the join below may split a hot group
    keep = F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return digested.join(groups, "digest", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        "digest",
    )
