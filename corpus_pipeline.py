"""A training corpus from ``documents``, stage by stage, each over all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import bagminhash, decontaminate, language, line_dedup, packing
from gondola.llm.queries import fold, table, tokenizer_path
from gondola.session import materialise, shared_dir

#: Keys of rows whose id is null or repeated begin here
OWN_KEYS = 1 << 62


def aside(docs: DataFrame, taken: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """The rows with other names for columns that a stage makes itself, and how to select all columns under their names."""
    others = {c: f"__own_{c}" for c in docs.columns if c in taken}
    return docs.withColumnsRenamed(others), [F.col(others.get(c, c)).alias(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those with a letter. Learns from the documents that are not held out.

    Null and empty texts have no letter and go. If no document has a language to learn from, those with a letter stay all the
    same. Rows that repeat an id or have none are judged each by its text. An empty table gives no rows.
    """
    rows, columns = aside(docs, ("lang_pred", "score"))
    model = language.train(rows, fold(4) != 2)
    if model is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return language.identify(rows, model).filter(F.col("lang_pred") != language.UNKNOWN).select(*columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from all documents but the one with the largest id; n_chars follows the text.

    A document of which nothing but white space is left goes; one that loses no line stays, empty or not. What
    counts as a document where ids are null or repeated says ``line_dedup.line_bitmaps``. An empty table gives no rows.
    """
    rows, columns = aside(docs, ("n_lines", "n_dropped"))
    kept = line_dedup.apply_bitmaps(rows, line_dedup.line_bitmaps(rows))
    kept = kept.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id.

    A row whose id is null, or is that of another row too, is a document of its own by id and text; it stays only if its class
    has no document with an id of its own, and one of those that are equal in both stays. Empty texts are classes of
    their own. An empty table gives no rows.
    """
    names = docs.columns
    again = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 AND doc_id IS NOT NULL")
    again = materialise(again.select(F.col("doc_id").alias("__id"), F.lit(True).alias("__again")), "repeated-ids")
    own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit(OWN_KEYS - 1)).bitwiseOR(F.lit(OWN_KEYS))
    keyed = docs.join(again, F.col("doc_id") == F.col("__id"), "left")
    keyed = keyed.withColumn("__key", F.when(F.col("doc_id").isNull() | F.col("__again").isNotNull(), own).otherwise(F.col("doc_id")))
    keyed = keyed.select(*names, "__key")
    found = bagminhash.near_duplicates(keyed, id_col="__key")
    stay = found.filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("__key")).distinct()
    kept = keyed.join(stay, "__key", "left_semi")
    once = kept.filter(F.col("__key") >= OWN_KEYS).dropDuplicates(["__key"])
    return kept.filter(F.col("__key") < OWN_KEYS).unionByName(once).select(*names)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.

    Null and empty texts hold none and stay, as do all documents if there is no item. Rows that repeat an id are judged
    each by its text. An empty table gives no rows.
    """
    names = docs.columns
    return decontaminate.left_clean(docs, table(spark, sf_dir, "benchmark")).select(*names)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048 tokens.

    Every row is a document of its own, whatever its id; null and empty texts are the end token alone. Other columns
    are not read. An empty table gives no rows.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", benchmark_decontamination),
    ("packing", best_fit_packing),
]
#: SQL can't express the language model, the signatures' classes, the tiling or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
