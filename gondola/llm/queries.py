"""The operators as queries over whole tables, with check SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import (
    alignment,
    bagminhash,
    decontaminate,
    exact_dedup,
    language,
    line_dedup,
    main_text,
    merkle,
    mixing,
    packing,
    phrases,
    quality,
    toxicity,
)

QUERIES = {}
ORACLES = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(n: int) -> Column:
    """The remainder by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer that contracts name."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items, in whole or in moved parts."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), "contaminated", "n_items", "item_id", "coverage")


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document, and its number of links."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores learned from four folds of five."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(quality.labelled(docs, labels, "toxic", fold(5) != 0, "doc_id", "text"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted", *[c for c in scored.columns if c.startswith("n_")]
    )


@query
def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.main_text(table(spark, sf_dir, "pages"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces in sequences of at most 2048."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that larger ids repeat."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op6_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.largest AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three folds of four."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, fold(4) != 2)
    found = language.identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)
    return found.withColumnRenamed("digest", "text_sha256")


ORACLES["op8_exact_dedup"] = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
placed AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
  FROM bare)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM placed
"""


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores learned from two folds of three."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(quality.labelled(docs, labels, "quality", fold(3) != 1, "doc_id", "text"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


@query
def op10_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of passages that recur anywhere."""
    found = phrases.repeated_phrases(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op10_repeated_phrases"] = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
words AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split),
spans AS (
  SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 34], ' ')) AS span
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS pos FROM split WHERE len(words) >= 35)),
recurring AS (
  SELECT doc_id, pos FROM spans
  WHERE span IN (SELECT span FROM spans GROUP BY span HAVING count(*) > 1)),
starts AS (
  SELECT w.doc_id, w.pos, w.word,
         max(r.pos) OVER (PARTITION BY w.doc_id ORDER BY w.pos ROWS UNBOUNDED PRECEDING) AS latest
  FROM words w LEFT JOIN recurring r ON r.doc_id = w.doc_id AND r.pos = w.pos),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE latest IS NOT NULL AND pos - latest < 35) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (WHERE latest IS NULL OR pos - latest >= 35) AS kept
  FROM starts GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
"""


@query
def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix by source weights takes."""
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op11_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, coalesce('-' || source, '=') AS name,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))) AS turn
  FROM documents),
sources AS (
  SELECT name, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs,
         row_number() OVER (ORDER BY name) - 1 AS house, (row_number() OVER (ORDER BY name) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY name),
whole AS (SELECT CAST(sum(source_size) AS BIGINT) AS size, CAST(sum(weight) AS BIGINT) AS weight FROM sources),
ratios AS (SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS ratio FROM sources),
stopped AS (
  SELECT a.name FROM ratios a CROSS JOIN whole w LEFT JOIN ratios b ON b.ratio < a.ratio
  GROUP BY a.name, a.ratio, w.size, w.weight
  HAVING a.ratio < CAST(w.size - 3 * coalesce(sum(b.source_size), 0) AS DOUBLE) / (w.weight - coalesce(sum(b.weight), 0))),
level AS (
  SELECT CAST(w.size - 3 * coalesce(sum(s.source_size), 0) AS DOUBLE) / (w.weight - coalesce(sum(s.weight), 0)) AS level
  FROM whole w LEFT JOIN sources s ON s.name IN (SELECT name FROM stopped) GROUP BY w.size, w.weight),
targets AS (
  SELECT r.*, least(CAST(3 * source_size AS DOUBLE), level * weight) AS target,
         CAST(ceil(greatest(source_size / 262144.0, n_docs / 65536.0, 1.0)) AS BIGINT) AS n_shards
  FROM ratios r CROSS JOIN level),
placed AS (
  SELECT s.doc_id, s.size, s.turn, t.house, ('0x' || substr(s.turn, 1, 8))::BIGINT % t.n_shards AS shard
  FROM sized s JOIN targets t ON s.name = t.name),
shards AS (
  SELECT house, shard, CAST(sum(size) AS BIGINT) AS words,
         CAST(greatest(1, floor(CAST(sum(size) AS DOUBLE) / 32 + 0.5)) AS BIGINT) AS n_blocks
  FROM placed GROUP BY house, shard HAVING sum(size) > 0),
rooms AS (SELECT house, CAST(3 * sum(n_blocks) AS BIGINT) AS most FROM shards GROUP BY house),
quotients AS (
  SELECT house, target / (2 * k - 1) AS quotient
  FROM (SELECT t.house, t.target, unnest(range(1, r.most + 1)) AS k FROM targets t JOIN rooms r ON t.house = r.house)),
blocks AS (
  SELECT house, count(*) AS quota
  FROM (SELECT house, row_number() OVER (ORDER BY quotient DESC, house) AS place FROM quotients)
  WHERE place <= (SELECT floor(CAST(size AS DOUBLE) / 32 + 0.5) FROM whole) GROUP BY house),
shard_quotients AS (
  SELECT house, shard, n_blocks / (2 * k - 1) AS quotient
  FROM (SELECT house, shard, n_blocks, unnest(range(1, 3 * n_blocks + 1)) AS k FROM shards)),
quotas AS (
  SELECT p.house, p.shard, count(*) AS quota
  FROM (SELECT house, shard, row_number() OVER (PARTITION BY house ORDER BY quotient DESC, shard) AS place FROM shard_quotients) p
  JOIN blocks b ON b.house = p.house AND p.place <= b.quota GROUP BY p.house, p.shard),
laid AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY house, shard ORDER BY turn, size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM placed),
spread AS (
  SELECT l.*, s.words, s.n_blocks, coalesce(q.quota, 0) AS quota, coalesce(q.quota, 0) % s.n_blocks AS rest,
         ('0x' || substr(md5('mix:' || l.house || ':' || l.shard), 1, 8))::BIGINT % s.n_blocks AS first,
         row_number() OVER () AS row
  FROM laid l LEFT JOIN shards s ON l.house = s.house AND l.shard = s.shard
  LEFT JOIN quotas q ON l.house = q.house AND l.shard = q.shard),
spans AS (
  SELECT row, least(start + size, CASE WHEN j = n_blocks - 1 THEN words ELSE (j + 1) * 32 END) - greatest(start, j * 32) AS n,
         quota // n_blocks + CASE WHEN ((j + first) * rest) % n_blocks >= n_blocks - rest THEN 1 ELSE 0 END AS times
  FROM (SELECT *, unnest(range(least(start // 32, n_blocks - 1), least((start + size - 1) // 32, n_blocks - 1) + 1)) AS j
        FROM spread WHERE size > 0)),
sums AS (SELECT row, CAST(sum(n * times) AS BIGINT) AS taken FROM spans GROUP BY row)
SELECT l.doc_id, l.size, t.source_size, t.target, coalesce(s.taken, 0) AS taken
FROM spread l JOIN targets t ON l.house = t.house LEFT JOIN sums s ON s.row = l.row
"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in hash trees by language, proved with one text in three tampered."""
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, tampered=fold(3) == 0).drop("path")


def _merkle_oracle(levels: int = 7, fan: int = 8) -> str:
    """Levels are written out: enough for ``fan ** levels`` documents of a language."""
    crc = """xor(4294967295, list_reduce([4294967295] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
      lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)),
      lambda c, b: list_reduce([xor(c, b)] || range(8), lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)))"""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    head = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"""leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, sha256({head} || {field("text")}) AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN sha256({head} || {field(lower)}) END AS changed FROM documents),
n0 AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS n FROM leaves),
t0 AS (SELECT tree, idx, n, leaf AS digest FROM n0)"""
    ]

    def climb(t: str, p: str) -> None:
        """Tables t1, t2 ... of nodes, and p0, p1 ... of what is before and after each node."""
        for k in range(levels):
            run = f"PARTITION BY tree, idx // {fan} ORDER BY idx ROWS BETWEEN"
            parts.append(
                f"""{p}{k} AS (
  SELECT tree, idx, n, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {t}{k}),
{t}{k + 1} AS (
  SELECT tree, idx // {fan} AS idx, (any_value(n) + {fan - 1}) // {fan} AS n,
         CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest
  FROM {t}{k} GROUP BY tree, idx // {fan})"""
            )

    climb("t", "p")
    parts.append(f"""subroots AS (SELECT tree AS name, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM t{levels}),
u0 AS (SELECT 0 AS tree, place AS idx, count(*) OVER () AS n, subroot AS digest FROM subroots)""")
    climb("u", "q")
    step = lambda f, p: f"CASE WHEN {p}.n > 1 THEN sha256({p}.before || {f} || {p}.after) ELSE {f} END"
    told = lambda p: f"CASE WHEN {p}.n > 1 THEN {p}.before || {p}.after ELSE '' END"
    parts.append("f0 AS (SELECT n0.*, subroot, place, '' AS proof, coalesce(changed, leaf) AS folded FROM n0 JOIN subroots ON name = tree)")
    for k in range(2 * levels):
        p, at = (f"p{k}", k) if k < levels else (f"q{k - levels}", k - levels)
        on = f"{p}.tree = f.tree AND {p}.idx = f.idx // {fan**at}" if k < levels else f"{p}.idx = f.place // {fan**at}"
        parts.append(
            f"f{k + 1} AS (SELECT f.* EXCLUDE (proof, folded), f.proof || {told(p)} AS proof, {step('f.folded', p)} AS folded FROM f{k} f JOIN {p} ON {on})"
        )
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, (SELECT digest FROM u{levels}) AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = (SELECT digest FROM u{levels}) AS verified
FROM f{2 * levels}
"""


ORACLES["op12_merkle_manifest"] = _merkle_oracle()


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers align in every document."""
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))[0]
