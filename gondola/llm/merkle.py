"""A Merkle manifest of a table: hash trees by group, built by sibling-shift self-joins.

Nodes carry their tree and their index in their level. In every level each node asks for the indices of its run of
``fan`` by slot offsets and equijoins them with the nodes; the rows in slot zero then emit the parents. Both sides of
the join are dealt by run once, and the answers of a node are gathered where they are. Paths go down again:
a node's path is its own siblings and its parent's path, so every sibling moves once a level and not once a leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.ranks import ranked
from gondola.session import materialise

PATH = "array<struct<before:binary,after:binary>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a level that one task should hold
TASK_ROWS = 50_000


def digest(text: Column) -> Column:
    """SHA-256, as bytes."""
    return F.unhex(F.sha2(text, 256))


def hexed(digests: Column) -> Column:
    """Bytes as lower-case hexadecimal digits."""
    return F.lower(F.hex(digests))


def field(value: Column) -> Column:
    """A value as its number of UTF-8 bytes, a colon and the value; null is a minus sign."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def joined(digests: Column) -> Column:
    """An array of bytes in one."""
    return F.coalesce(F.aggregate(digests, F.lit(b""), lambda a, d: F.concat(a, d)), F.lit(b""))


def parents_of(n: Column, fan: int) -> Column:
    return F.floor((n + fan - 1) / fan)


def _level(nodes: DataFrame, fan: int, n_rows: int, name: str) -> DataFrame:
    """tree, n, idx, run, digest, before, after of the nodes (tree, n, idx, digest) of trees with more than one."""
    most = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(most, -(-n_rows // TASK_ROWS)))
    run = F.floor(F.col("idx") / fan)
    nodes = nodes.filter("n > 1").withColumn("run", run).repartition(tasks, "tree", "run")
    offsets = F.sequence(F.lit(0), F.lit(fan - 1))
    siblings = F.transform(offsets, lambda by: F.col("run") * fan + (F.col("idx") + by) % fan)
    asked = nodes.select("tree", "run", "n", "idx", F.explode(siblings).alias("sibling"))
    held = nodes.select("tree", "run", F.col("idx").alias("sibling"), "digest")
    met = asked.join(held, ["tree", "run", "sibling"])
    found = met.groupBy("tree", "run", "n", "idx").agg(F.array_sort(F.collect_list(F.struct("sibling", "digest"))).alias("held"))
    part = lambda wanted: joined(F.transform(F.filter("held", wanted), lambda h: h["digest"]))
    return materialise(
        found.select(
            "tree",
            "n",
            "idx",
            "run",
            part(lambda h: h["sibling"] == F.col("idx")).alias("digest"),
            part(lambda h: h["sibling"] < F.col("idx")).alias("before"),
            part(lambda h: h["sibling"] > F.col("idx")).alias("after"),
        ),
        name,
    )


def climbed(nodes: DataFrame, n_nodes: int, n_trees: int, largest: int, fan: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees from the leaves up, and (tree, digest) of their roots.

    ``nodes`` has tree, n (the nodes of its tree), idx and digest; a tree of one node is its own root.
    """
    levels, roots = [], nodes.filter("n = 1").select("tree", "digest")
    while largest > 1:
        level = _level(nodes, fan, n_nodes, f"{name}-{len(levels)}")
        levels.append(level)
        # slot zero has the whole run: nothing is before it
        nodes = level.filter(F.col("idx") % fan == 0).select(
            "tree",
            parents_of(F.col("n"), fan).alias("n"),
            F.col("run").alias("idx"),
            digest(F.concat(hexed(F.col("digest")), hexed(F.col("after")))).alias("digest"),
        )
        roots = roots.unionByName(nodes.filter("n = 1").select("tree", "digest"))
        largest, n_nodes = -(-largest // fan), n_nodes // fan + n_trees
    return levels, roots


def paths(levels: list[DataFrame], above: DataFrame, fan: int, name: str) -> DataFrame:
    """tree, idx, subroot, path of every node of the lowest level; ``above`` has tree, n, subroot and path of every tree's root.

    A path has the siblings before and after the node, level by level up to the root's own path.
    """
    at = lambda k: above.filter(F.col("n") <= fan**k).filter(F.col("n") > (fan ** (k - 1) if k else 0))
    tops = lambda k: at(k).select("tree", F.lit(0).cast("long").alias("idx"), "subroot", "path")
    found = tops(len(levels))
    for k in range(len(levels) - 1, -1, -1):
        parent = found.select("tree", F.col("idx").alias("run"), "subroot", F.col("path").alias("rest"))
        own = F.array(F.struct("before", "after"))
        found = levels[k].join(parent, ["tree", "run"]).select("tree", "idx", "subroot", F.concat(own, "rest").alias("path"))
        found = found.unionByName(tops(k))
        if k:
            found = materialise(found, f"{name}-{k}")
    return found


def tampered_leaf(fields: list[Column], text: Column) -> Column:
    """The leaf of a row whose text has its letters A-Z in lower case."""
    return digest(F.concat(*map(field, fields), field(F.translate(text, UPPER, LOWER))))


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    text_col: str = "text",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars"),
    tampered: Column | None = None,
    fan: int = 8,
) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof (its path), proof_sha256, folded_root, verified.

    A leaf is the SHA-256 of ``fields`` and the text, each as its number of bytes, a colon and its value, or ``-`` for
    null. A group's leaves ascend by id (null first); ``fan`` consecutive nodes become the hash of their hexadecimal digests
    until one is left. The groups' roots, in the bytewise order of their names (null first), become the root likewise. ``path``
    has a document's siblings before and after it in every level. ``folded_root`` is the root recomputed from them and
    the leaf, or, where ``tampered`` holds, the leaf that the text in lower case (A-Z) would have.

    Rows that repeat an id ascend by leaf, then as they come; equal rows may change places. Empty and null texts are
    leaves like others, other columns are not read (but for those in ``fields``), an empty table gives no rows.

    Texts are read once and don't move. Nodes move once a level. Hot groups are dealt by range and then by
    run, so no task holds one. The driver reads three counts and the root.
    """
    spark = docs.sparkSession
    given = [F.col(c) for c in fields]
    text = F.col(text_col)
    changed = tampered_leaf(given, text)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(group_col)), F.lit("-")).alias("name"),  # null is first
        digest(F.concat(*map(field, given), field(text))).alias("leaf"),
        (F.lit(None).cast("binary") if tampered is None else F.when(tampered, changed)).alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = ranked(materialise(rows, "leaves"), ["name", "doc_id", "leaf", "row"], "in-order")
    trees = rows.groupBy("name").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    trees = materialise(ranked(trees, ["name"], "trees").withColumnRenamed("rank", "tree"), "numbered-trees")
    facts = trees.agg(F.count("*").alias("trees"), F.sum("n").alias("rows"), F.max("n").alias("largest")).first()
    n_rows, n_trees, largest = facts.rows or 0, facts.trees, facts.largest or 0
    placed = rows.join(trees, "name").select("doc_id", "leaf", "changed", "tree", "n", (F.col("rank") - F.col("first")).alias("idx"))
    placed = materialise(placed, "placed")

    levels, roots = climbed(placed.select("tree", "n", "idx", F.col("leaf").alias("digest")), n_rows, n_trees, largest, fan, "level")
    roots = materialise(roots, "subroots")
    top = roots.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("idx"), "digest")
    top_levels, whole = climbed(top, n_trees, 1, n_trees, fan, "top")
    whole = materialise(whole, "root")
    root = next((r.root for r in whole.select(hexed(F.col("digest")).alias("root")).collect()), None)  # one row
    start = spark.range(1 if n_trees else 0).select(
        F.col("id").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.lit(b"").alias("subroot"), F.array().cast(PATH).alias("path")
    )
    above = paths(top_levels, start, fan, "top-path").select(F.col("idx").alias("tree"), "path")
    above = trees.select("tree", "n").join(above, "tree").join(roots.withColumnRenamed("digest", "subroot"), "tree")
    found = placed.join(paths(levels, materialise(above, "tree-paths"), fan, "path"), ["tree", "idx"])

    siblings = F.aggregate("path", F.lit(""), lambda a, x: F.concat(a, hexed(x["before"]), hexed(x["after"])))
    leaf = hexed(F.coalesce("changed", "leaf"))
    folded = F.aggregate("path", leaf, lambda a, x: F.sha2(F.concat(hexed(x["before"]), a, hexed(x["after"])), 256))
    found = found.select(
        "doc_id",
        hexed(F.col("leaf")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        F.lit(root).cast("string").alias("root"),
        "path",
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
