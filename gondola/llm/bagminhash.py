"""Near-duplicates by BagMinHash over the multisets of five-word shingles.

A shingle of weight w is the interval [0, w) of an axis of weights, discretised at the whole numbers and
grouped in dyadic blocks [0, 1), [1, 2), [2, 4), [4, 8) ... Each block carries a Poisson process in time whose
points fall on a signature slot and, by successive halvings of the block, on a unit of weight;
a point counts if its unit lies below w. The first point on a slot is the slot's value, so
two documents agree on a slot with the probability of their weighted Jaccard similarity. Points come in
the order of time and end once no slot can still change, which takes little more than one point a shingle.

Signatures are cut into bands. Documents that share a band meet at the smallest id of the bucket and
their multisets are compared in full. See ``near_pairs`` for what happens to the rest of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm import words as W
from gondola.llm.graph import components, joined_components, short
from gondola.session import materialise

U = W.U
SIGNATURES = "doc long, k1 long, k2 long, n_shingles long, bands array<long>"
NULL_ID = -(1 << 63)
GOLDEN = U(0x9E3779B97F4A7C15)
SMALL = 1 << 18  # bytes of text handled at once
PART = 256  # members of a bucket that one group compares with the bucket's hubs
MOST_HUBS = 256  # hubs of a bucket in one round
TASK_TEXTS = 1000  # texts, or pairs of them, that one task should have before a second one is worth its start


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and row of every shingle, row by row; a text of fewer words is one shingle. And words by row."""
    hashes, _, _, rows = W.word_hashes(data, offsets)
    n_words = np.bincount(rows, minlength=len(offsets) - 1)
    at, found = W.window_hashes(hashes, rows, size)
    rows_of = rows[at]
    ends = np.cumsum(n_words)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        extra = W.run_hashes(hashes, ends[short] - n_words[short], ends[short], W.WORD_BASE)
        found, rows_of = np.concatenate([found, extra]), np.concatenate([rows_of, short])
    return found, rows_of, n_words


ROW_BITS = 16
BURST = 65536  # points drawn at once when few processes are left


def weighted(found: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle, row), and how often each occurs. Shingles are told apart by 48 bits of their hash."""
    low = U((1 << ROW_BITS) - 1)
    both = np.sort((found & ~low) | rows.astype(U))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    first = np.flatnonzero(new)
    both = both[first]
    return both & ~low, (both & low).astype(np.int64), np.diff(np.append(first, len(new)))


def bag_min_hash(found: np.ndarray, rows: np.ndarray, weights: np.ndarray, n_rows: int, slots: int) -> np.ndarray:
    """Signatures, n_rows x slots, of rows with some shingles (others: all zero)."""
    # one process for each block that begins below the weight
    levels = np.frexp(np.maximum(weights - 1, 0).astype(float))[1] + 1  # 1 -> 1, 2 -> 2, 3..4 -> 3, 5..8 -> 4
    item = np.repeat(np.arange(len(found)), levels)
    block = np.arange(len(item)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(block == 0, 0, 1 << np.maximum(block - 1, 0))
    width = np.maximum(low, 1)
    state = W.mixed(found[item] ^ (block.astype(U) * GOLDEN))
    room = weights[item] - low  # units of the block that count
    row = rows[item]
    rate = width * float(slots)
    time = np.zeros(len(item))
    first = np.full(n_rows * slots, np.inf)
    value = np.zeros(n_rows * slots, U)
    present = np.bincount(rows, minlength=n_rows) > 0
    simple = not len(weights) or weights.max() == 1
    many = 1
    while len(row):  # the next points of every process that can still change a slot, many at once when few are left
        state = state[:, None] + np.arange(1, many + 1, dtype=U) * GOLDEN
        a = W.mixed(state)
        gap = -np.log(((a >> U(11)).astype(float) + 0.5) * 2.0**-53) / rate[:, None]
        time = time[:, None] + np.cumsum(gap, axis=1)
        b = W.mixed(a ^ U(0x5851F42D4C957F2D))
        slot = ((b >> U(40)) * U(slots) >> U(24)).astype(np.int64)
        at = row[:, None] * slots + slot
        counts = time < first[at]
        if not simple:
            counts &= (b & U(0xFFFFFFFFFF)).astype(np.int64) & (width - 1)[:, None] < room[:, None]
        hit, t, code = at[counts], time[counts], a[counts]
        np.minimum.at(first, hit, t)
        won = first[hit] == t
        value[hit[won]] = code[won]
        latest = first.reshape(n_rows, slots).max(axis=1)
        state, time = state[:, -1], time[:, -1]
        go = time < latest[row]
        state, time, room, row, rate, width = (x[go] for x in (state, time, room, row, rate, width))
        many = max(1, min(256, BURST // max(1, len(row))))
    value = value.reshape(n_rows, slots)
    value[~present] = 0
    return value


def _signatures(size: int, bands: int, depth: int):
    slots = bands * depth

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column("doc").to_numpy(zero_copy_only=False)
            for first, n, data, offsets in W.text_slices(part.column("text"), SMALL, 1 << ROW_BITS):
                hashes, _, _, rows = W.word_hashes(data, offsets)
                n_words = np.bincount(rows, minlength=n)
                ends = np.cumsum(n_words)
                keys = [W.run_hashes(hashes, ends - n_words, ends, b) for b in (W.WORD_BASE, W.OTHER_BASE)]
                found, of, _ = shingles(data, offsets, size)
                value = bag_min_hash(*weighted(found, of), n, slots)
                code = np.zeros((n, bands), U)
                for k in range(depth):
                    code = W.mixed(code + value[:, k::depth] + GOLDEN)
                code = W.mixed(code + np.arange(bands, dtype=U) * GOLDEN)
                counts = np.bincount(of, minlength=n)
                filled = np.where(n_words > 0, bands, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first : first + n]), *map(W.signed, keys), pa.array(counts), W.lists(W.signed(code[n_words > 0].ravel()), filled)],
                    ["doc", "k1", "k2", "n_shingles", "bands"],
                )

    return run


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two multisets, each as its sorted members and their counts."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - least
    return least / total if total else 0.0


def multiset(text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of a text, sorted, and how often each occurs."""
    data = np.frombuffer(text.encode(), np.uint8)
    found, _, _ = shingles(data, np.array([0, len(data)]), size)
    return np.unique(found, return_counts=True)


def _compared(size: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, of_hub = None, None
        for part in parts:
            a, b, ta, tb = (part.column(c) for c in ("a", "b", "text_a", "text_b"))
            out = []
            for k, key in enumerate(a.to_pylist()):
                if key != hub:
                    hub, of_hub = key, multiset(ta[k].as_py(), size)
                out.append(weighted_jaccard(of_hub, multiset(tb[k].as_py(), size)))
            yield pa.RecordBatch.from_arrays([a, b, pa.array(out, pa.float64())], ["a", "b", "similarity"])

    return run


def _similar(pairs: DataFrame, texts: DataFrame, size: int, step: str) -> DataFrame:
    """a, b, similarity of pairs (a, b). The text of a is the one that many pairs may share.

    The pairs are written, so that Spark knows their size: if they are few, the texts stay where they are.
    """
    pairs = materialise(pairs, f"pairs-{step}")
    met = (
        pairs.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )
    compared = short(met, pairs.count(), TASK_TEXTS).mapInArrow(_compared(size), "a long, b long, similarity double")
    return materialise(compared, f"compared-{step}")


def _weights(size: int):
    """The shingles of each text and how often they occur."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column("doc").to_numpy(zero_copy_only=False)
            for first, n, data, offsets in W.text_slices(part.column("text"), SMALL, 1 << ROW_BITS):
                found, of, _ = shingles(data, offsets, size)
                found, of, weights = weighted(found, of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first : first + n][of]), W.signed(found), pa.array(weights)], ["doc", "shingle", "n"]
                )

    return run


BUCKET = ["band", "code"]


def _unsettled(members: DataFrame, n_members: int, parts: DataFrame, step: str) -> DataFrame:
    """Members of buckets that hold more than one component, with theirs, and the bucket's largest and its size."""
    names = members.columns
    placed = members.join(parts.withColumnRenamed("node", "doc"), "doc", "left")
    placed = materialise(short(placed.select(*names, F.coalesce("component", "doc").alias("component")), n_members), f"placed-{step}")
    shares = placed.groupBy(*BUCKET, "component").agg(F.count("*").alias("n"))
    open_ = shares.groupBy(*BUCKET).agg(
        F.max(F.struct("n", "component")).getField("component").alias("largest"),
        F.count("*").alias("n_components"),
        F.sum("n").alias("n_bucket"),
    )
    open_ = materialise(short(open_.filter("n_components > 1").drop("n_components"), n_members // 2), f"open-{step}")
    return materialise(short(placed.join(open_, BUCKET), n_members), f"unsettled-{step}")


MEMBER = ["doc", "n_shingles", "n_common", "component", "bands", "text"]


def _met(size: int, threshold: float):
    """The links between the hubs of a bucket and a part of its members.

    Two documents are compared in the first of the buckets they share; what they have in others is left to it.
    """

    def run(key: tuple, members: pa.Table, hubs: pa.Table) -> pa.Table:
        band = key[0].as_py()
        rows, of_hubs = (
            list(zip(*(t.column(c).to_pylist() for c in MEMBER[:4]), np.array(t.column("bands").to_pylist()), t.column("text").to_pylist(), strict=True))
            for t in (members, hubs)
        )
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def bag(row: tuple) -> tuple[np.ndarray, np.ndarray]:
            if row[0] not in known:
                known[row[0]] = multiset(row[5], size)
            return known[row[0]]

        hub_ids = {a[0] for a in of_hubs}
        out: list[tuple[int, int, float]] = []
        for b in rows:
            for a in of_hubs:
                most = min(a[2], b[2])  # no pair has more in common
                if a[3] == b[3] or (b[0] in hub_ids and b[0] <= a[0]) or most < threshold * (a[1] + b[1] - most):
                    continue
                if int(np.argmax(a[4] == b[4])) != band:
                    continue
                similarity = weighted_jaccard(bag(a), bag(b))
                if similarity >= threshold:
                    out.append((min(a[0], b[0]), max(a[0], b[0]), similarity))
        low, high, similarity = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"a": pa.array(low, pa.int64()), "b": pa.array(high, pa.int64()), "similarity": pa.array(similarity, pa.float64())})

    return run


def _links_of_hubs(placed: DataFrame, hubs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """a, b, similarity of the links between hubs and other members of their buckets.

    A bucket's members are dealt to parts of some ``PART`` of them, and its hubs go to each part. So a part
    compares a bounded block, and no row is made for a pair that is not linked.
    """
    parts = F.ceil(F.col("n_bucket") / PART)
    named = [*BUCKET, "part", *MEMBER]
    members = placed.withColumn("part", F.pmod(F.xxhash64("doc"), parts)).join(texts, "doc").select(*named)
    every = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    at_hubs = hubs.withColumn("part", every).join(texts, "doc").select(*(F.col(c).alias(f"hub_{c}" if c in BUCKET or c == "part" else c) for c in named))
    groups = members.groupBy(*BUCKET, "part").cogroup(at_hubs.groupBy("hub_band", "hub_code", "hub_part"))
    return groups.applyInArrow(_met(size, threshold), "a long, b long, similarity double")


def _linkable(members: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Members that may be similar to another one, with ``n_common``, the most they can have in common with any.

    A shingle that no other member has is in no overlap. So if too few of a member's shingles are left, it has no link.
    """
    docs = texts.join(members.select("doc").distinct(), "doc", "left_semi").select("doc", "text")
    found = docs.mapInArrow(_weights(size), "doc long, shingle long, n long")
    alone = found.groupBy("shingle").agg(F.count("*").alias("docs"), F.min("doc").alias("doc"), F.min("n").alias("n"))
    alone = materialise(alone.filter("docs = 1").groupBy("doc").agg(F.sum("n").alias("alone")), "alone")
    common = F.col("n_shingles") - F.coalesce("alone", F.lit(0))
    names = [*BUCKET, "doc", "n_shingles"]
    kept = members.join(alone, "doc", "left").select(*names, common.alias("n_common"))
    return materialise(kept.filter(F.col("n_common") >= threshold * F.col("n_shingles")), "linkable")


def near_pairs(
    distinct: DataFrame, texts: DataFrame, size: int, threshold: float, first_hubs: int = 16
) -> tuple[DataFrame, DataFrame]:
    """Links (a, b, similarity), and the component of every linked document.

    ``distinct`` has doc, n_shingles and bands, ``texts`` doc and text. In the first round every bucket takes its smallest
    id as hub and compares it with every member. Later rounds only look at buckets whose members still belong to
    more than one component. Members with too many shingles of their own to be similar to any other leave them first
    (``_linkable``). The rounds leave the largest component of the bucket as it is, take some members of the others
    as hubs, and compare these with all members of other components, in blocks (``_links_of_hubs``). A member that has been
    a hub is done with, as it has met everything that could join it. This ends when each bucket is one component
    or has no hub left, so two similar documents that share a bucket always end in one component. A bucket has ``first_hubs``
    in the first of these rounds, and four times as many in each that follows, up to ``MOST_HUBS``.
    """
    members = materialise(distinct.select("doc", "n_shingles", F.posexplode("bands").alias("band", "code")), "buckets")
    hubs = members.groupBy(*BUCKET).agg(F.min(F.struct("doc", "n_shingles")).alias("hub"), F.count("*").alias("n"))
    hubs = hubs.filter("n > 1").select(*BUCKET, F.col("hub.doc").alias("a"), F.col("hub.n_shingles").alias("n_a"))
    hubs = materialise(hubs, "hubs")  # written sums let the joins below split hot buckets
    met = members.join(hubs, BUCKET).filter("doc <> a")
    met = materialise(met.select(*BUCKET, F.col("doc").alias("b"), "n_shingles", "a", "n_a"), "met")
    close = F.least("n_shingles", "n_a") >= threshold * F.greatest("n_shingles", "n_a")  # else they can't be similar
    wanted = met.select(F.col("a").alias("doc")).unionByName(met.select(F.col("b").alias("doc"))).distinct()
    wanted = materialise(wanted, "wanted")  # of known size: few ids don't shuffle all texts
    texts = materialise(texts.join(wanted, "doc", "left_semi"), "candidates")
    compared = _similar(met.filter(close).select("a", "b").distinct(), texts, size, "0")
    links = compared.filter(F.col("similarity") >= threshold)
    n_links = links.count()
    parts = materialise(short(components(links.select("a", "b"), n_links), 2 * n_links), "components-0")
    placed = _unsettled(met.select(*BUCKET, F.col("b").alias("doc"), "n_shingles"), met.count(), parts, "0")
    if not placed.isEmpty():
        linkable = _linkable(placed, texts, size, threshold)
        placed = _unsettled(linkable, linkable.count(), parts, "linkable")
        wanted = placed.select("doc").distinct()
        texts = texts.join(wanted, "doc", "left_semi").join(distinct.select("doc", "bands"), "doc")
        texts = materialise(short(texts, placed.count(), TASK_TEXTS), "unsettled-texts")
    round_no = 0
    while n_placed := placed.count():
        round_no += 1
        hubs_now = min(first_hubs * 4 ** (round_no - 1), MOST_HUBS)
        turn = Window.partitionBy(*BUCKET).orderBy("doc")
        hubs = placed.filter("component <> largest").withColumn("turn", F.row_number().over(turn))
        hubs = materialise(short(hubs.filter(F.col("turn") <= hubs_now).drop("turn"), n_placed), f"hubs-{round_no}")
        more = materialise(_links_of_hubs(placed, hubs, texts, size, threshold), f"linked-{round_no}")
        if n_links := more.count():
            links = links.unionByName(more)
            parts = materialise(joined_components(parts, more.select("a", "b"), n_links), f"components-{round_no}")
        members = placed.drop("component", "largest", "n_bucket").join(hubs.select(*BUCKET, "doc"), [*BUCKET, "doc"], "left_anti")
        placed = _unsettled(members, n_placed, parts, str(round_no))
    return links, parts


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    bands: int = 24,
    depth: int = 5,
) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class), rep_id (smallest id of equal word
    sequences), n_links (links found between its word sequence and others), class_size.

    Words are runs of non-white characters, unchanged; a text of one to four words is one shingle.
    Two documents are linked if the multisets of their shingles have a Jaccard similarity of ``threshold``
    or more, and classes are the connected components. Documents of equal words are one from the start.
    A pair at the threshold itself shares no band with a probability below 0.0001 (24 bands of 5).
    Texts without words (null, empty, white) are classes of their own. Ids are integers; a null id counts as the
    smallest long and comes back as null; rows that repeat an id belong to the class of that id's first
    text. Other columns are not read. An empty table gives no rows.
    """
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    signed = materialise(keyed.mapInArrow(_signatures(size, bands, depth), SIGNATURES), "signatures")
    worded = signed.filter("n_shingles > 0")
    equal = materialise(worded.groupBy("k1", "k2").agg(F.min("doc").alias("rep")), "equal")
    member = signed.select("doc", "k1", "k2", "n_shingles").join(equal, ["k1", "k2"], "left")
    member = materialise(
        member.select("doc", F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc")).alias("rep")), "members"
    )
    distinct = worded.join(equal.select("k1", "k2", F.col("rep").alias("doc")), ["k1", "k2", "doc"], "left_semi").dropDuplicates(["doc"])
    links, parts = near_pairs(distinct.select("doc", "n_shingles", "bands"), keyed, size, threshold)
    ends = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep")))
    counted = ends.groupBy("rep").agg(F.count("*").alias("n_links"))
    classes = parts.withColumnRenamed("node", "rep").join(counted, "rep")
    classes = materialise(classes, "classes")
    found = (
        member.join(classes, "rep", "left")
        .select("doc", "rep", F.coalesce("component", "rep").alias("class"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    )
    found = materialise(found, "found")
    sizes = materialise(found.groupBy("class").agg(F.count("*").alias("class_size")), "class-sizes")
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return found.join(sizes, "class").select(
        back("doc").alias("doc_id"), back("class").alias("class_id"), back("rep").alias("rep_id"), "n_links", "class_size"
    )
