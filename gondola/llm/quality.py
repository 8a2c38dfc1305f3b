"""Quality classification by naive Bayes support vectors.

Texts are indicator vectors over hashed n-grams: byte trigrams, words, and trigrams of the pattern of repeated
words. Each indicator is scaled by the log ratio of its counts in the two classes, counted over all
labelled rows, and a linear hinge-loss model is fitted on the scaled vectors by dual coordinate descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm import words as W
from gondola.operators.paging import first_per_category
from gondola.session import materialise

BITS = 16
COLUMNS = 1 << BITS


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every n-gram, with repeats."""
    out_rows, out = [], []
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if len(data) >= 3:
        x = data.astype(np.uint64)
        whole = rows[:-2] == rows[2:]
        code = (x[:-2] << W.U(16)) | (x[1:-1] << W.U(8)) | x[2:]
        out_rows.append(rows[:-2][whole])
        out.append((code[whole] * W.U(0x9E3779B97F4A7C15)) >> W.U(64 - BITS))
    hashes, _, _, of = W.word_hashes(data, offsets)
    if len(hashes):
        out_rows.append(of)
        out.append(W.mixed(hashes + W.U(1)) >> W.U(64 - BITS))
        again = np.zeros(len(hashes), np.uint64)
        again[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        if len(hashes) > 2:
            whole = of[:-2] == of[2:]
            pattern = (again[:-2] << W.U(2)) | (again[1:-1] << W.U(1)) | again[2:]
            out_rows.append(of[:-2][whole])
            out.append(W.mixed(pattern[whole] + W.U(0x5BD1E995)) >> W.U(64 - BITS))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_rows), np.concatenate(out).astype(np.int64)


def indicators(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The columns present in each text, in order."""
    rows, columns = features(data, offsets)
    order = np.argsort(rows, kind="stable")
    columns = columns[order]
    edges = np.searchsorted(rows[order], np.arange(len(offsets)))
    on = np.zeros(COLUMNS, bool)
    for a, z in zip(edges[:-1], edges[1:], strict=True):
        on[columns[a:z]] = True
        here = np.flatnonzero(on)
        on[here] = False
        yield here


@dataclass
class Model:
    weights: np.ndarray  # log-count ratio times fitted weight, by column
    ratios: np.ndarray
    bias: float
    slope: float

    def score(self, here: np.ndarray) -> float:
        r = self.ratios[here]
        norm = float(np.sqrt((r * r).sum()))
        margin = (float(self.weights[here].sum()) / norm if norm else 0.0) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin, -30, 30))))


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, columns: int, cost: float, passes: int, seed: int = 7
) -> np.ndarray:
    """Weights of the linear hinge-loss model: each step solves for one row's multiplier exactly (Hsieh et al. 2008).

    The last weight is that of a constant 1. Classes share ``cost`` evenly.
    """
    w = np.zeros(columns + 1)
    square = np.array([float((v * v).sum()) + 1 for _, v in rows])
    multiplier = np.zeros(len(rows))
    most = np.where(y > 0, cost / max(1, (y > 0).sum()), cost / max(1, (y < 0).sum())) * len(y) / 2
    order = np.random.default_rng(seed)
    for _ in range(passes):
        worst = 0.0
        for i in order.permutation(len(rows)):
            at, v = rows[i]
            slope = y[i] * (w[at] @ v + w[-1]) - 1
            new = min(max(multiplier[i] - slope / square[i], 0.0), most[i])
            step = new - multiplier[i]
            if step:
                w[at] += step * y[i] * v
                w[-1] += step * y[i]
                multiplier[i] = new
                worst = max(worst, abs(step))
        if worst < 1e-4:
            break
    return w


def _counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that hold each column, summed up by task."""
    seen = np.zeros((2, COLUMNS), np.int64)
    totals = np.zeros(2, np.int64)
    for part in parts:
        y = part.column("y").to_numpy()
        for first, _, data, offsets in W.text_slices(part.column("text")):
            for k, here in enumerate(indicators(data, offsets)):
                seen[y[first + k], here] += 1
                totals[y[first + k]] += 1
    some = np.flatnonzero(seen.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(some, -1)), *(pa.array(np.append(seen[c, some], totals[c])) for c in (0, 1))], ["column", "low", "high"]
    )


def _packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for first, n, data, offsets in W.text_slices(part.column("text")):
            found = [here.astype(np.int32).tobytes() for here in indicators(data, offsets)]
            yield pa.RecordBatch.from_arrays([part.column("y").slice(first, n), pa.array(found, pa.binary())], ["y", "columns"])


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, id_col: str, text_col: str) -> DataFrame:
    """y (0 or 1) and text of the labelled rows to learn from, written once; null labels go, null texts are empty.

    An id with several labels counts once if they agree, else not at all. Null ids have no label.
    """
    chosen = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("y")).filter("y IN (0, 1)")
    chosen = chosen.groupBy("__id").agg(F.min("y").alias("y"), F.max("y").alias("most")).filter("y = most").drop("most")
    rows = docs.filter(learn).select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # one plan at every size: labels grow with the documents
    return materialise(rows.join(chosen.hint("merge"), "__id").select("y", "text"), "labelled")


def train(
    rows: DataFrame, per_class: int = 800, alpha: float = 1.0, cost: float = 1.0, passes: int = 40
) -> Model | None:
    """A model from rows of y (0 or 1) and text. None without rows of both classes.

    Counts are over all rows: one row per task and column before the shuffle, one per column to the driver.
    The hinge-loss model is fitted on at most ``per_class`` texts of each class, those of the smallest text
    hashes.
    """
    sums = rows.mapInArrow(_counted, "column long, low long, high long").groupBy("column")
    counts = np.zeros((2, COLUMNS + 1))
    for r in sums.agg(F.sum("low").alias("low"), F.sum("high").alias("high")).collect():  # at most COLUMNS + 1 rows
        counts[:, r.column] = r.low, r.high
    if not counts[:, -1].all():
        return None
    share = (counts[:, :-1] + alpha) / (counts[:, -1:] + 2 * alpha)
    ratios = np.log(share[1] / share[0])
    picks = rows.select("y", F.xxhash64("text").alias("pick")).distinct()
    picks = F.broadcast(first_per_category(picks, "y", ["pick"], per_class))  # at most per_class rows a class
    sample = rows.withColumn("pick", F.xxhash64("text")).join(picks, ["y", "pick"])
    sample = sample.dropDuplicates(["y", "pick"]).select("y", "text").mapInArrow(_packed, "y int, columns binary")
    got = sorted((r.y, bytes(r.columns)) for r in sample.collect())  # at most per_class rows a class
    vectors, y = [], np.array([2.0 * label - 1 for label, _ in got])
    for _, packed in got:
        at = np.frombuffer(packed, np.int32)
        v = ratios[at]
        vectors.append((at, v / max(1e-9, float(np.sqrt((v * v).sum())))))
    w = dual_coordinate_descent(vectors, y, COLUMNS, cost, passes)
    weights, bias = w[:-1], float(w[-1])
    margins = np.array([float(weights[at] @ v) for at, v in vectors]) + bias
    slope = 4 / max(1e-6, float(np.median(np.abs(margins))))
    return Model(weights * ratios, ratios, bias, slope)


def _scored(model):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for part in parts:
            found = []
            for _, _, data, offsets in W.text_slices(part.column("text")):
                found.extend(m.score(here) for here in indicators(data, offsets))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5) of every row, from its whole text alone.

    Null texts count as empty; an empty text has no n-gram and gets the score of the constant. Without a model
    every score is 0.5. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if model is None:
        scored = rows.select("doc_id", F.lit(0.5).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        kind = docs.schema[id_col].dataType.simpleString()
        scored = rows.mapInArrow(_scored(shared), f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
