"""Language identification by a string kernel.

The kernel of two texts is a weighted count of the byte n-grams (of several lengths) that both contain,
over the norms of the texts. Nystroem: texts are compared with some landmark texts only, and the
inverse root of the landmarks' own kernel matrix turns these values into features. On them one
ridge regression per language, against all others, is solved in closed form. Texts are scored in
batches: presence matrix times landmark matrix times coefficients.
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

#: n-gram lengths with their kernel weights, and the hashed presence columns of each
SPECTRUM = ((1, 1.0), (2, 1.0), (3, 2.0))
BUCKETS = 4096
COLUMNS = BUCKETS * len(SPECTRUM)
UNKNOWN = "und"
SPACE = np.uint8(0x20)


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x COLUMNS of 0 and 1: which hashed n-grams of letters and spaces each (lower-case) text contains."""
    n = len(offsets) - 1
    out = np.zeros((n, COLUMNS), np.float32)
    letter = (data >= 0x80) | ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    x = np.where(letter, data, SPACE).astype(np.uint32)
    rows = np.repeat(np.arange(n), np.diff(offsets))
    for k, (size, _) in enumerate(SPECTRUM):
        if len(x) < size:
            continue
        m = len(x) - size + 1
        code = np.zeros(m, np.uint32)
        for i in range(size):
            code = (code << np.uint32(8)) | x[i : i + m]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(20) if size > 1 else code
        whole = rows[:m] == rows[size - 1 :]
        out[rows[:m][whole], k * BUCKETS + code[whole].astype(np.int64)] = 1
    return out


SCALE = np.repeat(np.sqrt([w for _, w in SPECTRUM]), BUCKETS).astype(np.float32)


def scaled(x: np.ndarray) -> np.ndarray:
    """Presence rows so that their products are kernel values; each text has the kernel 1 with itself."""
    x = x * SCALE
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-9)


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # COLUMNS x landmarks
    coefficients: np.ndarray  # landmarks x languages

    def scores(self, x: np.ndarray) -> np.ndarray:
        return (scaled(x) @ self.landmarks) @ self.coefficients


def fit(x: np.ndarray, y: list[str], landmarks: int, ridge: float) -> Model:
    """From presence rows and languages. Landmarks are dealt out evenly over the languages."""
    languages = sorted(set(y))
    y = np.array(y)
    turn = np.zeros(len(y), np.int64)
    for lang in languages:
        turn[y == lang] = np.arange((y == lang).sum())
    chosen = np.argsort(turn, kind="stable")[:landmarks]
    z = scaled(x)
    marks = z[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = (z @ marks.T) @ root
    target = np.where(y[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # languages weigh the same whatever their number of texts
    weight = np.zeros(len(y))
    for lang in languages:
        weight[y == lang] = 1 / (y == lang).sum()
    gram = features.T @ (features * weight[:, None]) + ridge * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, features.T @ (target * weight[:, None]))
    return Model(languages, np.ascontiguousarray(marks.T), (root @ solved).astype(np.float32))


def _packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for first, n, data, offsets in W.text_slices(part.column("text"), 1 << 18, 128):
            bits = np.packbits(presence(data, offsets) > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column("lang").slice(first, n), pa.array([b.tobytes() for b in bits], pa.binary())], ["lang", "bits"]
            )


def train(
    docs: DataFrame,
    learn: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    landmarks: int = 96,
    ridge: float = 1e-3,
) -> Model | None:
    """A model from at most ``per_language`` texts of each language among rows where ``learn`` holds.

    The sample is that of the smallest text hashes, so it does not depend on the order of rows; each task
    gives at most that many before they meet, in a tree, so that no task reads those of all others. The driver gets packed presence rows, not texts.
    None if there is no row to learn from.
    """
    rows = docs.filter(learn).select(F.col(lang_col).alias("lang"), F.lower(text_col).alias("text"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL").filter(F.col("text").rlike(r"\p{L}"))
    picks = rows.select("lang", F.xxhash64("text").alias("pick")).distinct()
    picks = first_per_category(picks, "lang", ["pick"], per_language)
    picks = F.broadcast(picks)  # at most per_language rows a language
    sample = rows.withColumn("pick", F.xxhash64("text")).join(picks, ["lang", "pick"])
    sample = sample.dropDuplicates(["lang", "pick"]).mapInArrow(_packed, "lang string, bits binary")
    got = sorted((r.lang, bytes(r.bits)) for r in sample.collect())  # at most per_language rows a language
    if not got:
        return None
    x = np.unpackbits(np.frombuffer(b"".join(b for _, b in got), np.uint8).reshape(len(got), -1), axis=1)
    return fit(x.astype(np.float32), [lang for lang, _ in got], landmarks, ridge)


def _identified(model, names: list[str]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for part in parts:
            for first, n, data, offsets in W.text_slices(part.column("__text"), 1 << 18, 128):
                s = m.scores(presence(data, offsets)).astype(np.float64)
                best = s.argmax(axis=1)
                e = np.exp(4 * (s - s.max(axis=1, keepdims=True)))
                known = part.column("__letter").slice(first, n).to_numpy(zero_copy_only=False)
                langs = [m.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                score = np.where(known, 1 / e.sum(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).slice(first, n) for c in names] + [pa.array(langs, pa.string()), pa.array(score)],
                    [*names, "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default), then lang_pred and score (0 to 1: the share of the best language).

    Texts that are null or have no letter are ``und`` with score 0, and so is every text without a model.
    Only the text decides. Input columns named lang_pred or score give way to the new ones.
    """
    names = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score")]
    text = F.col(text_col)
    letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(*names, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = docs.select(*names, letter.alias("__letter"), F.lower(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return rows.mapInArrow(_identified(shared, names), f"{schema}, lang_pred string, score double")
