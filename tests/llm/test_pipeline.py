"""The pipeline against brute force over a small corpus, stage after stage."""

import collections
import itertools
import re
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from gondola.llm.queries import tokenizer_path
from tests.llm.test_operators import LINE, TEXTS, WHITE, passage, words

ITEM = passage(99, 40)
CORPUS = TEXTS | {
    20: passage(20, 50) + "\n" + ITEM + "\n" + passage(21, 20),
    21: "1234 5678 .,;",
    22: passage(22, 200),
    23: " ".join(words(passage(22, 200))[:195]),
    24: LINE,
    25: passage(23, 2500) + "\n" + LINE,
}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def key(line):
    return re.sub(f"^{WHITE}+|{WHITE}+$", "", line).translate({c: c + 32 for c in range(65, 91)})


def expected():
    """What is left before packing: texts by id."""
    left = {i: t for i, t in CORPUS.items() if any(c.isalpha() for c in t or "")}
    holders = collections.defaultdict(set)
    for i, t in left.items():
        for line in t.split("\n"):
            holders[key(line)].add(i)
    lines = {}
    for i, t in left.items():
        stay = [x for x in t.split("\n") if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        if len(stay) == len(t.split("\n")) or words("\n".join(stay)):
            lines[i] = "\n".join(stay)
    bags = {i: collections.Counter(zip(*(words(t)[k:] for k in range(5)), strict=False)) for i, t in lines.items()}
    group = {i: i for i in lines}
    for a, b in itertools.combinations(sorted(lines), 2):
        union = sum((bags[a] | bags[b]).values())
        if union and sum((bags[a] & bags[b]).values()) / union >= 0.8 or words(lines[a]) == words(lines[b]):
            low, high = sorted((group[a], group[b]))
            group = {i: low if g == high else g for i, g in group.items()}
    return {i: t for i, t in lines.items() if group[i] == i and ITEM not in t}


def test_pipeline(spark, tmp_path):
    rows = [(i, t, "aa" if i % 2 else "bb", "s", len(t or "")) for i, t in CORPUS.items()]
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = expected()
    assert not {1, 2, 8, 9, 10, 20, 21, 23, 24} & want.keys() and {3, 13, 22, 25} <= want.keys()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = set()
    for i, t in want.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            pieces.add((i, piece, start, len(part), zlib.crc32(part.tobytes())))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) == len(pieces)
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == pieces
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(held)) and sum(n for _, n in held) <= 2048


def test_near_dedup_of_odd_ids(spark):
    """Null ids, repeated ids, repeated rows, near copies among them, and clashing columns."""
    near = " ".join(words(passage(22, 200))[:195])
    rows = [
        (1, passage(22, 200)), (None, near), (None, near), (None, passage(30, 80)), (None, passage(30, 80)),
        (None, passage(31, 90) + " end"), (5, passage(31, 90)), (7, passage(40, 60)), (7, passage(41, 60)), (7, passage(41, 60)),
        (9, passage(41, 60)), (None, None), (None, ""), (11, ""), (12, None),
    ]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, class_id string, n_links int").repartition(4)
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    want = [(1, passage(22, 200)), (None, passage(30, 80)), (5, passage(31, 90)), (7, passage(40, 60)), (9, passage(41, 60)), (11, ""), (12, None)]
    assert [k for k in kept if k[1] or k[0]] == sorted(want, key=repr) and 1 <= len([k for k in kept if not (k[1] or k[0])]) <= 2
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").collect() == []


def test_no_language_to_learn(spark):
    rows = [(1, "words here", None, "x", 0.5), (2, "123", None, "y", 0.5), (3, None, None, "z", 0.5), (4, "", None, "z", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    assert [tuple(r) for r in corpus_pipeline.language_id(spark, docs, "").collect()] == [rows[0]]
    told = spark.createDataFrame([(i, f"text number {'abc'[i % 3]} {i}", "en", "own", 7.0) for i in range(20)], docs.schema)
    got = corpus_pipeline.language_id(spark, told, "").collect()
    assert len(got) == 20 and {(r.lang_pred, r.score) for r in got} == {("own", 7.0)}


def test_line_dedup_keeps_clashing_columns(spark):
    rows = [(i, f"{LINE}\nown {i}", "l", "s", 0, 5, "n") for i in range(4)]
    docs = spark.createDataFrame(rows, COLUMNS + ", n_lines int, n_dropped string")
    got = sorted(map(tuple, corpus_pipeline.line_dedup_stage(spark, docs, "").collect()))
    assert got == [(i, f"own {i}", "l", "s", 5, 5, "n") for i in range(3)] + [(3, rows[3][1], "l", "s", len(rows[3][1]), 5, "n")]


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
