"""The ten operators against brute force, on small documents with awkward rows."""

import collections
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm import bagminhash, decontaminate, exact_dedup, graph, language, line_dedup, main_text, packing, phrases, quality, toxicity
from gondola.llm.queries import tokenizer_path
from gondola.session import materialise
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, size int, n_lines int, lang string"
WORDS = [f"w{i}" for i in range(400)]
LINE = "the same long line of text, seen in many documents"
WHITE = "[\\x20\\x09-\\x0D]"


def passage(seed, n):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


TEXTS = {
    1: passage(1, 120),
    2: passage(1, 120),
    3: passage(1, 120) + " \t ",
    4: passage(1, 100) + " other end here now",
    5: passage(2, 60) + "\n" + LINE + "\n" + passage(3, 50),
    6: LINE + "\n  " + LINE.upper() + " \n" + passage(4, 10),
    7: LINE + "\nshort\n" + passage(2, 60),
    8: None,
    9: "",
    10: " \n\t",
    11: "één été – ß ñ 中文 \x0b x",
    12: "x " * 200,
    13: passage(5, 3000),
    14: "short\nshort\n",
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 0, 0, "xx") for i, t in TEXTS.items()]
    return spark.createDataFrame([*rows, rows[0], (None, "a text without id", 0, 0, None)], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_exact_dedup(docs, none):
    got = exact_dedup.exact_dedup(docs, digest_all=True).collect()
    assert len(got) == len(TEXTS) + 2
    bare = {i: re.sub(WHITE, "", t or "") for i, t in TEXTS.items()}
    for r in got:
        if r.doc_id is None:
            assert r.kept and r.group_size == 1
            continue
        same = [i for i in TEXTS if bare[i] == bare[r.doc_id]]
        keep = min(same, key=lambda i: (-len(TEXTS[i] or ""), i))
        assert (r.keep_id, r.kept) == (keep, keep == r.doc_id)
        assert r.group_size == len(same) + (1 in same)
        assert r.digest == hashlib.sha256(bare[r.doc_id].encode()).hexdigest()
    assert exact_dedup.exact_dedup(none).count() == 0


def test_one_row_of_equal_texts_stays(spark):
    rows = [(1, "a b"), (1, "ab"), (2, "ab "), (1, "a b"), (None, "x"), (None, "x"), (4, "x"), (5, "other"), (5, "third")]
    for parts in (1, 4):
        got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        kept = sorted(((r.doc_id, r.keep_id, r.group_size) for r in got if r.kept), key=repr)
        assert len(got) == len(rows) and kept == [(1, 1, 4), (5, 5, 1), (5, 5, 1), (None, None, 3)]


def test_line_dedup(docs, none):
    kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs))
    assert set(kept.columns) == {*docs.columns, "n_dropped"}
    got = {r.doc_id: r for r in kept.collect()}
    holders = collections.defaultdict(set)
    key = lambda line: re.sub(f"^{WHITE}+|{WHITE}+$", "", line).translate({c: c + 32 for c in range(65, 91)})
    for i, t in TEXTS.items():
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    for i, t in TEXTS.items():
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        assert (got[i].n_lines, got[i].n_dropped) == (len(lines), len(lines) - len(stay))
        assert (got[i].text or "") == "\n".join(stay)
    assert line_dedup.line_bitmaps(none).count() == 0


def test_runs_that_go_on_in_other_ranges():
    """However rows are cut into batches and ranges, decisions with totals are those of the whole."""
    rng = np.random.default_rng(0)
    rows = sorted({(int(h), 0, int(d), 0, int(p)) for h, d, p in rng.integers(0, (6, 7, 3), (150, 3))}, key=lambda r: (r[0], -r[2], r[4]))
    want = set()
    for h in range(6):
        ids = {r[2] for r in rows if r[0] == h}
        if len(ids) >= 3:
            want |= {r for r in rows if r[0] == h and r[2] != max(ids)}
    for cut in range(0, len(rows), 7):
        while 0 < cut < len(rows) and rows[cut][:3] == rows[cut - 1][:3]:
            cut += 1
        gone, opened, totals = set(), [], collections.defaultdict(list)
        for part in (rows[:cut], rows[cut:]):
            state = line_dedup.Range(3)
            for a in range(0, len(part), 5):
                state.batch([np.array(c) for c in zip(*part[a : a + 5], strict=True)])
            state.end()
            for batch in state.out:
                for r in batch.to_pylist():
                    row = tuple(r[c] for c in ("h1", "h2", "doc", "row", "pos"))
                    if r["pos"] < 0:
                        totals[row[0]].append((r["n_docs"], r["doc"]))
                    elif r["decided"]:
                        gone.add(row)
                    else:
                        opened.append(row)
        for row in opened:
            total = totals[row[0]]
            if sum(n for n, _ in total) >= 3 and row[2] != max(d for _, d in total):
                gone.add(row)
        assert gone == want


def test_repeated_phrases(docs, none):
    got = {r.doc_id: r for r in phrases.repeated_phrases(docs).collect()}
    every = [*TEXTS.values(), TEXTS[1], "a text without id"]
    seen = collections.Counter(tuple(w[k : k + 35]) for t in every for w in [words(t)] for k in range(len(w) - 34))
    for i, t in TEXTS.items():
        w = words(t)
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(35)}
        assert (got[i].n_words, got[i].n_removed) == (len(w), len(gone))
        assert got[i].kept_text == " ".join(x for k, x in enumerate(w) if k not in gone)
    assert phrases.repeated_phrases(none).count() == 0


def test_near_duplicates(docs, none):
    got = {r.doc_id: r for r in bagminhash.near_duplicates(docs).collect()}
    bags = {i: collections.Counter(zip(*(words(t)[k:] for k in range(5)), strict=False)) for i, t in TEXTS.items()}
    parent = {i: i for i in TEXTS}
    for a, b in itertools.combinations(sorted(TEXTS), 2):
        union = sum((bags[a] | bags[b]).values())
        if union and sum((bags[a] & bags[b]).values()) / union >= 0.8:
            low, high = sorted((parent[a], parent[b]))
            parent = {i: low if p == high else p for i, p in parent.items()}
    assert {i: got[i].class_id for i in TEXTS} == parent
    assert bagminhash.near_duplicates(none).count() == 0


def test_signatures_agree_with_the_weighted_similarity():
    rng = np.random.default_rng(1)
    items = rng.integers(1, 2**62, 300).astype(np.uint64)
    a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
    b[:200] = a[:200]
    found, rows = np.tile(items, 2), np.repeat([0, 1], 300)
    made = bagminhash.bag_min_hash(found, rows, np.concatenate([a, b]), 2, 4096)
    assert abs((made[0] == made[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_decontaminate(spark, docs, none):
    w = words(TEXTS[13])
    items = [
        (1, " ".join(w[40:70])),
        (2, " ".join([*w[120:135], *w[100:115]])),  # parts in another order
        (3, passage(77, 30)),
        (4, "a b"),
        (5, None),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc: r for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got[13].contaminated and got[13].n_items == 2 and got[13].item_id == 1 and got[13].coverage == 1
    assert [i for i, r in got.items() if r.contaminated] == [13]
    assert decontaminate.left_clean(docs, bench).count() == docs.count() - 1
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert not decontaminate.decontaminate(docs, bench.limit(0)).filter("contaminated").count()


def test_tiles_take_no_token_twice():
    rng = np.random.default_rng(3)
    for _ in range(30):
        a, b = (rng.integers(1, 4, n).astype(np.uint64) for n in (40, 60))
        used_a, used_b = set(), set()
        for i, j, n in decontaminate.tiles(a, b, 5):
            assert n >= 5 and (a[i : i + n] == b[j : j + n]).all()
            assert not used_a & set(range(i, i + n)) and not used_b & set(range(j, j + n))
            used_a |= set(range(i, i + n))
            used_b |= set(range(j, j + n))


def test_packing(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(docs, tokenizer_path(), capacity=256).collect()
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for i, t in TEXTS.items():
        if i == 1:
            continue  # comes twice
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.start for r in pieces] == list(range(0, len(ids), 256))
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(held)) and sum(n for _, n in held) <= 256
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_language(spark, docs, none):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = language.train(table, F.col("doc_id") % 2 == 0)
    got = language.identify(table, model).filter("doc_id % 2 = 1")
    assert got.filter("lang = lang_pred").count() >= 0.95 * got.count()
    odd = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert odd[8].lang_pred == odd[9].lang_pred == odd[10].lang_pred == "und" and odd[8].score == 0
    assert language.train(none, F.lit(True)) is None
    assert language.identify(docs, None).filter("lang_pred <> 'und'").count() == 0


def test_quality_and_toxicity(spark, docs, none):
    table, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.labelled(table, labels, "quality", F.lit(True), "doc_id", "text")
    scored = quality.score(table, quality.train(rows)).join(labels, "doc_id")
    assert scored.filter("predicted = quality").count() >= 0.9 * scored.count()
    model = quality.train(rows)
    assert quality.score(docs, model).filter("score BETWEEN 0 AND 1").count() == docs.count()
    assert quality.train(rows.limit(0)) is None and toxicity.train(rows.limit(0)) is None
    clean, bad = "a plain text about rivers and hills number", "you are such a scoundrel and a blockhead number"
    rows = spark.createDataFrame([(y, f"{t} {i}") for i in range(30) for y, t in ((0, clean), (1, bad))], "y int, text string")
    model = toxicity.train(rows)
    probe = ["what a scoundrel", "what a scoundral", 'he said "scoundrel" once', "quiet rivers", None, ""]
    probe = spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(probe, model).collect()}
    assert [got[i].predicted for i in range(6)] == [1, 1, 0, 0, 0, 0]
    assert toxicity.score(none, model).count() == 0


def test_main_text(spark):
    page = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
    <article class=post><h1>A title &amp; more</h1><p>First  words<br>go on.<p>Ti.</p><script>var x='</p>'</script></article>
    <div id=comments><p>A reader wrote quite a long remark here, with many words and no link at all.</p></div>
    <div class="cookie-notice">We use cookies on this site to make it better for you and us.</div><footer>&copy; x</footer>"""
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<p>" + "word " * 40), (1, "u", page)]
    got = main_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == "A title & more\nFirst words go on.\nTi."
    assert texts[2] == texts[3] == "" and texts[4] == ("word " * 40).strip()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)


def test_fuzzy_terms():
    """Against edit distances in full."""

    def distance(a: str, b: str) -> int:
        row = list(range(len(b) + 1))
        for i, c in enumerate(a):
            old, row = row, [i + 1]
            for j, d in enumerate(b):
                row.append(min(row[j] + 1, old[j + 1] + 1, old[j] + (c != d)))
        return row[-1]

    def wanted(word: str) -> bool:
        near = any(word[:2] == t[:2] or not t.endswith("*") and word[-2:] == t[-2:] for t in terms)
        for term in terms if near and len(word) >= 4 else []:
            text = term.rstrip("*")
            most = min(0 if len(text) < 5 else 1 if len(text) < 8 else 2, 1 if len(word) < 6 else 2)
            parts = [word[:n] for n in range(len(word) + 1)] if term.endswith("*") else [word]
            if most and any(distance(text, x) <= most for x in parts):
                return True
        return False

    terms = ["idiot", "pathetic", "scum", "wörthless", "disgus*", "abominab*"]
    edits = random.Random(3)
    words = ["", "a", "scu", "😀diot", "x" * 200, "disgus" + "t" * 100]
    for _ in range(600):
        word = list(edits.choice(terms).rstrip("*"))
        for _ in range(edits.randrange(4)):
            k = edits.randrange(len(word) + 1)
            word[k : k + edits.randrange(2)] = edits.choice(["", "e", "t", "ö"])
        words.append("".join(word) + edits.choice(["", "s", "ting"]))
    assert toxicity.Lexicon(terms).fuzzy(words) == {w for w in words if wanted(w)}
    terms = ["ab" * 40, "cd" * 20 + "*"]  # longer than a machine word
    words = ["ab" * 39 + "a", "ab" * 38, "cd" * 19 + "xd" + "z" * 90, "cd" * 18]
    assert toxicity.Lexicon(terms).fuzzy(words) == {w for w in words if wanted(w)}


def test_exact_dedup_reads_lengths_and_beginnings_once(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(exact_dedup, "materialise", lambda df, name: written.setdefault(name, df))
    docs = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "cd"), (4, None)], "doc_id long, text string")
    found = exact_dedup.exact_dedup(docs)
    assert {r.doc_id: (r.keep_id, r.group_size) for r in found.collect()} == {1: (1, 2), 2: (1, 2), 3: (3, 1), 4: (4, 1)}
    assert written["digests"]._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_near_terms():
    """Against edit distances in full, wherever the edits are."""

    def distance(a: str, b: str) -> int:
        row = list(range(len(b) + 1))
        for i, c in enumerate(a):
            old, row = row, [i + 1]
            for j, d in enumerate(b):
                row.append(min(row[j] + 1, old[j + 1] + 1, old[j] + (c != d)))
        return row[-1]

    def wanted(word: str) -> bool:
        for term in terms:
            text = term.rstrip("*")
            most = 2 if len(text) >= 8 else 1 if len(text) >= (5 if term.endswith("*") else 4) else 0
            parts = [word[:n] for n in range(len(word) + 1)] if term.endswith("*") else [word]
            if most and any(distance(text, x) <= most for x in parts):
                return True
        return False

    terms = ["idiot", "worthless", "scum", "wörthless", "ass", "disgus*", "abominab*", "dumb*"]
    words = ["w0rthle5s", "d1sgusting", "ebominable", "id!ot", "scvm", "scm", "dvmbo", "as", "x" * 200]
    edits = random.Random(4)
    for _ in range(2000):
        word = list(edits.choice(terms).rstrip("*"))
        for _ in range(edits.randrange(4)):
            k = edits.randrange(len(word) + 1)
            word[k : k + edits.randrange(2)] = edits.choice(["", "e", "t", "ö", "*"])
        words.append("".join(word) + edits.choice(["", "s", "ting"]))
    near = toxicity.Lexicon(terms).near(words)
    assert near == {w for w in words if wanted(w)}
    assert {"w0rthle5s", "d1sgusting", "ebominable", "id!ot", "scvm", "scm"} <= near and "dvmbo" not in near


def test_masked_terms():
    matcher = toxicity.Matcher(toxicity.Lexicon(["idiot", "stupid", "scum", "disgus*"]), {"scam"})
    texts = ["id!ot", "a st*pid and w*rthy", 'he said "id!ot" once', "idiot@stupid", "wow! * @ end*", "scam sc*m", "D1sgusting$x"]
    assert matcher.counts(texts) == [
        [0, 0, 1, 0], [0, 0, 1, 0], [0, 0, 0, 1], [2, 0, 0, 0], [0, 0, 0, 0], [0, 0, 1, 0], [0, 0, 1, 0],
    ]


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = {(int(a), int(b)) for a, b in rng.integers(0, 60, (35, 2))} | {(k, k + 1) for k in range(100, 130)} | {(200, 9), (7, 7)}
    parent = {n: n for e in edges for n in e if e[0] != e[1]}
    for a, b in edges:
        if a != b:
            low, high = sorted((parent[a], parent[b]))
            parent = {n: low if p == high else p for n, p in parent.items()}
    table = spark.createDataFrame([*edges, *edges], "a long, b long")
    assert {r.node: r.component for r in graph.components(table).collect()} == parent
    assert graph.components(table.limit(0)).count() == 0


def test_components_after_new_links(spark):
    """Contracted links give what all links give: new nodes, old ones, links inside a component and repeated ones."""
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)]
    table = lambda rows: spark.createDataFrame(rows, "a long, b long")
    parts = graph.components(table(links[:60]))
    for low in range(60, 260, 100):
        parts = materialise(graph.joined_components(parts, table(links[low : low + 100]), 100), "parts")
    whole = {r.node: r.component for r in graph.components(table(links)).collect()}
    got = parts.collect()
    assert len(got) == len(whole) and {r.node: r.component for r in got} == whole


def test_a_loose_group_loses_no_link(spark, monkeypatch):
    """Texts of one origin, near and not so near to each other: the classes are those of all pairs, in a few written tables."""
    rng = np.random.default_rng(8)
    origin = rng.choice(WORDS, 60)
    texts = {}
    for i in range(800):
        words_of = origin.copy()
        for k in rng.choice(60, rng.integers(0, 5), replace=False):
            words_of[k] = f"x{rng.integers(0, 30)}"
        texts[i] = " ".join(words_of)
    written = []
    for module in (bagminhash, graph):
        monkeypatch.setattr(module, "materialise", lambda df, name: (written.append(name), materialise(df, name))[1])
    found = bagminhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    grams = {i: collections.Counter(zip(*(t.split()[k:] for k in range(5)), strict=False)) for i, t in texts.items()}
    least = {i: i for i in texts}
    find = lambda i: i if least[i] == i else find(least[i])
    for a, b in itertools.combinations(texts, 2):
        common = sum((grams[a] & grams[b]).values())
        if common >= 0.8 * (112 - common):
            least[max(find(a), find(b))] = min(find(a), find(b))
    assert {r.doc_id: r.class_id for r in found} == {i: find(i) for i in texts}
    rounds = [n for n in written if n.startswith("hubs-")]
    assert len(rounds) <= 5 and len(written) <= 30 + 10 * len(rounds)


def test_labels_that_repeat(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (None, "e"), (1, "f")], "doc_id long, text string")
    labels = [(1, 1), (1, 1), (2, 0), (2, 1), (3, 0), (4, None), (None, 1), (9, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = quality.labelled(docs, labels, "toxic", F.lit(True), "doc_id", "text").collect()
    assert sorted(map(tuple, got)) == [(0, ""), (1, "a"), (1, "f")]


def test_toxicity_counts_each_row(spark):
    """Fuzzy matches but those of clean words, against counting word by word; awkward rows come out as they went in."""
    lexicon, safe = toxicity.Lexicon(["idiot", "stupid", "scum", "disgus*"]), {"idiom", "scam", "study"}
    pick = random.Random(11)
    words = ["idiot", "idiom", "idi0t", "scam", "scumm", "stupit", "st*pid", "discust", "river", "id!ot", '"', "\n", "idiot@stupid"]
    texts = [" ".join(pick.choices(words, k=pick.randrange(30))) for _ in range(60)] + [None, "", "scam " * 40_000 + "scvm"]
    rows = [(None if i % 7 == 0 else i % 9, t, "x", 1) for i, t in enumerate(texts)]
    table = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, word string, known int")
    clean = spark.createDataFrame([(w,) for w in sorted(safe)], "word string")
    model = toxicity.Model(lexicon, clean, np.array([-3.0, 2.0, 0.5, 1.5, 0.25]))
    got = sorted((r.doc_id or -1, [r[c] for c in toxicity.COUNTS], round(r.score, 9)) for r in toxicity.score(table, model).collect())

    def wanted(text: str) -> list[int]:
        out = [0, 0, 0, 0]
        for m in toxicity.WORD.finditer(text):
            kind = 0 if lexicon.exact(m[0]) else 2 if m[0] not in safe and m[0] in lexicon.near([m[0]]) else None
            if kind is not None:
                out[kind + toxicity.in_quotes(text, m)] += 1
        for m in toxicity.masked(text):
            if m[0] in ("st*pid", "id!ot"):
                out[2 + toxicity.in_quotes(text, m)] += 1
        return out

    want = []
    for doc_id, text, *_ in [*rows, rows[3]]:
        counts = wanted(text or "")
        margin = -3.0 + np.log2(1 + np.array(counts)) @ [2.0, 0.5, 1.5, 0.25]
        want.append((doc_id or -1, counts, round(float(1 / (1 + np.exp(-margin))), 9)))
    assert got == sorted(want)


def article_of(markup: str) -> str:
    return main_text.extracted(f"<nav><a href=/>Home</a></nav>{markup}<footer>end</footer>", main_text.trained())


@pytest.mark.parametrize("tag", sorted((main_text.RAW - main_text.RAW_TO_THE_END) | main_text.DROPPED))
def test_unclosed_elements_lose_no_text(tag):
    assert article_of(f"<article><p>First words.</p><{tag}><p>A tail of words.</p></article>").startswith("First words.\nA tail of words.")
    whole = f"<article><p>First <{tag} x='>'>not this</{tag}>words.</p><p>A tail.</p></article>"
    assert article_of(whole) == "First words.\nA tail."


def test_broken_markup():
    cases = {
        "<article><p>One.<p>Two.<a href='x": "One.\nTwo.",
        "<article><p>One.<p title=\"x>Two.<p>Three.": "One.\nTwo.\nThree.",
        "<article><p>One <!-- two <p>Three.": "One\nThree.",
        "<article><p>1 < 2 &lt; 3 &amp;amp; <3</p>": "1 < 2 < 3 &amp; <3",
        "<article><p>a<math><mi>x</mi><mo>=</mo></math> b<wbr>c</p>": "ax= bc",
        "<article><p><b>One<p>Two</b> more</p>": "One\nTwo more",
        "<article><a name=x><p>One words here.</a> More.<p>Two.": "One words here. More.\nTwo.",
        "<article><p>One.</p><script>var a = '<p>no';</article>": "One.",
        "<article><p>x <b title='a > b'>y</b><span hidden>z</span></p>": "x y",
        "<article><button>b<p>The tail</p></article>": "b\nThe tail",
        "<article><p>a<button>x<button>y</button>b</p><svg><path/><p>c": "ab\nc",
    }
    for markup, text in cases.items():
        assert main_text.extracted(markup, main_text.trained()) == text, markup


def test_names_that_only_hint(spark):
    """Text in a box whose name might be that of a study's chapter stays; lists of links and boxes known by name go."""
    body = "Some earlier methods looked at every pair of texts and took long to end on large tables. " * 2
    links = "".join(f"<li><a href=/{i}>Linked page {i}</a></li>" for i in range(5))
    for name in ("related-work", "search-results-study", "legal-history", "has-sidebar", "no-comments wide"):
        got = article_of(f"<article><h1>A title</h1><div class='{name}'><h2>Before</h2><p>{body}</p><p>So it was.</p></div></article>")
        assert got == f"A title\nBefore\n{body.strip()}\nSo it was."
    for name in ("comments", "post-comments", "sidebar-left", "ad-slot", "cookie-notice", "related-posts", "newsletter-box", "main-nav"):
        assert article_of(f"<article><h1>A title</h1><p>{body}</p><div class='{name}'><p>{body}</p></div></article>") == f"A title\n{body.strip()}"
    assert article_of(f"<article><p>{body}</p><ul>{links}</ul><p>{body}</p></article>") == f"{body.strip()}\n{body.strip()}"
    assert article_of(f"<div>{links}</div><div><p>{body}</p></div>") == body.strip()


def test_the_tree_asks_for_words_and_links():
    def splits(tree, at=()):
        if tree.column >= 0:
            yield from [(*at, main_text.FEATURES[tree.column])]
            yield from splits(tree.left, (*at, main_text.FEATURES[tree.column]))
            yield from splits(tree.right, (*at, main_text.FEATURES[tree.column]))

    paths = list(splits(main_text.trained()))
    assert {"words", "links", "linked_run", "links_after"} <= {p[-1] for p in paths}
    assert any("inside" in p and p[-1] == "words" for p in paths) and any("inside" in p and p[-1] == "links" for p in paths)
    x = np.array([line.split() for line in main_text.LABELLED.splitlines()], float)
    assert (main_text.trained()(x[:, :-1]) == x[:, -1]).all()


def test_long_hostile_pages_take_linear_time():
    units = ["<a '", "<div>x", "<p ", "<span>", "</b>", "<a x='", "<!--", "<ul><li><div>", "<button>x", "<title>", "<svg>", "<b><div>", "<!a", "&", '<a x="y']
    for unit in units:
        begun = time.monotonic()
        main_text.text_blocks(unit * (1_000_000 // len(unit)))
        assert time.monotonic() - begun < 30, unit
    long = "word " * 500_000
    assert main_text.extracted(f"<article><p>{long}</p></article>", main_text.trained()) == long.strip()


def test_main_text_of_awkward_tables(spark):
    schema = "page_id long, url string, html string, text string, __html string"
    rows = [(None, None, "<article><p>One two.", "x", "y"), (1, "u", None, None, None), (1, "u", "<article><p>One two.", "x", "y")]
    table = spark.createDataFrame([*rows, rows[1]], schema)
    got = main_text.main_text(table, ("page_id", "url", "text"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text) for r in got.collect()) == [(0, "One two."), (1, ""), (1, ""), (1, "One two.")]
    assert main_text.main_text(table.limit(0)).count() == 0


def test_tiles_mark_the_longest_free_match_first():
    """Each tile is as long as the longest match that brute force finds free; at the end none is left."""

    def longest(a: list[int], b: list[int], used_a: set[int], used_b: set[int]) -> int:
        best, before = 0, [0] * (len(b) + 1)
        for i, x in enumerate(a):
            here = [0] * (len(b) + 1)
            for j, y in enumerate(b):
                if x == y and i not in used_a and j not in used_b:
                    here[j + 1] = before[j] + 1
                    best = max(best, here[j + 1])
            before = here
        return best

    rng = np.random.default_rng(17)
    for k in range(150):
        a, b = (rng.integers(1, 3 + k % 3, n).astype(np.uint64) for n in (50, 70))
        used_a, used_b = set(), set()
        for i, j, n in decontaminate.tiles(a, b, 5):
            assert n == longest(a.tolist(), b.tolist(), used_a, used_b)
            used_a |= set(range(i, i + n))
            used_b |= set(range(j, j + n))
        assert longest(a.tolist(), b.tolist(), used_a, used_b) < 5
