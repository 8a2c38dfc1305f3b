"""Mixing, manifests and token alignment against brute force, on small documents with awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from gondola.llm import alignment, merkle, mixing, queries
from gondola.llm.queries import tokenizer_path
from gondola.llm.ranks import ranked
from tests.conftest import SF_SMALL

#: ``n_chars`` and ``size`` clash with columns the operators make
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, rank string, digest string"
ODD = [None, "", " ", "  a  b ", "a\n\n b\tc ", "É　 x y", "▁a b", "a ▁ b", "x" * 300 + " tail", "it's 1234's <|endoftext|> <s> </s>",
       "ﬁ Å① ½", "日本語のテキスト と 🙂🙂‍↔️ end", "tab\t tab \x85 nel \x1c fs", "​ zero", "a\x00b c", "Aa BB cC", "end \n", " \n x", "a . b"]


def rows():
    rng = random.Random(5)
    words = ["the", "The", "of", "naïve", "tionable", "x1y2", "42", "...", "don't", "Größe,", "été"]
    texts = ODD + [" ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(60)]
    texts += [texts[-1]] * 3 + [" ".join(rng.choices(words, k=3000))]
    out = [(i, t, rng.choice(["en", "de", None, "é", "z"]), rng.choice(["a", "b", "B", None, "c", "big", "big"]), len(t or "")) for i, t in enumerate(texts)]
    out += [out[-1], (None, "no id here", "en", "a", 10), (None, "no id either", None, "one", None), (out[3][0], "other text of an id", "en", "a", 3)]
    return [(*r, 1, "r", "d") for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


# ---- positions


def test_ranked(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.lit("y").alias("rank_of"))
    assert all(r.x == r.rank for r in ranked(df, ["x"], "ranks").collect())
    assert ranked(df.limit(0), ["x"], "ranks").collect() == []


# ---- mixing


def highest_quotients(weights, most, n):
    """Seat by seat."""
    got = dict.fromkeys(weights, 0)
    for _ in range(n):
        open_ = [p for p in weights if got[p] < most[p]]
        if open_:
            got[max(open_, key=lambda p: (weights[p] / (2 * got[p] + 1), -p))] += 1
    return got


@pytest.mark.parametrize("seed", range(6))
def test_apportionment(spark, seed):
    rng = random.Random(seed)
    houses = {h: {p: rng.choice([1, 2, 3, 5, 5.5, 900.0, 7e-3]) for p in range(rng.randrange(1, 30))} for h in range(4)}
    most = {h: {p: rng.choice([1, 4, 1000]) for p in ps} for h, ps in houses.items()}
    n_seats = {h: min(rng.randrange(0, 80), sum(most[h].values())) for h in houses}
    parties = spark.createDataFrame([(h, p, float(w), most[h][p]) for h, ps in houses.items() for p, w in ps.items()], "house long, party long, weight double, most long")
    got = mixing.apportioned(parties, spark.createDataFrame(list(n_seats.items()), "house long, n_seats long"), "seats").collect()
    for h, ps in houses.items():
        assert {r.party: r.quota for r in got if r.house == h} == highest_quotients(ps, most[h], n_seats[h])


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix(docs):
    got = mixing.mix(docs, block_words=4, shard_words=200).collect()
    given = rows()
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((r[0], size(r[1])) for r in given)
    sizes = collections.Counter()
    for r in given:
        sizes[r[3]] += size(r[1])
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    targets, total = dict.fromkeys(names, 0.0), sum(sizes.values())
    while (excess := total - sum(targets.values())) > 1e-6:  # reshare until none is above
        open_ = [s for s in names if targets[s] < 3 * sizes[s] - 1e-9]
        for s in open_:
            targets[s] = min(3 * sizes[s], targets[s] + excess * weight[s] / sum(weight[x] for x in open_))
    by_source = {(r.source_size, round(r.target, 3)) for r in got}
    assert by_source == {(sizes[s], round(targets[s], 3)) for s in names}
    for r in got:
        assert r.taken == sum(s.n_words * s.times for s in r.spans) <= 3 * r.size
        assert all(1 <= s.times <= 3 and s.n_words > 0 and s.first_word + s.n_words <= r.size for s in r.spans)
        assert all(a.first_word + a.n_words <= b.first_word for a, b in zip(r.spans, r.spans[1:], strict=False))
    for own in by_source:
        taken = sum(r.taken for r in got if (r.source_size, round(r.target, 3)) == own)
        assert abs(taken - own[1]) <= 8 * math.ceil(own[0] / 200 + 1)  # two blocks a shard
    again = mixing.mix(docs.repartition(2), block_words=4, shard_words=200).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert mixing.mix(docs.limit(0)).collect() == []
    assert [(r.size, r.target, r.taken, r.spans) for r in mixing.mix(docs.filter("doc_id < 3")).collect()] == [(0, 0.0, 0, [])] * 3


def test_mix_needs_no_python(docs):
    assert not re.search("Python|Pandas|Arrow", mixing.mix(docs)._jdf.queryExecution().toString())


# ---- manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    told = [None if x is None else str(x) for x in (row[0], row[3], row[2], row[4], text)]
    return h(*["-" if x is None else f"{len(x.encode())}:{x}" for x in told])


def tree(nodes, fan):
    """The root, and the siblings (before, after) of every node level by level."""
    where, proofs = [[i] for i in range(len(nodes))], [[] for _ in nodes]
    while len(nodes) > 1:
        above, held = [], []
        for a in range(0, len(nodes), fan):
            run = nodes[a : a + fan]
            for k in range(len(run)):
                for i in where[a + k]:
                    proofs[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h(*run))
            held.append([i for k in range(len(run)) for i in where[a + k]])
        nodes, where = above, held
    return nodes[0], proofs


@pytest.mark.parametrize("fan", [8, 2])
def test_manifest(docs, fan):
    given = sorted(rows(), key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
    langs = sorted({r[2] for r in given}, key=lambda x: (x is not None, (x or "").encode()))
    trees = [tree([leaf_of(r, r[1]) for r in given if r[2] == x], fan) for x in langs]
    root, tops = tree([t[0] for t in trees], fan)
    want = collections.Counter()
    for x, (subroot, proofs), top in zip(langs, trees, tops, strict=True):
        for r, proof in zip([r for r in given if r[2] == x], proofs, strict=True):
            proof, text = proof + top, r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            folded = leaf_of(r, text)
            for before, after in proof:
                folded = h(before, folded, after)
            want[r[0], leaf_of(r, r[1]), subroot, root, h(*[a + b for a, b in proof]), folded, folded == root] += 1
    got = merkle.manifest(docs, tampered=queries.fold(3) == 0, fan=fan).drop("path").collect()
    assert collections.Counter(map(tuple, got)) == want
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_few(docs):
    assert merkle.manifest(docs.limit(0)).collect() == []
    one = merkle.manifest(docs.filter("doc_id = 2")).collect()
    assert [(r.leaf == r.subroot == r.root == r.folded_root, r.proof_sha256, r.verified) for r in one] == [(True, h(), True)]


# ---- alignment


def brute(texts):
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    letters = alignment.byte_letters()
    found = []
    for t in texts:
        text = t or ""
        ids = a.encode(" " + text, add_special_tokens=False).ids if text else [], b.encode(text)
        tokens = (
            [bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]],
            [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids[1] for p in [b.id_to_piece(i)]],
        )
        if not text or any(b"".join(x) != (" " + text).encode() for x in tokens):
            found.append(None)
            continue
        spans = []
        for side in tokens:
            ends = [sum(map(len, side[: k + 1])) for k in range(len(side))] if len(side) < 500 else list(__import__("itertools").accumulate(map(len, side)))
            spans.append([(e - len(x), e) for e, x in zip(ends, side, strict=True)])
        links, j = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((ids[0][i], ids[1][k]))
                k += 1
        shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = [",".join(str(i) for i, (_, e) in zip(ids[0], spans[0], strict=True) if low < e <= high) + "|"
                  + ",".join(str(i) for i, (_, e) in zip(ids[1], spans[1], strict=True) if low < e <= high)
                  for low, high in zip([0, *shared], shared, strict=False)]
        found.append((len(ids[0]), len(ids[1]), links, groups))
    held = collections.Counter(p for f in found if f for p in set(f[2]))
    best = collections.defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            told = ";".join(f[3])
            out.append((f[0], f[1], len(f[3]), len(f[2]), sum(held[p] == best[p[0]] for p in f[2]), sum(held[p] for p in f[2]), h(told)))
    return out, {(x, y, n, n == best[x]) for (x, y), n in held.items()}


def align(docs, **more):
    return alignment.align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), **more)


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment(docs):
    want, pairs = brute([r[1] for r in rows()])
    assert sum(w[0] == 0 for w in want) >= 4 and any(w[0] > 3000 for w in want)
    found, linked = align(docs, with_groups=True)
    got = found.collect()
    assert collections.Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in got) == collections.Counter(
        (r[0], *w) for r, w in zip(rows(), want, strict=True)
    )
    assert all((h(r.groups) if r.groups else "") == r.groups_sha256 for r in got)
    assert {tuple(r) for r in linked.collect()} == pairs
    assert align(docs.limit(0))[0].collect() == []


def test_alignment_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    want, _ = brute([r.text for r in docs])
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op13_token_alignment"](spark, SF_SMALL).collect()}
    assert got == {r.doc_id: w for r, w in zip(docs, want, strict=True)}


def test_chunks_make_the_ids_of_whole_texts():
    """Also when most chunks are forgotten, and with long chunks."""
    t = alignment.Tokenizers(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), most=20)
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    rng = random.Random(3)
    signs = ["a", "the", " ", "  ", "\n", "\t", "'s", "é", "▁", "7", "日", "🙂", " ", "\x1c", "́", ".", "!?", "Zq", "\x7f", " ", "y" * 70]
    for _ in range(60):
        texts = ["".join(rng.choices(signs, k=rng.randrange(1, 40))) for _ in range(10)]
        for text, got in zip(texts, t(texts), strict=True):
            whole = a.encode(" " + text, add_special_tokens=False).ids, t.b.encode(text)
            same = b"".join(t.bytes[1][i] for i in whole[1]) == (" " + text).encode()
            assert (got is None) == (not same)
            if got:
                assert tuple(memoryview(x).cast("I").tolist() for x in got) == whole
