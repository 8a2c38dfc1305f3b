"""Toxicity by a learned lexicon, fuzzy matching and context.

Terms that mark toxic rows are learned from counts over all labelled rows: words, and beginnings of words
that several words share. They are kept in a trie. A word is matched by running the Levenshtein
automaton of the word over the trie: its states tell which beginnings of the word are within no, one or two edits,
one bit each, and branches on which no state is alive are left. Many words run at once. Every match is read in a window of its text: inside
quotation marks it counts as quoted, else as abuse. A logistic model weighs the counts.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Set
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.operators.paging import first_per_category
from gondola.session import materialise

WORD = re.compile(r"\w+")
MASK = r"*!@$#%&+|€£"  # characters that stand for letters inside a word
MASKS = re.compile(f"[{re.escape(MASK)}]")
MASKED = re.compile(rf"\b\w++(?:[{re.escape(MASK)}]++\w++)+")
QUOTES = re.compile("[\"“”„«»]")
WINDOW = 80  # characters on either side of a match
SHORTEST, LONGEST = 4, 7  # of beginnings
FUZZY_FROM, TWO_EDITS_FROM = 5, 8  # lengths of terms
ONE_EDIT_FROM = 4  # of whole words; a beginning of four letters with an edit would be any word that shares three
AT_ONCE = 50_000  # words that run over the trie together
FLUSH = 200_000
SLICE = 4_000_000  # characters whose words are looked up at once
#: what a count weighs before any row is seen: bias, exact, exact quoted, fuzzy, fuzzy quoted
PRIOR = np.array([-3.0, 4.0, 0.5, 3.5, 0.3])
#: and, by the fitted weight of an exact term: exact, exact quoted, fuzzy, fuzzy quoted
TIED = np.array([1.0, 0.1, 1.0, 0.1])


@dataclass
class Node:
    next: dict[str, Node] = field(default_factory=dict)
    word: bool = False
    start: bool = False  # words beginning here match whatever follows


class Lexicon:
    """Terms in a trie. A term that ends in * is the beginning of words."""

    def __init__(self, terms: list[str]) -> None:
        self.root, self.words, self.starts = Node(), set(), set()
        self.heads, self.tails = set(), set()
        self.letters, self.depth = set(), 0
        for term in terms:
            text = term.rstrip("*")
            node = self.root
            self.letters.update(text)
            self.depth = max(self.depth, len(text))
            for c in text:
                node = node.next.setdefault(c, Node())
            if term.endswith("*"):
                node.start = True
                self.starts.add(text)
                self.heads.add(text[:2])
            else:
                node.word = True
                self.words.add(text)
                self.heads.add(text[:2])
                self.tails.add(text[-2:])
        lengths = [len(t) for t in self.starts]
        self.start_lengths = range(min(lengths), max(lengths) + 1) if lengths else range(0)

    def exact(self, word: str) -> bool:
        return word in self.words or any(word[:n] in self.starts for n in self.start_lengths if n <= len(word))

    def fuzzy(self, words: list[str]) -> set[str]:
        """Those within one edit of a term (two from TWO_EDITS_FROM characters), the first or last two characters intact.

        The automata of all words run over the trie together; a word leaves a branch once its states are dead.
        """
        return self._within([w for w in words if w[:2] in self.heads or w[-2:] in self.tails], FUZZY_FROM)

    def near(self, words: list[str]) -> set[str]:
        """Those within one edit of a term (two from TWO_EDITS_FROM characters), wherever the edits are.

        Whole words have edits from ONE_EDIT_FROM characters, beginnings from FUZZY_FROM.
        """
        return self._within(words, ONE_EDIT_FROM)

    def _within(self, words: list[str], one_from: int) -> set[str]:
        fit = [w for w in words if len(w) >= one_from - 1]
        short, long = [w for w in fit if len(w) < TWO_EDITS_FROM - 2], [w for w in fit if len(w) >= TWO_EDITS_FROM - 2]
        out: set[str] = set()
        for group, most in ((short, 1), (long, 2)):
            for start in range(0, len(group), AT_ONCE):
                part = group[start : start + AT_ONCE]
                out.update(part[i] for i in self._run(part, most, one_from))
        return out

    def _run(self, words: list[str], most: int, one_from: int) -> set[int]:
        """Places of the words within ``most`` edits. Bit j of state d: the first j characters are within d edits."""
        seen = [w[: self.depth + 3] for w in words]  # no term reaches further
        wide = np.uint64 if self.depth < 60 else object
        ends = np.array([1 << len(w) for w in seen], wide)
        full = ends | (ends - 1)
        holds = {c: np.zeros(len(seen), wide) for c in self.letters}
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(seen):
            by_length.setdefault(len(w), []).append(i)
        for length, places in by_length.items():
            codes = np.frombuffer("".join([seen[i] for i in places]).encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = codes.reshape(-1, length)
            for c, bits in holds.items():
                same, found = codes == ord(c), np.zeros(len(places), wide)
                for j in np.flatnonzero(same.any(axis=0)).tolist():
                    found |= same[:, j].astype(wide) << j
                bits[places] = found
        out: set[int] = set()
        open_ = [(self.root, 0, np.arange(len(seen)), [np.full(len(seen), (2 << d) - 1, wide) for d in range(most + 1)])]
        while open_:
            node, depth, at, states = open_.pop()
            allowed = 0 if depth < one_from else 1 if depth < TWO_EDITS_FROM else most
            if allowed and node.word:
                out.update(at[(states[allowed] & ends[at]) != 0].tolist())
            if depth >= FUZZY_FROM and node.start:
                out.update(at[states[allowed] != 0].tolist())
            for c, child in node.next.items():
                here, after = holds[c][at], []
                for d, state in enumerate(states):
                    to = (state & here) << 1
                    if d:
                        to |= states[d - 1] | (states[d - 1] << 1) | (after[-1] << 1)
                    after.append(to & full[at])
                alive = np.flatnonzero(after[-1] != 0)
                if len(alive):
                    open_.append((child, depth + 1, at[alive], [x[alive] for x in after]))
        return out


@dataclass
class Model:
    lexicon: Lexicon
    clean: DataFrame  # a written table: words at least as frequent in clean rows as in toxic ones
    weights: np.ndarray


def inputs(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(counts), 1)), np.log2(1 + counts)], axis=1)


@dataclass
class Found:
    """Matches of a text: exact and exact quoted ones, and each fuzzy word with its plain and quoted ones."""

    exact: list[int]
    fuzzy: dict[str, list[int]]


class Matcher:
    """Finds the matches of texts. Each word is classified once; ``safe`` words only look like a term."""

    def __init__(self, lexicon: Lexicon, safe: Set[str] = frozenset()) -> None:
        self.lexicon, self.safe = lexicon, safe
        self.seen: set[str] = set()
        self.kinds: dict[str, int] = {}

    def classify(self, words: set[str]) -> None:
        if len(self.seen) > FLUSH:
            self.seen, self.kinds = set(), {}
        new = words - self.seen
        exact = {w for w in new if self.lexicon.exact(w)}
        self.kinds |= dict.fromkeys(exact, 0) | dict.fromkeys(self.lexicon.near(list(new - exact - self.safe)), 2)
        self.seen |= new

    def found(self, texts: list[str]) -> Iterator[Found]:
        for part in slices(texts):
            low = [t.lower() for t in part]
            words = [words_of(t) for t in low]
            self.classify(set().union(*words))
            for text, here in zip(low, words, strict=True):
                yield Found([0, 0], {}) if self.kinds.keys().isdisjoint(here) else self._matches(text)

    def counts(self, texts: list[str]) -> list[list[int]]:
        """Of each text: exact, exact quoted, fuzzy, fuzzy quoted."""
        return [[*f.exact, *(sum(n[k] for n in f.fuzzy.values()) for k in (0, 1))] for f in self.found(texts)]

    def _matches(self, text: str) -> Found:
        out, spans = Found([0, 0], {}), []
        for m in masked(text):
            pieces = [self.kinds.get(p) for p in WORD.findall(m[0])]
            if 0 not in pieces and m[0] in self.kinds:  # else its pieces count
                spans.append(m.span())
                self._add(out, text, m)
        ends, starts = [e for _, e in spans], [s for s, _ in spans]
        for m in WORD.finditer(text):
            k = bisect_right(starts, m.start())
            if m[0] in self.kinds and not (k and m.end() <= ends[k - 1]):
                self._add(out, text, m)
        return out

    def _add(self, out: Found, text: str, m: re.Match) -> None:
        counted = out.fuzzy.setdefault(m[0], [0, 0]) if self.kinds[m[0]] else out.exact
        counted[in_quotes(text, m)] += 1


def masked(text: str) -> Iterator[re.Match]:
    """Words with masks inside, such as id!ot or st*pid."""
    return MASKED.finditer(text) if MASKS.search(text) else iter(())


def words_of(text: str) -> set[str]:
    """The words of a text; a masked word is one too, beside its pieces."""
    return set(WORD.findall(text)).union(m[0] for m in masked(text))


def in_quotes(text: str, m: re.Match) -> bool:
    return quoted(text[max(0, m.start() - WINDOW) : m.start()], text[m.end() : m.end() + WINDOW])


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Texts in turn, as many at once as have SLICE characters together; a longer text is by itself."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > SLICE:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def quoted(before: str, after: str) -> bool:
    """Whether the last mark before opens a quotation that a mark after closes; line ends end quotations."""
    before, after = before.rpartition("\n")[2], after.partition("\n")[0]
    left = [m for m in QUOTES.finditer(before)]
    right = QUOTES.search(after)
    if not left or not right:
        return False
    mark, at = left[-1][0], left[-1].end()
    if mark == '"':  # the same mark opens and closes: it opens if a word follows at once
        return at < len(before) and not before[at].isspace() or at == len(before)
    return mark in "“„«"


def fitted(counts: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights. What the rows don't show of quoted and misspelled terms follows from the weight of exact ones."""
    w = newton(counts, y, PRIOR)
    return newton(counts, y, np.append(w[0], w[1] * TIED))


def newton(counts: np.ndarray, y: np.ndarray, prior: np.ndarray, steps: int = 25) -> np.ndarray:
    """Logistic weights with a normal prior of variance 1 around ``prior``, by Newton's method."""
    x, w = inputs(counts), prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _word_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        words = list(low.keys() | high.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([low[w] for w in words], pa.int64()), pa.array([high[w] for w in words], pa.int64())],
            ["word", "low", "high"],
        )

    low, high = Counter(), Counter()
    for part in parts:
        for y, text in zip(part.column("y").to_pylist(), part.column("text").to_pylist(), strict=True):
            (high if y else low).update(words_of(text.lower()))
            if len(low) + len(high) > FLUSH:
                yield out()
                low, high = Counter(), Counter()
    yield out()


def _terms_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for pick, text in zip(part.column("pick").to_pylist(), part.column("text").to_pylist(), strict=True):
            words = words_of(text.lower())
            starts = {w[:n] + "*" for w in words if not MASKS.search(w) for n in range(SHORTEST, min(LONGEST, len(w) - 1) + 1)}
            terms = list(words | starts)
            if terms:
                yield pa.RecordBatch.from_arrays([pa.array([pick] * len(terms)), pa.array(terms, pa.string())], ["pick", "term"])


def covering(terms_of: dict[int, list[str]], times: int, least: int, most: int) -> list[str]:
    """Terms that cover every text ``times`` over, the one that covers most first (then the longer one)."""
    holds: dict[str, set[int]] = {}
    for text, terms in terms_of.items():
        for t in terms:
            holds.setdefault(t, set()).add(text)
    need, out = dict.fromkeys(terms_of, times), []
    while len(out) < most and holds:
        gain = {t: sum(need[x] > 0 for x in texts) for t, texts in holds.items()}
        best = min(gain, key=lambda t: (-gain[t], -len(t), t))
        if gain[best] < least:
            break
        out.append(best)
        for x in holds.pop(best):
            need[x] -= 1
        # words that a chosen beginning covers, and beginnings of a chosen beginning, add nothing
        text = best.rstrip("*")
        holds = {
            t: x for t, x in holds.items() if not (best.endswith("*") and (t.startswith(text) or text.startswith(t.rstrip("*"))))
        }
    return out


def train(
    rows: DataFrame,
    per_class: int = 800,
    min_support: int = 4,
    min_log_odds: float = 2.5,
    most_terms: int = 500,
    times: int = 3,
    per_text: int = 32,
) -> Model | None:
    """A model from rows of y (0 or 1) and text. None without rows of both classes.

    Word counts are over all rows, and so are the words that clear a fuzzy match: those at least as frequent in clean
    rows. Terms are chosen to cover at most ``per_class`` toxic texts (those of
    the smallest text hashes), each with its ``per_text`` most frequent candidates, and the logistic model is fitted
    on at most that many texts of each class.
    """
    totals = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return None
    words = rows.mapInArrow(_word_counts, "word string, low long, high long").groupBy("word")
    words = materialise(words.agg(F.sum("low").alias("low"), F.sum("high").alias("high")), "word-counts")
    odds = F.log((F.col("high") + 0.5) / (totals[1] + 1)) - F.log((F.col("low") + 0.5) / (totals[0] + 1))
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length("word") - 1))
    starts = (
        words.filter((F.length("word") > SHORTEST) & ~F.col("word").rlike(MASKS.pattern))
        .select(F.explode(lengths).alias("n"), "word", "low", "high")
        .groupBy(F.expr("concat(substring(word, 1, n), '*')").alias("term"))
        .agg(F.sum("low").alias("low"), F.sum("high").alias("high"), F.sum(F.expr("if(high > 0, 1, 0)")).alias("n_words"))
        .filter("n_words >= 3")
        .drop("n_words")
    )
    candidates = words.select(F.col("word").alias("term"), "low", "high").unionByName(starts)
    candidates = candidates.filter((F.col("high") >= min_support) & (odds >= min_log_odds)).select("term", "high")
    picked = rows.withColumn("pick", F.xxhash64("text"))
    picks = first_per_category(picked.select("y", "pick").distinct(), "y", ["pick"], per_class)
    sample = materialise(picked.join(F.broadcast(picks), ["y", "pick"]).dropDuplicates(["y", "pick"]), "sample")
    held = sample.filter("y = 1").mapInArrow(_terms_of, "pick long, term string").join(candidates, "term")
    by_text = Window.partitionBy("pick").orderBy(F.desc("high"), F.desc(F.length("term")), "term")
    held = held.withColumn("place", F.row_number().over(by_text)).filter(F.col("place") <= per_text)
    terms_of: dict[int, list[str]] = {}
    for r in held.select("pick", "term").collect():  # at most per_class x per_text
        terms_of.setdefault(r.pick, []).append(r.term)
    lexicon = Lexicon(covering(terms_of, times, min(3, min_support), most_terms))
    clean = words.filter("low > 0 AND low >= high").select("word")
    got = counted(sample.select("y", "pick", "text"), lexicon, clean)
    got = sorted((r.y, r.pick, [r[c] for c in COUNTS]) for r in got.collect())  # at most per_class rows a class
    weights = fitted(np.array([g[2] for g in got], float), np.array([g[0] for g in got], float))
    return Model(lexicon, clean, weights)


COUNTS = ["n_exact", "n_exact_quoted", "n_fuzzy", "n_fuzzy_quoted"]


def _found(lexicon, names: list[str]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(lexicon.value)
        for part in parts:
            found = list(m.found(part.column("text").to_pylist()))
            words = [[{"word": w, "plain": n[0], "quoted": n[1]} for w, n in f.fuzzy.items()] for f in found]
            kind = pa.list_(pa.struct([("word", pa.string()), ("plain", pa.int64()), ("quoted", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in names] + [pa.array([f.exact[k] for f in found], pa.int64()) for k in (0, 1)] + [pa.array(words, kind)],
                [*names, *COUNTS[:2], "fuzzy"],
            )

    return run


def counted(rows: DataFrame, lexicon: Lexicon, clean: DataFrame) -> DataFrame:
    """The columns of ``rows`` but its text, and COUNTS. A fuzzy match counts unless its word is one of ``clean``.

    Clean words stay a table, as they grow with the corpus: those that match anywhere are looked up by a join, so that
    only matches, not texts, are shuffled. Rows without a fuzzy match are not joined.
    """
    spark, names = rows.sparkSession, [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    schema += ", n_exact long, n_exact_quoted long, fuzzy array<struct<word: string, plain: bigint, quoted: bigint>>"
    found = rows.mapInArrow(_found(spark.sparkContext.broadcast(lexicon), names), schema)
    found = materialise(found.withColumn("__row", F.monotonically_increasing_id()), "matches")
    kept = [*names, *COUNTS[:2]]
    none = found.filter("size(fuzzy) = 0").select(*kept, *[F.lit(0).cast("long").alias(c) for c in COUNTS[2:]])
    each = found.filter("size(fuzzy) > 0").select("__row", *kept, F.explode("fuzzy").alias("f"))
    each = each.select("__row", *kept, "f.*")
    matched = materialise(each.select("word").distinct(), "matched")  # written, so that its size is known to the joins
    known = materialise(clean.join(matched, "word", "left_semi").withColumn("known", F.lit(True)), "known")
    some = each.join(known, "word", "left").groupBy("__row", *kept)
    some = some.agg(*[F.sum(F.expr(f"if(known, 0L, {c})")).alias(f"n_{n}") for c, n in (("plain", "fuzzy"), ("quoted", "fuzzy_quoted"))])
    return none.unionByName(some.drop("__row"))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5) and the four match counts of every row, from its text alone.

    Null texts count as empty; a text without a match gets the score of the constant. Without a model scores are 0.
    Rows that repeat come out as often, null ids too. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if model is None:
        scored = rows.select("doc_id", F.lit(0.0).alias("score"), *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    else:
        constant, *weights = model.weights.tolist()
        margin = sum((F.lit(w) * F.log2(1 + F.col(c)) for w, c in zip(weights, COUNTS, strict=True)), F.lit(constant))
        margin = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), margin))
        scored = counted(rows, model.lexicon, model.clean).withColumn("score", 1 / (1 + F.exp(-margin)))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *COUNTS)
