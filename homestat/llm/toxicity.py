"""Toxicity: a learned lexicon, matched through misspellings, weighed by its context."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from homestat.llm.common import ngram_hashes, signed, staged, text_chunks, word_hashes

MAX_TERMS = 200  # terms of the lexicon, the strongest first
LABELLED = 40_000  # labelled documents to learn from at most, the first by a hash of the id
CANDIDATES = 100_000  # terms weighed for the lexicon, those in most toxic documents first
STEMS = range(3, 9)  # lengths of word beginnings that may stand for a family of words
LONGEST = 24  # letters of a term at most; of longer words the first so many are compared
CONTEXT = 80  # characters looked at on either side of a hit
TOKEN = re.compile(r"[\w@$*]+")
# Marks and words of quotation, and of direct address, in the corpus's languages.
QUOTES = "\"“”„«»‘’"
REPORTED = frozenset("said says called wrote word term quote quoted sagte schrieb wort dijo palabra dit mot".split())
ADDRESSED = frozenset("you your youre du dich dein ihr tu te vous toi usted".split())
HITS = ArrayType(StructType([StructField("key", IntegerType()), StructField("share", DoubleType())]))


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool  # any ending may follow

    @property
    def edits(self) -> int:
        """Edits a misspelling may have: short terms none, long ones two; stems as many as words of their length."""
        n = len(self.text)
        return 0 if n < 5 else 1 if n < 8 else 2


class Automaton:
    """Levenshtein automata of all terms, intersected with the lexicon's trie and made deterministic.

    A state is a set of (trie node, edits so far); reading a letter follows it down the
    trie, or spends an edit on a replaced, surplus or missing letter. Edits stop where no
    term below the node allows them. ``word`` and ``stem`` give, for each state, the best
    term that ends there (edits * 2**16 + term, or NONE): as a whole word, or with any
    ending to follow. Letters in no term share one class.
    """

    NONE = np.int32(2**30)

    def __init__(self, terms: Sequence[Term]):
        children: list[dict[str, int]] = [{}]
        ends: list[list[int]] = [[]]
        most = [0]
        for i, t in enumerate(terms):
            node = 0
            most[0] = max(most[0], t.edits)
            for c in t.text:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append([])
                    most.append(0)
                node = children[node][c]
                most[node] = max(most[node], t.edits)
            ends[node].append(i)
        self.letters = {c: k + 1 for k, c in enumerate(sorted({c for t in terms for c in t.text}))}

        def closed(states: dict[int, int]) -> frozenset:
            """With missing letters added, and nothing that a cheaper way to the same node beats."""
            todo = list(states.items())
            while todo:
                node, e = todo.pop()
                if states.get(node, e) < e:
                    continue
                for child in children[node].values():
                    if e + 1 <= most[child] and states.get(child, 99) > e + 1:
                        states[child] = e + 1
                        todo.append((child, e + 1))
            return frozenset(states.items())

        def step(state: frozenset, letter: str) -> frozenset:
            out: dict[int, int] = {}

            def add(node, e):
                if e <= most[node] and out.get(node, 99) > e:
                    out[node] = e

            for node, e in state:
                add(node, e + 1)
                for c, child in children[node].items():
                    add(child, e + (c != letter))
            return closed(out)

        alphabet = ["", *self.letters]  # "" is any other letter
        start = closed({0: 0})
        number, order, rows = {frozenset(): 0, start: 1}, [frozenset(), start], [[0] * len(alphabet)]
        at = 1
        while at < len(order):
            live = {c for node, _ in order[at] for c in children[node]}
            other = step(order[at], "")
            row = []
            for c in alphabet:
                nxt = step(order[at], c) if c in live else other
                if nxt not in number:
                    number[nxt] = len(order)
                    order.append(nxt)
                row.append(number[nxt])
            rows.append(row)
            at += 1
        self.next = np.array(rows, dtype=np.int32)
        self.word, self.stem = (np.array([min(
            [e * 65536 + i for node, e in s for i in ends[node] if e <= terms[i].edits and (not stem or terms[i].stem)],
            default=self.NONE) for s in order], dtype=np.int32) for stem in (False, True))

    def match(self, words: np.ndarray) -> np.ndarray:
        """Best match of each word (edits * 2**16 + term, or NONE): all words advance letter by letter."""
        best = np.full(len(words), self.NONE, dtype=np.int32)
        if not len(words) or len(self.next) < 3:
            return best
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        grid = np.array([w[:LONGEST] for w in words], dtype=f"U{LONGEST}").view(np.uint32).reshape(len(words), LONGEST)
        code = np.zeros(int(max(map(ord, self.letters))) + 2, dtype=np.int32)
        for c, k in self.letters.items():
            code[ord(c)] = k
        live, state = np.arange(len(words)), np.ones(len(words), dtype=np.int32)
        for j in range(LONGEST):
            open_ = lengths[live] > j
            live, state = live[open_], state[open_]
            if not len(live):
                break
            state = self.next[state, code[np.minimum(grid[live, j], len(code) - 1)]]
            on = state > 0
            live, state = live[on], state[on]
            best[live] = np.minimum(best[live], self.stem[state])
            done = lengths[live] == j + 1
            best[live[done]] = np.minimum(best[live[done]], self.word[state[done]])
        return best


def _tokens(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word codes, the different words, and where each text's words begin."""
    lists = [TOKEN.findall(t.lower()) if t else [] for t in texts]
    offsets = np.cumsum([0] + [len(x) for x in lists])
    flat = np.empty(offsets[-1], dtype=object)
    flat[:] = [w for x in lists for w in x]
    codes, words = pd.factorize(flat)
    return codes, words, offsets


def _context(text: str, start: int, end: int) -> int:
    """0: a plain use, 1: quoted or reported, 2: addressed at someone."""
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    near = TOKEN.findall(before.lower())[-5:]
    quoted = (any(q in before for q in QUOTES) and any(q in after for q in QUOTES)) + any(w in REPORTED for w in near)
    abuse = any(w in ADDRESSED for w in (*near, *TOKEN.findall(after.lower())[:5])) + ("!" in after[:20])
    return 1 if quoted > abuse else 2 if abuse else 0


def _hits(texts: Sequence[str | None], automaton: Automaton) -> list[list[tuple[int, float]]]:
    out: list[list[tuple[int, float]]] = [[] for _ in texts]
    codes, words, offsets = _tokens(texts)
    found = automaton.match(words)[codes] if len(words) else codes
    at = np.flatnonzero(found < Automaton.NONE)
    rows = np.searchsorted(offsets, at, side="right") - 1
    for row in np.unique(rows):
        low = texts[row].lower()
        spans = [m.span() for m in TOKEN.finditer(low)]
        uses: dict[int, list[int]] = {}
        for i in at[rows == row]:
            edits, term = divmod(int(found[i]), 65536)
            uses.setdefault(term, []).append(edits * 3 + _context(low, *spans[i - offsets[row]]))
        for term, kinds in sorted(uses.items()):
            often = min(len(kinds), 3) - 1
            out[row] += [((term * 9 + k) * 3 + often, kinds.count(k) / len(kinds)) for k in sorted(set(kinds))]
    return out


def hits_column(text: Column, automaton: Automaton) -> Column:
    """The matches of every text, as (key, share).

    A key is a term, its edits, its context and how often the text has the term (once,
    twice, more); the share is the part of the term's uses that are of this kind.
    """
    @F.pandas_udf(HITS)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = []
            for _, part in text_chunks(batch):
                rows += [[{"key": k, "share": x} for k, x in r] for r in _hits(part, automaton)]
            yield pd.Series(rows, index=batch.index, dtype=object)
    return hits(text)


def _term_counts(keep: frozenset | None = None):
    """For mapInPandas: the words, and beginnings of words, of texts, with their numbers of documents.

    ``n1``, ``n2``, ``n3``: documents that have the term once, twice, three times at
    least. A beginning is written with a trailing ``-``. ``keep``: count these terms only.
    """
    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, part in text_chunks(pdf["text"], 8_000_000):
                codes, words, offsets = _tokens(part)
                doc = np.repeat(np.arange(len(part)), np.diff(offsets))
                for length in (None, *STEMS):
                    names = [w[:LONGEST + 1] if length is None else w[:length] + "-" if len(w) >= length else "" for w in words]
                    term, kinds = pd.factorize(np.array(names, dtype=object))
                    wanted = np.fromiter((3 < len(k) <= LONGEST and (keep is None or k in keep) for k in kinds),
                                         dtype=bool, count=len(kinds))
                    if not wanted.any():
                        continue
                    of = term[codes]
                    use = wanted[of]
                    pairs, often = np.unique(of[use] * len(part) + doc[use], return_counts=True)
                    n = [np.bincount(pairs[often >= k] // len(part), minlength=len(kinds))[wanted] for k in (1, 2, 3)]
                    yield pd.DataFrame({"text": np.asarray(kinds, dtype=object)[wanted], "n1": n[0], "n2": n[1], "n3": n[2]})
    return counts


def _marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Three minima of hashed five-word runs of each text: near copies share them."""
    for pdf in batches:
        for a, part in text_chunks(pdf["text"]):
            words, offsets = word_hashes(part)
            rows = []
            for i in range(len(part)):
                own = words[offsets[i]:offsets[i + 1]]
                grams = ngram_hashes(own, min(5, max(1, len(own))))
                rows.append([int(signed((grams * np.uint64(m))).min()) if len(grams) else 0 for m in (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)])
            yield pd.DataFrame(rows, columns=["m1", "m2", "m3"]).assign(id=pdf["id"].to_numpy()[a:a + len(part)])


def _without_copies(labelled: DataFrame) -> DataFrame:
    """One of each group of near copies (the smallest id by each of three minima), that a copied text counts once."""
    marks = labelled.select("id", "text").mapInPandas(_marks, "m1 long, m2 long, m3 long, id " + dict(labelled.dtypes)["id"])
    for m in ("m1", "m2", "m3"):
        marks = marks.groupBy(m).agg(F.min(F.struct("id", *[x for x in ("m1", "m2", "m3") if x != m])).alias("s")).select(
            m, "s.*")
    return labelled.join(marks.select("id"), "id", "left_semi")


def learn_lexicon(labelled: DataFrame, max_terms: int = MAX_TERMS, candidates: int = CANDIDATES) -> list[Term]:
    """The words, and beginnings of words, that mark toxic documents.

    ``labelled``: id, text and toxic (0 or 1). A term's strength is the log-likelihood
    ratio of the labels of the documents that have it (once, twice or three times at
    least, whichever tells most) against the base rate; it must exceed what chance gives
    among so many terms. Near copies of toxic documents count once. The ``candidates``
    terms in most toxic documents are counted in all clean ones. Of a word and its
    beginnings the strongest is taken, the longest if equal, a whole word before the same
    stem; a shorter stem joins it if it is in three tenths more documents.
    """
    toxic = staged(_without_copies(labelled.where("toxic = 1")))
    n_toxic, n_clean = toxic.count(), labelled.where("toxic = 0").count()
    if not n_toxic or not n_clean:
        return []

    def count(of: DataFrame, keep=None) -> DataFrame:
        rows = of.select("text").mapInPandas(_term_counts(keep), "text string, n1 long, n2 long, n3 long")
        return rows.groupBy("text").agg(*[F.sum(c).alias(c) for c in ("n1", "n2", "n3")])

    terms_of_toxic = staged(count(toxic))
    vocabulary = terms_of_toxic.count()
    common = {r["text"]: r[1:] for r in terms_of_toxic.where("n1 > 2").orderBy(F.desc("n1"), "text").limit(candidates).collect()}
    clean = {r["text"]: r[1:] for r in count(labelled.where("toxic = 0"), frozenset(common)).collect()}
    q = n_toxic / (n_toxic + n_clean)
    found = []
    for text, times in common.items():
        gain = 0.0
        for t, c in zip(times, clean.get(text, (0, 0, 0)), strict=True):
            if t > c:
                gain = max(gain, t * math.log(t / ((t + c) * q)) + (c * math.log(c / ((t + c) * (1 - q))) if c else 0.0))
        if gain > math.log(10.0 * vocabulary):
            found.append((-gain, -len(text.rstrip("-")), text.endswith("-"), text, times[0]))
    terms: dict[Term, int] = {}
    for _, _, stem, text, n in sorted(found):
        text = text.rstrip("-")
        if not any(text.startswith(x.text) and (x.stem or x.text == text) or x.text.startswith(text) and n < 1.3 * m
                   for x, m in terms.items()):
            terms[Term(text, stem)] = n
            if len(terms) == max_terms:
                break
    return list(terms)


def _weights(counts: list, terms: list[Term], base: float) -> list[float]:
    """Log-odds of every key over the base rate, drawn to a prior where it was seldom seen.

    The prior of a plain, exact use is its term's own precision; each edit moves it
    towards one half, and a quoted use starts below one half.
    """
    seen = {r["key"]: (r["t"], r["n"]) for r in counts}
    logit = lambda p: math.log(p / (1 - p))
    out = []
    for i in range(len(terms)):
        own = []  # precision of exact uses by how often: once, twice, more
        for often in range(3):
            exact = [seen.get((i * 9 + c) * 3 + often, (0, 0)) for c in (0, 2)]
            own.append((sum(t for t, _ in exact) + 1) / (sum(n for _, n in exact) + 2))
        for edits in range(3):
            for context in range(3):
                for often in range(3):
                    prior = 0.5 + (own[often] - 0.5) * 0.6**edits - (0.4 if context == 1 else 0)
                    prior = min(max(prior, 0.05), 0.98)
                    t, n = seen.get((i * 9 + edits * 3 + context) * 3 + often, (0, 0))
                    out.append(logit((t + 4 * prior) / (n + 4)) - logit(base))
    return out


def _calibrate(bins: list, base: float, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of label on raw score by Newton's method, over (raw, toxic, n) bins.

    Drawn to what summed log-odds would give by themselves: slope 1, the base rate's log-odds.
    """
    x = np.array([r["raw"] for r in bins], dtype=float)
    y = np.array([r["toxic"] for r in bins], dtype=float)
    n = np.array([r["n"] for r in bins], dtype=float)
    start = np.array([1.0, math.log(base / (1 - base))])
    at, hold = start.copy(), np.array([10.0, 1.0])
    for _ in range(steps if len(n) else 0):
        z = 1 / (1 + np.exp(-np.clip(at[0] * x + at[1], -30, 30)))
        w = n * np.maximum(z * (1 - z), 1e-9)
        g = np.array([np.sum(n * (y - z) * x), np.sum(n * (y - z))]) - hold * (at - start)
        h = np.array([[np.sum(w * x * x), np.sum(w * x)], [np.sum(w * x), np.sum(w)]]) + np.diag(hold)
        move = np.clip(np.linalg.solve(h, g), -2, 2)
        at = at + move
        if np.abs(move).max() < 1e-9:
            break
    return max(float(at[0]), 0.01), float(at[1])


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from training: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """What :func:`fit` learns: its size is bounded by the number of terms."""

    terms: list[Term]
    automaton: Automaton
    weights: list[float]
    slope: float
    intercept: float
    without: float  # log-odds of texts without a match

    def score(self, text: Column) -> Column:
        """0 to 1, from the text alone; null and empty texts score as others without a match."""
        odds = _raw(hits_column(text, self.automaton), self.weights) * self.slope + self.intercept
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.coalesce(odds, F.lit(self.without))))


def _raw(hits: Column, weights: list[float]) -> Column:
    """Summed weights of a text's matches; null if it has none."""
    table = F.array(*map(F.lit, weights or [0.0]))
    return F.aggregate(hits, F.lit(None).cast("double"), lambda s, h: F.coalesce(s, F.lit(0.0)) + F.get(table, h["key"]) * h["share"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_terms: int = MAX_TERMS, labelled: int = LABELLED) -> Model:
    """Learn from at most ``labelled`` labelled documents outside the held-out fifth (:func:`held_out`).

    (1) A lexicon (:func:`learn_lexicon`, at most ``max_terms``); (2) the matches in these
    texts, misspelled ones too, each with its context (plain, quoted, addressed); (3) a
    weight for each term, number of edits, context and how often the text has the term;
    (4) a calibration of the summed weights, of the texts that have a match; texts without
    one score their share of toxic labels, below one half. With no toxic label every text scores the
    base rate. The labels are bounded, and so broadcast; what reaches the driver is
    bounded by ``CANDIDATES``, ``max_terms`` and 0.1-wide score bins.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marks = (labels.select(F.col("doc_id").alias("id"), "toxic").where("toxic in (0, 1) and id is not null")
             .where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("id"), "id").limit(labelled))
    sample = staged(own.join(F.broadcast(staged(marks)), "id").where("text is not null"))
    lexicon = learn_lexicon(sample, max_terms)
    automaton = Automaton(lexicon)
    seen = staged(sample.select("toxic", hits_column(F.col("text"), automaton).alias("hits")))
    base = seen.agg(F.avg("toxic")).first()[0]
    base = min(max(float(0.5 if base is None else base), 0.001), 0.999)
    counts = seen.select("toxic", F.explode("hits.key").alias("key")).groupBy("key").agg(
        F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    weights = _weights(counts, lexicon, base)
    bins = seen.select(F.round(_raw(F.col("hits"), weights), 1).alias("raw"), "toxic").groupBy("raw", "toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()
    bare = {r["toxic"]: r["n"] for r in bins if r["raw"] is None}
    t, n = bare.get(1, 0), sum(bare.values())
    rate = min((t + base) / (n + 1), 0.49) if lexicon else base
    slope, intercept = _calibrate([r for r in bins if r["raw"] is not None], base)
    return Model(lexicon, automaton, weights, slope, intercept, math.log(rate / (1 - rate)))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_terms: int = MAX_TERMS, labelled: int = LABELLED) -> DataFrame:
    """Score every whole text for toxicity, as ``labels.toxic`` (0 or 1) marks it.

    Learns a :class:`Model` (:func:`fit`), then reads every text once, on its own. Only
    texts enter a score. Returns the id, ``held_out``, ``score`` (0 to 1) and
    ``predicted`` (1 from 0.5), a row per row.

    Null and empty texts have no matches and score as other texts without one. Null ids are never
    trained on or held out; repeated rows score alike. Other columns, clashing names too,
    are not read. An empty table gives an empty table.
    """
    model = fit(docs, labels, id_col, text_col, max_terms, labelled)
    ident = F.col(f"`{id_col}`")
    scored = docs.select(ident, model.score(F.col(f"`{text_col}`")).alias("score"))
    return scored.select(ident, held_out(ident).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
