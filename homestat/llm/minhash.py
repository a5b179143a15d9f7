"""Near-duplicate documents by order min-hash, verified by banded alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import SECOND_BASE, RangeHashes, mix64, ngram_hashes, powers, signed, staged, text_chunks, word_hashes
from homestat.llm.components import components, joined

SHINGLE = 2  # words of a k-mer: few, as an edit touches that many
TAKEN = 3  # k-mers taken by each hash function, where ``MOST`` of them allow it
RECALL = 0.995  # share of the least similar pairs that become candidates, wherever their edits are
MOST = 128  # hash functions at most
LONG = 4096  # words from which on a text's length makes no difference to the hash functions it needs
SHORT = {2: 24, 1: 6}  # k-mers also taken, of texts that have so many k-mers at most
FULL = 1024  # texts outside a bucket's largest class above which it is divided by rarest words; up to that many, comparing sets of words costs less
FAN = 32  # tasks' counts that are added at a time
RARITY = 18  # bits of a word's hash under which its documents are counted
BITS = 2048  # of the set that tells most texts apart without an alignment
CELLS = 2_000_000  # places of a band's table, or of a table of ranks, at most; a longer band is aligned by hashes
NARROW = 8  # edits tried first
SMALL, KINDS = 4096, 256  # words up to which every kind's mask is kept; kinds whose masks are kept beyond
LEADERS = 32  # texts kept ready for alignment with others
LAST = np.iinfo(np.uint64).max
SIMILARITY = 0.8  # 1 - edits / words of the longer text, in words


def _room(n: int, held: list[np.ndarray] = [np.empty(0, np.uint64)]) -> np.ndarray:  # noqa: B006
    """``n`` numbers to write in; the same memory for every text, as asking for it anew takes longer than filling it."""
    if len(held[0]) < n:
        held[0] = np.empty(n, np.uint64)
    return held[0][:n]


def order_minhash(words: np.ndarray, odds: np.ndarray, k: int = SHINGLE, taken: int = TAKEN) -> np.ndarray:
    """For each hash function, one number for its ``taken`` least k-mers in the order of the text.

    A k-mer is told from its earlier copies in the text by the number of its occurrence.
    Texts shorter than ``k`` words are one k-mer; fewer k-mers than ``taken`` are all taken.
    An edit may touch most k-mers of a short text, so short texts add the numbers of fewer
    k-mers (``SHORT``), after the others.
    """
    grams = ngram_hashes(words, min(k, len(words)))
    order = np.argsort(grams, kind="stable")
    new = np.concatenate([[True], grams[order][1:] != grams[order][:-1]])
    at = np.arange(len(grams))
    occurrence = np.empty(len(grams), dtype=np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    labelled = mix64(grams + occurrence * SECOND_BASE)
    least = np.empty((len(odds), min(taken, len(grams))), dtype=np.int64)
    step = max(1, CELLS // len(grams))  # hash functions at a time
    for a in range(0, len(odds), step):
        part = odds[a:a + step, None]
        rank = np.multiply(labelled[None, :], part, out=_room(len(part) * len(grams)).reshape(len(part), len(grams)))
        for i in range(least.shape[1]):
            least[a:a + step, i] = rank.argmin(axis=1)
            rank[np.arange(len(rank)), least[a:a + step, i]] = LAST
    out = []
    for t in (taken, *(t for t, most in SHORT.items() if t < taken and len(grams) <= most)):
        number = np.full(len(odds), t, dtype=np.uint64)
        for i in np.sort(least[:, :t], axis=1).T:
            number = mix64(number * SECOND_BASE + grams[i])
        out.append(number)
    return np.concatenate(out)


def functions(similarity: float, k: int = SHINGLE, taken: int = TAKEN) -> tuple[int, int]:
    """How many hash functions find ``RECALL`` of the pairs of that similarity, and the k-mers each takes.

    An edit touches ``k`` k-mers at most, so the share of k-mers that two texts have in
    common has a lower bound, whatever the edits' places. Fewer k-mers are taken where more
    than ``MOST`` functions would be needed; with one k-mer, ``MOST`` are used at most.
    """
    kept = 1 - k * (1 - similarity)
    common = max(kept, 0.0) / (2 - max(kept, 0.0))
    for t in range(taken, 0, -1):
        agree = min(common**t, RECALL)
        n = math.ceil(math.log(1 - RECALL) / math.log(1 - agree)) if agree else MOST + 1
        if n <= MOST:
            return n, t
    return MOST, 1


def functions_by_words(similarity: float, enough: int, taken: int, k: int = SHINGLE) -> np.ndarray:
    """How many hash functions a text of so many words (the place) has: ``enough`` if long, more if short.

    A hash function takes several of a text's k-mers, never one twice, so it agrees less
    often where there are few. Two texts have the functions of the longer one in common, so
    no text has fewer than a longer one. ``MOST`` at most; the shortest texts have their
    own numbers (``SHORT``) and need no more than the longer texts that they may be like.
    """
    words = np.arange(LONG)
    grams = words - k + 1
    same = grams - k * np.floor((1 - similarity) * words + 1e-9)
    agree = np.ones(LONG)
    for i in range(taken):
        agree *= np.clip((same - i) / np.maximum(2 * grams - same - i, 1), 0, RECALL)
    with np.errstate(divide="ignore"):
        number = np.clip(np.ceil(np.log(1 - RECALL) / np.log1p(-agree)), enough, max(enough, MOST))
    short = SHORT[2] + k if taken > 2 else 0
    number[:short] = enough
    return np.maximum.accumulate(number[::-1])[::-1].astype(int)


def word_bits(words: np.ndarray) -> np.ndarray:
    """The words, each told from its earlier copies, on `BITS` bits in 64-bit numbers: whether an odd number of them is at a place.

    A word taken away or added changes one bit, one put in another's place two. So texts need
    no alignment whose bits differ in more places than twice the edits that are allowed, less
    the difference of their lengths. Unlike bits that say whether any word is there, these
    tell full sets apart too.
    """
    place = labelled_words(words) >> np.uint64(64 - BITS.bit_length() + 1)
    bits = np.bincount(place.astype(np.int64), minlength=BITS).astype(np.uint8) & 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def labelled_words(words: np.ndarray) -> np.ndarray:
    """Hashes of the words, each told from its earlier copies in the text."""
    order = np.argsort(words, kind="stable")
    new = np.concatenate([[True], words[order][1:] != words[order][:-1]])
    at = np.arange(len(words))
    occurrence = np.empty(len(words), dtype=np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix64(words + occurrence * SECOND_BASE)


def sketch_odds(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Aligned:
    """A text's words, made ready for alignment."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.kinds, self.counts = np.unique(words, return_counts=True)
        self._masks: dict[int, int] = {}

    @cached_property
    def hashes(self) -> RangeHashes:
        return RangeHashes(self.words)

    @cached_property
    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """The places of all words, kind by kind in order, and where each kind's begin."""
        return np.argsort(self.words, kind="stable"), np.concatenate([[0], np.cumsum(self.counts)])

    def mask(self, kind: int, start: int, width: int) -> int:
        """One bit for each of the places from ``start`` on (``width`` of them) that hold the kind.

        Whole masks are kept of frequent kinds alone (at most ``KINDS`` of them in a long
        text), so that memory grows with the text only.
        """
        whole = self._masks.get(kind)
        if whole is None:
            order, begins = self.places
            at = order[begins[kind]:begins[kind + 1]]
            if len(self.words) > SMALL and len(at) * KINDS < len(self.words):
                return sum(1 << p for p in (at[(at >= start) & (at < start + width)] - start).tolist())
            whole = self._masks[kind] = sum(1 << p for p in at.tolist())
        return (whole >> start if start >= 0 else whole << -start) & ((1 << width) - 1)


def _extend(a: Aligned, b: Aligned, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from ``i`` in ``a`` equal those from ``j`` in ``b``, by hashes of runs."""
    room = np.minimum(len(a.words) - i, len(b.words) - j)
    out = np.zeros(len(i), dtype=np.int64)
    live = np.flatnonzero(room > 0)
    live = live[a.words[i[live]] == b.words[j[live]]]
    if len(live):
        step = 1 << int(room[live].max()).bit_length()
        while step:
            end = out[live] + step
            fits = live[end <= room[live]]
            x, y, n = i[fits], j[fits], out[fits]
            same = a.hashes.plain(x + n, x + n + step) == b.hashes.plain(y + n, y + n + step)
            out[fits[same]] += step
            step >>= 1
    return out


def _runs(a: Aligned, b: Aligned, band: int) -> np.ndarray:
    """For each diagonal of the band and each place in ``a``, the first place from there that differs."""
    n, m = len(a.words), len(b.words)
    padded = np.concatenate([np.zeros(band, np.uint64), b.words, np.zeros(band + max(0, n - m) + 1, np.uint64)])
    lined = np.lib.stride_tricks.sliding_window_view(padded, n)[: 2 * band + 1]
    at = np.arange(n, dtype=np.int32)
    k = np.arange(-band, band + 1, dtype=np.int32)[:, None]
    same = (lined == a.words[None, :]) & (at + k >= 0) & (at + k < m)
    stop = np.where(same, np.int32(n), at[None, :])
    out = np.full((2 * band + 1, n + 1), n, dtype=np.int32)
    out[:, :n] = np.minimum.accumulate(stop[:, ::-1], axis=1)[:, ::-1]
    return out


def _reaches(a: Aligned, b: Aligned, limit: int) -> bool:
    """Whether the ends are reached by ``limit`` edits, inside the band that so many edits allow.

    For each number of edits, the furthest place reached on every diagonal; runs of equal
    words are jumped, by a table of the band or, where that would be large, by hashes.
    """
    n, m = len(a.words), len(b.words)
    runs = _runs(a, b, limit) if (2 * limit + 1) * n <= CELLS else None
    diagonals = np.arange(-limit - 1, limit + 2)  # j - i; the outermost two stay unreachable
    far = np.full(len(diagonals), -(2**40), dtype=np.int64)
    mid, goal = limit + 1, limit + 1 + m - n
    for d in range(limit + 1):
        lo, hi = mid - d, mid + d + 1
        if d == 0:
            now = np.zeros(1, dtype=np.int64)
        else:
            now = np.maximum(np.maximum(far[lo:hi] + 1, far[lo - 1:hi - 1]), far[lo + 1:hi + 1] + 1)
        k = diagonals[lo:hi]
        now = np.minimum(now, np.minimum(n, m - k))
        on = np.flatnonzero((now >= 0) & (now + k >= 0))
        if runs is None:
            now[on] += _extend(a, b, now[on], now[on] + k[on])
        else:
            now[on] = runs[lo - 1 + on, now[on]]
        now = np.minimum(now, np.minimum(n, m - k))
        far[lo:hi] = now
        if lo <= goal < hi and far[goal] >= n:
            return True
    return False


def _aligns(a: Aligned, b: Aligned, limit: int) -> bool:
    """Whether the edits are at most ``limit``, by the band's columns as whole numbers.

    A column of the table of edits, from ``limit`` rows above the diagonal to as many
    below, is kept as two bit sets: rows that cost one more than the row above them, and
    rows that cost one less. A word of ``b`` turns one column into the next with a few
    operations on all rows at once; the cost of the band's lowest row is carried along.
    """
    n, m = len(a.words), len(b.words)
    kinds = np.searchsorted(a.kinds, b.words)
    known = a.kinds[np.minimum(kinds, len(a.kinds) - 1)] == b.words
    width = 2 * limit + 1
    every = (1 << width) - 1
    up, down = every ^ ((1 << limit) - 1), 0
    cost, most = min(n, limit), 2 * limit + m - n  # a cost above that cannot fall to the limit any more
    for j, kind in enumerate(np.where(known, kinds, -1).tolist(), 1):
        same = a.mask(kind, j - limit - 1, width) if kind >= 0 else 0
        free = (((same & up) + up) ^ up | same | down) & every  # rows that cost what the cell up and left does
        more, less = (down | ~(free | up)) & every, free & up  # than the cell to the left
        if j + limit <= n:
            cost += 1 - (free >> (width - 1))
        else:
            row = n - j + limit
            cost += (more >> row & 1) - (less >> row & 1)
        if cost > most:
            return False
        free >>= 1  # the band's next column lies one row lower
        up, down = (less | ~(free | more)) & every, free & more
    return cost <= limit


def within(a: Aligned, b: Aligned, limit: int) -> bool:
    """Whether ``a`` becomes ``b`` by at most ``limit`` changed, added or left-out words.

    A banded alignment: by furthest-reaching diagonals in a narrow band, as most copies
    need few edits, then column by column in the band of the limit.
    """
    n, m = len(a.words), len(b.words)
    if abs(n - m) > limit:
        return False
    _, x, y = np.intersect1d(a.kinds, b.kinds, assume_unique=True, return_indices=True)
    if max(n, m) - np.minimum(a.counts[x], b.counts[y]).sum() > limit:
        return False  # words that the other lacks must be changed
    if abs(n - m) <= NARROW and _reaches(a, b, min(limit, NARROW)):
        return True
    return limit > NARROW and _aligns(a, b, limit)


def _sketches(odds: np.ndarray, taken: int, number: np.ndarray):
    def sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, part in text_chunks(pdf["text"], 2_000_000):
                words, offsets = word_hashes(part)
                rows = []
                for i in range(len(part)):
                    own = words[offsets[i]:offsets[i + 1]]
                    if len(own):
                        t = [int(signed(mix64((own * powers(base, len(own))).sum(keepdims=True) + np.uint64(len(own))))[0])
                             for base in (SECOND_BASE, np.uint64(3))]
                        rows.append((pdf["id"].iat[a + i], pdf["h"].iat[a + i], *t, len(own), signed(word_bits(own)),
                                     signed(order_minhash(own, odds[: number[min(len(own), len(number) - 1)]], taken=taken))))
                yield pd.DataFrame(rows, columns=["id", "h", "t1", "t2", "n", "bits", "sketch"])
    return sketches


def _verified(similarity: float):
    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            known: dict[int, Aligned] = {}  # some leaders: each has many pairs
            keep = []
            for start, part in text_chunks(pdf["text_b"]):
                words, offsets = word_hashes(part)
                for i in range(len(part)):
                    a = pdf["a"].iat[start + i]
                    if a not in known:
                        if len(known) == LEADERS:
                            known.clear()
                        known[a] = Aligned(word_hashes([pdf["text_a"].iat[start + i]])[0])
                    other = Aligned(words[offsets[i]:offsets[i + 1]])
                    longest = max(len(known[a].words), len(other.words))
                    keep.append(within(known[a], other, int((1 - similarity) * longest + 1e-9)))
            yield pdf.loc[keep, ["a", "b"]]
    return verified


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a task: in how many of its texts each place's words are."""
    count = np.zeros(2**RARITY, dtype=np.int64)
    for pdf in batches:
        for _, part in text_chunks(pdf["text"]):
            words, offsets = word_hashes(part)
            own = [labelled_words(words[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            places, n = np.unique(np.concatenate(own) >> np.uint64(64 - RARITY), return_counts=True)
            count[places.astype(np.int64)] += n
    if count.any():
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "counts": [_packed(count)]})


def _packed(count: np.ndarray) -> bytes:
    return np.minimum(count, 2**31 - 1).astype(np.int32).tobytes()


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, dtype=np.int32).astype(np.int64) for c in pdf["counts"])
    return pd.DataFrame({"part": pdf["part"].iloc[:1] // FAN, "counts": [_packed(total)]})


def _word_counts(texts: DataFrame) -> np.ndarray:
    """How often each place's words are in ``texts``: the tasks' counts, added ``FAN`` at a time to one row."""
    parts = staged(texts.mapInPandas(_frequencies, "part int, counts binary"))
    while parts.limit(2).count() > 1:
        parts = staged(parts.groupBy((F.col("part") / FAN).cast("int")).applyInPandas(_added, parts.schema))
    rows = parts.collect()  # of 2**RARITY numbers, one at most
    return np.frombuffer(rows[0]["counts"], dtype=np.int32) if rows else np.zeros(2**RARITY, dtype=np.int32)


def _rarest(count: np.ndarray, similarity: float):
    """For mapInPandas: the rarest words of each text, one more than it may lack of a similar text's.

    In one order of all words, two texts that share ``similarity`` of the longer one's
    words have one of these in common.
    """
    def rarest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for _, part in text_chunks(pdf["text"]):
                words, offsets = word_hashes(part)
                for i in range(len(part)):
                    own = labelled_words(words[offsets[i]:offsets[i + 1]])
                    order = np.lexsort((own, count[own >> np.uint64(64 - RARITY)]))
                    rows.append(signed(own[order[: len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1]]))
            yield pd.DataFrame({"node": pdf["node"], "rare": pd.Series(rows, index=pdf.index, dtype=object)})
    return rarest


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                    sketches: int | None = None, seed: int = 11) -> DataFrame:
    """The class of near-duplicates each document belongs to.

    Two texts are linked if their word sequences turn into each other by edits of at most
    ``1 - similarity`` of the longer one's words; a class is what links connect, and its
    id the smallest document id in it. Candidates share a number of their order min-hash
    sketches (:func:`order_minhash`; as many as ``similarity`` needs, :func:`functions`,
    if ``sketches`` does not say); every link is verified by banded alignment
    (:func:`within`). Equal word sequences are one text from the start.

    Returns the id and ``class_id``, a row per row. Null and empty texts, and rows with a
    null id, are in no class but their own (``class_id`` is the id). Rows of equal id are
    one document: their texts' classes are joined. Other columns, clashing names too, are
    not read. An empty table gives an empty table.

    Inside a bucket of equal sketches no list of all pairs is made: every text is compared
    with the bucket's first (by a number given to each different text), and no more with
    those of its other buckets that are in its class by then. Then all texts of a bucket
    that are of different classes by then are compared, those outside its largest class
    with all others. A large group of near copies thus costs a few comparisons a text.
    Pairs whose lengths or sets of words alone differ too much are left out (exactly:
    :func:`word_bits`). A bucket with more than ``FULL`` texts outside its largest class,
    as of unlike texts around one passage, is divided by the texts' rarest words
    (:func:`_rarest`): similar texts share one of them, so this loses no pair. A link can
    be missed only if no sketch agrees (about 1 - ``RECALL`` of the links of least
    similarity are expected to).
    """
    kind = dict(docs.dtypes)[id_col]
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # with the id, a hash of the text tells which of the id's texts is meant
    texts = own.where("id is not null and text is not null").withColumn("h", F.xxhash64("text"))
    enough, taken = functions(similarity)
    number = np.array([sketches]) if sketches else functions_by_words(similarity, enough, taken)
    marked = staged(texts.mapInPandas(_sketches(sketch_odds(int(number.max()), seed), taken, number),
                                      f"id {kind}, h long, t1 long, t2 long, n int, bits array<bigint>, sketch array<bigint>"))
    # each different text has a number, and stands for all its ids until the classes are read off
    firsts = marked.groupBy("t1", "t2").agg(
        F.min(F.struct(F.col("id").alias("rep"), "h")).alias("at"), *[F.first(c).alias(c) for c in ("n", "bits", "sketch")])
    firsts = staged(firsts.sortWithinPartitions("t1", "t2").select(
        F.monotonically_increasing_id().alias("node"), "t1", "t2", "at.*", "n", "bits", "sketch"))
    bands = firsts.select("node", F.posexplode("sketch").alias("band", "value"))
    buckets = bands.groupBy("band", "value").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("size"))
    # a table of its own, so that the join with it can split the rows of a full bucket
    buckets = staged(buckets.where("size > 1"))
    members = staged(bands.join(buckets, ["band", "value"]))
    needed = members.select("node").distinct().join(firsts.select("node", F.col("rep").alias("id"), "h"), "node")
    store = staged(texts.join(needed, ["id", "h"]).groupBy("node").agg(F.min("text").alias("text")))

    marks = firsts.select("node", "n", "bits")

    def can_be_alike(x: str, y: str):
        """What the lengths and sets of words of two such similar texts fulfil."""
        n, m = F.col(f"{x}n"), F.col(f"{y}n")
        apart = sum((F.bit_count(F.get(F.col(f"{x}bits"), F.lit(i)).bitwiseXOR(F.get(F.col(f"{y}bits"), F.lit(i))))
                     for i in range(BITS // 64)), F.lit(0))
        return (F.greatest(n, m) * similarity <= F.least(n, m) + 1e-6) & (
            apart + F.abs(n - m) <= 2 * (1 - similarity) * F.greatest(n, m) + 1e-6)

    def alike(pairs: DataFrame) -> DataFrame:
        x, y = (marks.select(F.col("node").alias(end), F.col("n").alias(f"{p}n"), F.col("bits").alias(f"{p}bits"))
                for end, p in (("a", "x_"), ("b", "y_")))
        return pairs.join(x, "a").join(y, "b").where(can_be_alike("x_", "y_")).select("a", "b")

    # texts that share an id are linked without a comparison
    several = marked.groupBy("id").agg(F.countDistinct("t1", "t2").alias("n")).where("n > 1").select("id")
    several = marked.join(several, "id", "left_semi").join(firsts.select("t1", "t2", "node"), ["t1", "t2"]).select("id", "node")
    twice = several.join(several.groupBy("id").agg(F.min("node").alias("a")), "id").where("a <> node").select("a", F.col("node").alias("b"))

    def verify(pairs: DataFrame) -> DataFrame:
        left = store.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = store.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(right, "b").join(left, "a")
        return both.mapInPandas(_verified(similarity), "a long, b long")

    def classed(nodes: DataFrame, classes: DataFrame, node: str, name: str) -> DataFrame:
        known = classes.select(F.col("id").alias("_id"), F.col("class").alias("_of"))
        return nodes.join(known, F.col(node) == F.col("_id"), "left").withColumn(name, F.coalesce("_of", node)).drop("_id", "_of")

    def linked(pairs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
        """The classes after all links among ``pairs``: each text with one other, then with those not in its class by then."""
        first = staged(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
        links = verify(first)
        classes = components(links.unionByName(twice)) if classes is None else joined(classes, staged(links))
        rest = classed(classed(pairs.join(first, ["a", "b"], "left_anti"), classes, "a", "_a"), classes, "b", "_b")
        rest = staged(verify(rest.where("_a <> _b").select("a", "b")))
        return joined(classes, rest) if rest.limit(1).count() else classes

    def mixed(rows: DataFrame, by: list[str]) -> DataFrame:
        """The rows of groups of several classes, with the class that most are of (``main``) and the number of others (``strays``)."""
        sizes = rows.groupBy(*by, "class").agg(F.count(F.lit(1)).alias("size"))
        groups = sizes.groupBy(*by).agg(F.count(F.lit(1)).alias("classes"), F.sum("size").alias("size"), F.max(F.struct("size", "class")).alias("main"))
        groups = staged(groups.where("classes > 1").select(*by, F.col("main.class").alias("main"), (F.col("size") - F.col("main.size")).alias("strays")))
        return staged(rows.join(groups, by).join(marks, "node"))

    def across(rows: DataFrame, by: list[str]) -> DataFrame:
        """The pairs of a group's texts that are of two classes and can be alike: strays with all, so the main class has no pairs of its own.

        Where rows say which buckets they were in before (``before``), a pair is listed in its first alone.
        """
        own = [c for c in rows.columns if c in ("node", "class", "n", "bits", "before")]
        other = rows.select(*by, *[F.col(c).alias(f"_{c}") for c in own])
        pairs = rows.where("class <> main").join(other, by).where("class <> _class and (_class = main or class < _class)")
        pairs = pairs.where(can_be_alike("", "_"))  # within the join, so that no other pair leaves it
        pairs = pairs.where(~F.arrays_overlap("before", "_before")) if "before" in own else pairs
        return pairs.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b"))

    tried = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    tried = staged(alike(tried))
    classes = linked(tried)
    # whatever else shares a bucket and is of another class by then
    buckets = mixed(classed(members.where("size > 2 and node <> leader").select("band", "value", "node"), classes, "node", "class"), ["band", "value"])
    # a bucket's texts of two classes meet in it, below under rarest words, or one of them is its first and they were tried
    before = F.slice(F.transform("sketch", lambda value, band: F.xxhash64(band, value)), 1, F.col("band")).alias("before")
    listed = buckets.where(F.col("strays") <= FULL).join(firsts.select("node", "sketch"), "node").select(*buckets.columns, before)
    pairs = across(staged(listed), ["band", "value"])
    crowd = staged(store.join(buckets.where(F.col("strays") > FULL).select("node").distinct(), "node", "left_semi"))
    if crowd.limit(1).count():
        # the texts of full buckets meet under their rarest words, whichever buckets they share
        rare = crowd.mapInPandas(_rarest(_word_counts(crowd), similarity), "node long, rare array<bigint>")
        rare = staged(classed(rare, classes, "node", "class").select("node", "class", F.explode("rare").alias("key")))
        pairs = pairs.unionByName(across(mixed(rare, ["key"]), ["key"]))
    pairs = staged(pairs.distinct().join(tried, ["a", "b"], "left_anti"))
    classes = linked(pairs, classes)
    smallest = classes.join(firsts.select(F.col("node").alias("id"), "rep"), "id").groupBy("class").agg(F.min("rep").alias("smallest"))
    named = classes.join(smallest, "class").select(F.col("id").alias("node"), "smallest")
    found = marked.join(firsts.select("t1", "t2", "node", "rep"), ["t1", "t2"]).join(named, "node", "left").groupBy("id").agg(
        F.min(F.coalesce("smallest", "rep")).alias("class"))
    out = own.select("id").join(found, "id", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("class", "id").alias("class_id"))
