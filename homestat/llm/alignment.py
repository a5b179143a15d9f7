"""Cross-tokenizer alignment: which tokens of two tokenizers overlap, counted over a corpus by minimal perfect hashing."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.llm.common import chunks, mix64, staged

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
CUT = re.compile(" (?<=[!-~À-ɏ] )(?=[!-~À-ɏ])")  # one space between characters that are surely no white space
PLAIN = re.compile("[!-~À-ɏ]+")  # a word of such characters only
# Fixed value: how a byte-level vocabulary of this kind parts a text before it merges.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHARDS = 256
SLICE = 1_000_000  # characters that are aligned together
KEPT_LINKS = 4_000_000  # links of words that a worker remembers
HELD_PAIRS = 2_000_000  # counts of a task that wait to be merged
FAN = 32  # partial vectors that are added by one task, level by level


# --- minimal perfect hash -----------------------------------------------------------


def shard_of(codes: np.ndarray) -> np.ndarray:
    return (mix64(codes.astype(np.uint64)) >> np.uint64(56)).astype(np.int64)


def _slots(codes: np.ndarray, level: int, size) -> np.ndarray:
    return (mix64(codes.astype(np.uint64) * np.uint64(2 * level + 3) + np.uint64(level + 1)) % np.asarray(size, dtype=np.uint64)).astype(np.int64)


def build_levels(codes: np.ndarray) -> list[np.ndarray]:
    """Bits of a minimal perfect hash of different whole numbers, level by level.

    Each level has two slots a key; a key alone in its slot sets the bit and is done, the
    others go on to the next level. A key's hash is the number of bits set before its own.
    """
    levels = []
    while len(codes):
        at = _slots(codes, len(levels), 2 * len(codes))
        alone = np.bincount(at, minlength=2 * len(codes)) == 1
        levels.append(alone)
        codes = codes[~alone[at]]
    return levels


class MinimalHash:
    """Minimal perfect hash of the keys of several shards, each hashed on its own, numbered one after another."""

    def __init__(self, shards: Sequence[tuple[int, Sequence[int], bytes]]):
        """``shards``: (shard, level sizes, packed bits of all levels), as :func:`build_levels` makes them."""
        depth = max([len(sizes) for _, sizes, _ in shards], default=0)
        self.size = np.zeros((SHARDS, depth), dtype=np.int64)
        self.base = np.zeros((SHARDS, depth), dtype=np.int64)
        bits, at = [], 0
        for shard, sizes, packed in shards:
            self.size[shard, :len(sizes)] = sizes
            self.base[shard, :len(sizes)] = at + np.cumsum([0, *sizes[:-1]])
            bits.append(np.unpackbits(np.frombuffer(packed, np.uint8), count=int(sum(sizes))))
            at += int(sum(sizes))
        packed = np.packbits(np.concatenate(bits) if bits else np.empty(0, np.uint8), bitorder="little")
        self.words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int64)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """The hash of each key; for what is no key any number of a key, or -1."""
        out, shard, left = np.full(len(codes), -1, np.int64), shard_of(codes), np.arange(len(codes))
        for level in range(self.size.shape[1]):
            size = self.size[shard[left], level]
            left, size = left[size > 0], size[size > 0]
            at = self.base[shard[left], level] + _slots(codes[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            found = (word >> bit) & np.uint64(1) > 0
            rank = self.before[at >> 6] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[found]] = rank[found]
            left = left[~found]
        return out


# --- two tokenizers -------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Numbered(dict):
    """Words by number: an unknown one that is looked up gets the next, and is listed as new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Aligner:
    """Aligns texts under a byte-level BPE (A) and a piece model (B), remembering the words seen.

    A text is taken with a space before it. Neither tokenizer joins anything across a single
    space between two non-spaces, so there both end a token, and each word between such
    spaces can be encoded and aligned by itself, once.
    """

    def __init__(self, byte_level: str, pieces: bytes):
        """``byte_level``: the JSON of a byte-level tokenizer; ``pieces``: a SentencePiece model."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        letters = _byte_letters()
        self.a_bytes = {i: bytes(letters.get(c, 0) for c in t) for t, i in self.a.get_vocab().items()}
        # the same merges by rank, for plain words: faster, and equal where tokens are numbered in the order of their merges
        special = set(self.a.get_added_tokens_decoder())
        self.quick = tiktoken.Encoding("a", pat_str=PARTS, special_tokens={}, mergeable_ranks={
            t: i for i, t in self.a_bytes.items() if i not in special})
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.n_a, self.n_b = max(self.a_bytes) + 1, len(self.b_bytes)
        self.a_size = np.array([len(self.a_bytes.get(i, b"")) for i in range(self.n_a)])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        # a token as it is written inside a group and at the end of its side of it
        self.written = np.array([f"{i}{end}" for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")) for end in ends for i in range(n)], dtype=object)
        self.weigh: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None
        self._forget()

    def _forget(self) -> None:
        self.known = Numbered()
        self.numbers = np.empty((0, 6), np.int64)  # tokens of A, of B, groups, whether bytes differ; best links, sum of counts
        self.links, self.at = np.empty(0, np.int64), np.zeros(1, np.int64)
        self.codes, self.code_at = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _encoded(self, words: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of A of all words and each word's number of them, the same of B, and which words they do not spell."""
        raw = [(" " + w).encode() for w in words]
        size = np.array([len(r) for r in raw])
        ids = None
        if plain:  # side by side they encode as each by itself
            ids = [i for k in range(0, len(words), 500) for i in self.quick.encode_ordinary(" " + " ".join(words[k:k + 500]))]
        if ids is not None and b"".join([self.a_bytes[i] for i in ids]) == b"".join(raw):
            a = np.array(ids, np.int64)
            n_a = np.diff(np.searchsorted(np.cumsum(self.a_size[a]), np.concatenate([[0], np.cumsum(size)]), side="right"))
        else:
            ids = [e.ids for e in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
            a, n_a = np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids])
        ids = self.b.encode(words, num_threads=1)
        b, n_b = np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids])
        bad = np.zeros(len(words), bool)
        if b"".join([self.a_bytes[i] for i in a.tolist()] + [self.b_bytes[i] for i in b.tolist()]) != b"".join(raw) * 2 or (
                _per(self.a_size[a], n_a) != size).any() or (_per(self.b_size[b], n_b) != size).any():
            ends_a, ends_b = np.cumsum([0, *n_a]).tolist(), np.cumsum([0, *n_b]).tolist()
            for k, r in enumerate(raw):
                bad[k] = (b"".join([self.a_bytes[i] for i in a[ends_a[k]:ends_a[k + 1]].tolist()]) != r
                          or b"".join([self.b_bytes[i] for i in b[ends_b[k]:ends_b[k + 1]].tolist()]) != r)
            a, b = a[~np.repeat(bad, n_a)], b[~np.repeat(bad, n_b)]
            n_a, n_b = np.where(bad, 0, n_a), np.where(bad, 0, n_b)
        return a, n_a, b, n_b, bad

    def _learn(self, words: list[str], plain: bool) -> None:
        """Aligns new words all at once: the links are the pieces into which the tokens of A and B cut the bytes together."""
        a, n_a, b, n_b, bad = self._encoded(words, plain)
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cuts = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        both = cuts[:-1][cuts[1:] == cuts[:-1]] if len(cuts) else cuts  # where tokens of both end
        cuts = cuts[np.concatenate([[True], cuts[1:] != cuts[:-1]])] if len(cuts) else cuts
        links = a[np.searchsorted(end_a, cuts)] * self.n_b + b[np.searchsorted(end_b, cuts)] if len(cuts) else cuts
        stop = np.concatenate([[0], np.cumsum(_per(self.a_size[a], n_a))])  # the words' ends
        fresh = np.zeros((len(words), 6), np.int64)
        fresh[:, 0], fresh[:, 1], fresh[:, 3] = n_a, n_b, bad
        fresh[:, 2] = np.diff(np.searchsorted(both, stop, side="right"))
        ends = np.searchsorted(cuts, stop, side="right")
        if self.weigh is not None:  # else the pairs alone are asked for
            for k, value in enumerate(self.weigh(links)):
                sums = np.concatenate([[0], np.cumsum(value)])
                fresh[:, 4 + k] = sums[ends[1:]] - sums[ends[:-1]]
            group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
            codes = np.empty(len(a) + len(b), np.int32)  # a group's tokens of A, then those of B
            codes[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = a + np.where(both[group_a] == end_a, self.n_a, 0) if len(a) else a
            codes[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = (
                b + 2 * self.n_a + np.where(both[group_b] == end_b, self.n_b, 0) if len(b) else b)
            self.codes = np.concatenate([self.codes, codes])
            self.code_at = np.concatenate([self.code_at, self.code_at[-1] + np.cumsum(n_a + n_b)])
        self.numbers = np.concatenate([self.numbers, fresh])
        self.links, self.at = np.concatenate([self.links, links]), np.concatenate([self.at, self.at[-1] + ends[1:]])

    def words(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts one after another, and where each text's begin and end."""
        if len(self.links) > KEPT_LINKS:
            self._forget()
        lists, first = [CUT.split(t) if t else [] for t in texts], len(self.known)
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(lists)), np.int64)
        if self.known.new:
            new, self.known.new = self.known.new, []
            plain = np.array([PLAIN.fullmatch(w) is not None for w in new])
            order = np.argsort(~plain, kind="stable")
            new, n = [new[i] for i in order.tolist()], int(plain.sum())
            self.known.update(zip(new, range(first, first + len(new)), strict=True))
            at = np.arange(first + len(new))
            at[first + order] = np.arange(first, first + len(new))
            flat = at[flat]
            for words, kind in ((new[:n], True), (new[n:], False)):
                if words:
                    self._learn(words, kind)
        return flat, np.cumsum([0] + [len(x) for x in lists])

    def aligned(self, texts: Sequence[str | None]) -> tuple[np.ndarray, list[str]]:
        """Per text: tokens of A, of B, groups, links, best links, sum of counts; and the groups themselves. Needs ``weigh``."""
        flat, ends = self.words(texts)
        every = np.concatenate([self.numbers[flat], np.diff(self.at)[flat][:, None]], axis=1)
        sums = np.concatenate([np.zeros((1, 7), np.int64), np.cumsum(every, axis=0)])
        sums = sums[ends[1:]] - sums[ends[:-1]]
        fine = sums[:, 3] == 0
        sums = np.where(fine[:, None], sums, 0)
        n = np.diff(self.code_at)[flat]
        stop = np.cumsum(n)
        parts = self.written[self.codes[np.repeat(self.code_at[flat] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]].tolist()
        edge = np.concatenate([[0], stop])[ends].tolist()
        groups = ["".join(parts[edge[i]:edge[i + 1]])[:-1] if fine[i] else "" for i in range(len(texts))]
        return sums[:, [0, 1, 2, 6, 4, 5]], groups

    def pairs(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The different linked pairs of the texts, as ``a * n_b + b``, and how many of the texts hold each."""
        flat, ends = self.words(texts)
        of = np.repeat(np.arange(len(texts)), np.diff(ends))
        fine = np.bincount(of, self.numbers[flat, 3], minlength=len(texts)) == 0
        once, _ = _distinct((of * max(1, len(self.known)) + flat)[fine[of]])
        of, word = np.divmod(once, max(1, len(self.known)))
        n = np.diff(self.at)[word]
        stop = np.cumsum(n)
        link = self.links[np.repeat(self.at[word] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]
        span = int(link.max(initial=0)) + 1
        return _distinct(_distinct(np.repeat(of, n) * span + link)[0] % span)


_last: tuple | None = None  # a worker's aligner, and what it is for


def kept_aligner(files: tuple[str, bytes], table=None) -> Aligner:
    """The worker's aligner of these vocabularies (and look-up table): one task's words help the next one's."""
    global _last
    if _last is None or _last[0] != files or _last[1] is not table:
        _last = (files, table, Aligner(*files))
    return _last[2]


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values, ascending, and how often each is there."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    return values[first], np.diff(np.append(first, len(values)))


def _per(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of values."""
    sums, ends = np.concatenate([[0], np.cumsum(values)]), np.concatenate([[0], np.cumsum(counts)])
    return sums[ends[1:]] - sums[ends[:-1]]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    texts = batch.column(column).to_pylist()
    for start, stop in chunks([len(t or "") for t in texts], SLICE):
        yield batch.slice(start, stop - start), texts[start:stop]


# --- counting pairs over the corpus ------------------------------------------------------


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = np.concatenate([c for c, _ in held]), np.concatenate([n for _, n in held])
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def _by_shard(codes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    shard = shard_of(codes)
    order = np.argsort(shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(SHARDS + 1))
    for s in range(SHARDS):
        if edges[s + 1] > edges[s]:
            own = order[edges[s]:edges[s + 1]]
            yield s, codes[own], counts[own]


def _binary_rows(rows, names: Sequence[str]) -> pa.RecordBatch:
    """Rows of a shard number and arrays, the arrays as bytes."""
    rows = list(rows)
    columns = [pa.array([r[0] for r in rows], pa.int32())]
    for k in range(1, len(names)):
        columns.append(pa.array([np.asarray(r[k], np.int64).tobytes() for r in rows], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=list(names))


def _numbers(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), np.int64)


class Alignment:
    """Two tokenizers and the corpus-wide counts of the pairs of their tokens that overlap.

    The pairs of each task's documents are counted in the task. Their different codes, shard
    by shard, get a minimal perfect hash; every task's counts then become a dense vector in
    the order of the hash, and vectors are added level by level, ``FAN`` at a time. A look-up
    hashes a pair, compares the key stored there with it and reads the count.

    What grows with the corpus is the number of different pairs, and only as far as bytes of
    two vocabularies can overlap. Hash, keys and counts (about 17 bytes a pair) reach the
    tasks ``pairs_a_pass`` pairs at a time: beyond that, documents are aligned again for each
    part of the pairs and the parts' sums added.
    """

    def __init__(self, spark: SparkSession, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, pairs_a_pass: int = 16_000_000):
        self.spark, self.pairs_a_pass = spark, pairs_a_pass
        with open(byte_level, encoding="utf-8") as f, open(pieces, "rb") as g:
            self.files = spark.sparkContext.broadcast((f.read(), g.read()))  # the vocabularies' size

    def count(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """How many documents link each pair: per shard its hash (``sizes, bits``), ``keys`` and ``counts`` in hash order.

        A table of at most ``SHARDS`` rows whose columns hold arrays of bytes (longs but for ``bits``)."""
        files = self.files

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner, held = kept_aligner(files.value), []
            for batch in batches:
                for _, texts in slices(batch, "text"):
                    held.append(aligner.pairs(texts))
                    if sum(len(c) for c, _ in held) > HELD_PAIRS:
                        held = [_merged(held)]
                        if len(held[0][0]) > HELD_PAIRS // 2:
                            yield _binary_rows(_by_shard(*held.pop()), ("shard", "codes", "counts"))
            if held:
                yield _binary_rows(_by_shard(*_merged(held)), ("shard", "codes", "counts"))

        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: dict[int, np.ndarray] = {}
            for batch in batches:
                own: dict[int, list] = {}
                for shard, codes in zip(batch.column("shard").to_pylist(), batch.column("codes"), strict=True):
                    own.setdefault(shard, []).append(_numbers(codes))
                for shard, parts in own.items():
                    seen[shard] = np.unique(np.concatenate([*parts, seen.get(shard, parts[0])]))
            for shard, codes in seen.items():
                levels = build_levels(codes)
                sizes, bits = [len(x) for x in levels], np.packbits(np.concatenate(levels)).tobytes()
                keys = np.empty_like(codes)
                keys[MinimalHash([(shard, sizes, bits)])(codes)] = codes
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([np.array(sizes, np.int64).tobytes()], pa.binary()),
                                                  pa.array([bits], pa.binary()), pa.array([keys.tobytes()], pa.binary())],
                                                 names=["shard", "sizes", "bits", "keys"])

        text = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
        counted = staged(text.mapInArrow(partial, "shard int, codes binary, counts binary"))
        hashes = staged(counted.select("shard", "codes").repartition("shard").mapInArrow(
            hashed, "shard int, sizes binary, bits binary, keys binary"))
        shards = {r.shard: (np.frombuffer(r.sizes, np.int64), bytes(r.bits)) for r in hashes.select("shard", "sizes", "bits").toLocalIterator()}
        sent = self.spark.sparkContext.broadcast(shards)  # four bits a pair

        def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vectors: dict[int, np.ndarray] = {}
            hashes: dict[int, MinimalHash] = {}
            for batch in batches:
                for shard, codes, counts in zip(batch.column("shard").to_pylist(), batch.column("codes"), batch.column("counts"), strict=True):
                    if shard not in vectors:
                        hashes[shard] = MinimalHash([(shard, *sent.value[shard])])
                        vectors[shard] = np.zeros(int(hashes[shard].before[-1]), np.int64)
                    vectors[shard][hashes[shard](_numbers(codes))] += _numbers(counts)
            if vectors:
                yield _binary_rows(vectors.items(), ("shard", "counts"))

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vectors: dict[int, np.ndarray] = {}
            for batch in batches:
                for shard, counts in zip(batch.column("shard").to_pylist(), batch.column("counts"), strict=True):
                    vectors[shard] = vectors[shard] + _numbers(counts) if shard in vectors else _numbers(counts)
            if vectors:
                yield _binary_rows(vectors.items(), ("shard", "counts"))

        vectors = counted.mapInArrow(dense, "shard int, counts binary").withColumn("part", F.floor(F.spark_partition_id() / FAN))
        vectors = vectors.repartition("shard", "part").select("shard", "counts").mapInArrow(added, "shard int, counts binary")
        vectors = vectors.repartition("shard").mapInArrow(added, "shard int, counts binary")
        return staged(vectors.join(hashes, "shard"))

    def pair_counts(self, counts: DataFrame) -> DataFrame:
        """``a, b, n_docs``: a row for each pair that :meth:`count` found."""
        files = self.files

        def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n_b = Aligner(*files.value).n_b
            for batch in batches:
                for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
                    a, b = np.divmod(_numbers(keys), n_b)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(_numbers(counts))], names=["a", "b", "n_docs"])

        return counts.select("keys", "counts").mapInArrow(unfold, "a long, b long, n_docs long")

    def align(self, docs: DataFrame, counts: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
        """The groups of each document's tokens, and how common their links are.

        ``counts`` is from :meth:`count`. Returns the columns ``keep``, ``n_a, n_b`` (tokens),
        ``n_groups``, ``n_links`` (pairs of tokens that share a byte), ``n_best`` (links whose
        count is the highest of their A token), ``count_sum`` (over links) and ``groups``
        (``a1,a2|b1;a3|b2,b3``). A row per row; kept columns called like an output are left out.

        Null and empty texts, and those whose tokens do not spell a space and the text byte
        for byte (U+2581 in a text, say), have no tokens: zeros and empty groups; they count
        for no pair. Very long texts are whole, also without spaces. Repeated rows count as
        documents of their own. Other columns do not matter; no rows give no rows.
        """
        n_b = Aligner(*self.files.value).n_b
        best, passes, size = {}, [[]], 0
        for r in counts.select("shard", "keys", "counts").orderBy("shard").toLocalIterator():  # a shard at a time
            a, n = np.frombuffer(r["keys"], np.int64) // n_b, np.frombuffer(r["counts"], np.int64)
            order = np.lexsort((-n, a))
            first = order[np.concatenate([[True], a[order][1:] != a[order][:-1]])]
            for x, y in zip(a[first].tolist(), n[first].tolist(), strict=True):
                best[x] = max(best.get(x, 0), y)  # as many as A has tokens
            if size and size + len(n) > self.pairs_a_pass:
                passes, size = [*passes, []], 0
            passes[-1].append(r["shard"])
            size += len(n)
        top = np.zeros(max(best, default=0) + 1, np.int64)
        top[list(best)] = list(best.values())
        own = [c for c in keep if c not in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")]
        rows = docs.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{text_col}`").cast("string").alias("_al_text"))
        if len(passes) == 1:
            return self._looked_up(rows, own, self._table(counts, passes[0], top))
        rows = staged(rows.withColumn("_al_row", F.monotonically_increasing_id()))
        parts = [staged(self._looked_up(rows, ["_al_row"], self._table(counts, shards, top)).select("_al_row", "n_best", "count_sum")) for shards in passes[1:]]
        whole = self._looked_up(rows, ["_al_row", *own], self._table(counts, passes[0], top))
        for i, part in enumerate(parts):
            more = part.select(F.col("_al_row").alias("_al_r"), F.col("n_best").alias("_al_n"), F.col("count_sum").alias("_al_s"))
            whole = whole.join(more, F.col("_al_row") == F.col("_al_r")).withColumns(
                {"n_best": F.col("n_best") + F.col("_al_n"), "count_sum": F.col("count_sum") + F.col("_al_s")}).drop("_al_r", "_al_n", "_al_s")
        return whole.drop("_al_row")

    def _table(self, counts: DataFrame, shards: list[int], top: np.ndarray):
        """Hash, keys and counts of some shards, sent to all tasks."""
        rows = counts.where(F.col("shard").isin(shards)).orderBy("shard").toLocalIterator() if shards else []
        levels, keys, n = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for r in rows:
            levels.append((r["shard"], np.frombuffer(r["sizes"], np.int64), bytes(r["bits"])))
            keys.append(np.frombuffer(r["keys"], np.int64))
            n.append(np.frombuffer(r["counts"], np.int64))
        return self.spark.sparkContext.broadcast((MinimalHash(levels), np.concatenate(keys), np.concatenate(n), top))

    def _looked_up(self, rows: DataFrame, own: list[str], table) -> DataFrame:
        files, names = self.files, ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
        rows = rows.select(*[F.col(f"`{c}`") for c in own], "_al_text")
        schema = rows.drop("_al_text").schema
        for name in names:
            schema = schema.add(name, "long")
        schema = schema.add("groups", "string")

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = kept_aligner(files.value, table.value)
            find, keys, counts, top = table.value

            def weigh(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                at = find(links)
                known = (at >= 0) & (keys[np.maximum(at, 0)] == links) if len(keys) else np.zeros(len(links), bool)
                n = np.where(known, counts[np.maximum(at, 0)], 0) if len(keys) else np.zeros(len(links), np.int64)
                a = links // aligner.n_b
                return known & (n == top[np.minimum(a, len(top) - 1)]), n

            aligner.weigh = weigh
            for batch in batches:
                for part, texts in slices(batch, "_al_text"):
                    numbers, groups = aligner.aligned(texts)
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], *[pa.array(numbers[:, k]) for k in range(6)], pa.array(groups, pa.string())],
                                                     names=[*part.schema.names[:-1], *names, "groups"])

        return rows.mapInArrow(look, schema)


def align_tokenizers(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, text_col: str = "text",
                     keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """:meth:`Alignment.align` of documents with the counts of the same documents."""
    alignment = Alignment(docs.sparkSession, byte_level, pieces)
    return alignment.align(docs, alignment.count(docs, text_col), text_col, keep)
