"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network with calibrated probabilities."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import mix64, span_hashes, text_chunks, word_spans

BUCKETS = 1 << 15  # words that have vectors of their own; more share them by hash
DIMS = 48
NONZERO = 6  # components of an index vector that are not 0
WINDOW = 2  # neighbours on each side
STRIPES = 64  # parts of the matrix of word vectors that are added up apart
BATCH = 192  # documents of one step of the fit
SLICE = 1_000_000  # characters that are read together
#: Classes of bytes: 0 white space, 1 small letter, 2 capital letter, 4 digit, 8 other ASCII, 16 beyond ASCII.
_KIND = np.full(256, 8, dtype=np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[ord("a"):ord("z") + 1], _KIND[ord("A"):ord("Z") + 1], _KIND[ord("0"):ord("9") + 1], _KIND[128:] = 1, 2, 4, 16
SHAPES = 1 << 10


def index_vectors(n: int, seed: int, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the ``NONZERO`` components of ``n`` random index vectors; nothing but the number decides them."""
    at = mix64(np.arange(n * NONZERO, dtype=np.uint64) + np.uint64(seed << 40)).reshape(n, NONZERO)
    return (at % np.uint64(dims)).astype(np.int32), np.where((at >> np.uint64(40)) & np.uint64(1), 1, -1).astype(np.int32)


def read_words(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and shape of every word of the texts, and where each text's words begin (a null text has none).

    A shape says which classes of characters a word has, how many signs (0 to 3), how long
    it is (four steps) and whether it repeats the word before.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw), dtype=np.uint8)
    starts, ends = word_spans(data)
    offsets = np.searchsorted(starts, np.cumsum([0] + [len(r) + 1 for r in raw]))
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), offsets
    hashes, kind = span_hashes(data, starts, ends), _KIND[data]
    classes = np.bitwise_or.reduceat(kind, starts).astype(np.int64)
    signs = np.minimum(np.add.reduceat((kind == 8).astype(np.int32), starts), 3).astype(np.int64)
    length = ends - starts
    steps = (length > 1).astype(np.int64) + (length > 4) + (length > 9)
    again = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    again[offsets[:-1][offsets[:-1] < len(starts)]] = False
    shape = classes + 32 * signs + 128 * steps + 512 * again
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), shape, offsets


def dense_vectors(n: int, seed: int, dims: int = DIMS) -> np.ndarray:
    """The index vectors as rows of numbers."""
    at, sign = index_vectors(n, seed, dims)
    out = np.zeros((n, dims), np.float32)
    for k in range(NONZERO):
        out[np.arange(n), at[:, k]] += sign[:, k]
    return out


def add_neighbours(bucket: np.ndarray, shape: np.ndarray, offsets: np.ndarray, vectors: tuple[np.ndarray, np.ndarray], out: np.ndarray) -> None:
    """Adds to each word's row of ``out`` the index vectors of the words around it in its text, and of their shapes."""
    if not len(bucket):
        return
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = np.arange(len(bucket)) + WINDOW * (1 + text)  # rows of zeros part the texts
    own = np.zeros((len(bucket) + WINDOW * len(offsets) + WINDOW, out.shape[1]), np.float32)
    own[place] = vectors[0][bucket] + vectors[1][shape]
    near = np.zeros_like(own)
    for step in range(1, WINDOW + 1):
        near[step:] += own[:-step]
        near[:-step] += own[step:]
    order = np.argsort(bucket, kind="stable")
    row = bucket[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    out[row[first]] += np.add.reduceat(near[place[order]], first, axis=0).astype(out.dtype)  # whole numbers: exact


def word_matrix(docs: DataFrame, text_col: str = "text", dims: int = DIMS) -> np.ndarray:
    """Random-indexing vectors of all words, from every text: ``BUCKETS`` rows of ``dims`` whole numbers.

    A word's vector is the sum of the index vectors of the words (and their shapes) within
    ``WINDOW`` places, over all its occurrences. Each task adds up one matrix of fixed size,
    whatever it reads; its ``STRIPES`` are then summed across tasks and brought to the driver
    (BUCKETS * dims * 8 bytes: 12 MB). Whole numbers, so the order of sums does not matter.
    """
    size = BUCKETS * dims // STRIPES

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = dense_vectors(BUCKETS, 1, dims), dense_vectors(SHAPES, 2, dims)
        total, words = np.zeros((BUCKETS, dims), np.int32), 0
        for batch in batches:
            for _, texts in text_chunks(batch.column(0).to_pylist(), SLICE):
                if words > 1 << 26:  # before 32 bits overflow
                    yield _striped(total)
                    total, words = np.zeros_like(total), 0
                read = read_words(texts)
                add_neighbours(*read, vectors, total)
                words += len(read[0])
        yield _striped(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                sums = total.setdefault(row["stripe"], np.zeros(size, np.int64))
                sums[np.frombuffer(row["places"], np.int32)] += np.frombuffer(row["sums"], np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                         names=["stripe", "sums"])

    parts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(partial, "stripe int, places binary, sums binary")
    out = np.zeros((STRIPES, size), np.int64)
    for r in parts.repartition("stripe").mapInArrow(added, "stripe int, sums binary").collect():
        out[r.stripe] = np.frombuffer(r.sums, np.int64)
    return out.reshape(BUCKETS, dims)


def _striped(total: np.ndarray) -> pa.RecordBatch:
    """The sums that are not 0, and their places, of each stripe that has any."""
    stripes = total.reshape(STRIPES, -1)
    some = [(i, np.flatnonzero(stripes[i])) for i in range(STRIPES)]
    some = [(i, at) for i, at in some if len(at)]
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in some], pa.int32()), pa.array([at.astype(np.int32).tobytes() for _, at in some], pa.binary()),
                                       pa.array([stripes[i][at].tobytes() for i, at in some], pa.binary())], names=["stripe", "places", "sums"])


class Pool:
    """Document vectors: means and spreads of the words' unit vectors, and the mean index vector of their shapes."""

    def __init__(self, matrix: np.ndarray, shape_dims: int = 64):
        norm = np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
        self.words = np.divide(matrix, norm, out=np.zeros(matrix.shape), where=norm > 0).astype(np.float32)
        self.shapes = dense_vectors(SHAPES, 3, shape_dims)

    def __call__(self, texts: Sequence[str | None]) -> np.ndarray:
        """A row per text; a text without words gives zeros."""
        bucket, shape, offsets = read_words(texts)
        n = np.diff(offsets)
        out = np.zeros((len(n), 2 * self.words.shape[1] + self.shapes.shape[1] + 1), np.float32)
        full = np.flatnonzero(n)
        if len(full):
            dims, per = self.words.shape[1], n[full][:, None]
            vectors = self.words[bucket]
            mean = np.add.reduceat(vectors, offsets[full], axis=0) / per
            square = np.add.reduceat(vectors * vectors, offsets[full], axis=0) / per
            out[full, :dims], out[full, dims:2 * dims] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
            out[full, 2 * dims:-1] = np.add.reduceat(self.shapes[shape], offsets[full], axis=0) / per
            out[full, -1] = np.log1p(n[full])
        return out


class Network:
    """Two layers: standardised inputs, ``hidden`` rectified units, one logit divided by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, check: np.ndarray, hidden: int = 32, epochs: int = 30, seed: int = 7, decay: float = 1e-3):
        """Fit by Adam on the rows that are not ``check``; the temperature by the likelihood of those that are."""
        fit = ~check if (~check).any() else np.ones(len(x), bool)
        self.mean, self.scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
        self.temperature = 1.0
        rng = np.random.default_rng(seed)
        self.w1 = rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)).astype(np.float32)
        self.b1, self.w2 = np.zeros(hidden, np.float32), rng.normal(0, np.sqrt(1 / hidden), hidden).astype(np.float32)
        base = np.clip(y[fit].mean(), 0.001, 0.999)
        self.b2 = np.array([np.log(base / (1 - base))], np.float32)
        xs, ys = self._scaled(x[fit]), y[fit].astype(np.float32)
        names, moments = ["w1", "b1", "w2", "b2"], {}
        step = 0
        for epoch in range(epochs):
            rate = 3e-3 * (1 - epoch / epochs)
            order = rng.permutation(len(xs))
            for a in range(0, len(xs), BATCH):
                xb, yb = xs[order[a:a + BATCH]], ys[order[a:a + BATCH]]
                inner = np.maximum(xb @ self.w1 + self.b1, 0)
                error = (_sigmoid(inner @ self.w2 + self.b2) - yb) / len(xb)
                back = np.outer(error, self.w2) * (inner > 0)
                grads = [xb.T @ back + decay * self.w1, back.sum(axis=0), inner.T @ error + decay * self.w2, np.array([error.sum()], np.float32)]
                step += 1
                for name, g in zip(names, grads, strict=True):
                    m, v = moments.get(name, (0.0, 0.0))
                    m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                    moments[name] = m, v
                    new = getattr(self, name) - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                    setattr(self, name, new.astype(np.float32))
        if check.any():
            logits, truth = self.logits(x[check]), y[check]
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
            loss = [np.logaddexp(0, np.where(truth > 0, -logits, logits) / t).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8).astype(np.float32)

    def logits(self, x: np.ndarray) -> np.ndarray:
        inner = np.maximum(self._scaled(x) @ self.w1 + self.b1, 0)
        return (inner @ self.w2 + self.b2).astype(np.float64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Quality:
    """A fitted scorer of texts."""

    def __init__(self, pool: Pool | None, network: Network | None, base: float):
        self.pool, self.network, self.base = pool, network, base

    def score(self, text: Column) -> Column:
        pool, network, base = self.pool, self.network, self.base

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                if network is None:
                    yield pd.Series(np.full(len(batch), base), index=batch.index)
                    continue
                parts = [network(pool(texts)) for _, texts in text_chunks(batch, SLICE)]
                yield pd.Series(np.concatenate(parts) if parts else np.empty(0), index=batch.index, dtype="float64")
        return scored(text)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a document's labels are kept from the fit: CRC-32 of its id as text, by ``folds``. A null id: false."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        most: int = 40_000, seed: int = 7) -> Quality:
    """Word vectors from all texts, the network from labelled documents that are not held out.

    At most ``most`` labelled documents are learned from, the first by a hash of their id (a
    bound on what the driver holds: their pooled vectors, 650 bytes each); a fifth of them by
    another hash sets the temperature. An id labelled both ways, or whose document comes
    twice, counts each way. Without documents of both labels every text scores the share of
    label 1 among them (0.5 without labels).
    """
    ident, label = F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    known = labels.where(ident.isNotNull() & label.isNotNull() & ~held_out(ident))
    known = known.select(ident.alias("_q_id"), (label > 0).cast("int").alias("_q_y"), F.xxhash64(F.lit(seed), ident.cast("string")).alias("_q_h"))
    known = known.distinct().orderBy("_q_h", "_q_id", "_q_y").limit(most)
    rows = docs.select(ident.alias("_q_doc"), F.col(f"`{text_col}`").cast("string").alias("_q_text"))
    rows = rows.join(F.broadcast(known), F.col("_q_doc") == F.col("_q_id")).select("_q_h", "_q_y", "_q_text")  # `most` rows of 20 bytes
    if rows.groupBy("_q_y").count().limit(3).count() < 2:
        share = rows.agg(F.avg("_q_y")).first()[0]
        return Quality(None, None, 0.5 if share is None else float(share))
    pool = Pool(word_matrix(docs, text_col))

    def pooled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, texts in text_chunks(batch["_q_text"], SLICE):
                some = batch.iloc[a:a + len(texts)]
                yield pd.DataFrame({"h": some["_q_h"], "y": some["_q_y"], "x": [v.tobytes() for v in pool(texts)]})

    learned = rows.mapInPandas(pooled, "h long, y int, x binary").collect()  # at most `most` documents (and their repeats)
    learned.sort(key=lambda r: (r.h, r.y, bytes(r.x)))
    x = np.array([np.frombuffer(r.x, np.float32) for r in learned])
    y, h = np.array([r.y for r in learned]), np.array([r.h for r in learned])
    return Quality(pool, Network(x, y, mix64(h.view(np.uint64)) % np.uint64(5) == 0, seed=seed), float(y.mean()))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
            threshold: float = 0.7, most: int = 40_000) -> DataFrame:
    """Score every whole text: how likely its label is 1.

    Returns ``id_col``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 if the score is
    ``threshold`` or more), a row per row. Labels are learned by :func:`fit` from documents
    that are not held out; id, language and source are no inputs. Null and empty texts score
    as a text without words; very long texts are pooled whole, like others; repeated rows
    score alike; other columns do not matter. An empty table gives an empty table.
    """
    model = fit(docs, labels, id_col, text_col, label_col, most)
    rows = docs.select(F.col(f"`{id_col}`"), held_out(F.col(f"`{id_col}`")).alias("held_out"), model.score(F.col(f"`{text_col}`").cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
