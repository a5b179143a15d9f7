"""Helpers shared by the operators: staged tables, stable columns, word hashes."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"  # fixed by the operators' contract: a maximal run without white space
_STAGED: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where it is unset, a local session (tests) gets a scratch folder of its own; on a
    cluster that would be a folder of one machine, so there it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="llm-stage-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not the work before it, and
    every branch that reads the table sees the same rows. Removed when Python ends.
    Spark deletes the shuffle files of finished work when the driver collects garbage;
    asking for that here keeps them from piling up over an operator's stages.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _STAGED:
        atexit.register(_remove_staged)
    _STAGED.append((spark, path))
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def _remove_staged() -> None:
    for spark, path in _STAGED:
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session has ended: its folder is the cluster's to clean
            return


def blocks(n: int, size: int) -> int:
    """Number of blocks of about ``size`` rows that ``n`` rows make (at least one)."""
    return max(1, -(-n // size))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(taken, *wanted: str) -> list[str]:
    """Names for helper columns that no column in ``taken`` has, in any case of letters."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def n_words(text) -> F.Column:
    """Words of a text (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# --- words and their hashes, over the bytes of a whole batch ----------------------

_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)  # odd
_M1, _M2 = np.uint64(0x7FB5D329728EA185), np.uint64(0x81DADEF4BC2DD44D)  # odd
_SHIFTS = np.uint64(31), np.uint64(27), np.uint64(33)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and multiply), elementwise."""
    y = x >> _SHIFTS[0]
    y ^= x
    y *= _M1
    y ^= y >> _SHIFTS[1]
    y *= _M2
    y ^= y >> _SHIFTS[2]
    return y


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (starts, ends) of the words in UTF-8 bytes."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; equal bytes give equal hashes at any place.

    Bytes are packed eight to a 64-bit number and mixed in turn, a round for every
    eight bytes of the longest span (the rounds shrink to the spans still open).
    """
    n = ends - starts
    out = mix64(n.astype(np.uint64) * _B1 + _B2)
    if not len(n):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    at, left, live = starts.copy(), n.copy(), np.arange(len(n))
    while len(live):
        chunk = np.ascontiguousarray(words[at]).view(np.uint64).ravel()
        short = left < 8
        if short.any():
            keep = (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            chunk[short] &= keep
        out[live] = mix64((out[live] + _B1) ^ (chunk * _B2))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return out


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch of texts (None: no words), and where each text's begin.

    Returns ``(hashes, offsets)``: text i has ``hashes[offsets[i]:offsets[i + 1]]``.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw), dtype=np.uint8)
    starts, ends = word_spans(data)
    begin = np.cumsum([0] + [len(r) + 1 for r in raw])
    return span_hashes(data, starts, ends), np.searchsorted(starts, begin)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (order matters)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        out = out * _B1 + words[i : len(words) - n + 1 + i]
    return mix64(out)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


FIRST_BASE, SECOND_BASE = _B1, np.uint64(0xC2B2AE3D27D4EB4F)  # odd: they have inverses modulo 2**64


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of a base modulo 2**64 (a table that grows with the longest text seen)."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(1024, 2 * n), base, dtype=np.uint64)
        known[0] = 1
        known = _POWERS[int(base)] = np.cumprod(known, dtype=np.uint64)
    return known[:n]


class RangeHashes:
    """Hash of any run of consecutive words, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, words: np.ndarray, base: np.uint64 = FIRST_BASE):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(base, len(words)), dtype=np.uint64)])
        self.back = powers(np.uint64(pow(int(base), -1, 2**64)), len(words) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64(self.plain(start, end) + (end - start).astype(np.uint64))

    def plain(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The bare sums, to compare runs of one length."""
        return (self.sums[end] - self.sums[start]) * self.back[start]


def chunks(sizes, limit: int = 4_000_000):
    """Ranges (from, to) of consecutive rows whose sizes add up to about ``limit`` (a row at least)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def text_chunks(texts, limit: int = 4_000_000):
    """Lists of consecutive texts of about ``limit`` characters together, whatever the batch's size."""
    texts = list(texts)
    for a, b in chunks([len(t) if t is not None else 0 for t in texts], limit):
        yield a, texts[a:b]


# --- vectors ------------------------------------------------------------------------


def usable_vectors(df: DataFrame, id_col: str, vec_col: str, nonzero: bool = False) -> DataFrame:
    """``id`` (long) and ``v`` (doubles) of the rows whose vectors can be compared.

    Left out: null ids, null or empty vectors, ones holding null or a non-finite
    component and, if asked, zero vectors.
    """
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(fine)
    return rows.where(F.exists("v", lambda x: x != 0)) if nonzero else rows


def matrix(vectors, width: int) -> np.ndarray:
    """Rows of doubles; a shorter vector is filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def block_pairs(queries: DataFrame, rows: DataFrame, query_blocks: int, row_blocks: int) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt to every pair of blocks (``_qb``, ``_rb``), ready to be grouped together."""
    q = queries.withColumn("_qb", F.pmod(F.xxhash64("id"), F.lit(query_blocks))).withColumn(
        "_rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)).cast("array<bigint>")))
    r = rows.withColumn("_rb", F.pmod(F.xxhash64("id"), F.lit(row_blocks))).withColumn(
        "_qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<bigint>")))
    return q, r


def best_of_each(query: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's ``k`` best: highest score first, then smallest id."""
    order = np.lexsort((ident, -score, query))
    q = query[order]
    new = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.empty(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(q)), 0)) if len(q) else np.empty(0, np.int64)
    return order[np.arange(len(q)) - first < k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query over all blocks, with their rank from 1."""
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
