"""Approximate nearest neighbours with randomly rotated one-bit codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import best_of_each, block_pairs, blocks, matrix, ranked, staged

QUERIES, ROWS = 4096, 8192  # vectors of a block
SAMPLE, CENTERS = 10_000, 64  # vectors that the centres are fitted on at most, and centres
PLANES = 6  # bits of a rotated query's components
CONFIDENCE = 1.9  # of the error bound, in its own deviations
RESULT = "query_id long, vec_id long, score double"


def rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    """``bits`` random directions of ``dim`` components: columns of a random rotation, orthogonal among themselves."""
    r = np.random.default_rng(seed).standard_normal((bits, bits))
    q, upper = np.linalg.qr(r)
    return (q * np.sign(np.diag(upper)))[:, :dim]


def fit_centers(x: np.ndarray, n: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Centres by Lloyd's rounds from random rows."""
    rng = np.random.default_rng(seed)
    c = x[np.sort(rng.choice(len(x), min(n, len(x)), replace=False))]
    for _ in range(rounds):
        near = nearest(x, c)
        sums, count = np.zeros_like(c), np.bincount(near, minlength=len(c))
        np.add.at(sums, near, x)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin(np.einsum("ij,ij->i", centers, centers) - 2 * (x @ centers.T), axis=1)


def encode(x: np.ndarray, centers: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, ...]:
    """Packed signs of the rotated, centred vectors, with what corrects the estimates.

    Returns the code's 64-bit words, the centre's number, the distance from it, and the
    inner product of the unit residual with its own code's direction.
    """
    at = nearest(x, centers)
    rest = x - centers[at]
    norm = np.linalg.norm(rest, axis=1)
    turned = (rest / np.maximum(norm, 1e-300)[:, None]) @ turn.T
    bits = turned > 0
    code = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    fit = np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[0])
    return code, at, norm, fit


def bit_sums(codes: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For queries and codes: the sum of +-components by the code's bits, and its rounding error.

    Components become whole numbers of ``PLANES`` bits, whose bit planes are packed like
    the codes: an AND and a count of bits for each plane and word.
    """
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / (2**PLANES - 1), 1e-300)
    whole = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    total = np.zeros((len(turned), len(codes)), dtype=np.int32)
    for p in range(PLANES):
        plane = np.packbits((whole >> p) & 1, axis=1, bitorder="little").view(np.uint64)
        for w in range(codes.shape[1]):
            total += np.bitwise_count(plane[:, w, None] & codes[None, :, w]).astype(np.int32) << p
    ones = np.bitwise_count(codes).sum(axis=1)
    on = total * step[:, None] + low[:, None] * ones[None, :]
    return 2 * on - turned.sum(axis=1)[:, None], step * np.sqrt(turned.shape[1] / 12)


def _index(centers: np.ndarray, turn: np.ndarray):
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            code, at, norm, fit = encode(matrix(pdf["v"], centers.shape[1]), centers, turn)
            yield pd.DataFrame({"id": pdf["id"], "v": pdf["v"], "code": [c.tobytes() for c in code],
                                "center": at.astype(np.int32), "norm": norm, "fit": fit})
    return index


def _search(k: int, centers: np.ndarray, turn: np.ndarray, confidence: float, width: int):
    bits = turn.shape[0]

    def search(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(r):
            rows, r_ids = matrix(r["v"], width), r["id"].to_numpy()
            codes = np.frombuffer(b"".join(r["code"]), dtype=np.uint64).reshape(len(r), -1)
            at, norm, fit = (r[c].to_numpy() for c in ("center", "norm", "fit"))
            safe = np.maximum(fit, 1e-3)
            spread = norm * np.sqrt(np.maximum(1 - safe**2, 0)) / safe / np.sqrt(bits - 1)
            all_q, q_ids = matrix(q["v"], width), q["id"].to_numpy()
            for a in range(0, len(q), 64):
                mine, ids = all_q[a:a + 64], q_ids[a:a + 64]
                sums, rounding = bit_sums(codes, mine[:, :turn.shape[1]] @ turn.T)
                guess = (mine @ centers.T)[:, at] + (norm / safe / np.sqrt(bits))[None, :] * sums
                error = confidence * (np.linalg.norm(mine, axis=1)[:, None] * spread[None, :]
                                      + rounding[:, None] * (norm / safe / np.sqrt(bits))[None, :])
                own = ids[:, None] == r_ids[None, :]
                guess[own] = -np.inf
                # exact scores of the best guesses set a mark; whatever its bound lets reach it is scored, too
                n = min(k, len(r))
                first = np.argpartition(-guess, n - 1, axis=1)[:, :n]
                exact = np.einsum("qd,qnd->qn", mine, rows[first])
                exact[np.take_along_axis(own, first, axis=1)] = np.inf
                mark = exact.min(axis=1) if len(r) > k else np.full(len(mine), -np.inf)
                mark[np.isinf(exact).any(axis=1)] = -np.inf
                i, j = np.nonzero((guess + error >= mark[:, None]) & ~own)
                score = np.empty(len(i))
                for b in range(0, len(i), 65536):
                    score[b:b + 65536] = np.einsum("nd,nd->n", mine[i[b:b + 65536]], rows[j[b:b + 65536]])
                best = best_of_each(i, score, r_ids[j], k)
                out.append(pd.DataFrame({"query_id": ids[i[best]], "vec_id": r_ids[j[best]], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    return search


def nearest_neighbours(queries: DataFrame, rows: DataFrame, k: int, confidence: float = CONFIDENCE,
                       centers: int = CENTERS, sample: int = SAMPLE, seed: int = 0) -> DataFrame:
    """Each query's ``k`` rows of largest inner product, nearly always all of them.

    Both tables have ``id`` (long) and ``v`` (doubles); a query is not compared with rows
    of its own id; a shorter vector counts as filled up with zeros. Centres are fitted on
    at most ``sample`` rows (the first by a hash of the id); every row is indexed: its
    difference from the nearest centre, randomly rotated to twice as many directions, is
    kept as one bit each, with its length and its inner product with the code. From these
    a query's inner products are estimated with bit counts; rows whose estimate plus error
    bound (``confidence`` deviations) reaches the kth exact score of the best estimates
    are scored exactly. Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``
    (double, of the original vectors), ties to the smaller id. Fewer than ``k`` rows: all
    of them. Empty tables give an empty table.

    Codes and vectors are dealt to blocks by a hash of the id; each pair of a query block
    and a row block gives ``k`` rows a query, then ranked together.
    """
    q, r = staged(queries), staged(rows)
    sizes = [t.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first() for t in (q, r)]
    width = max(s["d"] or 1 for s in sizes)
    some = r.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    c = fit_centers(matrix(some["v"], width), centers, seed) if len(some) else np.zeros((1, width))
    turn = rotation(width, 2 * 64 * blocks(width, 64), seed)
    coded = r.mapInPandas(_index(c, turn), "id long, v array<double>, code binary, center int, norm double, fit double")
    left, right = block_pairs(q, coded, blocks(sizes[0]["n"], QUERIES), blocks(sizes[1]["n"], ROWS))
    found = left.groupBy("_qb", "_rb").cogroup(right.groupBy("_qb", "_rb")).applyInPandas(
        _search(k, c, turn, confidence, width), RESULT)
    return ranked(found, k)
