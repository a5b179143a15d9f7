"""Exact top-k inner products by dual-tree search over cover trees."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import best_of_each, block_pairs, blocks, matrix, ranked, staged

QUERIES, ROWS = 4096, 8192  # vectors of a block
LEAF = 32  # points of a leaf at most, where the points can be covered by smaller balls
RESULT = "query_id long, vec_id long, score long"


@dataclass
class Node:
    """A ball of the cover tree: all of ``points`` lie within ``radius`` of ``center`` (a point)."""

    center: int
    points: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)


def cover_tree(x: np.ndarray, leaf: int = LEAF) -> Node:
    """Cover tree of the rows of ``x``: each level's balls have half the radius of the one above.

    A node's children are centred on its own points, more than half its radius apart, and
    cover them. Points too evenly spread for that (more than a quarter would be centres,
    as in many dimensions) stay together in one leaf.
    """
    square = np.einsum("ij,ij->i", x, x)

    def far(center: int, points: np.ndarray) -> np.ndarray:
        d = square[points] + square[center] - 2 * (x[points] @ x[center])
        return np.sqrt(np.maximum(d, 0)) * (1 + 1e-9) + 1e-6

    def split(center: int, points: np.ndarray, dist: np.ndarray) -> Node:
        node = Node(center, points, float(dist.max()))
        todo = [node]
        dists = {id(node): dist}
        while todo:  # no recursion: a chain of balls may be deep
            n = todo.pop()
            d = dists.pop(id(n))
            if len(n.points) <= leaf or n.radius <= 2e-6:
                continue
            half, rest, own, found = n.radius / 2, n.points, d, []
            c = n.center
            while len(rest):
                near = own <= half
                near[rest == c] = True
                found.append((c, rest[near], own[near]))
                rest = rest[~near]
                if len(found) * 4 > len(n.points):
                    break
                if len(rest):
                    c = int(rest[0])
                    own = far(c, rest)
            if len(rest) or len(found) < 2:
                continue
            for c, p, dd in found:
                child = Node(c, p, float(dd.max()))
                dists[id(child)] = dd
                n.children.append(child)
                todo.append(child)
        return node

    everything = np.arange(len(x))
    return split(0, everything, far(0, everything))


class Search:
    """Best ``k`` rows for each query, of integer vectors, pruning pairs of balls."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, r: np.ndarray, r_ids: np.ndarray, k: int):
        self.q, self.q_ids, self.r, self.r_ids, self.k = q, q_ids, r, r_ids, k
        top = max(np.abs(q).max(initial=0), np.abs(r).max(initial=0))
        self.exact = q.shape[1] * top * top < 2**53  # doubles hold every product and sum
        self.worst = np.full(len(q), -np.inf)  # each query's kth score so far
        none = np.empty(0, np.int64)
        self.found = (none, none, none)  # query, row, score
        self.q_norm, self.r_norm = np.linalg.norm(q, axis=1), np.linalg.norm(r, axis=1)

    def scores(self, qs: np.ndarray, rs: np.ndarray) -> np.ndarray:
        if self.exact:
            return (self.q[qs] @ self.r[rs].T).astype(np.int64)
        as_int = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object)
        out = as_int(self.q[qs]).dot(as_int(self.r[rs]).T)
        return np.clip(out, -(2**63), 2**63 - 1).astype(np.int64)

    def bound(self, a: Node, b: Node) -> float:
        """No inner product between the balls is higher."""
        dot = float(self.q[a.center] @ self.r[b.center])
        limit = dot + a.radius * self.r_norm[b.center] + b.radius * self.q_norm[a.center] + a.radius * b.radius
        return limit + 0.5 + 1e-9 * abs(limit)

    def compare(self, a: Node, b: Node) -> None:
        s = self.scores(a.points, b.points)
        s_open = np.where(self.q_ids[a.points][:, None] != self.r_ids[b.points][None, :], s.astype(np.float64), -np.inf)
        least = np.full(len(a.points), -np.inf)
        if len(b.points) > self.k:
            least = np.partition(s_open, len(b.points) - self.k, axis=1)[:, len(b.points) - self.k]
        least = np.maximum(least, self.worst[a.points])
        i, j = np.nonzero((s_open >= least[:, None]) & (s_open > -np.inf))
        old = np.isin(self.found[0], a.points)
        query = np.concatenate([self.found[0][old], a.points[i]])
        row = np.concatenate([self.found[1][old], b.points[j]])
        score = np.concatenate([self.found[2][old], s[i, j]])
        best = best_of_each(query, score, self.r_ids[row], self.k)
        query, row, score = query[best], row[best], score[best]
        self.found = tuple(np.concatenate([x[~old], y]) for x, y in zip(self.found, (query, row, score), strict=True))
        last = np.flatnonzero(np.concatenate([query[1:] != query[:-1], [True]])) if len(query) else np.empty(0, np.int64)
        full = np.diff(np.concatenate([[-1], last])) == self.k
        self.worst[query[last[full]]] = score[last[full]]

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        todo = [(np.inf, cover_tree(self.q), cover_tree(self.r))]
        while todo:
            limit, a, b = todo.pop()
            if limit < self.worst[a.points].min():
                continue
            if not a.children and not b.children:
                self.compare(a, b)
                continue
            pairs = [(self.bound(x, y), x, y) for x in a.children or [a] for y in b.children or [b]]
            todo += sorted(pairs, key=lambda p: p[0])  # the most promising pair comes next
        return self.found


def _search(k: int, width: int):
    def search(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        s = Search(matrix(q["v"], width), q["id"].to_numpy(), matrix(r["v"], width), r["id"].to_numpy(), k)
        query, row, score = s.run()
        return pd.DataFrame({"query_id": s.q_ids[query], "vec_id": s.r_ids[row], "score": score})
    return search


def exact_topk(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` rows of highest inner product, exactly, ties to the smaller id.

    Both tables have ``id`` (long) and ``v`` (doubles that are whole numbers); a query is
    not compared with rows of its own id; a shorter vector counts as filled up with
    zeros. Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` (long). Fewer
    than ``k`` rows: all of them. A product beyond a long's range counts as its nearest end. Rows repeated with their id are results each. Empty
    tables give an empty table.

    Both sides are dealt to blocks by a hash of the id, so no region of space is hot; each
    pair of blocks is searched with two cover trees, a pair of balls being skipped when
    its bound, from the centres' inner product and both covering radii, is below the worst
    kth score of the ball's queries. Blocks give ``k`` rows a query, then ranked together.
    """
    q, r = staged(queries), staged(rows)
    sizes = [t.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first() for t in (q, r)]
    width = max(s["d"] or 1 for s in sizes)
    left, right = block_pairs(q, r, blocks(sizes[0]["n"], QUERIES), blocks(sizes[1]["n"], ROWS))
    found = left.groupBy("_qb", "_rb").cogroup(right.groupBy("_qb", "_rb")).applyInPandas(_search(k, width), RESULT)
    return ranked(found, k)
