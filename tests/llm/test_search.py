"""Exact and approximate search against all pairs in numpy."""

import numpy as np
import pytest

from homestat.llm import ann, topk
from homestat.llm import queries as Q
from homestat.llm.common import usable_vectors

SF = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


def brute(ids, x, queries, k):
    s = x[queries] @ x.T
    out = {}
    for row, q in zip(s, queries, strict=True):
        order = [j for j in np.lexsort((ids, -row)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), row[j]) for j in order]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def vectors(n, d=6, seed=0, clusters=5):
    rng = np.random.default_rng(seed)
    return rng.integers(-3, 4, (clusters, d))[rng.integers(0, clusters, n)] * 40 + rng.integers(-2, 3, (n, d))


@pytest.mark.parametrize("rows", [37, 5000])
def test_dual_tree_is_exact_with_ties_over_many_blocks(spark, monkeypatch, rows):
    monkeypatch.setattr(topk, "QUERIES", 16)
    monkeypatch.setattr(topk, "ROWS", 300)
    x = vectors(200).astype(float)
    df = spark.createDataFrame([(i * 3, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = result(topk.exact_topk(df.where("id % 2 = 0"), df, 7))
    assert got == brute(np.arange(200) * 3, x, [i for i in range(200) if i % 2 == 0], 7)


def test_trees_prune_and_cover():
    x = vectors(2000, d=3).astype(float)
    tree, todo, leaves = topk.cover_tree(x), [], []
    todo.append(tree)
    while todo:
        n = todo.pop()
        assert np.linalg.norm(x[n.points] - x[n.center], axis=1).max() <= n.radius
        assert not n.children or sorted(np.concatenate([c.points for c in n.children])) == sorted(n.points)
        todo += n.children
        leaves += [n] if not n.children else []
    assert len(leaves) > 10
    compared = []
    s = topk.Search(x[:50], np.arange(50), x, np.arange(2000), 5)
    old = s.compare
    s.compare = lambda a, b: (compared.append(len(a.points) * len(b.points)), old(a, b))
    s.run()
    assert sum(compared) < 0.6 * 50 * 2000


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0, 1.0]), (3, None), (4, []), (5, [1.0, None]), (6, [NAN, 1.0]), (7, [INF, 1.0]), (None, [1.0, 1.0]),
            (9, [1.0, 2.0]), (10, [1.0, 2.0]), (11, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, score string")
    v = usable_vectors(df, "vec_id", "embedding")
    got = result(topk.exact_topk(v.where("id % 50 = 0"), v, 5))
    assert got[0] == [(9, 5), (10, 5), (50, 3), (11, 0)] and got[50] == [(0, 3), (9, 3), (10, 3), (11, 0)]
    v = usable_vectors(df, "vec_id", "embedding", nonzero=True)
    assert [i for i, _ in result(ann.nearest_neighbours(v.where("id % 50 = 0"), v, 20))[0]] == [9, 10, 50]
    empty = v.limit(0)
    assert topk.exact_topk(empty, v, 5).count() == topk.exact_topk(v, empty, 5).count() == 0
    assert ann.nearest_neighbours(empty, v, 5).count() == ann.nearest_neighbours(v, empty, 5).count() == 0


def test_large_whole_numbers_stay_exact(spark):
    big = 2.0**27 + 1
    df = spark.createDataFrame([(0, [big, big]), (1, [big, -1.0]), (2, [big + 2, 1.0])], "id long, v array<double>")
    got = result(topk.exact_topk(df, df, 1))
    assert got[0] == [(2, int(big) * (int(big) + 2) + int(big))]


def test_recall_and_scores_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERIES", 50)
    monkeypatch.setattr(ann, "ROWS", 400)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 40)).astype(np.float32)
    x[500:700] = x[500] + 0.02 * x[500:700]  # a tight group
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    v = usable_vectors(df, "vec_id", "embedding")
    got = result(ann.nearest_neighbours(v.where("id % 20 = 0"), v, 20))
    want = brute(np.arange(1500), x.astype(float), list(range(0, 1500, 20)), 20)
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) > 0.97
    assert all(abs(s - float(x[q].astype(float) @ x[i].astype(float))) < 1e-9 for q, r in got.items() for i, s in r)


def test_one_bit_estimates_are_near():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((300, 64)), rng.standard_normal((5, 64))
    c, turn = ann.fit_centers(x, 4, 0), ann.rotation(64, 128, 0)
    assert np.allclose(turn.T @ turn, np.eye(64))
    code, at, norm, fit = ann.encode(x, c, turn)
    assert code.shape == (300, 2)
    sums, _ = ann.bit_sums(code, q @ turn.T)
    guess = (q @ c.T)[:, at] + norm / fit / np.sqrt(128) * sums
    assert np.std(guess - q @ x.T) < 0.12 * np.mean(np.linalg.norm(q, axis=1)) * np.mean(norm)


def test_registered_queries_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], dtype=float)
    got = result(Q.op7_nearest_neighbours(spark, SF))
    want = brute(ids, x, [i for i, v in enumerate(ids) if v % 20 == 0], 20)
    assert set(got) == set(want)
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) >= 0.95
    got = result(Q.op3_exact_topk(spark, SF))
    assert got == brute(ids, np.floor(256 * x), [i for i, v in enumerate(ids) if v % 50 == 0], 5)
