"""Quality classifier: word vectors and pooling against plain Python, held-out accuracy, odd tables."""

import re
import zlib

import numpy as np
import pytest

from homestat.llm import quality as L
from homestat.llm import queries as Q
from homestat.llm.common import table

SF = "/root/testdata/sf0.01"
TEXTS = ["One two  THREE!!\nfour4 four4 five, one", None, "", "a", "été two\ttwo two $$$ --- ok...", " lead and trail "]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shape(word, before):
    raw = word.encode()
    kinds = [1 if 97 <= b <= 122 else 2 if 65 <= b <= 90 else 4 if 48 <= b <= 57 else 16 if b > 127 else 8 for b in raw]
    steps = (len(raw) > 1) + (len(raw) > 4) + (len(raw) > 9)
    return sum(set(kinds)) + 32 * min(3, kinds.count(8)) + 128 * steps + 512 * (word == before)


def test_words_shapes_and_neighbours():
    bucket, shapes, offsets = L.read_words(TEXTS)
    lists = [words(t) for t in TEXTS]
    assert np.diff(offsets).tolist() == [len(x) for x in lists]
    assert shapes.tolist() == [shape(w, x[i - 1] if i else None) for x in lists for i, w in enumerate(x)]
    place = {}
    for w, b in zip([w for x in lists for w in x], bucket.tolist(), strict=True):
        assert place.setdefault(w, b) == b and 0 <= b < L.BUCKETS
    vectors = L.dense_vectors(L.BUCKETS, 1), L.dense_vectors(L.SHAPES, 2)
    out = np.zeros((L.BUCKETS, L.DIMS), np.int32)
    L.add_neighbours(bucket, shapes, offsets, vectors, out)
    want = np.zeros_like(out)
    for x in lists:
        for i, w in enumerate(x):
            for j in range(max(0, i - L.WINDOW), min(len(x), i + L.WINDOW + 1)):
                if j != i:
                    want[place[w]] += (vectors[0][place[x[j]]] + vectors[1][shape(x[j], x[j - 1] if j else None)]).astype(np.int32)
    assert (out == want).all() and want.any()


def test_matrix_over_partitions_and_pooling(spark):
    texts = [t for t in TEXTS for _ in range(7)] + ["alpha beta gamma " * 3_000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    matrix = L.word_matrix(docs)
    want = np.zeros((L.BUCKETS, L.DIMS), np.int64)
    L.add_neighbours(*L.read_words(texts), (L.dense_vectors(L.BUCKETS, 1), L.dense_vectors(L.SHAPES, 2)), want)
    assert (matrix == want).all()
    pool = L.Pool(matrix)
    got = pool(TEXTS)
    for i, t in enumerate(TEXTS):
        x = words(t)
        if not x:
            assert not got[i].any()
            continue
        bucket, shapes, _ = L.read_words([t])
        rows = np.array([matrix[b] / np.linalg.norm(matrix[b]) if matrix[b].any() else np.zeros(L.DIMS) for b in bucket])
        direct = np.concatenate([rows.mean(axis=0), rows.std(axis=0), pool.shapes[shapes].mean(axis=0), [np.log1p(len(x))]])
        assert np.allclose(got[i], direct, atol=2e-3)


def test_network_learns_and_its_temperature_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4_000, 6)).astype(np.float32)
    chance = 1 / (1 + np.exp(-(2 * x[:, 0] * np.sign(x[:, 1]) + x[:, 2])))  # no linear rule
    y = (rng.random(4_000) < chance).astype(int)
    check = np.arange(4_000) % 5 == 0
    p = L.Network(x, y, check)(x[check])
    assert np.mean((p > 0.5) == (chance[check] > 0.5)) > 0.85
    assert abs(p.mean() - y[check].mean()) < 0.06 and np.mean(np.abs(p - chance[check])) < 0.12


def scored(df):
    return {r.doc_id: (r.held_out, r.score, r.predicted) for r in df.collect()}


def test_held_out_accuracy_and_labels_that_are_not_learned(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = scored(Q.op12_quality(spark, SF))
    assert len(got) == docs.count() and all(0 <= s <= 1 and p == (s >= 0.7) for _, s, p in got.values())
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, (h, _, _) in got.items())
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(got[d][1], q, got[d][2]) for d, q in truth.items() if got[d][0]]
    good, bad = [s for s, q, _ in held if q], [s for s, q, _ in held if not q]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.98 and np.mean([p == q for _, q, p in held]) > 0.95
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    again = scored(L.quality(docs.selectExpr("doc_id", "text", "'x' AS lang", "1 AS score", "2 AS _q_id", "3 AS held_out"), turned))
    assert all(again[d] == pytest.approx(got[d], abs=1e-9) for d in got)


def test_odd_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "fine words here"), (2, None), (3, ""), (None, "no id"), (4, "x" * 400_000), (4, "x" * 400_000), (5, "$$$ $$$")], "doc_id long, text string")
    labels = "doc_id long, quality int, toxic int"
    both = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, 0, 0), (5, 0, None), (None, 1, 0), (4, None, 0), (99, 1, 0)], labels)
    rows = L.quality(docs, both).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    empty = [r.score for r in rows if r.doc_id in (2, 3)]
    assert empty[0] == empty[1]
    one = L.quality(docs, both.where("quality = 1")).collect()
    assert {r.score for r in one} == {1.0}
    assert {r.score for r in L.quality(docs, both.limit(0)).collect()} == {0.5}
    assert L.quality(docs.limit(0), both).collect() == []
