"""The corpus pipeline, stage by stage, against what its operators decide."""

import random

import corpus_pipeline as C
from homestat.llm import queries as Q
from homestat.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_follow_one_another(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    before = docs.collect()
    frames = []
    for name, stage in C.STAGES:
        docs = C.staged(stage(spark, docs, SF))
        frames.append(docs)
        assert name == C.STAGES[-1][0] or docs.columns == columns
    toxic, lines, near, mixed, tokens = (f.collect() for f in frames)
    bad = {r.doc_id for r in Q.op5_toxicity(spark, SF).where("predicted = 1").collect()}
    assert {r.doc_id for r in toxic} == {r.doc_id for r in before} - bad
    assert len(lines) == len(toxic) and sum(r.n_chars for r in lines) < sum(r.n_chars for r in toxic)
    assert all(r.n_chars == len(r.text) for r in lines)
    classes = {r.doc_id: r.class_id for r in C.near_duplicates(frames[1]).collect()}
    assert sorted(r.doc_id for r in near) == sorted(set(classes.values()))
    assert sum(len(r.text.encode().split()) for r in mixed) == sum(len(r.text.encode().split()) for r in near)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in near}
    assert len(tokens) == len(mixed) and all(r.round_trip for r in tokens)
    assert sorted(map(str, C.run(spark, SF).collect())) == sorted(map(str, tokens))


def test_two_groups_of_near_copies_with_one_link_leave_one_document(spark):
    """The link is between two texts amid their groups; every other text of one group is too far from the other's."""
    rng, rows = random.Random(41), []

    def replaced(text, places, n):
        text = list(text)
        for i in rng.sample(places, n):
            text[i] = f"new{rng.randrange(10**6)}"
        return text

    even, odd = range(0, 100, 2), range(1, 100, 2)
    for k in range(6):
        x = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        y = replaced(x, even, 20)
        texts = [x, y] + [replaced(t, odd, 2) for t in (x, y) for _ in range(15)]
        rows += [(100 * k + j, " ".join(t), "en", "src1", len(" ".join(t))) for j, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = C.drop_near_copies(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept) == [100 * k for k in range(6)]


def test_stages_of_odd_and_empty_tables(spark):
    schema = table(spark, SF, "documents").schema
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "src1", 0), (None, "a b c", "en", "src1", 5),
                                 (4, "x y", "de", "other", 3), (4, "x y", "de", "other", 3)], schema)
    for docs in (odd, odd.limit(0)):
        for _, stage in C.STAGES[:4]:
            docs = C.staged(stage(spark, docs, SF))
            assert docs.columns == schema.names
        out = C.STAGES[4][1](spark, docs, SF).collect()
        assert all(r.round_trip in (True, None) for r in out)
