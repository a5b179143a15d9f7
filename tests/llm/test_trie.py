"""Prefix trie of conversations against plain Python; tree contraction against a plain walk."""

import hashlib
import random
import zlib
from collections import defaultdict

from homestat.llm import trie
from homestat.llm.contraction import subtree_totals
from homestat.llm.trie import conversation_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def expected(rows):
    """``rows``: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (
            r[0], r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        own[conv].append((role or "", text or ""))
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        rebuilt[conv] = tuple(own.get(conv - conv % 5, [])[:h] + turns[h:])
    members = defaultdict(list)
    for conv in sorted(rebuilt):
        for d in range(len(rebuilt[conv]) + 1):
            members[rebuilt[conv][:d]].append(conv)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((m[0], len(p), members[p[:-1]][0] if p else -1, len(m), kids.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if rebuilt[c] == p).encode()).hexdigest()) for p, m in members.items())


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def test_shared_starts_copies_and_odd_rows(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "été 😀"]))
            for c in range(30) for t in rng.sample(range(12), rng.randint(1, 9))]
    rows += [(None, 0, "user", "nobody"), (70, None, "user", "null turn"), (70, None, "user", "first"), (70, 0, "system", "x"),
             (71, 1, "user", "same"), (71, 1, "user", "same"), (71, 1, "a", "tie"), (72, 0, None, None), (2**40, 3, "user", "y" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(conversation_trie(df)) == expected(rows)


def test_one_conversation_of_many_turns_and_one_first_turn_of_all(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 16)  # so that a prefix is carried over several windows
    monkeypatch.setattr(trie, "CHUNK_BITS", 3)
    rows = [(1, t, "user", f"t{t}") for t in range(70)] + [(5 * c, 0, "user", "hello") for c in range(1, 200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert found(conversation_trie(df)) == expected(rows)


def test_empty_table_and_clashing_columns(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(c, t, "user", f"{c % 3}{t}") for c in range(6) for t in range(2)]
    wide = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA + ", conv long, pos long, a long, `last` long, row long")
    assert found(conversation_trie(wide)) == expected(rows)


def test_subtree_totals_of_a_chain_a_star_and_a_random_tree(spark):
    rng, parent = random.Random(1), {}
    for k, shape in enumerate([lambda i: i - 1, lambda i: 0, lambda i: rng.randrange(i)]):
        parent |= {1000 * k + i: 1000 * k + shape(i) if i else None for i in range(80)}
    kids = defaultdict(int)
    for p in parent.values():
        kids[p] += 1
    own = {i: (rng.randrange(10), 1) for i in parent}
    want = {i: list(v) for i, v in own.items()}
    for i in sorted(parent, reverse=True):
        if parent[i] is not None:
            want[parent[i]][0] += want[i][0]
            want[parent[i]][1] += want[i][1]
    df = spark.createDataFrame([(i, p, kids[i], *own[i]) for i, p in parent.items()], "k long, up long, m long, x long, y long")
    got = {r.k: [r.x, r.y] for r in subtree_totals(df, ["k"], ["up"], "m", ["x", "y"]).collect()}
    assert got == want
