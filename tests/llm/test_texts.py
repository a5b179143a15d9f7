"""Near-duplicates, substring dedup, toxicity, tokens and page texts against plain Python."""

import hashlib
import html as pyhtml
import random
import re

import numpy as np
import pytest

from homestat.llm import common, minhash, sentencepiece, substring, toxicity
from homestat.llm import html as pages_
from homestat.llm import queries as Q
from homestat.llm.components import components

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def words(rng, n, kinds=400):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        c = [i]
        for j, y in enumerate(b, 1):
            c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
        p = c
    return p[-1]


def edited(rng, w, n):
    w = list(w)
    for _ in range(n):
        i = rng.randrange(len(w) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            w.insert(i, "new%d" % rng.randrange(99))
        elif i < len(w):
            w[i:i + 1] = [] if kind == 1 else ["other%d" % rng.randrange(99)]
    return w


# --- shared helpers ------------------------------------------------------------------


def test_word_hashes_tell_words_apart_wherever_they_stand():
    texts = ["a bb  ccc\tdddddddd eeeeeeeee", None, "", "eeeeeeeee bb a", " x \x0bbb", "x" * 40 + " " + "x" * 41]
    hashes, at = common.word_hashes(texts)
    got = [list(hashes[at[i]:at[i + 1]]) for i in range(len(texts))]
    assert [len(g) for g in got] == [5, 0, 0, 3, 2, 2]
    assert got[0][1] == got[3][1] == got[4][1] and got[0][0] == got[3][2] and got[0][4] == got[3][0]
    assert len({h for g in got for h in g}) == len({w for t in texts if t for w in t.encode().split()})


# --- near-duplicates ---------------------------------------------------------------------


def test_banded_alignment_against_the_full_table():
    rng = random.Random(1)
    for _ in range(150):
        a = words(rng, rng.randrange(1, 40), rng.randrange(2, 12))
        b = edited(rng, a, rng.randrange(10))
        x, y = (minhash.Aligned(common.word_hashes([" ".join(w)])[0]) for w in (a, b))
        d = edit_distance(a, b)
        assert [minhash.within(x, y, n) for n in (0, 1, 2, 5, 9)] == [d <= n for n in (0, 1, 2, 5, 9)]


@pytest.mark.parametrize("small", [4096, 3])
def test_wide_bands_by_columns_against_the_full_table(small, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "KINDS", 4)
    rng = np.random.default_rng(7)
    for _ in range(400):
        a = rng.integers(0, rng.integers(2, 30), rng.integers(1, 40)).tolist()
        b = list(a)
        for _ in range(rng.integers(0, 16)):
            at = int(rng.integers(0, len(b) + 1))
            b[at:at + int(rng.integers(0, 2))] = rng.integers(0, 30, rng.integers(0, 2)).tolist()
        b = b or [1]
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        x, y = (minhash.Aligned(np.array(t, dtype=np.uint64)) for t in (a, b))
        for limit in range(abs(len(a) - len(b)), 18):
            assert minhash._aligns(x, y, limit) == minhash.within(x, y, limit) == (row[-1] <= limit)


def test_word_counts_of_many_tasks_are_added_up(spark):
    texts = spark.range(0, 3000, 1, 70).selectExpr("id as node", "concat('a b w', id % 7) as text")
    counts = minhash._word_counts(texts)
    assert sorted(counts[counts > 0].tolist()) == [428] * 3 + [429] * 4 + [3000] * 2
    assert not minhash._word_counts(texts.limit(0)).any()


def test_order_minhash_sees_order():
    odds = minhash.sketch_odds(64, 0)
    rng = random.Random(2)
    blocks = [words(rng, 60, 10**6) for _ in range(4)]
    sketch = lambda w: minhash.order_minhash(common.word_hashes([" ".join(w)])[0], odds)
    same = sketch(sum(blocks, []))
    swapped = np.mean(same == sketch(blocks[2] + blocks[3] + blocks[0] + blocks[1]))
    assert np.mean(same == sketch(edited(rng, sum(blocks, []), 3))) > 0.5 > swapped


def test_near_duplicates_classes_and_odd_rows(spark):
    rng = random.Random(3)
    base = [words(rng, n) for n in (200, 200, 60, 30)]
    rows, want = [], {}

    def put(i, w, cls):
        rows.append((i, w if w is None or isinstance(w, str) else " ".join(w), "clash"))
        want[i] = cls

    for k, b in enumerate(base):
        put(10 * k + 1, b, 10 * k + 1)
        put(10 * k + 2, b, 10 * k + 1)  # an exact copy
        for j in range(3, 7):
            put(10 * k + j, edited(rng, b, 1 + len(b) // 30), 10 * k + 1)
    passage = words(rng, 50, 10**6)
    for k in range(60, 75):  # a shared passage alone makes no duplicates
        put(k, words(rng, 120, 10**6) + passage, k)
    put(80, "", 80)
    put(81, " \n", 81)
    put(82, None, 82)
    put(83, "one two three four", 83)
    put(84, "one two  three four", 83)
    put(85, words(rng, 20000, 10**6), 85)
    rows += [(86, rows[-1][1], "clash"), (1, rows[0][1], "clash"), (None, rows[0][1], "clash")]
    want[86] = 85
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    out = minhash.near_duplicates(docs)
    assert out.columns == ["doc_id", "class_id"]
    got = out.collect()
    assert len(got) == len(rows) and {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_a_link_between_two_groups_joins_them(spark):
    rng = random.Random(4)
    a = words(rng, 100, 10**6)
    b, c = edited(rng, a, 16), None
    c = edited(rng, b, 16)
    docs = [(3, a), (1, c), (2, b)]
    got = minhash.near_duplicates(spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string"))
    assert edit_distance(a, c) > 20 >= max(edit_distance(a, b), edit_distance(b, c))
    assert {r.class_id for r in got.collect()} == {1}


def replaced(rng, w, at):
    w = list(w)
    for i in at:
        w[i] = f"new{rng.randrange(10**6)}"
    return w


def two_groups_with_one_link(rng, k, size=15):
    """Near copies of ``x`` and of ``y``; ``x`` and ``y`` are 20 edits apart, all other texts of the two groups more."""
    x = words(rng, 100, 10**6)
    y = replaced(rng, x, rng.sample(range(0, 100, 2), 20))
    odd = list(range(1, 100, 2))
    return [(100 * k + j, " ".join(w)) for j, w in enumerate(
        [x, y] + [replaced(rng, w, rng.sample(odd, 2)) for w in (x, y) for _ in range(size)])]


def test_a_link_amid_two_groups_joins_them(spark):
    rng = random.Random(31)
    docs = [row for k in range(8) for row in two_groups_with_one_link(rng, k)]
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(got) == len(docs) and {r.doc_id: r.class_id for r in got} == {i: i // 100 * 100 for i, _ in docs}


@pytest.mark.parametrize("full", [1, 10**6])
def test_links_inside_full_buckets_are_found(spark, monkeypatch, full):
    """The same classes whether texts of one bucket meet in it or under their rarest words."""
    monkeypatch.setattr(minhash, "FULL", full)
    rng = random.Random(32)
    docs, passage = [], words(rng, 40, 10**6)
    for k in range(12):  # most of the texts is one passage: no links but to own near copies
        own = words(rng, 20, 10**6) + passage
        docs += [(10 * k + j, " ".join(w)) for j, w in enumerate([own] + [replaced(rng, own, rng.sample(range(20), 3)) for _ in range(4)])]
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i // 10 * 10 for i, _ in docs}


def test_moderate_buckets_of_unlike_texts_are_not_divided(spark, monkeypatch):
    """Forty texts around a passage are told apart by their sets of words, without a row for each rare word."""
    def divided(*_):
        raise AssertionError("divided by rarest words")

    monkeypatch.setattr(minhash, "_rarest", divided)
    rng = random.Random(33)
    passage = words(rng, 60, 10**6)
    docs = [(2 * k + j, " ".join(w)) for k in range(40) for own in [words(rng, 40, 10**6) + passage] for j, w in enumerate([own, edited(rng, own, 3)])]
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i - i % 2 for i, _ in docs}


def test_pairs_of_unlike_near_copies_are_not_listed(spark, monkeypatch):
    """Longer copies of a text that are too far from its others: told apart by words and lengths, not listed as pairs."""
    listed, staged = [], minhash.staged

    def counted(df):
        out = staged(df)
        listed.extend([out.count()] if out.columns == ["a", "b"] else [])
        return out

    monkeypatch.setattr(minhash, "staged", counted)
    rng = random.Random(34)
    base = words(rng, 700, 10**6)
    near = [replaced(rng, base, rng.sample(range(700), 35)) for _ in range(25)]
    far = [replaced(rng, base, rng.sample(range(700), 56)) for _ in range(25)]
    for w in far:
        for x in words(rng, 160, 10**6):
            w.insert(rng.randrange(len(w)), x)
    docs = [(i, " ".join(w)) for i, w in enumerate(near + far)]
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: 0 if i < 25 else i for i in range(50)}
    assert sum(listed[2:]) <= 100  # beside those with a bucket's first text


def test_word_bits_bound_the_edits():
    rng = random.Random(35)
    bits = lambda w: np.unpackbits(minhash.word_bits(common.word_hashes([" ".join(w)])[0]).view(np.uint8))
    for n, kinds in ((40, 10), (40, 10**6), (900, 50), (3000, 10**6)):
        for _ in range(15):
            a = words(rng, n, kinds)
            b = edited(rng, a, rng.randrange(1, 12))
            edits = edit_distance(a, b) if n < 100 else 11
            assert (bits(a) != bits(b)).sum() + abs(len(a) - len(b)) <= 2 * edits


def test_links_of_short_texts_are_found_as_often_as_those_of_long_ones(spark):
    """Texts of 30 words with every fifth replaced: 0.005 of them may be missed (0.014 with as many sketches as long texts)."""
    rng, n = random.Random(36), 2000
    docs = []
    for k in range(n):
        a = words(rng, 30, 10**9)
        docs += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(replaced(rng, a, range(2, 30, 5))))]
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(r.class_id in (r.doc_id, r.doc_id - r.doc_id % 2) for r in got)
    assert sum(r.doc_id == r.class_id for r in got) - n <= 16


def test_sketches_needed_for_a_similarity():
    assert minhash.functions(0.8) == (65, 3) and minhash.functions(0.95)[0] < 20
    assert minhash.functions(0.7)[1] == 2 and minhash.functions(0.5) == (minhash.MOST, 1)


def test_short_texts_have_more_sketches():
    number = minhash.functions_by_words(0.8, 65, 3)
    assert (np.diff(number) <= 0).all() and number[30] >= 81 and number[-1] == 65 and len(set(number[:27])) == 1
    assert minhash.functions_by_words(0.5, *minhash.functions(0.5)).max() == minhash.MOST


@pytest.mark.parametrize("similarity", [0.8, 0.84, 0.9])
def test_planted_pairs_are_found_wherever_their_edits_are(spark, similarity):
    rng = random.Random(int(similarity * 100))
    docs, want = [], {}
    for k in range(120):
        n = (100, 400, 30, 10)[k % 4]
        a, d = words(rng, n, 10**6), int((1 - similarity) * n + 1e-9)
        at = rng.sample(range(n), d) if k % 3 else [int((i + 0.5) * n / d) for i in range(d)]  # scattered, or evenly spaced
        docs += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(replaced(rng, a, at)))]
        want[2 * k] = want[2 * k + 1] = 2 * k
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[i] in (i, c) for i, c in want.items())
    assert np.mean([got[2 * k + 1] == 2 * k for k in range(120)]) >= 0.98


def test_rows_of_equal_id_join_their_classes(spark):
    rng = random.Random(5)
    a, b = " ".join(words(rng, 50)), " ".join(words(rng, 50))
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")
    assert {(r.doc_id, r.class_id) for r in minhash.near_duplicates(docs).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_near_copies_of_each_text_of_a_repeated_id(spark):
    rng = random.Random(12)
    rows, want = [], {}
    for k in range(0, 80, 10):  # an id with two or three unlike texts, and a near copy of each
        of = [words(rng, 80, 10**6) for _ in range(2 + k // 10 % 2)]
        rows += [(f"d{k + 15}", " ".join(w)) for w in of]
        rows += [(f"d{k + 11 + j}", " ".join(edited(rng, w, 6))) for j, w in enumerate(of)]
        want |= dict.fromkeys([f"d{k + 15}", *(f"d{k + 11 + j}" for j in range(len(of)))], f"d{k + 11}")
    rng.shuffle(rows)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == len(rows) and {r.doc_id: r.class_id for r in got} == want


def test_components_of_a_long_chain(spark):
    ids = list(range(100))
    random.Random(6).shuffle(ids)
    links = [(a, b) for a, b in zip(ids, ids[1:], strict=False)] + [(200, 201)]
    got = {r["id"]: r["class"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(ids, 0), 200: 200, 201: 200}


def near_classes(docs):
    """All pairs that share a run of five words (or are short), by the full alignment."""
    texts = {i: common.word_hashes([t])[0] for i, t in docs}
    aligned = {i: minhash.Aligned(w) for i, w in texts.items() if len(w)}
    sets = {i: set(common.ngram_hashes(w, min(5, len(w))).tolist()) for i, w in texts.items() if len(w)}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(aligned)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            longest = max(len(texts[a]), len(texts[b]))
            if 5 * abs(len(texts[a]) - len(texts[b])) <= longest and sets[a] & sets[b] and minhash.within(
                    aligned[a], aligned[b], int(0.2 * longest + 1e-9)):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: find(i) for i in texts}


def test_op2_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert {r.doc_id: r.class_id for r in Q.op2_minhash_dedup(spark, SF).collect()} == near_classes(docs)


# --- substring dedup ---------------------------------------------------------------------


def without_repeats(docs, window=50):
    seen, out = {}, {}
    texts = sorted((i, (t or "").encode().split()) for i, t in docs if i is not None)
    for i, w in texts:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            seen[k] = min(seen.get(k, i), i)
    for i, w in texts:
        cover = [False] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s:s + window])] < i:
                cover[s:s + window] = [True] * window
        kept = b" ".join(x for x, c in zip(w, cover, strict=True) if not c)
        out[i] = (len(w), sum(cover), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("window,anchor", [(50, 20), (8, 3)])
def test_substring_dedup_against_plain_python(spark, window, anchor):
    rng = random.Random(window)
    pool = words(rng, 400, 6 if window == 8 else 200)
    docs = []
    for i in range(60):
        w = []
        for _ in range(rng.randrange(4)):
            s = rng.randrange(len(pool))
            w += pool[s:s + rng.randrange(2 * window)] + words(rng, rng.randrange(5))
        docs.append((i, " \n".join(w)))
    docs += [(70, None), (71, ""), (72, docs[5][1]), (73, "é " * 300), (74, "é " * 200), (75, "x" * 50000)]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, n_words string")
    out = substring.substring_dedup(df, window=window, anchor=anchor).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == without_repeats(docs, window)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in out)
    assert substring.substring_dedup(df.limit(0)).count() == 0


def test_substring_rows_without_an_id_or_with_one_id(spark):
    text = " ".join(map(str, range(60)))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (5, "a " + text), (9, text)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in substring.substring_dedup(df).collect())
    assert got == [(0, 0), (5, 0), (5, 0), (5, 0), (9, 60)]


def test_op6_against_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in Q.op6_substring_dedup(spark, SF).collect()}
    assert got == without_repeats(docs)


# --- toxicity -----------------------------------------------------------------------------


def test_automaton_against_edit_distance():
    terms = [toxicity.Term(t, s) for t, s in (("idiot", False), ("disgusting", False), ("stupid", True), ("scum", True), ("abcdefgh", True))]
    rng = random.Random(7)
    tries = ["", "scumbag", "scu", "idiots", "idio", "1diot", "stupidity", "stupd", "disgstng", "x" * 99]
    for _ in range(1500):
        w = list(rng.choice(terms).text)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.randrange(2)] = rng.choice(["", "a", "d", "zz"])
        tries.append("".join(w))

    def best(w):
        hits = []
        for i, t in enumerate(terms):
            ends = range(min(len(w), toxicity.LONGEST) + 1) if t.stem else [len(w)]
            if not t.stem and len(w) > toxicity.LONGEST:
                continue
            d = min(edit_distance(w[:e], t.text) for e in ends)
            hits += [d * 65536 + i] if d <= t.edits else []
        return min(hits, default=int(toxicity.Automaton.NONE))

    got = toxicity.Automaton(terms).match(np.array(tries, dtype=object))
    assert got.tolist() == [best(w) if w else int(toxicity.Automaton.NONE) for w in tries]
    assert toxicity.Automaton([]).match(np.array(["a"], dtype=object)).tolist() == [int(toxicity.Automaton.NONE)]


def toxic_corpus(n=600, seed=8):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w, bad = words(rng, 30, 2000), i % 5 == 0
        if bad:
            for t in rng.sample(["wretchling", "gorbag", "snivelorc"], 2):
                w.insert(rng.randrange(30), t)
        elif i % 7 == 0:
            w.insert(15, 'they wrote the word "wretchling" in it')
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_learns_matches_misspellings_and_spares_quotations(spark):
    docs, labels = toxic_corpus()
    more = [(1000, "you are a wretchlng and a gorbaag"), (1001, 'he said the word "wretchling" was used'), (1002, "a calm text"),
            (1003, ""), (1004, None), (None, "gorbag snivelorc gorbag"), (1005, "calm " * 50000 + "gorbag gorbag snivelorc")]
    df = spark.createDataFrame([(*d, "clash") for d in docs + more + [docs[0]]], "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels + [(None, 1), (1002, None), (3, 0)], "doc_id long, toxic int")
    out = toxicity.toxicity(df, lab)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) + len(more) + 1 and all(0 <= r.score <= 1 for r in rows)
    assert all(got[i].predicted == t for i, t in labels)
    assert got[1000].predicted == 1 and got[1001].predicted == got[1002].predicted == 0 and got[1005].predicted == 1
    assert got[1003].score == got[1004].score < 0.5 and got[None].predicted == 1 and not got[None].held_out
    import zlib
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in labels)


def test_misspelled_inflected_terms_of_a_stem_are_matched(spark):
    rng = random.Random(13)
    docs, labels = [], []
    for i in range(600):
        w, bad = words(rng, 30, 2000), i % 5 == 0
        if bad:
            w.insert(rng.randrange(30), rng.choice(["gorbag", "gorbags", "gorbagish", "gorbaggy"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    more = [(1000, "you g0rbag"), (1001, "what gorbogs they are"), (1002, "a gxrbagish thing"), (1003, "a calm text"), (1004, "some garbxg")]
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [(t.text, t.stem) for t in model.terms] == [("gorbag", True)]
    df = spark.createDataFrame(docs + more, "doc_id long, text string")
    got = {r.doc_id: r.score for r in df.select("doc_id", model.score(df["text"]).alias("score")).collect()}
    assert min(got[i] for i in (1000, 1001, 1002)) >= 0.5 > got[1003] == got[1004]
    assert all((got[i] >= 0.5) == t for i, t in labels)


def test_toxicity_without_anything_to_learn(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.toxicity(df, none).collect()] == [0.5, 0.5]
    assert toxicity.toxicity(df.limit(0), none).count() == 0


def test_held_out_labels_are_never_read(spark):
    docs, labels = toxic_corpus(300)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    held = {r.doc_id for r in df.select("doc_id", toxicity.held_out(df["doc_id"]).alias("h")).where("h").collect()}
    a = toxicity.toxicity(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    flipped = [(i, 1 - t if i in held else t) for i, t in labels]
    b = toxicity.toxicity(df, spark.createDataFrame(flipped, "doc_id long, toxic int")).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_op5_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    lab = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    held = [(r.score, r.predicted, lab[r.doc_id]) for r in Q.op5_toxicity(spark, path).collect() if r.held_out and r.doc_id in lab]
    good, bad = [s for s, _, t in held if t], [s for s, _, t in held if not t]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.93 and np.mean([p == t for _, p, t in held]) > 0.97


# --- SentencePiece -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.load()


def best_score(p, word, score):
    best = [0.0] + [-1e99] * len(word)
    for i in range(1, len(word) + 1):
        for j in range(max(0, i - p.longest), i):
            s = score.get(word[j:i], p.missing if i - j == 1 else None)
            if s is not None:
                best[i] = max(best[i], best[j] + s)
    return best[-1]


def test_viterbi_finds_the_best_segmentation(pieces):
    import sentencepiece as library
    model = library.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    by_id = dict(zip(pieces.ids.tolist(), pieces.scores.tolist(), strict=True))
    score = {model.id_to_piece(i): s for i, s in by_id.items()}
    rng = random.Random(9)
    tries = ["".join(rng.choice("abcdehinorst'-é1") for _ in range(rng.randrange(1, 25))) for _ in range(300)] + ["▁x", "zzz" * 30]
    for w, ids in zip(tries, pieces.encode(tries), strict=True):
        assert all(int(i) in by_id for i in ids)
        assert abs(sum(by_id[int(i)] for i in ids) - best_score(pieces, sentencepiece.SPACE + w, score)) < 1e-9
        assert model.decode(ids.tolist()) == w.replace(sentencepiece.SPACE, " ")


def test_unigram_scores_are_added_as_they_are():
    p = sentencepiece.Pieces([("<unk>", 0, "unknown"), ("▁", -3.0, "normal"), ("a", -2.0, "normal"), ("b", -2.0, "normal"),
                              ("ab", -3.5, "normal"), ("▁a", -2.5, "normal"), ("ba", -3.0, "normal")], ranks=False)
    assert [list(map(int, x)) for x in p.encode(["ab", "aba", "z"])] == [[5, 3], [5, 6], [1, 0]]


def test_round_trip_of_odd_texts(spark, pieces):
    texts = [None, "", " ", "  a  b ", "a\n\tb\r\n", "日本語 \U0001F600́", "x" * 30000, "\x00\x7f", "a b", "▁a", "<s> <0x0A>", "ab ab ab"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    coded = df.select("doc_id", "text", sentencepiece.encode_column(df["text"], pieces).alias("ids"))
    rows = coded.select("*", sentencepiece.decode_column(coded["ids"], pieces).alias("back")).collect()
    for r in rows:
        assert r.back == (None if r.text is None else r.text.replace("▁", " "))
        assert (r.ids is None) == (r.text is None) and (r.text != "" or r.ids == [])
    assert coded.limit(0).count() == 0
    out = {r.doc_id: r for r in sentencepiece.tokenize(df, pieces, keep=("doc_id", "ids")).collect()}
    assert [(out[r.doc_id].ids, out[r.doc_id].n_ids) for r in rows] == [(r.ids, len(r.ids or [])) for r in rows]
    assert [out[i].round_trip for i in range(3)] == [None, True, True] and all(out[i].round_trip for i in range(1, 12))
    assert sentencepiece.tokenize(df.limit(0), pieces).count() == 0
    assert pieces.decode([np.array([-5, 99999999])]) == [""]


def test_op4_round_trips_every_document(spark):
    rows = Q.op4_sentencepiece(spark, SMALL).collect()
    assert len(rows) == 200 and all(r.round_trip and r.n_ids == len(r.ids) for r in rows)


# --- HTML -----------------------------------------------------------------------------------


WEIGHTS = pages_.weights_of({"p": (900.0, 1000.0), "noise": (0.0, 500.0)})


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b &amp; c", "a\nb & c"), ("<p>x</p", "x"), ("<p>1 < 2 and 3</p>", "1 < 2 and 3"),
    ("<nav><ul><li><a href=x>menu</a></ul><article><h1>T</h1><p>o<b>n</b>e<br>two</article><footer>f</footer>", "T\none two"),
    ("<main><p>a</p><aside>s</aside><form>f</form><ul><li>b<li>c</ul><section class='user-comments'><p>no</p></section></main>", "a\nb\nc"),
    ("<article><header><h1>Head</h1><span>by me</span></header><p>x</article>", "Head\nx"),
    ("<div id='cookie-notice'>we use</div><script>var a='<p>no</p>'</script><style>p{}</style><p>yes &eacute;&#233;</p><!-- c --><p hidden>h</p>", "yes éé"),
    ("<header><p>site</p></header><div class=content><p>" + "word " * 20 + "</p><div class='ad'>buy</div><p>more words here</p></div>",
     "word " * 19 + "word\nmore words here"),
    ("<p>cut <b>off", "cut off"), ("<article><p>a</p><article class='comment'><p>reader</p></article></article>", "a"),
    ("<table><tr><td>a a a a<td>b b b b<tr><td>c c c c</table>", "a a a a\nb b b b\nc c c c"), ("<div title='a > b'><p>q</p></div>", "q"), ("<<p>>x", "<\n>x"),
])
def test_main_text_of_small_pages(page, text):
    assert pages_.main_text(page, WEIGHTS) == text


def test_best_run_against_all_runs():
    rng = random.Random(10)
    for _ in range(200):
        s = [rng.randrange(-5, 6) for _ in range(rng.randrange(12))]
        a, b = pages_.best_run(np.array(s))
        assert sum(s[a:b]) == max([0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)])


def test_extract_keeps_rows_and_handles_odd_ones(spark):
    rows = [(1, "u", "<article><p>one</p></article>", "clash"), (1, "u", "<article><p>one</p></article>", "clash"), (None, None, None, "clash"),
            (3, "u", "", "clash"), (4, "u", "<p>" + "a " * 100000, "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = pages_.extract_text(df)
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted(r.n_chars for r in out.collect()) == [0, 0, 3, 3, 199999]
    assert pages_.extract_text(df.limit(0)).count() == 0


def test_op8_against_the_marked_article(spark):
    for r in Q.op8_html_extract(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet"), ["page_id", "url"]).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = [" ".join(pyhtml.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


@pytest.mark.parametrize("mark", ["<main id=app></main>", "<article><p>A teaser of six words here</p></article>"])
def test_an_empty_or_small_main_element_does_not_hide_the_text(mark):
    page = f"<nav><a href=x>menu</a></nav>{mark}<div><p>{'word ' * 60}</p><p>{'more ' * 60}</p></div><footer>f</footer>"
    got = pages_.main_text(page, WEIGHTS).split()
    assert got.count("word") == got.count("more") == 60 and "menu" not in got and "f" not in got


def test_learned_weights_find_the_article_without_its_mark(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    weights = pages_.learn_weights(pages, "page_id", "html")
    rows = [r.html for r in pages.collect()]
    bare = [re.sub(r"</?(?:article|main)\b[^>]*>", "", h) for h in rows]
    assert [pages_.main_text(b, weights) for b in bare] == [pages_.main_text(h, weights) for h in rows]


def test_pages_with_an_empty_or_small_main_element_are_no_labels(spark):
    page = "<main></main><article><p>teaser</p></article><div><p>" + "word " * 60 + "</p></div>"
    df = spark.createDataFrame([(i, page) for i in range(5)], "page_id long, html string")
    assert pages_.learn_weights(df, "page_id", "html") == {}


# --- names that clash, article text under noisy names, deep pages -------------------------


def test_article_text_under_names_that_look_like_noise():
    from homestat.llm.html import main_text
    para = "<p>" + "These are many plain words of the story itself. " * 6 + "</p>"
    lead = "<p>" + "The lead of the story has some words. " * 3 + "</p>"
    for inner in ("<section class='social-history'>{}</section>", "<div class='long-form'>{}</div>", "<div id='search-engines'>{}</div>",
                  "<div class='content form-group'>{}</div>"):
        for page in (f"<article>{lead}{inner.format(para)}</article>", f"<html><body><nav>menu words</nav><article>{inner.format(para)}</article></body></html>"):
            assert "many plain words" in main_text(page, {}), page[:60]
    assert "many plain words" in main_text(f"<main><div class='alert-levels'>{para}</div></main>", {})
    gone = f"<article>{para}<div class='ad'>buy this now</div><div class='comment-list'><p>{'reader says. ' * 90}</p></div><div class='post-newsletter'>join us</div></article>"
    assert not {"buy", "reader", "join"} & set(main_text(gone, {}).split())


def test_deep_pages_take_time_in_proportion():
    import time

    from homestat.llm.html import parse
    t = time.perf_counter()
    assert len(parse("<div>" * 20_000 + "deep" + "</div>" * 20_000 + "</b>" * 20_000 + "<li>" * 200)) > 40_000
    assert time.perf_counter() - t < 4


def test_clashing_column_names(spark):
    from homestat.llm.html import extract_text
    from homestat.llm.lines import line_dedup
    from homestat.llm.urls import url_filter
    text = "a\nb\nc\nd"
    docs = spark.createDataFrame([(1, text, 7, "x", 1, 2, 3), (2, text, 8, "y", 1, 2, 3)],
                                 "doc_id long, text string, starts int, _ld_id string, _LD_kept int, N_LINES int, pos int")
    out = {r.doc_id: r for r in line_dedup(docs).collect()}
    assert (out[1].text, out[2].text) == (text, "") and out[2].n_removed == 4 and out[2].starts == 8 and "N_LINES" not in out[1].asDict()
    pages = spark.createDataFrame([(1, "http://a.com/x", "<article><p>some words here</p></article>", "h", "p", "H", "T", 5)],
                                  "page_id long, url string, html string, h string, p string, Host string, Text string, score int")
    judged = url_filter(pages, [("com/", "allow")]).first()
    assert (judged.host, judged.path, judged.rule, judged.verdict, judged.h, judged.p) == ("a.com", "/x", "com/", "allow", "h", "p")
    assert extract_text(pages).first().text == "some words here"


def test_products_beyond_a_long(spark):
    from homestat.llm.topk import exact_topk
    rows = spark.createDataFrame([(1, [3e9, 3e9]), (2, [3e9, 3e9]), (3, [-4e9, -4e9])], "id long, v array<double>")
    got = [(r.query_id, r.vec_id, r.score) for r in exact_topk(rows.where("id = 1"), rows, 2).collect()]
    assert sorted(got) == [(1, 2, 2**63 - 1), (1, 3, -(2**63))]
