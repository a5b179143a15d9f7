"""Cross-tokenizer alignment against whole-text encoding and byte intervals; the perfect hash against a dictionary."""

import functools
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from homestat.llm import queries as Q
from homestat.llm.alignment import BYTE_LEVEL, PIECES, Aligner, Alignment, MinimalHash, align_tokenizers, build_levels, shard_of
from homestat.llm.common import table

SF = "/root/testdata/sf0.001"
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES), ByteLevel()


def token_spans(tokenizers, text):
    """Ids and byte ranges of all tokens of both, or nothing where they do not spell the text."""
    a, b, _ = tokenizers
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(x): x for x in plain}
    letter |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    ba = [bytes(letter[c] for c in a.id_to_token(i)) for i in ia]
    bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
    raw = (" " + text).encode()
    if b"".join(ba) != raw or b"".join(bb) != raw:
        return None
    ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
    return ia, ends(ba), ib, ends(bb)


def groups_and_links(spans):
    ia, ea, ib, eb = spans
    groups, links, x, y = [], [], 0, 0
    for cut in sorted(set(ea) & set(eb)):
        u, v = ea.index(cut) + 1, eb.index(cut) + 1
        groups.append(",".join(map(str, ia[x:u])) + "|" + ",".join(map(str, ib[y:v])))
        for i in range(x, u):
            for j in range(y, v):
                if max(ea[i - 1] if i else 0, eb[j - 1] if j else 0) < min(ea[i], eb[j]):
                    links.append((ia[i], ib[j]))
        x, y = u, v
    return groups, links


def expected(tokenizers, texts):
    found = [groups_and_links(s) if t and (s := token_spans(tokenizers, t)) else ([], []) for t in texts]
    spans = [token_spans(tokenizers, t) if t and g else ([], [], [], []) for t, (g, _) in zip(texts, found, strict=True)]
    count = Counter(pair for _, links in found for pair in set(links))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return [(len(s[0]), len(s[2]), len(g), len(ln), sum(count[p] == top[p[0]] for p in ln), sum(count[p] for p in ln), ";".join(g))
            for s, (g, ln) in zip(spans, found, strict=True)], count


ODD = [None, "", " ", "  two  spaces ", "a▁b", "<s> x </s><|endoftext|>", "<0x41>", "tab\tand\r\nlines\n\n end", "naïve été é ﬁ",
       "中文字符 \U0001f600\U0001f469‍\U0001f4bb", "it's we'll 's 'S", " nbsp　wide", "x", "x", "12345 67,890.12 $%^ ___", "word " * 50]


def test_whole_result_of_given_and_odd_texts(spark, tokenizers):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id here"), (20_000, "endless" * 600)]
    want, count = expected(tokenizers, [t for _, t in rows])
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n_a int, groups string, _al_row int").repartition(5)
    alignment = Alignment(spark)
    counts = alignment.count(docs)
    got = {r.doc_id: tuple(r[1:]) for r in alignment.align(docs, counts).collect()}
    assert got == {d: w for (d, _), w in zip(rows, want, strict=True)}
    n_b = 32_000
    assert {(r.a, r.b): r.n_docs for r in alignment.pair_counts(counts).collect()} == dict(count) and max(b for _, b in count) < n_b
    parts = Alignment(spark, pairs_a_pass=len(count) // 3)  # the same by several passes over parts of the pairs
    assert {r.doc_id: tuple(r[1:]) for r in parts.align(docs, counts).collect()} == got


def test_query_digests(spark, tokenizers):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    want, _ = expected(tokenizers, [r.text for r in rows])
    got = {r.doc_id: tuple(r[n] for n in (*NAMES, "groups_sha256")) for r in Q.op11_token_alignment(spark, SF).collect()}
    assert got == {r.doc_id: (*w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "") for r, w in zip(rows, want, strict=True)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokenizers(docs).collect() == []
    none = spark.createDataFrame([(1, None), (1, ""), (2, "▁")], "doc_id long, text string")
    assert sorted(tuple(r) for r in align_tokenizers(none).collect()) == [(1, *[0] * 6, ""), (1, *[0] * 6, ""), (2, *[0] * 6, "")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab \n\t'1,é▁中  \x1c\x85", "  ", " the", "</s>", "'ll", "ing ", "..."]), max_size=25).map("".join))
def test_words_encode_as_in_the_whole_text(tokenizers, text):
    numbers, groups = aligner().aligned([text])
    spans = token_spans(tokenizers, text) if text else None
    want, links = groups_and_links(spans) if spans else ([], [])
    assert groups[0] == ";".join(want) and numbers[0, 3] == len(links)


@functools.cache
def aligner():
    with open(BYTE_LEVEL, encoding="utf-8") as f, open(PIECES, "rb") as g:
        made = Aligner(f.read(), g.read())
    made.weigh = lambda links: (links >= 0, links)
    return made


def test_minimal_hash_numbers_every_key_once():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 31, 60_000))
    shards = []
    for s in np.unique(shard_of(keys)):
        levels = build_levels(keys[shard_of(keys) == s])
        shards.append((int(s), [len(x) for x in levels], np.packbits(np.concatenate(levels)).tobytes()))
    find = MinimalHash(shards)
    assert sorted(find(keys)) == list(range(len(keys)))
    other = np.setdiff1d(rng.integers(0, 1 << 31, 5_000), keys)
    at, held = find(other), np.empty(len(keys), np.int64)
    held[find(keys)] = keys
    assert not (held[np.maximum(at, 0)] == other)[at >= 0].any() and len(MinimalHash([])(keys)) == len(keys)


def test_every_token_encodes_to_itself_by_rank(tokenizers):
    """So that merging by rank takes the very merges of the tokenizer's own list."""
    a = aligner()
    quick = a.quick._core_bpe
    assert all(quick.encode_single_piece(t) == [i] for i, t in a.a_bytes.items() if i != 50256)
    words = ["the", "Onatorsh", "re's", "1234,5", "été", "x×÷y", "don't--", "ÀÉǅǈ", "a'll'd"]
    assert [a.quick.encode_ordinary(" " + w) for w in words] == [tokenizers[0].encode(" " + w, add_special_tokens=False).ids for w in words]
