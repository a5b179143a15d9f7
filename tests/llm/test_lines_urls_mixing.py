"""Line dedup, URL filter and mixing on small tables: nulls, empties, ties, repeats, clashing columns."""

import random

from pyspark.sql import functions as F

from homestat.llm import mixing
from homestat.llm.lines import line_dedup
from homestat.llm.urls import url_filter

DOCS = "doc_id long, text string, n_lines string, pos int"


def test_later_windows_go_and_overlaps_merge(spark):
    docs = spark.createDataFrame([
        (1, "a\nb\nc\nd\ne", "x", 1), (2, "q\na\nb\nc\nd\nr", "x", 2), (3, "a\nb", "x", 3), (4, None, "x", 4),
        (5, "", "x", 5), (6, "a\nb\nc", None, 6), (7, "\n \n\t\n\nz", "x", 7), (8, "\n\n\nz2", "x", 8)], DOCS)
    got = {r.doc_id: r for r in line_dedup(docs).collect()}
    assert (got[1].text, got[1].n_removed) == ("a\nb\nc\nd\ne", 0)
    assert (got[2].text, got[2].n_lines, got[2].n_removed) == ("q\nr", 6, 4)
    assert got[3].text == "a\nb" and got[6].text == "" and got[6].n_removed == 3
    assert got[4].text is None and got[4].n_lines == 0 and (got[5].text, got[5].n_lines) == ("", 1)
    assert got[7].n_removed == got[8].n_removed == 0  # windows of blank lines are no repeats
    assert got[6].pos == 6 and line_dedup(docs).columns == ["doc_id", "text", "pos", "n_lines", "n_removed"]


def test_repeats_inside_a_document_and_of_rows(spark):
    text = "a\nb\nc\na\nb\nc"
    docs = spark.createDataFrame([(1, text), (1, text), (None, "x\ny\nz"), (3, "x\ny\nz\nw")], "doc_id long, text string")
    rows = sorted(line_dedup(docs).collect(), key=lambda r: (r.doc_id or 0, r.text))
    assert [r.text for r in rows] == ["x\ny\nz", "a\nb\nc", "a\nb\nc", "w"]  # a null id comes first
    assert line_dedup(docs.limit(0)).count() == 0


def test_line_dedup_against_plain_python(spark):
    rng = random.Random(3)
    docs = [(i, "\n".join(rng.choice("abc") for _ in range(rng.randrange(12)))) for i in range(60)]
    seen, want = set(), {}
    for i, t in docs:
        lines, gone = t.split("\n"), set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if any(w):
                gone |= {p, p + 1, p + 2} if w in seen else set()
                seen.add(w)
        want[i] = "\n".join(x for p, x in enumerate(lines) if p not in gone)
    got = line_dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.text for r in got.collect()} == want


def test_one_very_long_document(spark):
    docs = spark.createDataFrame([(1, "\n".join(str(i % 5000) for i in range(10000)))], "doc_id long, text string")
    row = line_dedup(docs).first()
    assert row.n_lines == 10000 and row.text == "\n".join(map(str, range(5000)))


def test_no_python_in_native_plans(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert "Python" not in line_dedup(docs)._jdf.queryExecution().executedPlan().toString()


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block")]


def test_urls_rules_hosts_and_paths(spark):
    urls = ["http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "http://example.com/fr/1", "ftp://x.NET/es/a#b",
            "http://x.com", "no scheme", None, "a://b://c/d", "http://notexample.com/en/", "http://x.org?x/y", "", "http://É.com/",
            "http://u.org/" + "z" * 20000]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(0, urls[0], "clash")], "page_id long, url string, score string")
    rows = url_filter(pages, RULES).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == len(urls) + 1
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(5)] == [
        ("a.example.com", "/en/x", "example.com/en/", "block"), ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("example.com", "/fr/1", "com/", "allow"), ("x.net", "/es/a", "net/es/", "block"), ("x.com", "", None, got[4].verdict)]
    assert [(got[i].host, got[i].path) for i in (5, 6, 7, 9, 10)] == [("", ""), ("", ""), ("b:", "//c/d"), ("x.org", ""), ("", "")]
    assert got[8].rule == "com/" and got[11].host == "É.com"
    assert {r.verdict for r in rows} <= {"allow", "block"} and got[5].verdict == got[6].verdict == got[10].verdict
    assert url_filter(pages.limit(0), RULES).count() == 0


def test_urls_model_separates_unruled_hosts(spark):
    good = [f"http://news{i}.com/story/{i}" for i in range(40)]
    bad = [f"http://casino{i}.net/es/win-{i}" for i in range(40)]
    probe = ["http://news99.org/story/7", "http://casino99.org/es/win-7"]
    pages = spark.createDataFrame(list(enumerate(good + bad + probe)), "page_id long, url string")
    got = {r.url: r.verdict for r in url_filter(pages, RULES).collect()}
    assert got[probe[0]] == "allow" and got[probe[1]] == "block"


def fill(budget, caps, weights):
    """Plain water filling in exact fractions, one level."""
    from fractions import Fraction
    open_, share = set(caps), dict.fromkeys(caps, Fraction(0))
    rest = Fraction(budget)
    while open_:
        total = sum(weights[k] for k in open_)
        full = {k for k in open_ if rest * weights[k] >= caps[k] * total}
        if not full:
            for k in open_:
                share[k] = rest * weights[k] / total
            break
        for k in full:
            share[k] = Fraction(caps[k])
            rest -= caps[k]
        open_ -= full
    return share


def test_waterfill_against_fractions(spark):
    rng = random.Random(5)
    for _ in range(6):
        caps = {c: rng.randrange(0, 100) for c in "abcdef"}
        weights = {c: rng.randrange(1, 6) for c in caps}
        budget = rng.randrange(sum(caps.values()) + 1)
        nodes = spark.createDataFrame([(0, c, caps[c], weights[c], budget) for c in caps], "p int, c string, cap long, weight long, budget long")
        got = {r.c: r.share for r in mixing.waterfill(nodes, ["p"], "c").collect()}
        want = fill(budget, caps, weights)
        assert sum(got.values()) == budget
        assert all(abs(got[c] - want[c]) < 1 and got[c] <= caps[c] for c in caps)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("x", "s1", 10), ("x", "s2", 90), ("y", "s3", 100)], "domain string, source string, tokens long")
    got = {r.source: r.budget for r in mixing.leaf_budgets(leaves, ["domain", "source"], {}, 120, 1).collect()}
    assert got == {"s1": 10, "s2": 50, "s3": 60}  # x gets its half: what s1 lacks, s2 gives
    got = {r.source: r.budget for r in mixing.leaf_budgets(leaves, ["domain", "source"], {"domain": {"x": 9}}, 120, 1).collect()}
    assert got == {"s1": 10, "s2": 90, "s3": 20}  # all of x is not enough: y gives the rest


def test_mix_meets_budgets_with_whole_documents_and_one_cut(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, " ".join("w" * rng.randrange(40)), "en", "hot" if i % 3 else f"s{i % 7}", "clash") for i in range(400)]
                                 + [(400, None, None, None, "clash"), (401, "", "en", "empty", "clash"), (None, "a b", "en", "hot", "clash")],
                                 "doc_id long, text string, lang string, source string, copies string")
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    mixed = mixing.mix(docs, levels, {"source": {"s1": 5}}, total_tokens=3000, max_epochs=3, seed=2)
    rows = mixed.collect()
    assert len(rows) == 403 and {r.lang for r in rows} == {"en", "(none)"}
    leaf = {}
    for r in rows:
        leaf.setdefault((r.lang, r.source), []).append(r)
    assert sum(r.copies * r.n_tokens + r.cut_tokens for r in rows) == 3000
    for rs in leaf.values():
        assert sum(r.cut_tokens > 0 for r in rs) <= 1 and max(r.copies for r in rs) - min(r.copies for r in rs) <= 1
        assert all(r.cut_tokens < r.n_tokens or not r.cut_tokens for r in rs)
    assert all(r.copies == 0 for r in leaf["(none)", "(none)"])
    taken = mixing.take(docs, mixed)
    assert taken.columns == docs.columns
    assert taken.select(F.sum(mixing.n_words(F.col("text")))).first()[0] == 3000
    assert sorted(map(str, mixing.mix(docs, levels, {"source": {"s1": 5}}, total_tokens=3000, max_epochs=3, seed=2).collect())) == sorted(map(str, rows))
    assert mixing.mix(docs.limit(0), levels, {}).count() == 0
