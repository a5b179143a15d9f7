"""Generic operators, checked against brute force on small fixtures.

The skew tests put one group at a third (or more) of all rows and lower the size from
which groups are cut, so a group always spans several pieces."""

import datetime as dt
import math
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from homestat.operators import aggregates as A
from homestat.operators import relational as R
from homestat.operators import splits
from homestat.operators import windows as W


def _skewed_rows(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 9)}"
        v = round(rnd.uniform(0, 1000), 2) if rnd.random() > 0.02 else None
        rows.append((g, v, i))
    rows += [("dup", 5.0, n + i) for i in range(7)]          # all-equal group
    rows += [("single", 42.0, 2 * n)]                          # one value
    rows += [(None, 1.0, 3 * n), (None, 3.0, 3 * n + 1)]      # NULL group key
    return rows


@pytest.mark.parametrize("hot_rows", [1, 100, 10**6])
def test_median_matches_brute_force(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(splits, "HOT_ROWS", hot_rows)
    rows = _skewed_rows()
    df = spark.createDataFrame(rows, "g string, v double, id long")
    got = {r["g"]: (r["m"], r["n"]) for r in
           A.group_median(df, "g", "v", out="m", count_out="n").collect()}
    groups = {}
    for g, v, _ in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vals in groups.items():
        assert got[g][1] == len(vals)
        assert got[g][0] == pytest.approx(statistics.median(vals), abs=1e-9)


def test_median_two_groups_whole_table(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert A.group_median(df, [], "v", out="m").first()["m"] == 2.5


def test_consecutive_pairs_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(2500):
        acct = "hot" if i % 2 == 0 else f"a{rnd.randint(0, 200)}"
        day = None if rnd.random() < 0.03 else rnd.randint(0, 400)
        rows.append((acct, day, float(rnd.randint(1, 9)), i))
    df = spark.createDataFrame(rows, "acct string, day int, price double, id long")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = W.consecutive_pairs(df, "acct", "day", ["id"], ["price", "id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = set()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for acct, rs in by.items():
        rs.sort(key=lambda r: (r[1] is None, r[1] if r[1] is not None else 0, r[3]))
        for a, b in zip(rs, rs[1:]):
            expected.add((acct, a[1], a[2], a[3], b[1], b[2], b[3]))
    got_set = {(r["acct"], r["first_day"], r["first_price"], r["first_id"], r["second_day"], r["second_price"],
                r["second_id"]) for r in got}
    assert len(got) == len(expected)
    assert got_set == expected


def test_global_and_grouped_rank(spark):
    rnd = random.Random(5)
    rows = [(f"k{i % 4}", float(rnd.randint(0, 50)), i) for i in range(1200)]
    df = spark.createDataFrame(rows, "g string, x double, id long")
    got = {r["id"]: r["rank"] for r in W.rank_by(df, None, "x", tie=["id"]).collect()}
    order = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert got == {r[2]: i + 1 for i, r in enumerate(order)}
    got_g = {r["id"]: r["rank"] for r in W.rank_by(df, "g", "x", tie=["id"]).collect()}
    exp_g = {}
    for g in {r[0] for r in rows}:
        for i, r in enumerate(sorted([r for r in rows if r[0] == g], key=lambda r: (-r[1], r[2]))):
            exp_g[r[2]] = i + 1
    assert got_g == exp_g


def test_rank_with_null_groups(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "g string, x int")
    out = sorted((r["g"] or "", r["x"], r["rank"]) for r in W.rank_by(df, "g", "x").collect())
    assert out == [("", 1, 2), ("", 2, 1), ("a", 5, 1)]


@pytest.fixture()
def cut(monkeypatch):
    """Groups of more than 50 rows are cut into pieces."""
    monkeypatch.setattr(splits, "HOT_ROWS", 50)


def _skewed(n=3000, seed=5):
    rnd = random.Random(seed)
    return [("hot" if i % 3 == 0 else None if i % 11 == 0 else f"g{rnd.randint(0, 40)}", i,
             None if rnd.random() < 0.1 else float(rnd.choice([7, 7, 7, rnd.randint(0, 99)]))) for i in range(n)]


def test_cut_groups_are_found_and_pieces_follow_the_order(spark, cut):
    df = spark.createDataFrame(_skewed(), "g string, t long, v double")
    rows = splits.split_groups(df, ["g"], "t").collect()
    hot = [r for r in rows if r["g"] == "hot"]
    assert all(r["_hot"] for r in hot) and len({r["_piece"] for r in hot}) > 30
    pieces = [r["_piece"] for r in sorted(hot, key=lambda r: r["t"])]
    assert pieces == sorted(pieces)
    assert {r["g"] for r in rows if r["_hot"]} >= {"hot", None}


def test_cut_median_pairs_and_ranks_match_uncut(spark, monkeypatch):
    rows = _skewed() + [("empty", -1, None), ("one", -2, 3.0)]
    df = spark.createDataFrame(rows, "g string, t long, v double")

    def run():
        med = {r["g"]: (r["m"], r["n"]) for r in A.group_median(df, "g", "v", out="m", count_out="n").collect()}
        pairs = sorted((str(r["g"]), r["first_t"], r["second_t"]) for r in W.consecutive_pairs(df, "g", "t", [], ["v"]).collect())
        rank = {(r["g"], r["t"]): r["rank"] for r in W.rank_by(df, "g", "v", tie=["t"]).collect()}
        return med, pairs, rank

    plain = run()
    monkeypatch.setattr(splits, "HOT_ROWS", 50)
    assert run() == plain
    med, pairs, _ = plain
    assert med["empty"] == (None, 0) and med["one"] == (3.0, 1)
    for g in ("hot", None):
        v = [r[2] for r in rows if r[0] == g and r[2] is not None]
        assert med[g] == (statistics.median(v), len(v))
        t = sorted(r[1] for r in rows if r[0] == g)
        assert [p[1:] for p in pairs if p[0] == str(g)] == list(zip(t, t[1:], strict=False))


def test_median_of_a_whole_table_and_of_one_frequent_value(spark):
    vals = [5.0] * 900 + [float(i) for i in range(101)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double")
    r = A.group_median(df, None, "v", out="m", count_out="n").first()
    assert (r["m"], r["n"]) == (statistics.median(vals), 1001)
    none = A.group_median(df.where("v is null"), None, "v", out="m", count_out="n").first()
    assert (none["m"], none["n"]) == (None, 0)


def test_latest_n_and_pct_change(spark):
    rows = [("r", d, p) for d, p in [(1, 100.0), (2, None), (3, 110.0), (4, 0.0), (5, 5.0)]]
    df = spark.createDataFrame(rows, "region string, d int, p double")
    last3 = sorted(r["d"] for r in W.latest_n(df, "region", "d", 3).collect())
    assert last3 == [3, 4, 5]
    ch = {r["d"]: r["c"] for r in W.pct_change(df, "region", "d", "p", "c").collect()}
    # the gap repeats the last value (0 % change); division by zero gives NULL
    assert ch[1] is None and ch[2] == 0.0 and ch[3] == pytest.approx(0.1) and ch[4] == -1.0 and ch[5] is None


def test_direction_band(spark):
    rows = [(1, 1.0), (2, 1.001), (3, 1.0021), (4, 1.0), (5, 1.0)]
    df = spark.createDataFrame(rows, "m int, v double")
    out = [r["direction"] for r in W.direction(df, None, "m", "v").orderBy("m").collect()]
    assert out == ["→ Flat", "→ Flat", "↑ Expanding", "↓ Compressing", "→ Flat"]


def test_drop_bulk_keeps_null_keys_and_threshold(spark):
    rows = [("d1", 1.0)] * 4 + [("d2", 1.0)] * 3 + [(None, 1.0)] * 5
    df = spark.createDataFrame(rows, "d string, p double")
    kept = R.drop_bulk(df, ["d", "p"], threshold=3).collect()
    assert sorted((r["d"] or "", r["p"]) for r in kept) == [("", 1.0)] * 5 + [("d2", 1.0)] * 3


def test_join_on_account_normalises_and_multiplies(spark):
    fact = R.account_key(spark.createDataFrame([("7002", 1), ("0042", 2), ("", 3), (None, 4)],
                                               "acct string, x int"), "acct")
    dim = R.account_key(spark.createDataFrame([("0000007002", "a"), ("42", "b"), ("42", "c"), ("000", "z"),
                                               (None, "n")], "acct string, y string"), "acct")
    out = sorted((r["x"], r["y"]) for r in R.join_on_account(fact.drop("acct"), dim.drop("acct")).collect())
    assert out == [(1, "a"), (2, "b"), (2, "c"), (3, "z")]
    d = R.join_on_account(fact.drop("acct"), dim.drop("acct"), dedupe=True).count()
    assert d == 3


def test_trailing_and_prior_windows(spark):
    import datetime as dt
    as_of = dt.datetime(2026, 1, 1)
    days = [0, 180, 364, 365, 366, 729, 730, 731, -5]
    df = spark.createDataFrame([((as_of - dt.timedelta(days=d)),) for d in days], "t timestamp_ntz")
    now = sorted((as_of - r["t"]).days for r in R.trailing(df, "t", as_of, 365).collect())
    assert now == [-5, 0, 180, 364, 365]
    pri = sorted((as_of - r["t"]).days for r in R.prior(df, "t", as_of, 365, 365).collect())
    assert pri == [366, 729, 730]


def test_unpivot_dates_latest_and_schema_pruning(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0, 3.0, "x")],
                               "region string, `2025-12-31` double, `2026-01-31` double, `2026-02-28` double, note string")
    long = R.unpivot_dates(df, ["region"], latest=2)
    assert [(str(r["month"]), r["value"]) for r in long.orderBy("month").collect()] == \
        [("2026-01-31", 2.0), ("2026-02-28", 3.0)]
    assert R.date_columns(df) == ["2025-12-31", "2026-01-31", "2026-02-28"]


def test_align_attach_select(spark):
    left = spark.createDataFrame([("r", 1), ("r", 2)], "region string, m int")
    right = spark.createDataFrame([("r", 1, 5.0)], "region string, m int, v double")
    out = sorted(tuple(r) for r in R.align_series(left, right, ["region", "m"]).collect())
    assert out == [("r", 1, 5.0), ("r", 2, 0.0)]
    one = spark.createDataFrame([(9.5,)], "s double")
    assert R.attach_scalar(left, one).where("s = 9.5").count() == 2
    assert R.select_existing(left, ["m", "missing", "region"]).columns == ["m", "region"]
    assert R.with_default(left, "price_yoy", 0.0, "double").first()["price_yoy"] == 0.0


def test_share_mean_argextreme(spark):
    df = spark.createDataFrame([("a", 1.10, True), ("a", 2.20, False), ("a", 3.30, True), ("b", 0.05, False)],
                               "g string, v double, c boolean")
    share = {r["g"]: (r["total"], r["share"]) for r in A.group_share(df, "g", F.col("c")).collect()}
    assert share == {"a": (3, pytest.approx(2 / 3)), "b": (1, 0.0)}
    mean = {r["g"]: r["mean"] for r in A.group_mean(df, "g", "v", scale=2).collect()}
    assert mean["a"] == 2.2 and mean["b"] == 0.05
    top = {r["g"]: r["v"] for r in A.arg_extreme(df, "g", "v", ["v"]).collect()}
    low = {r["g"]: r["v"] for r in A.arg_extreme(df, "g", "v", ["v"], largest=False).collect()}
    assert top == {"a": 3.3, "b": 0.05} and low == {"a": 1.1, "b": 0.05}


def test_pct_change_skewed_matches_pandas(spark, cut):
    import pandas as pd
    rnd = random.Random(21)
    rows = []
    for i in range(3000):
        g = "hot" if i % 2 == 0 else (None if i % 97 == 0 else f"g{rnd.randint(0, 30)}")
        v = None if rnd.random() < 0.15 else float(rnd.randint(0, 20))
        rows.append((g, i, v))
    df = spark.createDataFrame(rows, "g string, t long, v double")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["t"]: r["c"] for r in W.pct_change(df, "g", "t", "v", "c").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    pdf = pd.DataFrame(rows, columns=["g", "t", "v"]).sort_values("t")
    pdf["g"] = pdf["g"].fillna("<null>")
    for _, grp in pdf.groupby("g"):
        filled = grp["v"].ffill()
        prev = filled.shift(1)
        for t, f, p in zip(grp["t"], filled, prev):
            exp = None if pd.isna(f) or pd.isna(p) or p == 0 else f / p - 1.0
            assert (got[t] is None and exp is None) or got[t] == pytest.approx(exp), (t, got[t], exp)


def test_direction_skewed_matches_brute_force(spark, cut):
    rnd = random.Random(4)
    rows = [("hot" if i % 2 == 0 else f"g{rnd.randint(0, 20)}", i, float(rnd.choice([1.0, 1.0005, 1.002, 0.99])))
            for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, t long, v double")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["t"]: r["direction"] for r in W.direction(df, "g", "t", "v").collect()}
        small = {r["t"]: r["direction"] for r in W.direction(df, "g", "t", "v", bounded_groups=True).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    prev = {}
    for g, t, v in sorted(rows, key=lambda r: r[1]):
        p = prev.get(g)
        exp = "→ Flat" if p is None else ("↑ Expanding" if v > p * 1.001 else "↓ Compressing" if v < p * 0.999
                                         else "→ Flat")
        assert got[t] == exp and small[t] == exp
        prev[g] = v


def test_checkpoint_dir_reads_the_session_and_only_falls_back_when_unset():
    from types import SimpleNamespace

    from homestat.session import checkpoint_dir

    class Ctx:
        def __init__(self, current, master):
            self.current, self.set_to, self.master = current, None, master

        def getCheckpointDir(self):
            return self.current

        def setCheckpointDir(self, p):
            self.set_to = p

    def session(conf_value, current, master="local[2]"):
        conf = SimpleNamespace(get=lambda k, d=None: conf_value if k == "spark.checkpoint.dir" else d)
        return SimpleNamespace(conf=conf, sparkContext=Ctx(current, master))

    s = session("hdfs://shared/ckpt", None)
    assert checkpoint_dir(s) == "hdfs://shared/ckpt" and s.sparkContext.set_to == "hdfs://shared/ckpt"
    s = session("hdfs://shared/ckpt", "hdfs://shared/ckpt/uuid")
    assert checkpoint_dir(s) == "hdfs://shared/ckpt" and s.sparkContext.set_to is None
    s = session(None, None)  # unset: a scratch folder, as in local tests
    path = checkpoint_dir(s)
    assert s.sparkContext.set_to == path and "homestat-ckpt-" in path
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):  # on a cluster: an error
        checkpoint_dir(session(None, None, "spark://host:7077"))


# ------------------------------------------------------------------ composite cuts, bucketed medians

@pytest.mark.parametrize("order", ["d", "s"])
def test_a_group_of_one_date_is_cut_by_its_ties(spark, monkeypatch, order):
    monkeypatch.setattr(splits, "HOT_ROWS", 2000)
    rows = [("hot", dt.date(2020, 1, 1), "same", i * 7919 % 20011, float(i)) for i in range(20000)]
    rows += [(f"g{i % 50}", dt.date(2020, 1, 1 + i % 28), f"t{i % 9}", i, float(i)) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, d date, s string, k long, p double")
    pieces = Counter(r["_piece"] for r in splits.split_groups(df, ["g"], order, ["k"]).where("g = 'hot'").collect())
    assert len(pieces) > 40 and max(pieces.values()) < 2 * sorted(pieces.values())[len(pieces) // 2]
    assert not splits.split_groups(df, ["g"], order, ["k"]).where("g <> 'hot' AND (_hot OR _piece <> 0)").count()
    got = sorted(tuple(r) for r in W.consecutive_pairs(df, "g", order, ["k"], ["k"]).select("g", "first_k", "second_k").collect())
    want = []
    for g in {r[0] for r in rows}:
        own = sorted((r[1] if order == "d" else r[2], r[3]) for r in rows if r[0] == g)
        want += [(g, a[1], b[1]) for a, b in zip(own, own[1:])]
    assert got == sorted(want)


def test_text_order_and_more_than_64_large_groups(spark, monkeypatch):
    monkeypatch.setattr(splits, "HOT_ROWS", 60)
    rows = [(g, f"{(i * 37) % 101:03d}" if i % 10 else None, i) for g in range(80) for i in range(100)]
    df = spark.createDataFrame(rows, "g long, s string, k long")
    assert splits.split_groups(df, ["g"], "s", ["k"]).where("_hot").select("g").distinct().count() == 80
    got = {(r.g, r.k): r["rank"] for r in W.rank_by(df, "g", "s", tie=["k"]).collect()}
    for g in range(80):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, [-ord(c) for c in r[1] or ""], r[2]))
        assert [got[g, r[2]] for r in own] == list(range(1, 101))


@pytest.mark.parametrize("hot_rows", [40, 10**6])
def test_medians_of_odd_values(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(splits, "HOT_ROWS", hot_rows)
    nan, inf = float("nan"), float("inf")
    groups = {"one value": [5.0] * 900, "signs": [float(i) for i in range(-300, 301)], "tiny": [1e-308 * i for i in range(200)],
              "even gap": [1.0] * 100 + [1e9] * 100, "infinite": [-inf] * 30 + [inf] * 31 + [0.0] * 3, "nan": [nan] * 150 + [1.0] * 50,
              "nulls": [None] * 200 + [2.0], "none": [None] * 50, "zeros": [0.0, -0.0] * 60 + [-1e-300], "few": [3.0, 1.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double").repartition(7)
    got = {r.g: (r.m, r.twice, r.n) for r in A.group_medians(df, "g", {"m": F.col("v"), "twice": F.col("v") * 2}, {"n": F.count("v")}).collect()}
    for g, vs in groups.items():
        own = sorted((v for v in vs if v is not None), key=lambda v: (math.isnan(v), v))
        want = None if not own else (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2 if own[(len(own) - 1) // 2] != own[len(own) // 2] else own[len(own) // 2]
        m, twice, n = got[g]
        assert n == len(own) and (m == want or math.isnan(m) and math.isnan(want)), g
        assert m is None or math.isnan(m) or twice == 2 * m
    whole = A.group_median(df.where("v > 0 AND v < 1e300"), None, "v", out="m", count_out="n").first()
    own = sorted(v for vs in groups.values() for v in vs if v is not None and 0 < v < 1e300)
    assert (whole.m, whole.n) == ((own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2, len(own))


def test_median_reads_its_input_twice(spark):
    plan = A.group_median(spark.range(10).selectExpr("id % 2 AS g", "id * 1.0D AS v"), "g", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 2 and "Union" not in plan
