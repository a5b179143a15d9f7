"""Mixing sources to target weights: hierarchical token budgets, filled from seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from homestat.llm.common import WORD, n_words, staged

NONE = "(none)"  # the name of a null level
BUCKET_ROWS = 4096  # rows of a leaf whose order is decided in one task (on average)


# The production mix: target weights by level, others count 1.
WEIGHTS = {"domain": {"d0": 3, "d1": 2}, "lang": {"en": 4, "de": 2}}
EPOCHS, SEED = 4, 17


def corpus_levels() -> dict[str, Column]:
    """Domain (a source's number modulo 4 stands for it), language, source."""
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint) % 4")
    return {"domain": F.concat(F.lit("d"), number), "lang": F.col("lang"), "source": F.col("source")}


def _weight(name: Column, weights: Mapping[str, int]) -> Column:
    if any(w <= 0 or w != int(w) for w in weights.values()):
        raise ValueError("weights are positive whole numbers")
    out = F.lit(1)
    for k, w in weights.items():
        out = F.when(name == k, int(w)).otherwise(out)
    return out.cast("decimal(19,0)")


def waterfill(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Divide each parent's ``budget`` over its children by ``weight``, none above its ``cap``.

    What a full child cannot take goes to its siblings by weight. In the order of
    cap / weight the full children come first: child i is full when, the ones before it
    full as well, its fair share of the rest reaches its cap. The rest is divided in
    whole tokens, left-over ones going to the largest fractions, then by name.
    ``budget`` must not exceed the children's caps together. Adds ``share``.
    """
    dec = lambda c: F.col(c).cast("decimal(19,0)") if isinstance(c, str) else c.cast("decimal(19,0)")
    order = W.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight").cast("double"), name)
    upto, after = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(1, W.unboundedFollowing)
    a = nodes.select("*", F.sum("cap").over(upto).alias("_s"), F.coalesce(F.sum("weight").over(after), F.lit(0)).alias("_w"))
    # cap_i full <=> (budget - caps up to i) * w_i >= cap_i * (weights after i)
    a = a.withColumn("_full", (dec(F.col("budget") - F.col("_s")) * dec("weight")) >= (dec("cap") * dec("_w")))
    whole = W.partitionBy(*parent)
    a = a.withColumn("_rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(whole), F.lit(0)))
    a = a.withColumn("_wsum", dec(F.coalesce(F.sum(F.when(~F.col("_full"), F.col("weight"))).over(whole), F.lit(1))))
    part = dec("_rest") * dec("weight")
    a = a.withColumn("_base", F.when(F.col("_full"), F.col("cap")).otherwise(
        F.floor((part - part % F.col("_wsum")) / F.col("_wsum")).cast("long")))
    a = a.withColumn("_frac", F.when(F.col("_full"), F.lit(-1).cast("decimal(38,0)")).otherwise((part % F.col("_wsum")).cast("decimal(38,0)")))
    a = a.withColumn("_left", F.col("budget") - F.sum("_base").over(whole))
    rank = F.row_number().over(W.partitionBy(*parent).orderBy(F.desc("_frac"), name))
    a = a.withColumn("share", F.least(F.col("cap"), F.col("_base") + F.when(~F.col("_full") & (rank <= F.col("_left")), 1).otherwise(0)))
    return a.drop("_s", "_w", "_full", "_rest", "_wsum", "_base", "_frac", "_left")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]],
                 total: int | None, max_epochs: int) -> DataFrame:
    """Token budget of every leaf: the total flows from the root down the levels.

    A node's cap is its leaves' tokens times ``max_epochs``. Each level divides its
    parents' budgets with :func:`waterfill`, so a shortage is made up by the siblings
    first, and only what a whole subtree cannot give reaches its ancestors' other
    children. ``leaves`` has the levels and ``tokens``; adds ``budget``.
    """
    root = leaves.agg(F.sum("tokens").alias("tokens"))
    cap = F.coalesce("tokens", F.lit(0)) * max_epochs
    budget = F.coalesce("tokens", F.lit(0)) if total is None else F.least(F.lit(total).cast("long"), cap)
    above = root.select(F.lit(0).alias("_root"), budget.alias("budget"))
    for i, level in enumerate(levels):
        parent, path = ["_root", *levels[:i]], list(levels[: i + 1])
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("cap")).withColumn("_root", F.lit(0))
        nodes = nodes.withColumn("weight", _weight(F.col(level), weights.get(level, {})))
        above = waterfill(nodes.join(above, parent), parent, level).select("_root", *path, F.col("share").alias("budget"))
    return leaves.join(above.drop("_root"), list(levels))


def mix(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]],
        total_tokens: int | None = None, max_epochs: int = 4, seed: int = 0, id_col: str = "doc_id",
        tokens: Column | None = None, text_col: str = "text") -> DataFrame:
    """How often, and how far, each document is taken to bring a corpus to target weights.

    ``levels`` names the tree from the top down (for instance domain, language, source)
    with an expression for each; ``weights`` gives whole-number weights by level and
    name (others: 1). ``total_tokens`` (default: the tokens there are) is divided by
    :func:`leaf_budgets`; no leaf gives more than ``max_epochs`` times its tokens, and a
    total beyond that becomes all there is. A leaf's stream of tokens is its documents
    in the order of ``md5(seed:epoch:id)``, epoch after epoch; its budget is a prefix of
    that stream. Tokens are words unless ``tokens`` gives a count.

    Returns one row per document: the id, the levels, ``n_tokens``, ``copies`` (times it
    is taken whole, long) and ``cut_tokens`` (tokens of one more, partial copy, where
    the prefix ends inside it; else 0, long). A leaf's copies * n_tokens + cut_tokens
    add up to its budget.

    Null levels form a leaf called ``(none)``; null and empty texts have 0 tokens, are
    taken as often as their place in the stream says, and a leaf without tokens is not
    taken. Rows repeated with equal ids are all kept; equal ids fall side by side in the
    order. Other columns of ``docs``, clashing names too, are not read. An empty table
    gives an empty table.

    Scale: one aggregation to leaves, then each leaf's order is cut into buckets of about
    ``BUCKET_ROWS`` rows by its hash; bucket sums place whole buckets inside or beyond
    the prefix, and only the bucket in which it ends is ordered row by row. A source that
    holds a third of all rows is thus ordered by no task.
    """
    names = list(levels)
    count = n_words(F.col(f"`{text_col}`")) if tokens is None else F.coalesce(tokens, F.lit(0)).cast("long")
    slim = staged(docs.select(F.col(f"`{id_col}`").alias("_id"), count.alias("n_tokens"),
                              *[F.coalesce(e.cast("string"), F.lit(NONE)).alias(n) for n, e in levels.items()]))
    leaves = slim.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("_rows"))
    plan = leaf_budgets(leaves, names, weights, total_tokens, max_epochs).select(
        *names,
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("_full"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(-1).alias("_rest"),
        F.ceil(F.col("_rows") / BUCKET_ROWS).alias("_buckets"))
    plan = staged(plan)  # a row a leaf
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_full"), F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    placed = slim.join(plan, names).withColumn("_key", key).withColumn(
        "_bucket", F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * F.col("_buckets") / F.lit(2.0**32)))
    sums = placed.groupBy(*names, "_bucket").agg(F.sum("n_tokens").alias("_tokens"), F.max("_rest").alias("_rest"))
    sums = sums.withColumn("_upto", F.sum("_tokens").over(
        W.partitionBy(*names).orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)))
    ends = sums.where("_upto > _rest").groupBy(*names).agg(
        F.min("_bucket").alias("_end"), F.min_by(F.col("_upto") - F.col("_tokens"), "_bucket").alias("_before"))
    placed = placed.join(staged(ends), names, "left")
    columns = [F.col("_id").alias(id_col), *names, "n_tokens"]
    inside = F.col("_bucket").eqNullSafe(F.col("_end"))
    taken = F.col("_full") + F.when(F.col("_rest") < 0, 0).otherwise(
        F.when(F.col("_bucket") < F.col("_end"), 1).otherwise(0))
    whole = placed.where(~inside).select(*columns, taken.cast("long").alias("copies"), F.lit(0).cast("long").alias("cut_tokens"))
    run = W.partitionBy(*names).orderBy("_key", "_id", "n_tokens").rowsBetween(W.unboundedPreceding, 0)
    edge = placed.where(inside).withColumn("_from", F.col("_before") + F.sum("n_tokens").over(run) - F.col("n_tokens"))
    fits = F.col("_from") + F.col("n_tokens") <= F.col("_rest")
    edge = edge.select(
        *columns, (F.col("_full") + F.when(fits, 1).otherwise(0)).cast("long").alias("copies"),
        F.when(~fits & (F.col("_from") < F.col("_rest")), F.col("_rest") - F.col("_from")).otherwise(0).cast("long").alias("cut_tokens"))
    return whole.unionByName(edge)


def take(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixed corpus: each document as often as ``mixed`` says, all its columns kept.

    A partial copy holds the document's first ``cut_tokens`` words, joined by one space.
    Rows of equal ids are each taken as often as the one that is taken most.
    """
    plan = mixed.where("copies > 0 or cut_tokens > 0").groupBy(F.col(f"`{id_col}`").alias("_mx_id")).agg(
        F.max("copies").alias("_mx_copies"), F.max("cut_tokens").alias("_mx_cut"))
    both = docs.join(plan, F.col(f"`{id_col}`").eqNullSafe(F.col("_mx_id")))
    both = both.withColumn("_mx_part", F.explode(F.concat(
        F.when(F.col("_mx_copies") > 0, F.array_repeat(F.lit(False), F.col("_mx_copies").cast("int"))).otherwise(F.array().cast("array<boolean>")),
        F.when(F.col("_mx_cut") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))))
    text = F.col(f"`{text_col}`")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})")), F.lit(1), F.col("_mx_cut").cast("int")), " ")
    return both.select(*[F.when(F.col("_mx_part"), cut).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`")
                         for c in docs.columns])
