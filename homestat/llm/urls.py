"""URL filter: domain rules, then a character language-model ratio (DataFrame functions only)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import free_names, staged

ORDER = 3  # characters of context at most
WEIGHT = 2.0  # pseudo-count given to the next shorter context
ALPHABET = 256  # the shortest context falls back on one in so many
HOST_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, HOST_PATH, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``? #`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, HOST_PATH, 2), F.lit(""))


def rule_of(host_: Column, path_: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (both null if none does).

    A rule is a host and the start of a path, written together (``example.com/en/``), and
    fits its host and all subdomains where the path starts with the rule's. The rules
    are a parameter of the query, at most a few hundred.
    """
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is tested first
        name, slash, rest = text.partition("/")
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _grams(strings: DataFrame, *keep: str, order: int = ORDER) -> DataFrame:
    """A row for each character of ``s`` and for its end: the character after ``order`` before it."""
    padded = F.concat(F.lit("\u0002" * order), F.col("s"), F.lit("\u0003"))
    at = F.explode(F.sequence(F.lit(1), F.length("s") + 1))
    return strings.select(*keep, padded.alias("_p"), at.alias("_at")).select(
        *keep, F.substring(F.col("_p"), F.col("_at"), F.lit(order + 1)).alias("gram"))


def gram_ratios(labelled: DataFrame, order: int = ORDER, weight: float = WEIGHT) -> DataFrame:
    """Log-likelihood ratio (accepted over rejected) of the last character of every gram.

    ``labelled`` has ``s``, and ``accepted`` and ``rejected``: how many urls of each class
    the string stands for (both may be 0). Two Markov models of variable order: the
    estimate after k characters counts ``weight`` times the one after k - 1, so rare
    contexts lean on shorter ones, down to one in ``ALPHABET``.
    """
    counts = (_grams(labelled, "accepted", "rejected", order=order).groupBy("gram")
              .agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")))
    levels = counts.select("gram", "a", "r", F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k")).select(
        "gram", "a", "r", "k", F.expr("right(gram, k + 1)").alias("tail"),
        F.expr(f"substring(gram, {order} - k + 1, k)").alias("context"))
    tails = levels.groupBy("k", "tail").agg(F.sum("a").alias("ta"), F.sum("r").alias("tr"))
    contexts = levels.groupBy("k", "context").agg(F.sum("a").alias("ca"), F.sum("r").alias("cr"))
    whole = levels.select("gram", "k", "tail", "context").join(tails, ["k", "tail"]).join(contexts, ["k", "context"])
    pick = lambda c, k: F.max(F.when(F.col("k") == k, F.col(c)))
    wide = whole.groupBy("gram").agg(*[pick(c, k).alias(f"{c}{k}") for c in ("ta", "tr", "ca", "cr") for k in range(order + 1)])
    pa = pr = F.lit(1.0 / ALPHABET)
    for k in range(order + 1):
        pa = (F.col(f"ta{k}") + weight * pa) / (F.col(f"ca{k}") + weight)
        pr = (F.col(f"tr{k}") + weight * pr) / (F.col(f"cr{k}") + weight)
    return wide.select("gram", (F.log(pa) - F.log(pr)).alias("ratio"))


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]], url_col: str = "url",
               order: int = ORDER, weight: float = WEIGHT) -> DataFrame:
    """Judge every url: by the longest rule that fits, else by two character models.

    The models learn from all urls that a rule judges (every row counts; host and path
    are the text). A url's score is its log-likelihood under the accepted urls' model
    less that under the rejected ones', divided by its characters. The threshold lies
    between the classes' mean scores, in proportion to their spreads; a score at or
    above it says allow. If a class has no url, or both score alike, the threshold is 0.

    Adds ``host``, ``path``, ``rule``, ``verdict`` and ``score`` to all columns of
    ``pages`` (a column of such a name, in any case, is replaced). Null urls and ones without ``://``
    have empty host and path, no rule, and are scored as the empty text. Repeated urls
    share a score; an empty table gives an empty table.

    Scale: strings are counted before the grams; gram tables grow with the number of
    different grams only; the join of grams and ratios has hot keys that AQE can split,
    or broadcasts the ratios when their measured size allows.
    """
    spark = pages.sparkSession
    url = F.col(f"`{url_col}`")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "score")]
    s_host, s_path = free_names(pages.columns, "_uf_host", "_uf_path")
    keep = [F.col(f"`{c}`") for c in own]
    rows = pages.select(*keep, host(url).alias("host"), path(url).alias("path"))
    strings = (rows.select("host", "path").groupBy(F.col("host").alias("h"), F.col("path").alias("p")).agg(F.count(F.lit(1)).alias("n"))
               .select("h", "p", F.concat("h", "p").alias("s"), "n"))
    says = rule_of(F.col("h"), F.col("p"), rules)[1]
    strings = staged(strings.select("h", "p", "s", F.when(says == "allow", F.col("n")).otherwise(0).alias("accepted"),
                                    F.when(says == "block", F.col("n")).otherwise(0).alias("rejected")))
    ratios = staged(gram_ratios(strings, order, weight))  # so that the join with it can split a frequent gram
    scored = staged(_grams(strings, "h", "p", "accepted", "rejected", order=order).join(ratios, "gram")
                    .groupBy("h", "p").agg(F.avg("ratio").alias("score"), F.max("accepted").alias("accepted"),
                                           F.max("rejected").alias("rejected")))
    limit = threshold(scored)
    found = scored.select(F.col("h").alias(s_host), F.col("p").alias(s_path), "score")
    judged = rows.join(found, (F.col("host") == F.col(s_host)) & (F.col("path") == F.col(s_path)), "left")
    judged = judged.select(*keep, "host", "path", "score")
    return judged.select(*keep, "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("score") >= F.lit(limit), "allow").otherwise("block")).alias("verdict"),
                         "score")


def threshold(scored: DataFrame) -> float:
    """The score between the two classes' means, each mean weighed by the other's spread (one row)."""
    def stats(n: str) -> list[Column]:
        return [F.sum(n).alias(n), F.sum(F.col(n) * F.col("score")).alias(f"{n}_1"),
                F.sum(F.col(n) * F.col("score") * F.col("score")).alias(f"{n}_2")]
    row = scored.agg(*stats("accepted"), *stats("rejected")).first()
    if not row["accepted"] or not row["rejected"]:
        return 0.0
    mean = {c: row[f"{c}_1"] / row[c] for c in ("accepted", "rejected")}
    spread = {c: math.sqrt(max(0.0, row[f"{c}_2"] / row[c] - mean[c] ** 2)) for c in mean}
    if not spread["accepted"] + spread["rejected"]:
        return (mean["accepted"] + mean["rejected"]) / 2
    return ((mean["accepted"] * spread["rejected"] + mean["rejected"] * spread["accepted"])
            / (spread["accepted"] + spread["rejected"]))
