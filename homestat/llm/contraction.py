"""Subtree totals of a forest by parallel tree contraction, in join rounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import staged


def subtree_totals(nodes: DataFrame, key: Sequence[str], parent: Sequence[str], children: str, values: Sequence[str]) -> DataFrame:
    """For every node, the sums of ``values`` (whole numbers) over its subtree, itself included.

    ``nodes`` has a row per node: its ``key`` columns, its parent's key in the ``parent``
    columns (null for a root), how many ``children`` it has, and its own values. Returns
    ``key`` and ``values``.

    Rounds alternate two steps on the nodes still active. Rake: a leaf's total is known;
    it leaves, its parent gains it. Compress: a node with one child left leaves too, if its
    hash of the round is less than its parent's and its child's, so no two neighbours go
    together; the child hangs on the node's parent, and the edge between them carries what
    the node would have added. Of a chain a third goes each round, so even a tree that is
    one long chain takes a number of rounds logarithmic in its nodes. Then the rounds are
    undone in reverse: a spliced node's total is its child's plus what the edge carried.

    A round shuffles its active nodes a few times, by their own key or summed by parent
    (with partial sums, so a node of very many children is no hot spot), and there are
    fewer of them each round: all rounds together move a constant multiple of the nodes.
    Every round is a table in the shared folder. An empty table gives an empty table.
    """
    key, parent, values = list(key), list(parent), list(values)
    above = [f"p{i}" for i in range(len(key))]
    own, edge = [f"w{i}" for i in range(len(values))], [f"e{i}" for i in range(len(values))]
    active = staged(nodes.select(
        *key, *[F.col(c).alias(a) for c, a in zip(parent, above, strict=True)], F.col(children).cast("long").alias("m"),
        *[F.col(v).cast("long").alias(w) for v, w in zip(values, own, strict=True)],
        *[F.lit(0).cast("long").alias(e) for e in edge]))
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while not active.isEmpty():
        raked = active.where("m = 0").select(*key, *own)
        after = staged(_rake(active, key, above, own, edge, len(rounds)))
        if after.isEmpty():
            active = raked
            break
        below = after.where("picked").select(
            *[F.col(c).alias(f"_{c}") for c in [f"c{i}" for i in range(len(key))]], F.lit(True).alias("_hit"),
            *[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], *[F.col(c).alias(f"_{c}") for c in (*above, *own, *edge)])
        rest = after.where(~F.col("picked")).join(below, [F.col(c) == F.col(f"_c{i}") for i, c in enumerate(key)], "left")
        rest = staged(rest.select(
            *key, *[F.when(F.col("_hit"), F.col(f"_{a}")).otherwise(F.col(a)).alias(a) for a in above], "m", *own,
            *[(F.col(e) + F.coalesce(F.col(f"_{w}") + F.col(f"_{e}"), F.lit(0))).alias(e) for e, w in zip(edge, own, strict=True)],
            "_hit", *[F.col(f"_k{i}") for i in range(len(key))],
            *[(F.col(e) + F.col(f"_{w}")).alias(f"_add{i}") for i, (e, w) in enumerate(zip(edge, own, strict=True))]))
        undo = rest.where("_hit").select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(key)],
                                         *[f"_k{i}" for i in range(len(key))], *[f"_add{i}" for i in range(len(values))])
        rounds.append((raked, undo))
        active = rest.select(*key, *above, "m", *own, *edge)
    known = active.select(*key, *own)
    for raked, undo in reversed(rounds):
        again = undo.join(known, [F.col(f"_c{i}") == F.col(c) for i, c in enumerate(key)]).select(
            *[F.col(f"_k{i}").alias(c) for i, c in enumerate(key)],
            *[(F.col(w) + F.col(f"_add{i}")).alias(w) for i, w in enumerate(own)])
        known = staged(known.unionByName(raked).unionByName(again))
    return known.select(*key, *[F.col(w).alias(v) for v, w in zip(values, own, strict=True)])


def _rake(active: DataFrame, key: list[str], above: list[str], own: list[str], edge: list[str], turn: int) -> DataFrame:
    """The active nodes without the leaves, which their parents have gained; with the nodes to splice marked.

    ``m`` is the number of children left, ``c<i>`` the key of one of them, ``picked`` whether
    the node is spliced out this round.
    """
    stays = F.col("m") > 0
    gain = active.where(F.col(above[0]).isNotNull()).groupBy(*above).agg(
        F.count_if(stays).alias("_m"),
        *[F.max(F.when(stays, F.col(c))).alias(f"c{i}") for i, c in enumerate(key)],
        *[F.sum(F.when(~stays, F.col(w) + F.col(e)).otherwise(0)).alias(f"_{w}") for w, e in zip(own, edge, strict=True)])
    gain = gain.withColumnsRenamed({a: f"_g{i}" for i, a in enumerate(above)})
    after = active.where(stays).join(gain, [F.col(c) == F.col(f"_g{i}") for i, c in enumerate(key)])
    after = after.select(*key, *above, F.col("_m").alias("m"), *[(F.col(w) + F.col(f"_{w}")).alias(w) for w in own],
                         *edge, *[f"c{i}" for i in range(len(key))])
    rank = lambda cols: F.xxhash64(F.lit(turn), *[F.col(c) for c in cols])
    child = [f"c{i}" for i in range(len(key))]
    least = (rank(key) < rank(above)) & (rank(key) < rank(child))
    return after.withColumn("picked", F.coalesce((F.col("m") == 1) & F.col(above[0]).isNotNull() & least, F.lit(False)))
