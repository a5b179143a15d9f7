"""Prefix trie of conversations: nodes by prefix hash, subtree totals by tree contraction."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from homestat.llm.common import staged
from homestat.llm.contraction import subtree_totals

PIECE = 1024  # turns that one window holds
CHUNK_BITS = 13  # 8192 ids are joined to one text at once


def _sorted_and_numbered(df: DataFrame, *order) -> DataFrame:
    """``df`` sorted over all partitions, with ``gid``: partition (above bit 33) and place in it.

    Dealt by ranges of the whole sort key, so no value of its first columns can fill a task."""
    return staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("gid", F.monotonically_increasing_id()))


def numbered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns with their place in the conversation, and the conversations' lengths.

    Returns ``conv, pos`` (from 1), ``i1, i2`` (128 bits that stand for role and text) and
    ``n_bytes`` (UTF-8 bytes of the text); and ``conv, n``. Turns are ordered by ``turn_col``
    (null first), then role, then text; null role or text is empty; rows without a
    conversation are left out. A conversation may hold any share of all rows: the table is
    sorted by ranges, and a turn's place is its number in its partition plus the turns of
    its conversation in partitions before.
    """
    name = lambda c: F.col(f"`{c}`")
    rows = conversations.where(name(id_col).isNotNull()).select(
        name(id_col).cast("long").alias("conv"), name(turn_col).alias("turn"), F.coalesce(name(role_col), F.lit("")).alias("role"),
        F.coalesce(name(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(placed.select("conv", F.xxhash64(digest).alias("i1"), F.xxhash64(F.lit(1), digest).alias("i2"),
                                  F.octet_length("text").cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("gid")))
    placed = placed.withColumn("part", F.shiftright("gid", 33))
    parts = placed.groupBy("conv", "part").agg(F.min("gid").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = staged(parts.withColumn("before", F.coalesce(before, F.lit(0))))
    turns = placed.join(parts.drop("n"), ["conv", "part"])
    turns = turns.select("conv", (F.col("gid") - F.col("first") + F.col("before") + 1).alias("pos"), "i1", "i2", "n_bytes")
    return staged(turns), staged(parts.groupBy("conv").agg(F.sum("n").alias("n")))


def with_borrowed_start(turns: DataFrame, lengths: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their ``every``, as forks of one dialogue do.

    Conversation c gets the first h turns of conversation ``c - c % every`` (all, if it has
    fewer; none, if it is absent), then its own turns after its first h; h is the unsigned
    CRC-32 of c in decimal, modulo ``most``. Returns turns like those given, with ``last``
    on each conversation's last one, and the conversations that have no turn left (``conv``).
    """
    conv = F.col("conv")
    borrows = F.crc32(conv.cast("string")) % most
    convs = lengths.select("conv", "n", (conv - conv % every).alias("base"), borrows.alias("h"))
    donors = lengths.select(F.col("conv").alias("_base"), F.col("n").alias("_n"))
    convs = convs.join(donors, F.col("base") == F.col("_base"), "left")
    convs = staged(convs.select("conv", "n", "base", "h", F.least("h", F.coalesce("_n", F.lit(0))).alias("take")))
    to = convs.where("take > 0").select(F.col("conv").alias("to"), "base", "take", (F.col("n") <= F.col("h")).alias("ends"))
    lent = turns.where(F.col("pos") < most).join(to, (conv == F.col("base")) & (F.col("pos") <= F.col("take")))
    lent = lent.select(F.col("to").alias("conv"), "pos", "i1", "i2", "n_bytes", (F.col("ends") & (F.col("pos") == F.col("take"))).alias("last"))
    own = turns.where(F.col("pos") > borrows).join(convs.select("conv", "n", "h", "take"), "conv")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("take")).alias("pos"), "i1", "i2", "n_bytes",
                     (F.col("pos") == F.col("n")).alias("last"))
    return staged(lent.unionByName(own)), convs.where("take = 0 AND n <= h").select("conv")


def prefix_trie(turns: DataFrame, turnless: DataFrame) -> DataFrame:
    """The trie of all prefixes of conversations, with totals of every subtree.

    ``turns``: ``conv, pos`` (1, 2, ... without gaps), ``i1, i2`` (what the turn is),
    ``n_bytes, last``; ``turnless``: ``conv`` of conversations without turns. Two
    conversations share a node of depth d if their first d turns are equal; the root, of
    depth 0, has all. Returns per node ``conv_id`` (its smallest member), ``depth``,
    ``parent_conv_id`` (the parent's ``conv_id``; null for the root), ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (of its subtree, itself included), ``saved_tokens`` (over
    its subtree, ``n_convs - 1`` times the bytes of each node's last turn) and
    ``ends_sha256`` (of the ids of the members that end here, ascending, joined by commas;
    of nothing, if none does). No conversation: no node.

    A prefix is known by 128 bits: the exclusive or of a hash of every turn and its place,
    taken ``PIECE`` turns a window, then carried from piece to piece, so a conversation of
    any length is shared out. Nodes are counted with partial sums (a first turn that a third
    of all conversations share is a row a task), and subtree totals come from tree
    contraction (:mod:`contraction`). The ids that end at one node are sorted by ranges and
    joined 8192 at a time; the digest itself must read them in order, so one task passes
    over a node's texts of joined ids, holding one at a time.
    """
    pos = F.col("pos")
    hashes = [F.xxhash64("pos", "i1", "i2"), F.xxhash64("i2", "pos", "i1", F.lit(7))]
    rows = turns.select("conv", "pos", "n_bytes", "last", F.floor((pos - 1) / PIECE).alias("piece"),
                        hashes[0].alias("ha"), hashes[1].alias("hb"))
    carry = rows.groupBy("conv", "piece").agg(F.bit_xor("ha").alias("xa"), F.bit_xor("hb").alias("xb"))
    earlier = W.partitionBy("conv").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    carry = carry.select("conv", "piece", F.bit_xor("xa").over(earlier).alias("xa"), F.bit_xor("xb").over(earlier).alias("xb")).where("piece > 0")
    inside = W.partitionBy("conv", "piece").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"a": F.bit_xor("ha").over(inside), "b": F.bit_xor("hb").over(inside)}).join(carry, ["conv", "piece"], "left")
    xor = lambda x, y: F.col(x).bitwiseXOR(F.coalesce(F.col(y), F.lit(0)))
    rows = rows.select("conv", "pos", "n_bytes", "last", "ha", "hb", xor("a", "xa").alias("a"), xor("b", "xb").alias("b"))
    rows = staged(rows.select("conv", "pos", "n_bytes", "last", "a", "b", xor("a", "ha").alias("pa"), xor("b", "hb").alias("pb")))
    nodes = rows.groupBy("a", "b").agg(
        F.min("conv").alias("conv_id"), F.max("pos").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        F.max("n_bytes").alias("n_bytes"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    ends = rows.where("last").select("a", "b", "conv").unionByName(turnless.select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv"))
    none = F.lit(None).cast("long")
    root = ends.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs",
        F.lit(0).cast("long").alias("n_bytes"), none.alias("pa"), none.alias("pb"))
    nodes = staged(nodes.unionByName(root))
    up = nodes.select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 0").groupBy(F.col("pa").alias("_a"), F.col("pb").alias("_b")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = staged(nodes.join(up, (F.col("pa") == F.col("_a")) & (F.col("pb") == F.col("_b")), "left").drop("_a", "_b"))
    tree = tree.join(below, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left").select(
        "a", "b", "conv_id", "depth", "parent_conv_id", F.when(F.col("depth") > 0, F.col("depth") - 1).alias("parent_depth"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), F.col("n_children").isNull().cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    tree = staged(tree)
    totals = subtree_totals(tree, ["conv_id", "depth"], ["parent_conv_id", "parent_depth"], "n_children", ["leaf", "saved"])
    totals = totals.withColumnsRenamed({"leaf": "n_leaves", "saved": "saved_tokens"})
    digests = id_digests(ends).withColumnsRenamed({"a": "_a", "b": "_b"})
    out = tree.drop("leaf", "saved").join(totals, ["conv_id", "depth"])
    out = out.join(digests, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def id_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ids, ascending and joined by commas: ``a, b, sha256``."""
    placed = _sorted_and_numbered(ends, "a", "b", "conv")
    chunk = F.shiftright("gid", CHUNK_BITS).alias("chunk")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",")
    chunks = placed.groupBy("a", "b", chunk).agg(ids.alias("ids"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            out = []
            for a, b, text in zip(batch["a"], batch["b"], batch["ids"], strict=True):
                if (a, b) == node:
                    state.update(b"," + text.encode())
                    continue
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256(text.encode())
            yield pd.DataFrame(out, columns=["a", "b", "sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["a", "b", "sha256"])

    in_order = chunks.repartition("a", "b").sortWithinPartitions("a", "b", "chunk").select("a", "b", "ids")
    return in_order.mapInPandas(digest, "a long, b long, sha256 string")


def conversation_trie(conversations: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """:func:`prefix_trie` of conversations that share starts (:func:`with_borrowed_start`).

    Rows without ``conv_id`` are left out; null roles and texts are empty, and a null turn
    comes first. Equal turn numbers are ordered by role and text, and repeated rows are
    turns of their own. Empty and very long texts count their bytes. Other columns do not
    matter. An empty table gives an empty table.
    """
    return prefix_trie(*with_borrowed_start(*numbered_turns(conversations), every, most))
