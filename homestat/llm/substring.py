"""Substring deduplication by winnowed blocks and window hashes, in place of relative Lempel-Ziv parsing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import SECOND_BASE, RangeHashes, mix64, ngram_hashes, signed, staged, text_chunks, word_hashes

WINDOW = 50  # words of the shortest duplicate span
ANCHOR = 20  # words of an anchor


def reference_blocks(words: np.ndarray, offsets: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """Cut every text's windows into blocks, in the same way wherever the same words stand.

    Each window belongs to the anchor (a run of ``anchor`` words) of least hash in it, the
    first if equal. The windows of one anchor start at consecutive words and make up one
    block. Returns for each block its text, the anchor's hash, the block's content hash
    (words, and where the anchor stands), and the first and last window start, counted
    from the text's first word.
    """
    if len(words) < window:
        none = np.empty(0, np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    grams = ngram_hashes(words, anchor)
    reach = window - anchor + 1  # anchors of a window
    best = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= reach:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    best = np.minimum(best[: len(best) - (reach - size)], best[reach - size:]) if reach > size else best
    starts = np.arange(len(best))
    text = np.searchsorted(offsets, starts, side="right") - 1
    inside = starts + window <= offsets[text + 1]
    starts, text, at = starts[inside], text[inside], (best[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(starts):
        return text, at.astype(np.uint64), at.astype(np.uint64), at, at
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([new[1:], [len(at)]]) - 1
    lo, hi, p, of = starts[new], starts[last], at[new], text[new]
    content = mix64(RangeHashes(words).of(lo, hi + window) + (p - lo).astype(np.uint64))
    return of, grams[p], content, lo - offsets[of], hi - offsets[of]


def _index(window: int, anchor: int):
    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, part in text_chunks(pdf["_text"]):
                words, offsets = word_hashes(part)
                of, h, content, lo, hi = reference_blocks(words, offsets, window, anchor)
                yield pd.DataFrame({"_id": pdf["_id"].to_numpy()[a + of], "_th": pdf["_th"].to_numpy()[a + of],
                                    "h": signed(h), "c": signed(content), "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)})
    return blocks


def _boundary_windows(window: int):
    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, part in text_chunks(pdf["_text"]):
                words, offsets = word_hashes(part)
                los, his = pdf["lo"].to_numpy()[a:a + len(part)], pdf["hi"].to_numpy()[a:a + len(part)]
                lo, hi = np.concatenate(los), np.concatenate(his)
                n = hi - lo + 1
                of = np.repeat(np.repeat(np.arange(len(part)), [len(x) for x in los]), n)
                start = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = offsets[of] + start
                yield pd.DataFrame({"_id": pdf["_id"].to_numpy()[a + of], "_th": pdf["_th"].to_numpy()[a + of], "at": start.astype(np.int32),
                                    "w1": signed(RangeHashes(words).of(at, at + window)),
                                    "w2": signed(RangeHashes(words, SECOND_BASE).of(at, at + window))})
    return windows


def _remove(window: int, with_text: bool):
    def removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, los, his in zip(pdf["_text"], pdf["lo"], pdf["hi"], strict=True):
                words = [] if text is None else text.encode("utf-8", "surrogatepass").split()
                kept = words
                if los is not None:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edge, los, 1)
                    np.add.at(edge, his + window, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                joined = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(),
                             joined.decode("utf-8", "surrogatepass") if with_text else None))
            out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept_text"])
            yield out.assign(_id=pdf["_id"].to_numpy())
    return removed


def duplicate_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Window starts (``lo`` to ``hi``) of each document that also start in a smaller ``_id``.

    ``docs``: ``_id``, ``_th`` and ``_text``. The corpus is indexed in blocks
    (:func:`reference_blocks`) under their anchors' hashes. Every document is compared
    with all blocks of other documents under its anchors: a block that an earlier
    document has word for word is a duplicate as a whole, and such blocks that follow one
    another join. Where the text goes on with a block that no earlier document has as a
    whole although others share its anchor, its windows are checked one by one against
    those of the other such blocks. That is exact: the
    earliest document with a window has it in a block that no earlier one has.
    """
    kind = dict(docs.dtypes)["_id"]
    blocks = staged(docs.mapInPandas(_index(window, anchor), f"_id {kind}, _th int, h long, c long, lo int, hi int"))
    shared = blocks.groupBy("h").agg(F.min("_id").alias("a"), F.max("_id").alias("b")).where("a < b").select("h")
    live = staged(blocks.join(shared, "h"))
    firsts = live.groupBy("h", "c").agg(F.min("_id").alias("first"))
    parsed = staged(live.join(firsts, ["h", "c"]).select("_id", "_th", "lo", "hi", (F.col("_id") > F.col("first")).alias("factor")))
    edges = _spans(parsed.where("not factor"))
    windows = staged(docs.join(edges, ["_id", "_th"]).select("_id", "_th", "_text", "lo", "hi").mapInPandas(
        _boundary_windows(window), f"_id {kind}, _th int, at int, w1 long, w2 long"))
    known = windows.groupBy("w1", "w2").agg(F.min("_id").alias("first"), F.max("_id").alias("last")).where("first < last")
    found = windows.join(known.drop("last"), ["w1", "w2"]).where("_id > first").select("_id", "_th", F.col("at").alias("lo"), F.col("at").alias("hi"))
    return parsed.where("factor").select("_id", "_th", "lo", "hi").unionByName(found)


def _spans(rows: DataFrame) -> DataFrame:
    """The ``lo`` and ``hi`` of each document, as two arrays in the same order."""
    return rows.groupBy("_id", "_th").agg(F.collect_list(F.struct("lo", "hi")).alias("s")).select(
        "_id", "_th", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, anchor: int = ANCHOR, with_text: bool = True) -> DataFrame:
    """Remove every word that lies in ``window`` words which also start in a document of smaller id.

    Words are runs of bytes without white space (bytes 32 and 9 to 13), unchanged. Windows are
    judged on the input, by :func:`duplicate_spans`, which finds shared blocks
    by their hashes (nothing is factored: the README says why). Words are compared by 64-bit hashes, windows by two
    independent 64-bit sums of them, blocks by such a sum and their anchor's hash.

    Returns the id, ``n_words``, ``n_removed``, ``kept_sha256`` (lower-case hex of the kept
    words, joined by one space, in UTF-8) and ``kept_text`` (those words; null unless
    ``with_text``), a row per row. Null and empty texts have no words, texts of fewer
    words than a window lose none. Rows of equal id do not make each other duplicates;
    a row without an id neither loses words nor makes others lose them. Other columns,
    clashing names too, are not read. An empty table gives an empty table.

    Scale: a block stands for about a dozen windows, and only blocks whose anchor several
    documents share go further. A passage that thousands of documents share has the same
    blocks in all of them, so that only blocks at its ends differ; nothing gathers the
    documents of a block, and all joins and sums are by hash.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("_id"), F.hash(F.col(f"`{text_col}`")).alias("_th"), F.col(f"`{text_col}`").alias("_text"))
    spans = staged(_spans(duplicate_spans(own.where("_id is not null and _text is not null"), window, anchor)))
    both = own.join(spans, ["_id", "_th"], "left").select("_id", "_text", "lo", "hi")
    out = both.mapInPandas(_remove(window, with_text), f"_id {dict(docs.dtypes)[id_col]}, n_words long, n_removed long, "
                           "kept_sha256 string, kept_text string")
    return out.withColumnRenamed("_id", id_col)
