"""SentencePiece encoding and decoding: batched Viterbi over numpy arrays."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from homestat.llm.common import chunks, mix64, text_chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # stands for a space in pieces
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
LOWEST = -1e18
DIRECTORY = 18  # leading bits of a key that are looked up directly
MERGE_POWER = -3
CHUNK = 1_000_000  # characters that are encoded together: their words are all in memory


def _merges(piece: str, rank: dict[str, float]) -> list[float]:
    """Ranks of the merges that build a piece from its characters, the lowest rank first wherever it fits."""
    parts, out = list(piece), []
    while len(parts) > 1:
        best, at = min((rank.get(a + b, math.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if best == math.inf:
            break
        out.append(best)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return out


class Pieces:
    """The pieces of a model, ready to be probed: plain arrays, sent to the tasks as they are.

    Pieces are found by a polynomial hash of their characters, in a sorted array of keys.
    A unigram model's scores are log-probabilities, added up as they are. A BPE model's are
    merge ranks; there a piece scores the sum of (rank + 10) ** -3 over the merges that
    build it, so that the segmentation with the most of the highest-ranked merges wins.
    """

    def __init__(self, pieces: Sequence[tuple[str, float, str]], ranks: bool, dummy_prefix: bool = True):
        """``pieces``: (text, score, kind) by id, kind being normal, byte, unknown or other."""
        self.dummy_prefix = dummy_prefix
        normal = [(i, t, s) for i, (t, s, kind) in enumerate(pieces) if kind == "normal" and t]
        if any(SPACE in t.lstrip(SPACE) for _, t, _ in normal):
            raise ValueError("a piece spans two words")
        self.longest = max((len(t) for _, t, _ in normal), default=1)
        rank = {t: -s for _, t, s in normal}
        score = np.array([sum((r + 10.0) ** MERGE_POWER for r in _merges(t, rank)) if ranks else s for _, t, s in normal])
        keys = np.array([self._key(t) for _, t, _ in normal], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], score[order]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces have one key")
        self.ids = np.array([i for i, _, _ in normal], dtype=np.int64)[order]
        # where the keys of each leading bit pattern begin, and how many have the same at most
        self.first = np.searchsorted(self.keys, np.arange(2**DIRECTORY, dtype=np.uint64) << np.uint64(64 - DIRECTORY)).astype(np.int32)
        self.crowd = int(np.diff(np.append(self.first, len(self.keys))).max(initial=1))
        self.padded = np.append(self.keys, np.zeros(self.crowd + 1, np.uint64))
        # a character that no piece holds costs more than any piece
        self.missing = float(score.min(initial=0.0)) - 10.0
        unknown = next((i for i, p in enumerate(pieces) if p[2] == "unknown"), 0)
        self.bytes = np.full(256, unknown, dtype=np.int64)
        for i, (t, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.bytes[int(t[3:5], 16)] = i
        raw = [bytes([int(t[3:5], 16)]) if kind == "byte" else t.encode() if kind == "normal" else
               " ⁇ ".encode() if kind == "unknown" else b"" for t, _, kind in pieces]
        self.spell = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.spell_at = np.cumsum([0] + [len(r) for r in raw])

    @staticmethod
    def _key(text: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in text:
            h = h * _BASE + np.uint64(ord(c) + 1)
        return int(mix64(h)[0])

    def _probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key among the sorted keys (any, if it is not there), and whether it is there."""
        at = self.first[keys >> np.uint64(64 - DIRECTORY)]
        found = self.padded[at] == keys
        for step in range(1, self.crowd):
            more = self.padded[at + step] == keys
            at = np.where(more, at + step, at)
            found |= more
        return np.minimum(at, len(self.keys) - 1), found

    def viterbi(self, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best pieces of words of one length (rows of code points), all words at once.

        Returns the tokens of all words one after another, and each word's number of them. A
        character without a piece is -1 - its code point. The best total score wins, the
        longer last piece if equal.
        """
        n, length = grid.shape
        hashes = np.zeros((length + 1, n), dtype=np.uint64)
        for i in range(length):
            hashes[i + 1] = hashes[i] * _BASE + (grid[:, i].astype(np.uint64) + np.uint64(1))
        best = np.zeros((length + 1, n))
        back = np.zeros((length + 1, n), dtype=np.int32)
        token = np.zeros((length + 1, n), dtype=np.int32)
        for i in range(1, length + 1):
            most = min(i, self.longest)
            spans = np.arange(most, 0, -1)
            keys = mix64(hashes[i][None, :] - hashes[i - spans] * np.array([pow(int(_BASE), int(s), 2**64) for s in spans], dtype=np.uint64)[:, None])
            at, found = self._probe(keys)
            total = np.where(found, self.scores[at], LOWEST)
            total[-1] = np.where(found[-1], total[-1], self.missing)  # one character
            total += best[i - spans]
            pick = np.argmax(total, axis=0)
            rows = np.arange(n)
            best[i], back[i] = total[pick, rows], spans[pick]
            token[i] = np.where(found[pick, rows], self.ids[at[pick, rows]], -1 - grid[:, i - 1].astype(np.int64))
        place = np.full(n, length)
        steps = []
        while True:
            live = np.flatnonzero(place > 0)
            if not len(live):
                break
            steps.append((live, token[place[live], live]))
            place[live] -= back[place[live], live]
        counts = np.zeros(n, dtype=np.int64)
        for live, _ in steps:
            counts[live] += 1
        ends = np.cumsum(counts)
        out = np.empty(ends[-1] if n else 0, dtype=np.int32)
        for k, (live, t) in enumerate(steps):  # the last token of each word comes first
            out[ends[live] - 1 - k] = t
        return out, counts

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray | None]:
        """Token ids of each text (null: null)."""
        tokens, ends = self.encode_all(texts)
        return [None if t is None else tokens[ends[i]:ends[i + 1]] for i, t in enumerate(texts)]

    def encode_all(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after another, and where each text's begin and end."""
        lists = []
        for t in texts:
            t = (t or "").replace(" ", SPACE)
            lists.append(WORD.findall(SPACE + t if t and self.dummy_prefix else t))
        offsets = np.cumsum([0] + [len(x) for x in lists])
        flat = np.empty(offsets[-1], dtype=object)
        flat[:] = [w for x in lists for w in x]
        codes, words = pd.factorize(flat)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(lengths, kind="stable")
        tokens, counts = [], np.zeros(len(words), dtype=np.int64)
        for length in np.unique(lengths):
            own = order[np.searchsorted(lengths[order], length):np.searchsorted(lengths[order], length, side="right")]
            for a in range(0, len(own), 16384):
                some = own[a:a + 16384]
                grid = np.array(list(words[some]), dtype=f"U{length}").view(np.uint32).reshape(len(some), length)
                t, counts[some] = self.viterbi(grid)
                tokens.append(t)
        pool = np.concatenate(tokens) if tokens else np.empty(0, np.int32)
        start = np.empty(len(words), dtype=np.int64)
        start[order] = np.cumsum(counts[order]) - counts[order]
        flat_tokens, per_word = _gather(pool, start[codes], counts[codes])
        flat_tokens, sizes = self._spelled(flat_tokens)
        return flat_tokens, np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(per_word)])[offsets]]

    def _spelled(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their UTF-8 bytes; each token's new count."""
        c = np.where(tokens < 0, -1 - tokens.astype(np.int64), 0)
        size = np.where(tokens < 0, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF), 1)
        of = np.repeat(np.arange(len(tokens)), size)
        place = size[of] - 1 - (np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size))  # bytes that follow
        char, many = c[of], size[of]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[many]
        byte = np.where(place == many - 1, lead | (char >> (6 * place)), 0x80 | ((char >> (6 * place)) & 0x3F))
        byte = np.where(many == 1, char, byte)
        return np.where(tokens[of] < 0, self.bytes[np.clip(byte, 0, 255)], tokens[of]).astype(np.int32), size

    def decode(self, tokens: Sequence[np.ndarray | None]) -> list[str | None]:
        """Texts of token ids (null: null); ids that are no piece spell nothing."""
        sizes = [0 if t is None else len(t) for t in tokens]
        flat = np.concatenate([np.asarray(t, dtype=np.int64) for t in tokens if t is not None] or [np.empty(0, np.int64)])
        known = (flat >= 0) & (flat < len(self.spell_at) - 1)
        at = np.where(known, flat, 0)
        spelled, size = _gather(self.spell, self.spell_at[at], np.where(known, np.diff(self.spell_at)[at], 0))
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *sizes])]
        out = []
        for i, t in enumerate(tokens):
            s = spelled[ends[i]:ends[i + 1]].tobytes().decode("utf-8", "replace").replace(SPACE, " ")
            out.append(None if t is None else s[1:] if self.dummy_prefix and s.startswith(" ") else s)
        return out


def _gather(pool: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``pool[start:start + count]`` one after another."""
    ends = np.cumsum(count)
    return pool[np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)], count


def load(path: str = MODEL) -> Pieces:
    """The pieces of a SentencePiece model file, read on the driver (its size is the vocabulary's)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = [(model.id_to_piece(i), model.get_score(i),
              "unknown" if model.is_unknown(i) else "byte" if model.is_byte(i) else
              "other" if model.is_control(i) or model.is_unused(i) else "normal") for i in range(model.get_piece_size())]
    scores = [s for _, s, k in kinds if k == "normal"]
    ranks = all(s == int(s) and s <= 0 for s in scores)  # merge ranks, not log-probabilities
    return Pieces(kinds, ranks, dummy_prefix=model.encode("a")[:1] == model.encode(" a")[-1:] or
                  "".join(model.id_to_piece(i) for i in model.encode("a")).startswith(SPACE))


def encode_column(text: Column, pieces: Pieces) -> Column:
    """Token ids of a text: the segmentation of best total score (:meth:`Pieces.viterbi`).

    Spaces become ``\\u2581`` and one is put before the text; words (each with the spaces
    before it) are cut into pieces on their own, which no piece crosses; characters that no
    piece holds become their UTF-8 bytes. Null gives null, an empty text no tokens.
    """
    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = [x for _, part in text_chunks(batch, CHUNK) for x in pieces.encode(part)]
            yield pd.Series(rows, index=batch.index, dtype=object)
    return encode(text)


def decode_column(ids: Column, pieces: Pieces) -> Column:
    """The text of token ids. Inverts :func:`encode_column`, but for ``\\u2581`` in a text, which becomes a space."""
    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = list(batch)
            parts = chunks([0 if x is None else len(x) for x in rows], CHUNK // 2)
            yield pd.Series([x for a, b in parts for x in pieces.decode(rows[a:b])], index=batch.index, dtype=object)
    return decode(ids)


def tokenize(docs: DataFrame, pieces: Pieces, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Token ids of every whole text, decoded again to see that nothing is lost.

    Returns the columns ``keep``, ``ids`` (see :func:`encode_column`), ``n_ids`` and
    ``round_trip`` (whether the ids decode to the text), a row per row. Null text: null ids,
    0, null. Empty text: no ids, 0, true. Very long texts are whole; their words are cut
    one after another like others. Repeated rows, null ids and other columns do not matter;
    kept columns called like an output are left out. An empty table gives an empty table.
    Texts are taken in slices of about ``CHUNK`` characters, whatever Arrow's batches hold.
    """
    own = [c for c in keep if c not in ("ids", "n_ids", "round_trip")]
    rows = docs.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{text_col}`").alias("_sp_text"))
    schema = StructType([*[f for f in rows.schema if f.name != "_sp_text"], StructField("ids", ArrayType(IntegerType())),
                         StructField("n_ids", IntegerType()), StructField("round_trip", BooleanType())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column("_sp_text")), 0).to_pylist()
            for a, b in chunks(sizes, CHUNK):
                part = batch.slice(a, b - a)
                texts = part.column("_sp_text").to_pylist()
                tokens, ends = pieces.encode_all(texts)
                back = pieces.decode([tokens[ends[i]:ends[i + 1]] for i in range(len(texts))])
                none = np.array([t is None for t in texts], dtype=bool)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int32()), mask=pa.array(none))
                same = pa.array([None if t is None else t.replace(SPACE, " ") == d for t, d in zip(texts, back, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, pa.array(np.diff(ends), pa.int32()), same],
                                                 names=[*part.schema.names[:-1], "ids", "n_ids", "round_trip"])
    return rows.mapInArrow(coded, schema)
