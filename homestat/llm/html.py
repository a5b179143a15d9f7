"""Main text of web pages: the maximum-scoring run of words and tags."""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestat.llm.common import staged, text_chunks

SAMPLE = 5_000  # labelled pages that weights are learned from at most, the first by a hash of the id
PRIOR_WORDS = 20  # words that a prior counts for
LIMIT = 4.0  # largest weight of a word
TAG = 0.2  # what any tag costs
LABEL = 0.25  # share of a page's words that its article and main elements hold, if it is learned from

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|iframe|svg|xmp)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S | re.I)
NAMED = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Elements of a page by their use, and words in class, id or role that say what an element is for.
MAIN = frozenset("article main".split())
NOISE = frozenset("nav header footer aside form button select dialog menu head object canvas audio video map".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navigation navbar menu "
    "breadcrumb breadcrumbs footer header masthead sidebar aside widget cookie cookies consent gdpr notice notices alert "
    "popup modal overlay comment comments reply replies disqus respond share sharing social related recommended newsletter "
    "subscribe subscription signup login search form toolbar pagination pager copyright complementary contentinfo".split())
#: Words that say little inside an article, unless they are a whole name there; and those that mark readers' comments anywhere.
AMBIGUOUS = frozenset("form search social alert menu notice notices header login related recommended".split())
COMMENTS = frozenset("comment comments reply replies disqus".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr br img input".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
# How likely a word is content before any page is seen, by the block it stands in.
PRIORS = {"noise": 0.02, "p": 0.9, "pre": 0.8, "blockquote": 0.8, "li": 0.6, "td": 0.6, "dd": 0.6} | dict.fromkeys(HEADINGS, 0.8)


class Block:
    """Text between the tags of two blocks: where it stands, and the tags before it."""

    __slots__ = ("tag", "noise", "main", "parts", "tags", "linked", "doubt")

    def __init__(self, tag: str, noise: bool, main: bool, doubt: int = -1):
        self.tag, self.noise, self.main, self.doubt = tag, noise, main, doubt
        self.parts: list[str] = []
        self.tags: list[str] = []
        self.linked = 0  # words inside links

    def text(self) -> str:
        return " ".join("".join(self.parts).split())

    def kind(self, words: int) -> str:
        return "noise" if self.noise else self.tag + ("/a" if self.linked * 2 > words else "")


def _is_noise(name: str, attrs: str, inside_main: bool) -> tuple[bool, bool]:
    """Whether an element is noise, and whether only its names say so, which its text may refute."""
    if name in MAIN or name in ("body", "html"):
        return name in MAIN and any(w in ("comment", "comments", "reply") for t in _names(attrs) for w in t[1]), False
    if name in NOISE or bool(attrs) and bool(HIDDEN.search(attrs)):
        return True, False
    names = _names(attrs) if attrs else []
    if any(w in COMMENTS for _, words in names for w in words):
        return True, False
    if inside_main:  # a whole name, or the end of one where that is clear
        return any(t in NOISE_WORDS or words[-1] in NOISE_WORDS - AMBIGUOUS for t, words in names), True
    return any(w in NOISE_WORDS for _, words in names for w in words), True


def _names(attrs: str) -> list[tuple[str, list[str]]]:
    """The names in class, id, role and label, each whole and in its words."""
    tokens = [t for m in NAMED.finditer(attrs) for v in m.groups() if v for t in v.split()]
    return [(t.lower(), words) for t in tokens if (words := [w.lower() for w in PART.findall(t)])]


class Open:
    """The open elements of a page. What holds for all of them is kept with the last one, so each step looks at few."""

    def __init__(self):
        self.names: list[str] = []
        # nearest element that is no inline one, place of the first noise, whether all noise is headers, number of the doubtful element
        self.state: list[tuple[str, int, bool, int]] = []
        self.count: Counter[str] = Counter()
        self.doubtful = 0

    def top(self) -> tuple[str, int, bool, int]:
        return self.state[-1] if self.state else ("body", -1, True, -1)

    def main(self) -> bool:
        return any(self.count[n] for n in MAIN)

    def push(self, name: str, noise: bool, doubt: bool) -> None:
        holder, first, headers, number = self.top()
        if noise and first < 0:
            first = len(self.names)
            if doubt:
                number, self.doubtful = self.doubtful, self.doubtful + 1
        elif noise and not doubt:
            number = -1  # surely noise, whatever holds it
        self.state.append((holder if name in INLINE else name, first, headers and (not noise or name == "header"), number))
        self.names.append(name)
        self.count[name] += 1

    def cut(self, at: int) -> int:
        """Closes all from place ``at``; returns how many links that were."""
        gone = self.names[at:]
        del self.names[at:], self.state[at:]
        self.count.subtract(gone)
        return gone.count("a")

    def last(self, names) -> int:
        """Place of the innermost open element of these names, or -1."""
        if not any(self.count[n] for n in names):
            return -1
        return next(i for i in range(len(self.names) - 1, -1, -1) if self.names[i] in names)


def parse(page: str | None) -> list[Block]:
    """The blocks of a page in order, each with the tags that come before its text.

    An element that only its class, id, role or label calls noise is none if it holds most
    words of the page's (or, in an article, the article's) and most of them are no links.
    """
    stack = Open()
    block = Block("body", False, False)
    out = [block]
    links = 0

    def text(s: str) -> None:
        s = _html.unescape(s)
        if s:
            block.parts.append(s)
            if links:
                block.linked += len(s.split())

    def renew() -> None:
        nonlocal block
        holder, first, headers, doubt = stack.top()
        noise, main = first >= 0, stack.main()
        if noise and holder in HEADINGS and main and headers:
            noise = False  # a heading in an article's own header
        block = Block(holder, noise, main, doubt if noise else -1)
        out.append(block)

    def close(names) -> None:
        nonlocal links
        at = stack.last(names)
        if at >= 0:
            links -= stack.cut(at)

    at = 0
    page = page or ""
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name, ends, attrs = name.lower(), m["end"] or m["end2"], m["attrs"] or m["attrs2"] or ""
        if name in INLINE:
            block.tags.append(name)
            if name == "br":
                block.parts.append("\n")
            elif ends:
                close({name})
            elif name not in VOID:
                if name == "a":
                    close({"a"})
                    links += 1
                noise, doubt = _is_noise(name, attrs, True) if attrs else (False, False)
                stack.push(name, noise, doubt)
                if noise:
                    renew()
            if ends and block.noise:
                renew()
            continue
        if ends:
            close({name})
        else:
            if name in MAIN and not stack.main() and stack.top()[1] >= 0:
                links -= stack.cut(stack.top()[1])  # an article begins where a menu was left open
            if name in CLOSES and any(stack.count[n] for n in CLOSES[name]):
                outer = stack.last(("ul", "ol", "dl", "table", "select"))
                inner = next((i for i in range(outer + 1, len(stack.names)) if stack.names[i] in CLOSES[name]), None)
                if inner is not None:
                    links -= stack.cut(inner)
            if name not in VOID:
                close({"p"})
                stack.push(name, *_is_noise(name, attrs, stack.main()))
        renew()
        block.tags.append(name)
    text(page[at:])
    _clear_doubts(out)
    return out


def _clear_doubts(blocks: list[Block]) -> None:
    if all(b.doubt < 0 for b in blocks):
        return
    held: Counter[int] = Counter()
    linked: Counter[int] = Counter()
    whole: Counter[bool] = Counter()
    for b in blocks:
        n = len(b.text().split())
        whole[False] += n
        whole[b.main] += n if b.main else 0
        held[b.doubt] += n
        linked[b.doubt] += b.linked
    for b in blocks:
        if b.doubt >= 0 and 2 * held[b.doubt] > whole[b.main] and 2 * linked[b.doubt] <= held[b.doubt]:
            b.noise = False


def _prior(kind: str) -> float:
    p = PRIORS.get(kind.removesuffix("/a"), 0.6)
    return p if not kind.endswith("/a") else p / 4


def weights_of(counts: Mapping[str, tuple[float, float]]) -> dict[str, float]:
    """Log-odds of content by kind of word, and the cost of each tag, from (inside, all) counts.

    Kinds of tags are written in angle brackets; a tag costs ``TAG``, more if it stands
    rather outside of content.
    """
    out = {}
    for kind, (inside, n) in counts.items():
        p = 0.5 if kind.startswith("<") else _prior(kind)
        p = (inside + PRIOR_WORDS * p) / (n + PRIOR_WORDS)
        odds = max(-LIMIT, min(LIMIT, math.log(max(p, 1e-9) / max(1 - p, 1e-9))))
        out[kind] = min(0.0, odds) - TAG if kind.startswith("<") else odds
    return out


def best_run(scores: np.ndarray) -> tuple[int, int]:
    """Bounds of the contiguous run of highest sum (the first, if equal; empty if none is positive)."""
    best, where, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        total += s
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, where = total, (start, i + 1)
    return where


def main_share(blocks: list[Block], sizes: list[int]) -> float:
    """Share of the words outside noise that stand in an article or main element: 0 if these are empty."""
    all_, inside = (sum(n for b, n in zip(blocks, sizes, strict=True) if not b.noise and (b.main or every)) for every in (True, False))
    return inside / all_ if all_ else 0.0


def main_text(page: str | None, weights: Mapping[str, float]) -> str:
    """Text of the blocks in the best run of words and tags, without those that are noise."""
    blocks = parse(page)
    texts = [b.text() for b in blocks]
    sizes = [len(t.split()) for t in texts]
    # the page's own mark counts as much as the part of its text that it holds: a teaser or an empty element says little
    share = main_share(blocks, sizes)
    scores = []  # the tags before a block, then its words
    for b, n in zip(blocks, sizes, strict=True):
        kind = b.kind(n)
        word = weights[kind] if kind in weights else math.log(_prior(kind) / (1 - _prior(kind)))
        cost = sum(weights.get(f"<{x}>", -TAG) for x in b.tags)
        if b.main:  # noise inside is left out, and so costs the less
            cost *= 1 - share
            word = word * (1 - share) if b.noise else word + LIMIT * share
        else:
            word -= LIMIT * share
        # a block of noise between two of content does not outweigh what follows: it is left out anyway
        scores += [cost, n * word if not b.noise else max(n * word, -5 * LIMIT)]
    a, b = best_run(np.array(scores))
    return "\n".join(t for i, t in enumerate(texts) if t and a <= 2 * i + 1 < b and not blocks[i].noise)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        total: dict[str, list[float]] = {}
        for page in pdf["html"]:
            blocks = parse(page)
            sizes = [len(b.text().split()) for b in blocks]
            if main_share(blocks, sizes) < LABEL:
                continue
            for b, n in zip(blocks, sizes, strict=True):
                for kind, k in [(b.kind(n), n), *((f"<{x}>", 1) for x in b.tags if x not in MAIN)]:
                    c = total.setdefault(kind, [0, 0])
                    c[0] += k * b.main
                    c[1] += k
        yield pd.DataFrame([(k, float(a), float(n)) for k, (a, n) in total.items()], columns=["kind", "inside", "n"])


def learn_weights(pages: DataFrame, id_col: str, html_col: str, sample: int = SAMPLE) -> dict[str, float]:
    """Weights from pages that label their content themselves, with an article or main element.

    Pages whose elements hold less than ``LABEL`` of their words, as teasers do, are no labels.
    """
    own = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").alias("html"))
    own = own.where(F.col("html").rlike(r"(?i)<(article|main)[\s>]"))
    keys = own.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    some = own.join(F.broadcast(staged(keys)), "id")  # at most ``sample`` ids
    rows = some.select("html").mapInPandas(_counts, "kind string, inside double, n double").groupBy("kind").agg(
        F.sum("inside").alias("inside"), F.sum("n").alias("n")).collect()  # as many as the sample's pages have kinds of elements
    return weights_of({r["kind"]: (r["inside"], r["n"]) for r in rows})


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> DataFrame:
    """Add ``text``, the main text of each page, and ``n_chars``, its code points.

    A page is a sequence of words and tags. Words score by the kind of block they stand
    in, tags cost; the weights are log-odds learned from at most ``sample`` pages that
    label their content with an article or main element. One linear scan finds the
    contiguous run of highest sum; its blocks are the text, in page order, joined by
    line feeds, without blocks inside menus, headers, footers, sidebars, notices,
    adverts, forms, comments or hidden elements (by element, class, id or role; see
    :func:`parse` and :func:`_is_noise` for when a name is not believed).
    Character references are decoded, white space in a block becomes one space, its ends
    are trimmed. In an article or main element, words score more, and words outside less,
    by as much as the element holds of the page's text: the weights still decide where
    it is empty or a teaser.

    A row per row, with all its columns (``text`` and ``n_chars`` are replaced). Null,
    empty and textless pages: empty text. Broken markup (elements left open, cut pages)
    is read as far as it goes; repeated rows give equal texts; ids may be null. An empty
    table gives an empty table. Pages are read on their own: nothing is shuffled.
    """
    weights = learn_weights(pages, id_col, html_col, sample)

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p, weights) for _, part in text_chunks(batch) for p in part], index=batch.index, dtype=object)

    own = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("text", "n_chars")]
    return pages.select(*own, text_of(F.col(f"`{html_col}`")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
