"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from homestat.llm import mixing, sentencepiece, urls
from homestat.llm.alignment import align_tokenizers
from homestat.llm.ann import nearest_neighbours
from homestat.llm.common import table, usable_vectors
from homestat.llm.html import extract_text
from homestat.llm.lines import line_dedup
from homestat.llm.minhash import near_duplicates
from homestat.llm.quality import quality
from homestat.llm.substring import substring_dedup
from homestat.llm.topk import exact_topk
from homestat.llm.toxicity import toxicity
from homestat.llm.trie import conversation_trie

# --- 1: mixing ----------------------------------------------------------------------

def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.corpus_levels(), mixing.WEIGHTS,
                      max_epochs=mixing.EPOCHS, seed=mixing.SEED)


def _fill_sql(i: int, levels: list[str]) -> str:
    """One level of the budget tree: b<i> from b<i - 1>."""
    level, path, parent = levels[i], ", ".join(levels[: i + 1]), ", ".join(["root", *levels[:i]])
    weight = "".join(f" WHEN '{k}' THEN {w}" for k, w in mixing.WEIGHTS.get(level, {}).items())
    weight = f"CASE {level}{weight} ELSE 1 END" if weight else "1"
    return f"""
n{i} AS (SELECT 0 AS root, {path}, sum(tokens) * {mixing.EPOCHS} AS cap, {weight} AS weight FROM leaves GROUP BY {path}),
f{i} AS (SELECT n{i}.*, budget, sum(cap) OVER o AS s,
           coalesce(sum(weight) OVER (o ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS w
         FROM n{i} JOIN {f'b{i - 1}' if i else 'top'} USING ({parent}) WINDOW o AS (PARTITION BY {parent} ORDER BY cap::DOUBLE / weight, {level})),
g{i} AS (SELECT *, (budget - s) * weight >= cap * w AS is_full FROM f{i}),
h{i} AS (SELECT *, budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER q, 0) AS rest,
           coalesce(sum(CASE WHEN NOT is_full THEN weight END) OVER q, 1) AS total FROM g{i} WINDOW q AS (PARTITION BY {parent})),
i{i} AS (SELECT *, CASE WHEN is_full THEN cap ELSE rest * weight // total END AS base,
           CASE WHEN is_full THEN -1 ELSE rest * weight % total END AS frac FROM h{i}),
j{i} AS (SELECT *, budget - sum(base) OVER (PARTITION BY {parent}) AS remain,
           row_number() OVER (PARTITION BY {parent} ORDER BY frac DESC, {level}) AS place FROM i{i}),
b{i} AS (SELECT root, {path}, least(cap, base + CASE WHEN NOT is_full AND place <= remain THEN 1 ELSE 0 END) AS budget FROM j{i})"""


_LEVELS = ["domain", "lang", "source"]
OP1_SQL = r"""
WITH slim AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens,
         coalesce('d' || (try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4), '(none)') AS domain,
         coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM slim GROUP BY ALL),
top AS (SELECT 0 AS root, coalesce(sum(tokens), 0) AS budget FROM leaves),""" + ",".join(
    _fill_sql(i, _LEVELS) for i in range(3)) + f""",
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
           CASE WHEN tokens > 0 THEN budget % tokens ELSE -1 END AS rest
         FROM leaves JOIN b2 USING (domain, lang, source)),
placed AS (
  SELECT slim.*, whole, rest, sum(n_tokens) OVER (
           PARTITION BY domain, lang, source
           ORDER BY md5('{mixing.SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, '')), doc_id, n_tokens
           ROWS UNBOUNDED PRECEDING) - n_tokens AS start
  FROM slim JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens,
       (whole + CASE WHEN start + n_tokens <= rest THEN 1 ELSE 0 END)::BIGINT AS copies,
       (CASE WHEN start + n_tokens > rest AND start < rest THEN rest - start ELSE 0 END)::BIGINT AS cut_tokens
FROM placed
"""

# --- 2: near-duplicates ----------------------------------------------------------------


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


# --- 3: exact top-k ------------------------------------------------------------------


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    # whole numbers, kept as doubles: beyond 2**53 a double has no fraction to lose
    vectors = vectors.select("id", F.transform("v", lambda x: F.floor(x * 256).cast("double")).alias("v"))
    return exact_topk(vectors.where("id % 50 = 0"), vectors, 5)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_dot_product(q.e, r.e)::BIGINT AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.e) = len(r.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
WHERE rank <= 5
"""

# --- 4: SentencePiece --------------------------------------------------------------------


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text again."""
    return sentencepiece.tokenize(table(spark, sf_dir, "documents"), sentencepiece.load(sentencepiece.MODEL))


# --- 5: toxicity ----------------------------------------------------------------------


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --- 6: substring dedup ---------------------------------------------------------------


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


# --- 7: approximate nearest neighbours --------------------------------------------------


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", nonzero=True)
    return nearest_neighbours(vectors.where("id % 20 = 0"), vectors, 20)


# --- 8: HTML extraction ----------------------------------------------------------------


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


# --- 10: URL filter -------------------------------------------------------------------

URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _url_sql() -> str:
    longest = sorted(URL_RULES, key=lambda r: (-len(r[0]), r[0]))
    rule = "CASE" + "".join(
        f" WHEN (host = '{t.partition('/')[0]}' OR host LIKE '%.{t.partition('/')[0]}')"
        f" AND starts_with(path, '/{t.partition('/')[2]}') THEN '{t}'" for t, _ in longest) + " END"
    says = "CASE rule" + "".join(f" WHEN '{t}' THEN '{v}'" for t, v in longest) + " END"
    k, w = urls.ORDER, urls.WEIGHT
    a = r = f"(1.0::DOUBLE / {urls.ALPHABET})"
    for i in range(k + 1):
        a, r = (f"((ta{i} + {w}::DOUBLE * {x}) / (c{y}{i} + {w}::DOUBLE))".replace("ta", f"t{y}") for x, y in ((a, "a"), (r, "r")))
    counts = ", ".join(
        f"sum(a) OVER (PARTITION BY right(gram, {i + 1})) AS ta{i}, sum(r) OVER (PARTITION BY right(gram, {i + 1})) AS tr{i}, "
        f"sum(a) OVER (PARTITION BY substr(gram, {k - i + 1}, {i})) AS ca{i}, sum(r) OVER (PARTITION BY substr(gram, {k - i + 1}, {i})) AS cr{i}"
        for i in range(k + 1))
    return rf"""
WITH rows0 AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
           '{urls.UPPER}', '{urls.LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
ruled AS (SELECT *, {rule} AS rule FROM rows0),
judged AS (SELECT *, {says} AS says FROM ruled),
strings AS (SELECT host, path, host || path AS s, sum(CASE says WHEN 'allow' THEN 1 ELSE 0 END) AS accepted,
              sum(CASE says WHEN 'block' THEN 1 ELSE 0 END) AS rejected FROM judged GROUP BY host, path),
padded AS (SELECT *, repeat(chr(2), {k}) || s || chr(3) AS p FROM strings),
grams AS (SELECT host, path, accepted, rejected, substr(p, i::BIGINT, {k + 1}) AS gram
          FROM (SELECT *, unnest(range(1, length(s) + 2)) AS i FROM padded)),
counts AS (SELECT gram, sum(accepted) AS a, sum(rejected) AS r FROM grams GROUP BY gram),
wide AS (SELECT gram, {counts} FROM counts),
ratios AS (SELECT gram, ln({a}) - ln({r}) AS ratio FROM wide),
scored AS (SELECT host, path, avg(ratio) AS score, max(accepted) AS accepted, max(rejected) AS rejected
           FROM grams JOIN ratios USING (gram) GROUP BY host, path),
stats AS (SELECT sum(accepted) AS na, sum(rejected) AS nr, sum(accepted * score) / sum(accepted) AS ma,
            sum(rejected * score) / sum(rejected) AS mr,
            sqrt(greatest(0, sum(accepted * score * score) / sum(accepted) - (sum(accepted * score) / sum(accepted)) ** 2)) AS sa,
            sqrt(greatest(0, sum(rejected * score * score) / sum(rejected) - (sum(rejected * score) / sum(rejected)) ** 2)) AS sr
          FROM scored),
cut AS (SELECT CASE WHEN coalesce(na, 0) = 0 OR coalesce(nr, 0) = 0 THEN 0.0 WHEN sa + sr = 0 THEN (ma + mr) / 2
               ELSE (ma * sr + mr * sa) / (sa + sr) END AS least FROM stats)
SELECT page_id, host, path, rule,
       coalesce(says, CASE WHEN score >= (SELECT least FROM cut) THEN 'allow' ELSE 'block' END) AS verdict
FROM judged JOIN scored USING (host, path)
"""


OP10_SQL = _url_sql()

# --- 9: line dedup --------------------------------------------------------------------


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


OP9_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
keyed AS (
  SELECT doc_id, pos, line,
         CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') THEN line ELSE '' END AS k FROM lines),
runs AS (
  SELECT doc_id, pos, k AS a, lead(k) OVER d AS b, lead(k, 2) OVER d AS c
  FROM keyed WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS occurrence
  FROM runs WHERE c IS NOT NULL AND (a <> '' OR b <> '' OR c <> '')),
covered AS (
  SELECT DISTINCT doc_id, pos + i AS pos FROM ranked, (VALUES (0), (1), (2)) AS o(i) WHERE occurrence > 1),
kept AS (
  SELECT k.doc_id, string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (c.pos IS NULL) AS text,
         count(*) AS n_lines, count(c.pos) AS n_removed
  FROM keyed k LEFT JOIN covered c ON k.doc_id = c.doc_id AND k.pos = c.pos GROUP BY k.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

# --- 11: cross-tokenizer alignment ---------------------------------------------------------


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_tokenizers(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups"), 256))
    return aligned.select(F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                          digest.alias("groups_sha256"))


# --- 12: quality -------------------------------------------------------------------------


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --- 13: conversation prefix trie ---------------------------------------------------------


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = """
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, count(*) OVER (PARTITION BY conv_id) AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, n, conv_id - conv_id % 5 AS base, xor(4294967295::UBIGINT, list_reduce(
           list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT),
           lambda crc, byte: list_reduce([0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
             lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END, xor(crc, byte)),
           4294967295::UBIGINT)) % 9 AS h
  FROM (SELECT DISTINCT conv_id, n FROM own)),
rebuilt AS (
  SELECT c.conv_id, o.pos, role, text FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, o.pos - c.h + least(c.h, coalesce(b.n, 0)), role, text
  FROM convs c JOIN own o USING (conv_id) LEFT JOIN convs b ON b.conv_id = c.base WHERE o.pos > c.h),
members AS (
  SELECT conv_id, pos AS depth, strlen(text) AS bytes, sha256(string_agg(sha256(length(role) || ':' || role || text), '')
           OVER (PARTITION BY conv_id ORDER BY pos)) AS k
  FROM rebuilt UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (SELECT k, min(conv_id) AS conv_id, max(depth) AS depth, count(*) AS n_convs, max(bytes) AS bytes FROM members GROUP BY k),
paths AS (
  SELECT n.k, n.depth, n.n_convs, n.bytes, m.k AS above, m.depth AS above_depth
  FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth),
children AS (SELECT above AS k, count(*) AS n_children FROM paths WHERE above_depth = depth - 1 GROUP BY above),
parents AS (SELECT p.k, n.conv_id AS parent_conv_id FROM paths p JOIN nodes n ON n.k = p.above WHERE above_depth = p.depth - 1),
subtrees AS (
  SELECT above AS k, count(*) FILTER (c.k IS NULL) AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
  FROM paths p LEFT JOIN children c ON c.k = p.k GROUP BY above),
ends AS (
  SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS last FROM members) WHERE depth = last GROUP BY k)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes LEFT JOIN parents USING (k) LEFT JOIN children USING (k) JOIN subtrees USING (k) LEFT JOIN ends USING (k)
"""

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_exact_topk": op3_exact_topk,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_toxicity": op5_toxicity,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_html_extract": op8_html_extract,
    "op9_line_dedup": op9_line_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_token_alignment": op11_token_alignment,
    "op12_quality": op12_quality,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_mix_sources": OP1_SQL,
    "op3_exact_topk": OP3_SQL,
    "op9_line_dedup": OP9_SQL,
    "op10_url_filter": OP10_SQL,
    "op13_prefix_trie": OP13_SQL,
}
