"""The corpus pipeline: documents, cleaned, deduplicated, mixed and tokenised.

Each stage takes the documents that the one before kept and returns the columns of
documents; the last returns token ids. ``run`` writes every stage as a table before the
next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.llm import mixing, sentencepiece
from homestat.llm.common import staged, table
from homestat.llm.lines import line_dedup
from homestat.llm.minhash import near_duplicates
from homestat.llm.toxicity import fit

#: No SQL: a learned lexicon, edit distances and token ids are beyond it (tests compare with plain Python).
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity. Null and empty texts score as the base rate does."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) < 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat, three at a time, earlier lines; every document stays."""
    return _counted(line_dedup(docs).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document of smallest id. Null ids and empty texts stay."""
    copies = near_duplicates(docs).where("doc_id <> class_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, in the production mix: some documents repeat, some go, one a source is cut."""
    mixed = mixing.mix(docs, mixing.corpus_levels(), mixing.WEIGHTS, max_epochs=mixing.EPOCHS, seed=mixing.SEED)
    return _counted(mixing.take(docs, mixed))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it (null for a null text)."""
    return sentencepiece.tokenize(docs, sentencepiece.load(sentencepiece.MODEL), keep=("doc_id", "lang", "source"))


def _counted(docs: DataFrame) -> DataFrame:
    """With ``n_chars`` as it is now, where documents have it."""
    n = F.length("text").cast(dict(docs.dtypes)["n_chars"]) if "n_chars" in docs.columns else None
    return docs if n is None else docs.select(*[n.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
