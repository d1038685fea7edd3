"""A training corpus from raw documents: five stages, each over all its predecessor kept.

Stages read their columns by name and pass the others on. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chorale.llm import byte_bpe, jaccard_join, mixing, substring_dedup, toxicity
from chorale.llm.common import table
from chorale.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents graded 0 by the severity model fitted on the labels.

    Null and empty texts are graded 0; repeated rows are graded each.
    """
    return toxicity.tolerable(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest doc_id.

    Documents without words stay, and so do rows with a null doc_id; rows of one doc_id stay
    or go together.
    """
    return jaccard_join.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words and more that occur more than once.

    A text without any stays as it is, a null one too; of rows repeated all passages repeat.
    """
    return substring_dedup.shortened(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; those without words are not taken.

    A null source is the last of the sources.
    """
    return mixing.mixture(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, tokens, and the digest of the bytes they decode to; a row for each row."""
    return byte_bpe.tokens(docs, keep=("doc_id", "source"))


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

# The severity model, the cube method and the merges have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        place = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return STAGES[-1][1](spark, docs, sf_dir)
