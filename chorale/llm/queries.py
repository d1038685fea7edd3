"""The queries of the operators over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from chorale.llm import (
    ann, byte_bpe, fill_middle, fingerprints, html_text, jaccard_join, mixing, periodic, sharding, sql, substring_dedup, top_scores,
    toxicity, url_filter,
)
from chorale.llm.common import table

QUERIES = {}
ORACLES = {}


def query(run, text=None):
    QUERIES[run.__name__] = run
    if text is not None:
        ORACLES[run.__name__] = text
    return run


def with_sql(text):
    return lambda run: query(run, text)


@with_sql(sql.SUBSTRING_DEDUP)
def op1_substring_dedup(spark, sf_dir):
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op2_main_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@with_sql(sql.JACCARD_JOIN)
def op3_jaccard_join(spark, sf_dir):
    return jaccard_join.similar(table(spark, sf_dir, "documents"))


@query
def op4_nearest(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 20 = 0"))


@query
def op5_shards(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark, sf_dir):
    return toxicity.severities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op8_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


@query
def op9_mixture(spark, sf_dir):
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


@query
def op10_fingerprints(spark, sf_dir):
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


@query
def op11_periodic_runs(spark, sf_dir):
    return periodic.digest(table(spark, sf_dir, "documents"), periodic.planted)


@with_sql(top_scores.SQL)
def op12_top_scores(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return top_scores.top_scores(rows, rows.where("vec_id % 50 = 0"))


@with_sql(fill_middle.SQL)
def op13_fill_middle(spark, sf_dir):
    return fill_middle.digest(table(spark, sf_dir, "documents"))


# What of the queries above SQL can tell, in queries of its own.


@with_sql(sql.SHARD_SLOTS)
def shard_slots(spark, sf_dir):
    return op5_shards(spark, sf_dir).drop("text_crc32")


@with_sql(sql.URL_RULES)
def url_rules(spark, sf_dir):
    judged = op7_url_filter(spark, sf_dir)
    return judged.select(
        "page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("ruled_verdict")
    )


@with_sql(sql.MIX_TARGETS)
def mix_targets(spark, sf_dir):
    return op9_mixture(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"))


@with_sql(sql.EDITED_TEXTS)
def edited_texts(spark, sf_dir):
    return op10_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")
