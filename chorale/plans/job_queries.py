"""Queries that put several steps together as a notebook or a job does."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale import sinks
from chorale.functions.scores import score_columns
from chorale.operators import enrich, tags
from chorale.operators import tagstate as tg
from chorale.plans import report_queries as rq
from chorale.plans import stream_queries, views
from chorale.plans.registry import query
from chorale.plans.views import with_views
from chorale.session import cached, scratch_path
from chorale.sources.tables import read_parquet

_LEXICON = """WITH lexicon AS (
        SELECT term, CASE WHEN ascii(term) % 2 = 0 THEN 'anger' ELSE 'joy' END AS tone, (length(term) % 5) / 4.0::DOUBLE AS weight
        FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\w+')) AS term FROM benchmark)),
    words AS (SELECT doc_id, source, unnest(regexp_extract_all(lower(text), '\\w+')) AS term FROM documents),
    scores AS (
        SELECT doc_id, source, tone, greatest(0, least(1, avg(weight))) * 100 AS score
        FROM words JOIN lexicon USING (term) GROUP BY 1, 2, 3)"""


@query(
    _LEXICON
    + """ SELECT source AS author, count(DISTINCT doc_id) AS n_scored,
        count(*) FILTER (WHERE tone = 'anger' AND score > 40) AS anger_over,
        count(*) FILTER (WHERE tone = 'joy' AND score > 40) AS joy_over
    FROM scores GROUP BY 1"""
)
def enriched_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts scored by a lexicon, unscored ones left out, flat columns, a report (UDF-5, FIL-11, PRJ-2)."""
    posts = views.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("author"), "text")
    lexicon = (
        views.table(spark, sf_dir, "benchmark")
        .select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\w+)"), F.lit(1))).alias("term")).distinct()
        .select(
            "term", F.when(F.ascii("term") % 2 == 0, "anger").otherwise("joy").alias("tone"),
            ((F.length("term") % 5) / 4.0).alias("weight"),
        )
    )
    scorer = enrich.lexicon_scorer(lexicon, "doc_id")
    scored = enrich.scored_only(enrich.enrich(posts.select("doc_id", "author", "text"), scorer, "doc_id"))
    flat = scored.select("author", *score_columns(F.transform_values("scores", lambda _, v: v * 100)))
    return flat.groupBy("author").agg(
        F.count("*").alias("n_scored"), F.count_if(F.col("Anger") > 40).alias("anger_over"),
        F.count_if(F.col("Joy") > 40).alias("joy_over"),
    )


@query(
    """SELECT name, n FROM (
        SELECT 'written' AS name, count(*) AS n FROM documents
        UNION ALL SELECT 'english', count(*) FROM documents WHERE lang = 'en'
        UNION ALL SELECT 'sources', count(DISTINCT source) FROM documents)"""
)
def written_and_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, register, ask by SQL, count (SNK-1, SNK-2, SNK-10)."""
    place = scratch_path(spark, "posts")
    sinks.write_parquet(views.table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), place)
    view = "written_" + place.rsplit("-", 1)[1]
    written = sinks.register(read_parquet(spark, place), view)
    return sinks.count_report(
        written=written, english=spark.sql(f"SELECT * FROM {view} WHERE lang = 'en'"),
        sources=spark.sql(f"SELECT DISTINCT source FROM {view}"),
    )


@query(
    with_views(
        """SELECT 'sentiment' AS report, coalesce("SENTIMENT", 'NONE') AS name, count(*) AS n FROM flags GROUP BY 2
        UNION ALL SELECT 'gender', coalesce("USER_GENDER", 'NONE'), count(*) FROM flags GROUP BY 2
        UNION ALL SELECT 'urgent', CAST("URGENT" AS VARCHAR), count(*) FROM flags GROUP BY 2""",
        "flags",
    )
)
def cached_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several reports of one flagged table that is kept hot while they run (MAT-1)."""
    place = scratch_path(spark, "reports")
    with cached(rq._flags(spark, sf_dir)) as flags:
        for report, column in (("sentiment", "SENTIMENT"), ("gender", "USER_GENDER"), ("urgent", "URGENT")):
            name = F.coalesce(F.col(column).cast("string"), F.lit("NONE")).alias("name")
            flags.groupBy(name).agg(F.count("*").alias("n")).select(F.lit(report).alias("report"), "name", "n").write.mode(
                "append").parquet(place)
    return read_parquet(spark, place)


@query(
    """SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(text, '\\s')) AS word FROM documents)
    WHERE NOT starts_with(word, 'http') AND NOT regexp_matches(word, '[^\\x00-\\x7F]') AND length(word) > 3
      AND word NOT IN (SELECT DISTINCT unnest(regexp_split_to_array(text, '\\s')) FROM benchmark)
    GROUP BY word"""
)
def words_not_in_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts with the words of a table left out (JOIN-8)."""
    words = tags.word_counts(views.table(spark, sf_dir, "documents").select("text"), stop_words=())
    stop = views.table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", r"\s")).alias("w")).distinct()
    return tags.without_words(words, stop)


@query(
    with_views(
        stream_queries._STATE_BY_SLICE
        + """ SELECT CAST(batch_id AS INTEGER) AS batch_id, 'topHashtags' AS channel,
               '[' || string_agg('["' || tag || '",' || "count" || ']', ',' ORDER BY rn) || ']' AS payload
        FROM ranks WHERE rn <= 5 GROUP BY batch_id""",
        "tag_tones",
    )
)
def topic_channel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running job's top tags as side-channel rows (SNK-7)."""
    out, _ = stream_queries._metrics_run(spark, sf_dir)
    messages = spark.read.parquet(out)
    sent = sinks.topic_channel(messages, keep=("batch_id",))
    return sent.where(F.col("channel") == sinks.CHANNEL_OF_TOPIC[tg.TOPIC_TAGS])
