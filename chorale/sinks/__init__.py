"""Writers and message rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorale.schemas import SCORED_POST


def write_parquet(df: DataFrame, path: str, single_file: bool = False, mode: str = "error") -> None:
    """Parquet sink (SNK-1). One file only on request: it writes from one task."""
    (df.coalesce(1) if single_file else df).write.mode(mode).parquet(path)


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def count_report(**frames: DataFrame) -> DataFrame:
    """Row counts of several frames as one (name, n) frame (SNK-10)."""
    parts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in frames.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def documents(posts: DataFrame, sentiment: str = "sentiment") -> DataFrame:
    """Posts as nested documents for a document store (SNK-5)."""
    return posts.select(
        "author",
        "date",
        F.col("lang").alias("language"),
        "text",
        F.struct("lat", "long").alias("geo"),
        F.col(sentiment).alias("sentiment"),
    )


def write_documents(posts: DataFrame, path: str, sentiment: str = "sentiment", mode: str = "append") -> None:
    documents(posts, sentiment).write.mode(mode).json(path)


def envelope(picture: Column | None = None, scores: str = "scores") -> Column:
    """A post as a JSON text with its score map (SNK-8)."""
    pic = F.lit(None).cast("string") if picture is None else picture
    return F.to_json(
        F.struct("author", "userid", pic.alias("pic"), "text", F.col(scores).alias("sentiment")),
        {"ignoreNullFields": "false"},
    )


# Channel names of the side-channel rows.
CHANNEL_POSTS = "tweets"
CHANNEL_OF_TOPIC = {
    "topHashTags": "topHashtags",
    "topHashTags.toneScores": "toneScores",
    "total_tweets": "TweetProcessed",
}


def post_channel(posts: DataFrame, scores: str = "scores") -> DataFrame:
    return posts.select(
        F.lit(CHANNEL_POSTS).alias("channel"), envelope(scores=scores).alias("payload")
    )


def topic_channel(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Topic messages as (channel, payload) rows, after the columns to keep (SNK-7)."""
    names = F.create_map(*[F.lit(x) for pair in CHANNEL_OF_TOPIC.items() for x in pair])
    return messages.select(
        *keep, F.element_at(names, F.col("topic")).alias("channel"), F.col("value").alias("payload")
    )


def publish_topics(messages: DataFrame, servers: str) -> None:
    """Send (topic, key, value) rows to Kafka; needs the connector (SNK-6)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def captured(
    spark: SparkSession, path: str, schema: T.StructType = SCORED_POST, view: str | None = None
) -> DataFrame | None:
    """The table a capture has written so far, or None while it is empty (SNK-4)."""
    try:
        table = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if table.isEmpty():
        return None
    return register(table, view) if view else table
