"""What the plans must and must not hold, whatever the data size."""

import pytest
from pyspark.sql import functions as F

from chorale.operators import graph, mentions, rows, tags
from chorale.plans import views
from chorale.plans.catalog import QUERIES

# These run their jobs when called and return a plain scan of what was written.
EAGER = {"running_total", "stream_tag_state", "stored_tag_changes", "metric_messages", "captured_union",
         "captured_scores", "throttle_stream", "stored_documents", "written_and_counted", "cached_reports",
         "topic_channel_rows", "progress_rows", "batches_with_rows", "message_polarity_stream", "daily_sentiment_stream",
         "label_daily_stream", "published_posts"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Tables as large as on a cluster: nothing may count on a small side."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_pairwise_joins_or_row_udfs(spark, sf_dir, no_broadcast, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "BroadcastExchange"):
        assert node not in plan
    # No window without a partition key.
    for window in plan.split("Window [")[1:]:
        assert "[]" not in window.split("\n")[0]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    posts = views.table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    plan = _plan(posts.groupBy("o_orderpriority").count())
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan


def test_polarity_is_one_join_after_the_grouping(spark, sf_dir, no_broadcast):
    messages = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("MESSAGE_ID"))
    plan = _plan(mentions.message_polarity(messages, views.sentiments(spark, sf_dir)))
    # The messages, the records, and the means once more so that AQE can split a hot id.
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 3


def test_group_limit_is_taken_before_the_shuffle(spark, sf_dir):
    df = views.user_posts(spark, sf_dir)
    plan = _plan(rows.first_per_group(df, ["userid"], [F.desc("created_at")], 5))
    assert "Partial" in plan and plan.index("Final") < plan.index("Partial")


def test_word_count_combines_before_the_shuffle(spark, sf_dir):
    plan = _plan(tags.hashtag_counts(views.posts(spark, sf_dir)))
    assert plan.count("Exchange") == 1 and "partial_count" in plan


@pytest.fixture()
def small_skew(spark):
    """AQE takes partitions of some kilobytes for skewed."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _split(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "isSkew=true" in plan or "skewed" in plan


def test_hot_vertex_is_split(spark, no_broadcast, small_skew):
    vertices = spark.range(4000).select("id", F.create_map(F.lit("k"), F.col("id").cast("string")).alias("properties"))
    hub = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 4000).cast("bigint")
    edges = spark.range(0, 60_000, 1, 8).select(
        hub.alias("src"), (F.col("id") % 4000).alias("dst"),
        F.create_map(F.lit("id"), F.col("id").cast("string")).alias("properties"),
    )
    triples = graph.triplets(vertices, edges)
    assert len(triples.collect()) == 60_000 and _split(triples)


def test_hot_message_id_is_split(spark, no_broadcast, small_skew):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 4000).cast("bigint")
    messages = spark.range(0, 60_000, 1, 8).select(hot.alias("MESSAGE_ID"), F.col("id").alias("ROW"))
    sentiments = spark.range(0, 8000, 1, 4).select((F.col("id") % 4000).alias("MESSAGE_ID"), F.lit("POSITIVE").alias("SENTIMENT_POLARITY"))
    joined = mentions.message_polarity(messages, sentiments)
    assert len(joined.collect()) == 60_000 and _split(joined)


def test_windows_over_batches_hold_the_ones_that_count(spark):
    from chorale.operators import tagstate

    metrics = spark.createDataFrame([], "b int, tag string, count bigint, scores map<string,double>")
    assert "WindowGroupLimit" in _plan(tagstate.state_of_batches(metrics, "b"))
