"""Queries over events: decoding, streaming runs and their batch twins.

The streaming queries run real Structured Streaming jobs over all events, which
arrive in slices of days so that every slice is a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from chorale import sinks
from chorale.functions.messages import midnight
from chorale.operators import rows
from chorale.operators import tagstate as tg
from chorale.operators import throttle as th
from chorale.operators import tones
from chorale.plans import report_queries as rq
from chorale.plans import views
from chorale.plans.registry import query
from chorale.plans.views import with_views
from chorale.schemas import TONES
from chorale.session import scratch_path, settings
from chorale.sinks import channel
from chorale.sources import streams
from chorale.streaming import joins, windows
from chorale.streaming import pipelines as pl
from chorale.streaming import tags
from chorale.streaming.jobs import StreamJob, watched
from chorale.streaming.throttle import throttled

GAP_MS = 6 * 3_600_000


@query(
    """SELECT event_id,
        CASE WHEN event_id % 7 = 0 THEN '' ELSE 'user ' || user_id END AS "userName",
        CASE WHEN event_id % 7 = 0 OR event_id % 3 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS "userId",
        CASE WHEN event_id % 7 = 0 THEN '' ELSE 'en' END AS "userLang",
        '' AS "createdAt",
        CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS text,
        CASE WHEN event_id % 7 = 0 OR event_id % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE value END AS long,
        CASE WHEN event_id % 7 = 0 OR event_id % 4 = 0 OR event_id % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE value END AS lat
    FROM events"""
)
def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.decode_status(views.event_messages(spark, sf_dir))


# Means of each tag, tone and batch, spread over the tones a tag ever has.
_FOLD = """, per AS (SELECT {b} AS b, tag, tone, sum(score) AS s, count(*) AS n FROM tag_tones {w} GROUP BY 1, 2, 3),
batches AS (SELECT b, tag, sum(n) // count(*) AS cnt FROM per GROUP BY 1, 2),
grid AS (SELECT g.b, g.tag, t.tone, g.cnt,
                coalesce(round(CAST(p.s / p.n AS DECIMAL(30, 12)), 2)::DOUBLE, CAST(0 AS DOUBLE)) AS m
         FROM batches g JOIN (SELECT DISTINCT tag, tone FROM per) t ON g.tag = t.tag
         LEFT JOIN per p ON p.b = g.b AND p.tag = g.tag AND p.tone = t.tone)"""
_SCORE = "list_reduce(list_prepend(CAST(0 AS DOUBLE), list(m ORDER BY {b})), lambda s, x: (s + x) / 2)"

_STATE = _FOLD + """, state AS (
    SELECT tag, tone, CAST(sum(cnt) AS BIGINT) AS count, """ + _SCORE.format(b="b") + """ AS score
    FROM grid GROUP BY 1, 2)"""


def _state_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = views.event_posts(spark, sf_dir).withColumn("day", midnight(F.col("ts")))
    metrics = tg.batch_metrics(tg.tag_tone_rows(posts, keep=("day",)), keep=("day",))
    return tg.state_of_batches(metrics, "day")


@query(
    with_views(
        _STATE.format(b="day", w="") + ' SELECT tag, tone, "count", round(score, 9) AS score FROM state',
        "tag_tones",
    )
)
def tag_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_by_day(spark, sf_dir).withColumn("score", F.round("score", 9))


@query(
    with_views(
        _STATE.format(b="day", w="")
        + ' SELECT tag, max("count") AS "count" FROM state GROUP BY tag ORDER BY 2 DESC, tag LIMIT 5',
        "tag_tones",
    )
)
def tag_state_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _state_by_day(spark, sf_dir).groupBy("tag").agg(F.max("count").alias("count"))
    return tg.top_tags(state)


@query(
    with_views(
        ", per AS (SELECT day, tag, tone, sum(score) AS s, count(*) AS n FROM tag_tones GROUP BY 1, 2, 3) "
        "SELECT CAST(day AS TIMESTAMP) AS day, tag, CAST(sum(n) // count(*) AS BIGINT) AS \"count\", "
        "string_agg(tone || '=' || CAST(round(CAST(s / n AS DECIMAL(30, 12)), 2)::DOUBLE AS VARCHAR), ';' ORDER BY tone) AS scores "
        "FROM per GROUP BY 1, 2",
        "tag_tones",
    )
)
def tag_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = views.event_posts(spark, sf_dir).withColumn("day", midnight(F.col("ts")))
    metrics = tg.batch_metrics(tg.tag_tone_rows(posts, keep=("day",)), keep=("day",))
    entries = F.transform(
        F.array_sort(F.map_entries("scores")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return metrics.withColumn("scores", F.array_join(entries, ";"))


# Rows of one file of a slice, about; a slice has the same number of files as the others.
FILE_ROWS = 1_000_000


def write_slices(df: DataFrame, number: Column, path: str) -> int:
    """A table written slice by slice, for a job to read them in order; number of files of each slice.

    Slices are told by their number, nulls first, and written in that order one after the
    other. Slices with few rows are filled up with empty files, and a null number given to
    no row stands for no slice.
    """
    spark = df.sparkSession
    # The table may be joins of others, so it is told once and not again for every slice.
    cut, staged = df.withColumn("slice_number", number), scratch_path(spark, "staged")
    cut.write.partitionBy("slice_number").parquet(staged)
    whole = spark.read.schema(cut.schema).parquet(staged)
    # One row per slice.
    sizes = sorted(whole.groupBy(F.col("slice_number").alias("piece")).count().collect(), key=lambda r: (r.piece is not None, r.piece))
    files = max([1, *(-(-r["count"] // FILE_ROWS) for r in sizes)])
    for r in sizes:
        rows = whole.where(F.col("slice_number").eqNullSafe(r.piece)).drop("slice_number")
        if r["count"] >= 1000 * files > 1000:
            rows.repartition(files).write.mode("append").parquet(path)
            continue
        rows.coalesce(1).write.mode("append").parquet(path)
        for _ in range(files - 1):
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(path)
    return files


def replay_tables(
    spark: SparkSession,
    build: Callable[..., DataStreamWriter],
    *feeds: tuple[DataFrame, Column],
) -> StreamingQuery:
    """Feed tables, each with the number of a row's slice, to a job; the query when it has ended.

    All slices are there when the job starts; the source's rate limit makes each slice of a
    table a micro-batch of one query.
    """
    sources = []
    for rows_, number in feeds:
        path = scratch_path(spark, "slices")
        sources.append((path, rows_.schema, write_slices(rows_, number, path)))
    job = StreamJob(
        lambda: build(*[streams.read_files(spark, path, schema, files_per_batch=n) for path, schema, n in sources])
    )
    # State is cut into this many parts for as long as its checkpoint lives.
    cores = str(spark.sparkContext.defaultParallelism)
    with settings(spark, {"spark.sql.shuffle.partitions": cores}):
        return job.run_available().query


def replay(spark: SparkSession, sf_dir: str, build: Callable[[DataFrame], DataStreamWriter]) -> StreamingQuery:
    """Feed all events to a job, five days at a time."""
    events = views.table(spark, sf_dir, "events")
    return replay_tables(spark, build, (events, views.five_days(events)))


def _metrics_run(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Run the metrics job on the state store; folders of its messages and of the tags each batch changed."""
    changes, top, out, checkpoint = (scratch_path(spark, n) for n in ("changes", "top", "messages", "checkpoint"))
    replay(
        spark,
        sf_dir,
        lambda events: tags.stored_metrics(
            rows.admit(views.event_posts(spark, sf_dir, events)),
            top,
            checkpoint,
            pl.write_message_folder(out),
            pl.write_message_folder(changes),
        ),
    )
    return out, changes


_ADMITTED = "WHERE lang = 'en'"
_STATE_BY_SLICE = _FOLD.format(b="slice", w=_ADMITTED) + """,
state AS (
    SELECT n.b AS batch_id, tag, tone, CAST(sum(cnt) AS BIGINT) AS count, """ + _SCORE.format(b="grid.b") + """ AS score
    FROM (SELECT DISTINCT b FROM batches) n JOIN grid ON grid.b <= n.b GROUP BY 1, 2, 3),
ranks AS (
    SELECT batch_id, tag, "count", row_number() OVER (PARTITION BY batch_id ORDER BY "count" DESC, tag) AS rn
    FROM (SELECT DISTINCT batch_id, tag, "count" FROM state))"""


@query(
    with_views(
        """, slices AS (SELECT slice, count(*) AS n FROM event_posts WHERE lang = 'en' GROUP BY 1)
        SELECT CAST(slice AS INTEGER) AS batch_id,
               '[["total_tweets",' || CAST(sum(n) OVER (ORDER BY slice) AS BIGINT) || ']]' AS value FROM slices""",
        "event_posts",
    )
)
def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total of a streaming aggregation, whose state is in the state store, published by each batch."""
    out, checkpoint = (scratch_path(spark, n) for n in ("messages", "checkpoint"))
    publish = pl.write_message_folder(out)
    replay(
        spark,
        sf_dir,
        lambda events: pl.published_total(rows.admit(views.event_posts(spark, sf_dir, events)), checkpoint, publish),
    )
    return spark.read.parquet(out).select("batch_id", "value")


@query(
    with_views(
        _STATE_BY_SLICE
        + """ SELECT tag, tone, "count", score FROM state WHERE batch_id = (SELECT max(batch_id) FROM state)""",
        "tag_tones",
    )
)
def stream_tag_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after all batches: of each tag what the last batch that changed it left."""
    _, changes = _metrics_run(spark, sf_dir)
    latest = tg.tags_only(spark.read.parquet(changes)).groupBy("tag").agg(
        F.max_by(F.struct("count", "scores"), "batch_id").alias("s")
    )
    return latest.select("tag", "s.count", F.explode("s.scores").alias("tone", "score"))


@query(
    with_views(
        _STATE_BY_SLICE
        + """, top AS (SELECT * FROM ranks WHERE rn <= 5),
        lines AS (
            SELECT t.batch_id, t.rn, t.tag, string_agg(CAST(s.score AS VARCHAR), ',' ORDER BY s.tone) AS line,
                   string_agg('"' || s.tone || '"', ',' ORDER BY s.tone) AS head
            FROM top t JOIN state s ON t.batch_id = s.batch_id AND t.tag = s.tag GROUP BY 1, 2, 3)
        SELECT CAST(batch_id AS INTEGER) AS batch_id, 'topHashTags' AS topic, 'tweet' AS key,
               '[' || string_agg('["' || tag || '",' || "count" || ']', ',' ORDER BY rn) || ']' AS value
        FROM top GROUP BY batch_id
        UNION ALL
        SELECT CAST(batch_id AS INTEGER), 'topHashTags.toneScores', 'tweet',
               '[["x",' || max(head) FILTER (WHERE rn = 1) || '],'
               || string_agg('["' || tag || '",' || line || ']', ',' ORDER BY rn) || ']'
        FROM lines GROUP BY batch_id""",
        "tag_tones",
    )
)
def metric_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _metrics_run(spark, sf_dir)
    return (
        spark.read.parquet(out)
        .where(F.col("topic") != tg.TOPIC_TOTAL)
        .select("batch_id", "topic", "key", "value")
    )


@query(
    with_views(
        _STATE_BY_SLICE
        + """ SELECT CAST(batch_id AS INTEGER) AS batch_id, tag, tone, "count", score FROM state WHERE (batch_id, tag) IN (SELECT b, tag FROM batches)""",
        "tag_tones",
    )
)
def stored_tag_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tags each batch changed, from the job that keeps them in the state store."""
    _, changes = _metrics_run(spark, sf_dir)
    found = tg.tags_only(spark.read.parquet(changes))
    return found.select("batch_id", "tag", "count", F.explode("scores").alias("tone", "score"))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def captured_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "capture"), scratch_path(spark, "checkpoint")
    replay(spark, sf_dir, lambda events: pl.capture(events, out, checkpoint))
    return sinks.captured(spark, out, views.table(spark, sf_dir, "events").schema)


@query(
    """WITH seen AS (
        SELECT CASE WHEN event_id % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE value END AS anger, length(event_type) * 10 AS joy
        FROM events WHERE event_id % 7 <> 0)
    SELECT emotion, n FROM (
        SELECT 'Anger' AS emotion, count(*) FILTER (WHERE anger > 60) AS n FROM seen
        UNION ALL SELECT 'Joy', count(*) FILTER (WHERE joy > 60) FROM seen
        UNION ALL SELECT unnest(["""
    + ", ".join(f"'{t}'" for t in TONES if t not in ("Anger", "Joy"))
    + "]), 0)"
)
def captured_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages decoded, admitted, scored and captured, then reported on."""
    out, checkpoint = scratch_path(spark, "capture"), scratch_path(spark, "checkpoint")
    scores = F.create_map(
        F.lit("anger"), F.col("long"), F.lit("joy"), F.length("text") * F.lit(10.0)
    )

    def build(events: DataFrame) -> DataStreamWriter:
        messages = views.event_messages(spark, sf_dir, events)
        posts = pl.scored_posts(messages, scores)
        return pl.capture(pl.scored_table(posts), out, checkpoint)

    replay(spark, sf_dir, build)
    return tones.score_distribution(sinks.captured(spark, out))


_THROTTLED = f"""WITH RECURSIVE ev AS (
        SELECT user_id AS key, epoch_us(ts) // 1000 AS ms, min(event_id) AS message_id FROM events GROUP BY 1, 2),
    sent AS (
        SELECT key, min(ms) AS ms FROM ev GROUP BY key
        UNION ALL
        SELECT ev.key, min(ev.ms) FROM sent JOIN ev ON ev.key = sent.key AND ev.ms > sent.ms + {GAP_MS} GROUP BY ev.key)
    SELECT sent.key, sent.ms, ev.message_id FROM sent JOIN ev ON ev.key = sent.key AND ev.ms = sent.ms"""


@query(_THROTTLED)
def throttle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    return th.throttle(events, "user_id", "ts", "event_id", gap_ms=GAP_MS)


@query(_THROTTLED)
def throttle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages forwarded by the streaming job, slice by slice."""
    out, checkpoint = scratch_path(spark, "sent"), scratch_path(spark, "checkpoint")

    def build(events: DataFrame) -> DataStreamWriter:
        return pl.capture(throttled(events, "user_id", "ts", "event_id", gap_ms=GAP_MS), out, checkpoint)

    replay(spark, sf_dir, build)
    return spark.read.schema("key bigint, ms bigint, message_id bigint").parquet(out)


_SLICES = """WITH sliced AS (
        SELECT *, date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) // 5 AS five FROM events),
    numbered AS (SELECT *, dense_rank() OVER (ORDER BY five) - 1 AS slice FROM sliced)"""


@query(
    _SLICES
    + """ SELECT slice AS batch_id, count(*) AS rows, count(*) FILTER (WHERE event_type = 'error') AS errors,
        count(*) FILTER (WHERE value > 50) AS large, count(props) AS with_props FROM numbered GROUP BY 1"""
)
def progress_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch of a capture counted while it ran, from the progress log (STR-8)."""
    out, checkpoint, place = (scratch_path(spark, n) for n in ("capture", "checkpoint", "progress"))

    def build(events: DataFrame) -> DataStreamWriter:
        counted = events.observe(
            "seen", F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("value") > 50).alias("large"),
            F.count("props").alias("with_props"),
        )
        return pl.capture(counted, out, checkpoint)

    with watched(spark, place) as log:
        ended = replay(spark, sf_dir, build)
        if not log.wait_stopped(ended):
            raise RuntimeError("the end of the query was not reported")
        batches = log.frame(spark).where("event = 'batch' and rows > 0")
    seen = [F.element_at("observed", f"seen.{c}").alias(c) for c in ("errors", "large", "with_props")]
    return batches.where(F.col("query") == str(ended.id)).select("batch_id", "rows", *seen)


@query(
    _SLICES
    + """ SELECT CAST(slice AS INTEGER) AS batch_id, count(*) AS n, max(event_id) AS last_event
        FROM numbered WHERE slice % 2 = 0 GROUP BY 1"""
)
def batches_with_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches handed to a writer when every other slice has no admitted row: empty ones are skipped (FIL-14)."""
    out, checkpoint = scratch_path(spark, "written"), scratch_path(spark, "checkpoint")
    whole = views.table(spark, sf_dir, "events")
    # The numbers of the slices there are, one row each.
    numbers = sorted(r[0] for r in whole.select(views.five_days(whole)).distinct().collect() if r[0] is not None)
    chosen = [n for i, n in enumerate(numbers) if i % 2 == 0]

    def build(events: DataFrame) -> DataStreamWriter:
        first = whole.agg(F.min(F.to_date("ts"))).first()[0]
        five = F.floor(F.date_diff(F.to_date("ts"), F.lit(first)) / 5)
        return pl.write_batches(events.where(five.isin(chosen)), checkpoint, pl.write_message_folder(out))

    replay(spark, sf_dir, build)
    return spark.read.parquet(out).groupBy("batch_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"))


@query(
    with_views(
        """SELECT 'tweets' AS channel, event_id, 'a "b"' AS author, CAST(user_id AS VARCHAR) AS userid, true AS no_picture, text,
                  anger, CASE WHEN k % 5 <> 0 THEN k END AS joy FROM event_posts""",
        "event_posts",
    )
)
def post_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every envelope read back field by field; the event is told by its text form."""
    posts = views.event_posts(spark, sf_dir).select(
        F.lit("a \"b\"").alias("author"), F.col("user_id").cast("string").alias("userid"),
        F.concat_ws("|", F.col("event_id").cast("string"), "text").alias("text"), "scores",
    )
    fields = F.from_json("payload", "author string, userid string, pic string, text string, sentiment map<string,double>")
    read = sinks.post_channel(posts).select("channel", "payload", fields.alias("f"))
    return read.select(
        "channel", F.substring_index("f.text", "|", 1).cast("bigint").alias("event_id"), "f.author", "f.userid",
        (F.col("f.pic").isNull() & F.col("payload").contains('"pic":null')).alias("no_picture"),
        F.expr("substring(f.text, instr(f.text, '|') + 1)").alias("text"),
        F.try_element_at("f.sentiment", F.lit("anger")).alias("anger"),
        F.try_element_at("f.sentiment", F.lit("joy")).alias("joy"),
    )


@query(
    with_views('SELECT "MESSAGE_ID", "SENTIMENT_POLARITY", "SENTIMENT", "MESSAGE_BODY" FROM polarity', "polarity")
)
def message_polarity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and their sentiment records joined as both arrive, some records late (JOIN-1)."""
    out, checkpoint = scratch_path(spark, "pairs"), scratch_path(spark, "checkpoint")
    posted = F.col("MESSAGE_POSTED_TIME").cast("timestamp").alias("POSTED")
    messages = views.messages(spark, sf_dir).select("MESSAGE_ID", "MESSAGE_BODY", posted)
    records = views.timed_sentiments(spark, sf_dir)
    build = lambda m, r: pl.capture(
        joins.polarity_pairs(m, r, "POSTED", "SCORED", within="7 days", late="40 days"), out, checkpoint)
    replay_tables(spark, build, (messages, F.year("POSTED")), (records, F.year("ARRIVED")))
    pairs = spark.read.schema("MESSAGE_ID bigint, MESSAGE_BODY string, POSTED timestamp, POLARITY int").parquet(out)
    return joins.mean_polarity(pairs, "MESSAGE_ID", "MESSAGE_BODY")


def _closed(messages: DataFrame, posted: str = "POSTING_TIME") -> tuple[DataFrame, Column]:
    """Messages with an event time, a last one long after the others to close their days, and the slice of each by year."""
    timed = messages.withColumn(posted, F.col(posted).cast("timestamp"))
    last = timed.agg((F.max(posted) + F.expr("INTERVAL 400 DAYS")).alias(posted))
    return timed.unionByName(last, allowMissingColumns=True), F.year(posted)


@query(
    with_views(
        'SELECT "POSTING_TIME", "SENTIMENT", count("MESSAGE_BODY") AS "NUM_TWEETS" FROM cleaned GROUP BY 1, 2', "cleaned"
    )
)
def daily_sentiment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series given out by a stream as its days close (AGG-14)."""
    out, checkpoint = scratch_path(spark, "daily"), scratch_path(spark, "checkpoint")
    cleaned = rq._cleaned(spark, sf_dir).select("POSTING_TIME", "SENTIMENT", "MESSAGE_BODY")
    replay_tables(spark, lambda m: pl.capture(windows.daily_sentiment(m), out, checkpoint), _closed(cleaned))
    days = spark.read.schema("POSTING_TIME timestamp, SENTIMENT string, NUM_TWEETS bigint").parquet(out)
    return days.withColumn("POSTING_TIME", F.col("POSTING_TIME").cast("timestamp_ntz"))


@query(with_views('SELECT "LABEL", "POSTING_TIME", count(*) AS "COUNT" FROM labelled GROUP BY 1, 2', "labelled"))
def label_daily_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series per label given out by a stream as its days close (AGG-16)."""
    out, checkpoint = scratch_path(spark, "daily"), scratch_path(spark, "checkpoint")
    flags = rq._flags(spark, sf_dir).select("POSTING_TIME", *rq.LABELS)
    feed, number = _closed(flags)
    # The closing message has a label, or it would not reach the watermark.
    feed = feed.fillna(True, [rq.LABELS[0]])
    replay_tables(spark, lambda m: pl.capture(windows.label_daily(m, rq.LABELS), out, checkpoint), (feed, number))
    days = spark.read.schema("POSTING_TIME timestamp, LABEL string, COUNT bigint").parquet(out)
    return days.withColumn("POSTING_TIME", F.col("POSTING_TIME").cast("timestamp_ntz"))


@query(
    with_views(
        """SELECT CAST(slice AS BIGINT) AS batch_id, 'tweets' AS channel, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
        FROM event_posts WHERE lang = 'en' GROUP BY 1""",
        "event_posts",
    )
)
def published_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admitted posts as channel rows, published once per batch by a sink with a commit (SNK-7, SNK-8)."""
    out, checkpoint = scratch_path(spark, "channel"), scratch_path(spark, "checkpoint")

    def build(events: DataFrame) -> DataStreamWriter:
        posts = rows.admit(views.event_posts(spark, sf_dir, events)).select(
            F.col("event_id").cast("string").alias("author"), F.col("user_id").cast("string").alias("userid"), "text", "scores"
        )
        return channel.publish(sinks.post_channel(posts), out, checkpoint)

    replay(spark, sf_dir, build)
    batches = spark.createDataFrame(
        [(b.batch_id, f"{name}") for b in channel.published_batches(spark, out) for name in b.files], "batch_id bigint, file string"
    )
    sent = channel.published(spark, out, "channel string, payload string").withColumn(
        "file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    author = F.get_json_object("payload", "$.author").cast("bigint")
    return sent.join(batches, "file").groupBy("batch_id", "channel").agg(
        F.count("*").alias("n"), F.sum(author).alias("ids"))
