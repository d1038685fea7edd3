import json
import random
import time

import pytest
from pyspark.sql import functions as F

from chorale import sinks
from chorale.functions import render as rd
from chorale.functions import text as tx
from chorale.operators import enrich
from chorale.operators import rows as rw
from chorale.operators import tagstate as tg
from chorale.plans import views
from chorale.session import cached, scratch_root
from chorale.sources import streams, tables
from chorale.sinks import channel
from chorale.streaming import joins, tags, windows
from chorale.streaming import pipelines as pl
from chorale.streaming.jobs import ProgressLog, StreamJob, watched
from chorale.streaming.state import Snapshot
from chorale.streaming.throttle import throttled

POSTS = "id bigint, lang string, text string, scores map<string,double>"


def _write(spark, path, rows, schema=POSTS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def _source(spark, path, ddl=POSTS):
    return streams.read_files(spark, path, _schema(spark, ddl), files_per_batch=1)


def test_batch_metrics(spark):
    rows = spark.createDataFrame(
        [("#x", "anger", 10.0), ("#x", "anger", 20.0), ("#x", "joy", 30.0)], "tag string, tone string, score double"
    )
    out = tg.batch_metrics(rows).first()
    assert (out.tag, out["count"], out.scores) == ("#x", 1, {"anger": 15.0, "joy": 30.0})


def test_tag_tone_rows(spark):
    posts = spark.createDataFrame(
        [(1, "en", "#a # b", {"joy": 1.0, "anger": 2.0}), (2, "en", "#c", {}), (3, "en", "#d", None)], POSTS
    )
    assert sorted(tuple(r) for r in tg.tag_tone_rows(posts).collect()) == [("#a", "anger", 2.0), ("#a", "joy", 1.0)]
    counted = tg.counted_rows(posts)
    assert counted.where(F.col("tag") == tg.TOTAL).count() == 3
    assert sorted(tuple(r) for r in counted.where(F.col("tag") != tg.TOTAL).collect()) == [
        ("#a", "anger", 2.0), ("#a", "joy", 1.0)]


def _metrics(spark, rows):
    return spark.createDataFrame(rows, pl.TAG_STATE)


def test_state_folding(spark):
    first = tg.fold_state(None, _metrics(spark, [("#x", 1, {"anger": 10.0}), ("#y", 1, {"joy": 8.0})]))
    second = tg.fold_state(first, _metrics(spark, [("#x", 2, {"anger": 20.0})]))
    got = {r.tag: (r["count"], r.scores) for r in second.collect()}
    assert got == {"#x": (3, {"anger": 12.5}), "#y": (1, {"joy": 4.0})}
    third = tg.fold_state(second, _metrics(spark, [("#x", 1, {"joy": 2.0})])).where("tag = '#x'").first()
    assert third.scores == {"anger": 6.25, "joy": 1.0}
    mean = tg.fold_state(_metrics(spark, [("#x", 1, {"a": 10.0})]), _metrics(spark, [("#x", 3, {"a": 2.0})]), True)
    assert mean.first().scores == {"a": 4.0}


def test_closed_form_equals_fold(spark):
    batches = [
        [("#x", 1, {"a": 10.0, "b": 4.0}), ("#y", 2, {"a": 1.0})],
        [("#x", 1, {"a": 6.0})],
        [("#y", 5, {"b": 3.0}), ("#x", 1, {"b": 7.0, "a": 2.0})],
    ]
    state = None
    for b in batches:
        state = tg.fold_state(state, _metrics(spark, b))
    folded = {(r.tag, r.tone): (r["count"], r.score) for r in state.select("tag", "count", F.explode("scores").alias("tone", "score")).collect()}
    every = spark.createDataFrame(
        [(i, *row) for i, b in enumerate(batches) for row in b], "b int, " + pl.TAG_STATE
    )
    closed = {(r.tag, r.tone): (r["count"], r.score) for r in tg.state_of_batches(every, "b").collect()}
    assert closed == folded


def test_message_texts(spark):
    state = _metrics(spark, [("#a", 3, {"anger": 1.5, "joy": 2.0}), ("#b", 2, {"anger": 0.0, "joy": 4.0})])
    got = {r.topic: (r.key, r.value) for r in tg.metric_messages(state).collect()}
    assert got == {
        "topHashTags": ("tweet", '[["#a",3],["#b",2]]'),
        "topHashTags.toneScores": ("tweet", '[["x","anger","joy"],["#a",1.5,2.0],["#b",0.0,4.0]]'),
    }
    assert tg.metric_messages(state.where("count > 9")).count() == 0
    quoted = spark.createDataFrame([('#"b', 2)], "tag string, count bigint")
    text = quoted.agg(rd.pairs_json(F.collect_list(F.struct("tag", "count")))).first()[0]
    assert text == '[["#b",2]]'
    assert tg.total_message(quoted.where("count > 9")).first().value == "[]"


def test_metrics_stream_equals_batch_replay(spark, tmp_path):
    src, state, out = (str(tmp_path / n) for n in ("src", "state", "out"))
    batches = [
        [(1, "en", "#x one", {"anger": 10.0}), (2, "fr", "#x", {"anger": 99.0}), (3, "en", "no tag", {"joy": 1.0})],
        [(4, "en", "#x #x", {"anger": 20.0}), (5, "en", "#y # z", {"joy": 6.0})],
        [(6, "en", "#y", {"joy": 2.0})],
    ]
    for b in batches:
        _write(spark, src, b)
        time.sleep(0.05)
    log = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        build = lambda: pl.running_metrics(
            _source(spark, src), state, str(tmp_path / "cp"), pl.write_message_folder(out)
        )
        job = StreamJob(build).run_available()
        last = job.query.lastProgress["batchId"]
        folded = None
        for b in batches:
            posts = rw.admit(spark.createDataFrame(b, POSTS))
            folded = tg.fold_state(folded, tg.batch_metrics(tg.tag_tone_rows(posts)))
        expected = {r.tag: (r["count"], r.scores) for r in folded.collect()}
        snapshot = Snapshot(state, pl.TAG_STATE)
        got = {r.tag: (r["count"], r.scores) for r in tg.tags_only(snapshot.after(spark, last)).collect()}
        assert last == 2 and got == expected
        totals = spark.read.parquet(out).where("topic = 'total_tweets'").orderBy("batch_id").collect()
        assert [r.value for r in totals] == [f'[["total_tweets",{n}]]' for n in (2, 4, 5)]
        # A restart goes on from the checkpoint and the state it finds.
        _write(spark, src, [(7, "en", "#x", {"anger": 8.0})])
        again = StreamJob(build).run_available()
        assert again.query.lastProgress["batchId"] == 3
        x = snapshot.after(spark, 3).where("tag = '#x'").first()
        assert (x["count"], x.scores) == (expected["#x"][0] + 1, {"anger": (expected["#x"][1]["anger"] + 8.0) / 2})
        deadline = time.time() + 20
        while time.time() < deadline and log.frame(spark).where("event = 'stopped'").count() < 2:
            time.sleep(0.1)
        events = [r.event for r in log.frame(spark).collect()]
        assert events.count("started") == 2 and events.count("batch") >= 4 and events.count("stopped") == 2
    finally:
        spark.streams.removeListener(log)


def test_snapshot_retry_is_idempotent(spark, tmp_path):
    snap = Snapshot(str(tmp_path / "s"), "n bigint")

    def step(amount):
        def add(before):
            base = spark.createDataFrame([(amount,)], "n bigint")
            return (base if before is None else base.unionByName(before)).agg(F.sum("n").alias("n"))

        return add

    for batch, amount in ((0, 1), (1, 10), (1, 10), (2, 100), (2, 100)):
        out = snap.fold(spark, batch, step(amount))
    assert out.first().n == 111


def test_complete_mode_total(spark, tmp_path):
    src = str(tmp_path / "src")
    _write(spark, src, [(1, "en", "a", None), (2, "en", "b", None)])
    stream = pl.running_total(_source(spark, src))
    job = StreamJob(lambda: stream.writeStream.outputMode("complete").format("memory").queryName("totals")).run_available()
    assert [tuple(r) for r in spark.table("totals").collect()] == [("total_tweets", 2)]
    assert not job.running


def test_job_start_stop(spark, tmp_path):
    src = str(tmp_path / "src")
    _write(spark, src, [(1, "en", "a", None)])
    job = StreamJob(lambda: _source(spark, src).writeStream.format("noop"), clock="1 second")
    assert job.stop() is False
    job.start()
    with pytest.raises(RuntimeError):
        job.start()
    assert job.running and job.stop() and not job.running
    job.start(stop_after=1)
    assert not job.running


def test_capture_and_captured(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = _schema(spark, POSTS)
    assert sinks.captured(spark, out, schema) is None
    _write(spark, src, [(1, "en", "a", None)])
    _write(spark, src, [(2, "fr", "b", None)])
    StreamJob(lambda: pl.capture(_source(spark, src), out, str(tmp_path / "cp"), by=["lang"])).run_available()
    table = sinks.captured(spark, out, schema, view="posts_so_far")
    assert sorted(r.id for r in table.collect()) == [1, 2]
    assert spark.sql("select count(*) from posts_so_far").first()[0] == 2


def test_documents_stream(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "docs")
    ddl = ("author string, userid string, date string, lang string, text string, lat double, long double, "
           "sentiment struct<tone_categories: array<struct<category_id: string>>>")
    _write(spark, src, [("a", "u", "d", "en", "t", 1.0, 2.0, None)], ddl)
    StreamJob(
        lambda: pl.write_batches(
            _source(spark, src, ddl), str(tmp_path / "cp"),
            lambda b, i: sinks.write_documents(b, f"{out}/batch_id={i}", mode="overwrite"),
        )
    ).run_available()
    doc = json.loads(spark.read.text(out).first().value)
    assert doc == {"author": "a", "date": "d", "language": "en", "text": "t", "geo": {"lat": 1.0, "long": 2.0}}


def _throttled(spark, tmp_path, name, late="0 seconds", gap=200):
    (tmp_path / name).mkdir()
    stream = _source(spark, str(tmp_path / name), "k string, id bigint, ms bigint").withColumn("ts", F.timestamp_millis("ms"))
    out = str(tmp_path / f"{name}-out")
    rows = throttled(stream, "k", "ts", "id", gap, late)
    return out, lambda: pl.capture(rows, out, str(tmp_path / f"{name}-cp"))


def _sent(spark, out):
    return sorted(tuple(r) for r in spark.read.schema("key string, ms bigint, message_id bigint").parquet(out).collect())


def test_throttled_stream(spark, tmp_path):
    ddl, times = "k string, id bigint, ms bigint", [1000, 1100, 1200, 1201, 1350, 1402]
    out, build = _throttled(spark, tmp_path, "gap")
    for i in (0, 3):
        _write(spark, str(tmp_path / "gap"), [("k", j, times[j]) for j in range(i, i + 3)], ddl)
        time.sleep(0.05)
    StreamJob(build).run_available()
    assert [ms for _, ms, _ in _sent(spark, out)] == [1000, 1201, 1402]
    # A restart goes on from the state.
    _write(spark, str(tmp_path / "gap"), [("k", 9, 1500), ("k", 10, 1603)], ddl)
    StreamJob(build).run_available()
    assert [ms for _, ms, _ in _sent(spark, out)] == [1000, 1201, 1402, 1603]


def test_throttle_state_is_dropped_after_the_gap(spark, tmp_path):
    ddl = "k string, id bigint, ms bigint"
    draw, last, expected = random.Random(5), {}, []
    out, build = _throttled(spark, tmp_path, "keys")
    for batch in range(6):
        # Keys of their own in every batch, beside one of all.
        rows = [(f"{batch}-{draw.randrange(40)}", batch * 1000 + i, batch * 10_000 + draw.randrange(9_000)) for i in range(100)]
        rows += [("all", batch * 1000 + 500 + i, batch * 10_000 + draw.randrange(9_000)) for i in range(100)]
        for k, i, ms in sorted(rows, key=lambda r: (r[2], r[1])):
            if k not in last or ms > last[k] + 200:
                last[k] = ms
                expected.append((k, ms, i))
        _write(spark, str(tmp_path / "keys"), rows, ddl)
        time.sleep(0.05)
    query = StreamJob(build).run_available().query
    assert _sent(spark, out) == sorted(expected)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) < 100 and held[-1] <= 10 and len(last) > 200


def test_late_and_incomplete_messages_are_counted(spark, tmp_path):
    ddl = "k string, id bigint, ms bigint"
    out, build = _throttled(spark, tmp_path, "late", late="1 second")
    batches = [
        [("k", 1, 10_000), (None, 2, 10_000), (None, 3, None), ("k", 4, None)],
        [("k", 5, 9_500), ("k", 6, 11_000), ("x", 7, 9_900)],
        [("k", 8, 20_000), ("new", 9, 5_000), ("x", 10, 19_500)],
    ]
    for b in batches:
        _write(spark, str(tmp_path / "late"), b, ddl)
        time.sleep(0.05)
    with watched(spark, str(tmp_path / "log")) as log:
        query = StreamJob(build).run_available().query
        assert log.wait_stopped(query)
        rows = log.frame(spark).where("event = 'batch' and rows > 0").orderBy("batch_id").collect()
    assert [r.observed for r in rows] == [
        {"left_out.null_keys": 2, "left_out.null_times": 1}, {"left_out.null_keys": 0, "left_out.null_times": 0},
        {"left_out.null_keys": 0, "left_out.null_times": 0}]
    assert [r.late for r in rows] == [0, 0, 1]  # "new", behind the watermark
    assert _sent(spark, out) == [("k", 10_000, 1), ("k", 11_000, 6), ("k", 20_000, 8), ("x", 9_900, 7), ("x", 19_500, 10)]


def test_decode_defaults(spark):
    values = [
        ('{"user":{"name":"n","userid":"u","lang":"en"},"created_at":"c","text":"t","geo":{"long":1.5,"lat":2.5}}',),
        ('{"user":{"name":null},"text":null}',),
        ("no json",),
        (None,),
    ]
    status = streams.decode_status(spark.createDataFrame(values, "value string"))
    empty = ("", "", "", "", "", 0.0, 0.0)
    assert [tuple(r) for r in status.collect()] == [("n", "u", "en", "c", "t", 1.5, 2.5), empty, empty, empty]
    flat = streams.flat_posts(status).first()
    assert (flat.author, flat.lat, flat.long) == ("n", 2.5, 1.5)


def test_envelope_and_channels(spark):
    posts = spark.createDataFrame([('a"b', "u", "t\n\"q\"", {"joy": 1.0})], "author string, userid string, text string, scores map<string,double>")
    row = sinks.post_channel(posts).first()
    assert row.channel == "tweets"
    assert json.loads(row.payload) == {"author": 'a"b', "userid": "u", "pic": None, "text": 't\n"q"', "sentiment": {"joy": 1.0}}
    topics = spark.createDataFrame([(t, "tweet", "[]") for t in (tg.TOPIC_TAGS, tg.TOPIC_SCORES, tg.TOPIC_TOTAL)], "topic string, key string, value string")
    assert [r.channel for r in sinks.topic_channel(topics).collect()] == ["topHashtags", "toneScores", "TweetProcessed"]


def test_sinks_and_options(spark, tmp_path):
    path = str(tmp_path / "one")
    sinks.write_parquet(spark.range(100, numPartitions=4), path, single_file=True)
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1
    assert tables.read_parquet(spark, path).count() == 100
    assert sinks.register(spark.range(3), "three").sparkSession.table("three").count() == 3
    counts = sinks.count_report(a=spark.range(3), b=spark.range(5))
    assert {r.name: r.n for r in counts.collect()} == {"a": 3, "b": 5}
    assert tables.literal_rows(spark, [("x",)], "name string").first().name == "x"
    options = tables.jdbc_options("jdbc:x", "T", {"user": "u"}, "id", 0, 10, 4)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "T", {}, "id")
    assert streams.topic_options("h:1", ["a", "b"])["subscribe"] == "a,b"
    assert streams.topic_options("h:1", ["a"])["startingOffsets"] == "latest"


def test_scratch_follows_the_cluster_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    with cached(spark.range(5)) as hot:
        assert hot.is_cached
    assert not hot.is_cached


def test_event_posts_view(spark, sf_dir):
    posts = views.event_posts(spark, sf_dir)
    assert posts.where(F.size("scores") > 2).count() == 0
    assert posts.where(F.size("scores") == 1).count() > 0


def test_stored_state_equals_folded_state(spark, tmp_path):
    src, top, out, log = (str(tmp_path / n) for n in ("src", "top", "out", "changes"))
    batches = [
        [(1, "en", "#x one", {"anger": 10.0, "joy": 2.0}), (2, "en", "no tag", None)],
        [(3, "en", "#x #x", {"anger": 20.0}), (4, "en", "#y # z", {"joy": 6.0}), (5, "en", "#y", {"joy": 1.01})],
        [(6, "en", "#y", {"joy": 2.0}), (7, "en", "#z", {"joy": 2.0})],
    ]
    for b in batches:
        _write(spark, src, b)
        time.sleep(0.05)
    job = StreamJob(
        lambda: tags.stored_metrics(
            _source(spark, src), top, str(tmp_path / "cp"), pl.write_message_folder(out), pl.write_message_folder(log), n=2
        )
    ).run_available()
    assert job.query.lastProgress["batchId"] == 2
    state, messages, changed = None, [], {}
    for i, b in enumerate(batches):
        metrics = tg.batch_metrics(tg.counted_rows(spark.createDataFrame(b, POSTS)))
        state = tg.fold_state(state, metrics)
        seen = [r.tag for r in metrics.collect()]
        rows = state.collect()
        changed |= {(i, r.tag): (r["count"], r.scores) for r in rows if r.tag in seen}
        messages += [(i, r.topic, r.value) for r in tg.metric_messages(tg.tags_only(state), 2).collect()]
        messages += [(i, r.topic, r.value) for r in tg.total_message(tg.total_only(state)).collect()]
    got = {(r.batch_id, r.tag): (r["count"], r.scores) for r in spark.read.parquet(log).collect()}
    assert got == changed
    read = [(r.batch_id, r.topic, r.value) for r in spark.read.parquet(out).collect()]
    assert sorted(read) == sorted(messages)


def test_partial_sums_are_those_of_the_pairs(spark):
    draw = random.Random(3)
    posts = [
        (i, "en", " ".join(f"#{draw.choice('abc')}" for _ in range(draw.randrange(4))),
         draw.choice([None, {}, {"joy": 1.5}, {"joy": 2.0, "anger": float(i)}]))
        for i in range(500)
    ] + [(501, "en", None, {"joy": 1.0})]
    df = spark.createDataFrame(posts, POSTS).repartition(3)
    known = F.coalesce(F.map_entries("scores"), F.array().cast("array<struct<key:string,value:double>>"))
    found = df.select(F.coalesce(tx.hashtags(F.col("text"), bare=False), F.array().cast("array<string>")).alias("tags"), known.alias("scores"))
    sums = found.mapInArrow(tags.partial_sums, tags.PARTIAL).groupBy("tag", "tone").agg(F.sum("total"), F.sum("n"))
    pairs = tg.counted_rows(df).groupBy("tag", "tone").agg(F.sum("score"), F.count("*"))
    assert sorted(map(tuple, sums.collect())) == sorted(map(tuple, pairs.collect()))


def test_messages_to_metrics_and_to_table(spark, tmp_path):
    """The whole way of a topic message, with a Python scorer that can fail."""
    src, out, table = (str(tmp_path / n) for n in ("src", "out", "table"))

    def message(lang, text):
        return (json.dumps({"user": {"name": "n", "userid": "u", "lang": lang}, "text": text}),)

    _write(spark, src, [message("en", "#a joyful"), message("fr", "#a joyful"), ("broken",)], "value string")
    time.sleep(0.05)
    _write(spark, src, [message("en", "#a grim #b"), message("en", "#b FAIL")], "value string")

    def score(text):
        if "FAIL" in text:
            raise ValueError(text)
        return {"joy": 80.0} if "joyful" in text else {"joy": 10.0, "anger": 70.0}

    def posts():
        return pl.scored_posts(_source(spark, src, "value string"), enrich.score_column(score, F.col("text"))["scores"])

    StreamJob(
        lambda: pl.running_metrics(posts(), str(tmp_path / "state"), str(tmp_path / "cp1"), pl.write_message_folder(out))
    ).run_available()
    got = {(r.batch_id, r.topic): r.value for r in spark.read.parquet(out).collect()}
    assert got[(0, "total_tweets")] == '[["total_tweets",1]]' and got[(1, "total_tweets")] == '[["total_tweets",3]]'
    assert got[(1, "topHashTags")] == '[["#a",2],["#b",1]]'
    assert got[(1, "topHashTags.toneScores")] == '[["x","anger","joy"],["#a",35.0,25.0],["#b",35.0,5.0]]'

    StreamJob(lambda: pl.capture(pl.scored_table(posts()), table, str(tmp_path / "cp2"))).run_available()
    captured = sinks.captured(spark, table)
    assert len(captured.columns) == 20
    assert sorted((r.text, r.Joy, r.Anger) for r in captured.collect()) == [
        ("#a grim #b", 10.0, 70.0), ("#a joyful", 80.0, 0.0), ("#b FAIL", 0.0, 0.0)]


def _events_dir(spark, tmp_path, sf_dir, months):
    """The tables of a test set with the events told again in later months."""
    import os

    out = tmp_path / "tables"
    out.mkdir()
    for name in os.listdir(sf_dir):
        if not name.startswith("events"):
            os.symlink(f"{sf_dir}/{name}", out / name)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    whole = events
    for m in range(1, months):
        later = events.withColumn("ts", F.expr(f"ts + make_interval(0, {m})")).withColumn(
            "event_id", F.col("event_id") + m * 10**6)
        whole = whole.unionByName(later)
    whole.write.parquet(str(out / "events.parquet"))
    return str(out)


def test_replay_over_two_months_forwards_what_the_batch_does(spark, tmp_path, sf_dir):
    from chorale.plans.catalog import QUERIES

    place = _events_dir(spark, tmp_path, sf_dir, 2)
    batch, stream = (sorted(map(tuple, QUERIES[n](spark, place).collect())) for n in ("throttle_events", "throttle_stream"))
    assert batch == stream and len(batch) > 0


def test_a_second_call_sees_new_rows(spark, tmp_path, sf_dir):
    from chorale.plans.catalog import QUERIES

    place = _events_dir(spark, tmp_path, sf_dir, 1)
    before = QUERIES["running_total"](spark, place).count()
    more = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.expr("ts + make_interval(0, 1)"))
    more.write.mode("append").parquet(f"{place}/events.parquet")
    assert QUERIES["running_total"](spark, place).count() > before


def test_timed_stop_waits_for_the_running_batch(spark, tmp_path):
    done = []

    def slow(batch, batch_id):
        time.sleep(3)
        done.append(batch_id)

    job = StreamJob(
        lambda: spark.readStream.format("rate").load().writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(slow),
        clock="0 seconds",
    )
    job.start(stop_after=1.0)
    assert done and not job.running


def test_empty_batches_are_not_written_and_plans_run_once(spark, tmp_path):
    src, runs = str(tmp_path / "src"), spark.sparkContext.accumulator(0)
    for b in ([(1, "en", "a", None)], [], [(2, "en", "b", None), (3, "en", "c", None)]):
        _write(spark, src, b)
        time.sleep(0.05)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    written = []
    stream = _source(spark, src).mapInArrow(count, POSTS)
    StreamJob(lambda: pl.write_batches(stream, str(tmp_path / "cp"), lambda b, i: written.append((i, b.count())))).run_available()
    assert written == [(0, 1), (2, 2)] and runs.value == 3


MESSAGE = "MESSAGE_ID bigint, MESSAGE_BODY string, POSTED timestamp"
RECORD = "MESSAGE_ID bigint, SENTIMENT_POLARITY string, SCORED timestamp"


def test_streams_joined_with_late_rows_and_bounded_state(spark, tmp_path):
    day = lambda d, h=0: f"2024-01-01 00:00:00|{d}|{h}"

    def frame(rows, ddl, at):
        kinds = ddl.replace(f"{at} timestamp", f"{at} string")
        part = lambda i: F.split(at, r"\|")[i]
        stamp = part(0).cast("timestamp") + F.make_dt_interval(part(1).cast("int"), part(2).cast("int"))
        return spark.createDataFrame(rows, kinds).withColumn(at, F.when(F.col(at).isNotNull(), stamp))

    messages = [
        [(1, "a", day(0)), (2, "b", day(0, 5)), (None, "no key", day(0)), (9, "no time", None)], [(3, "c", day(40))], [(4, "d", day(80))],
        [(5, "e", day(120))], [(6, "f", day(160))], [(7, "g", day(200))]]
    records = [
        [(1, "POSITIVE", day(1)), (1, "NEGATIVE", day(6)), (2, "POSITIVE", day(8)), (None, "POSITIVE", day(0))],
        [(3, "POSITIVE", day(41)), (2, "AMBIVALENT", day(2))],  # 38 days late, within the bound
        [(3, None, day(42))], [(5, "NEUTRAL", day(121))], [(6, "POSITIVE", day(161))],
        [(1, "POSITIVE", day(3)), (7, "POSITIVE", day(201))]]  # the first is too late
    for name, batches, ddl, at in (("m", messages, MESSAGE, "POSTED"), ("r", records, RECORD, "SCORED")):
        for b in batches:
            frame(b, ddl, at).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
            time.sleep(0.05)
    out = str(tmp_path / "out")
    job = StreamJob(lambda: pl.capture(
        joins.polarity_pairs(_source(spark, str(tmp_path / "m"), MESSAGE), _source(spark, str(tmp_path / "r"), RECORD),
                             "POSTED", "SCORED", late="40 days"), out, str(tmp_path / "cp"))).run_available()
    pairs = spark.read.schema(MESSAGE + ", POLARITY int").parquet(out)
    got = {r.MESSAGE_ID: (r.SENTIMENT_POLARITY, r.SENTIMENT) for r in joins.mean_polarity(pairs, "MESSAGE_ID").collect()}
    assert got == {1: (0.0, "AMBIVALENT"), 2: (0.0, "AMBIVALENT"), 3: (0.0, "AMBIVALENT"), 5: (-1.0, "NEGATIVE"),
                   6: (1.0, "POSITIVE"), 7: (1.0, "POSITIVE")}
    progress = [p for p in job.query.recentProgress if p["stateOperators"]]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] < 8
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 1


def test_daily_windows_close_and_drop_late_rows(spark, tmp_path):
    ddl = "POSTING_TIME timestamp, SENTIMENT string, MESSAGE_BODY string, A boolean, B boolean"

    def rows(*days):
        shaped = spark.createDataFrame([(d, s, b, True, s is None) for d, s, b in days], ddl.replace("timestamp", "string"))
        return shaped.withColumn("POSTING_TIME", F.col("POSTING_TIME").cast("timestamp"))

    src = str(tmp_path / "src")
    for b in (
        rows(("2024-01-01 03:00:00", "POSITIVE", "x"), ("2024-01-01 05:00:00", "POSITIVE", None), (None, "POSITIVE", "x")),
        rows(("2024-01-03 03:00:00", None, "x"), ("2024-01-01 23:00:00", "POSITIVE", "late, in time")),
        rows(("2024-01-09 03:00:00", None, "x")),
        rows(("2024-01-09 04:00:00", None, "x")),
        rows(("2024-01-02 03:00:00", None, "too late"), ("2024-02-09 03:00:00", None, "x")),
    ):
        b.coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    out, labels = str(tmp_path / "out"), str(tmp_path / "labels")
    job = StreamJob(lambda: pl.capture(windows.daily_sentiment(_source(spark, src, ddl)), out, str(tmp_path / "cp"))).run_available()
    got = sorted((str(r[0])[:10], r[1], r[2]) for r in spark.read.parquet(out).collect())
    assert got == [("2024-01-01", "POSITIVE", 2), ("2024-01-03", None, 1), ("2024-01-09", None, 2)]
    dropped = [s["numRowsDroppedByWatermark"] for p in job.query.recentProgress for s in p["stateOperators"]]
    assert sum(dropped) == 1
    StreamJob(lambda: pl.capture(
        windows.label_daily(_source(spark, src, ddl), ["A", "B"]), labels, str(tmp_path / "cp2"))).run_available()
    got = sorted((str(r.POSTING_TIME)[:10], r.LABEL, r.COUNT) for r in spark.read.parquet(labels).collect())
    assert got == [("2024-01-01", "A", 3), ("2024-01-03", "A", 1), ("2024-01-03", "B", 1), ("2024-01-09", "A", 2), ("2024-01-09", "B", 2)]


def test_a_batch_that_is_run_again_is_published_once(spark, tmp_path):
    src, out, marker = (str(tmp_path / n) for n in ("src", "out", "killed"))
    for b in ([(1, "en", "a", None), (2, "en", "b", None)], [(3, "en", "c", None), (4, "en", "KILL", None)]):
        _write(spark, src, b)
        time.sleep(0.05)

    def rows():
        import os

        def fail_once(batches):
            import pyarrow.compute as pc

            for batch in batches:
                if not os.path.exists(marker) and pc.any(pc.equal(batch.column("payload"), "KILL")).as_py():
                    raise RuntimeError("killed")
                yield batch

        named = _source(spark, src).select(F.lit("tweets").alias("channel"), F.col("text").alias("payload"))
        return named.mapInArrow(fail_once, "channel string, payload string")

    build = lambda: channel.publish(rows(), out, str(tmp_path / "cp"))
    with pytest.raises(Exception, match="killed"):
        StreamJob(build).run_available()
    assert [b.rows for b in channel.published_batches(spark, out)] == [2]
    open(marker, "w").close()
    StreamJob(build).run_available()
    assert [(b.batch_id, b.rows) for b in channel.published_batches(spark, out)] == [(0, 2), (1, 2)]
    got = channel.published(spark, out, "channel string, payload string")
    assert sorted(r.payload for r in got.collect()) == ["KILL", "a", "b", "c"]


def test_commit_of_a_published_batch_changes_nothing(tmp_path):
    import pyarrow as pa

    writer = channel.ChannelWriter(str(tmp_path / "c"))
    batch = pa.RecordBatch.from_pydict({"channel": ["t"], "payload": ["p"]})
    first, second = writer.write(iter([batch])), writer.write(iter([batch]))
    writer.commit([first, writer.write(iter([]))], 7)
    writer.commit([second], 7)
    assert [(b.batch_id, b.files, b.rows) for b in channel.published_batches(None, str(tmp_path / "c"))] == [(7, [first.name], 1)]
    writer.abort([second, None], 8)
    assert len(list((tmp_path / "c" / "data").iterdir())) == 1
    assert channel.published_batches(None, str(tmp_path / "none")) == []


def test_a_batch_costs_what_it_changes(spark, tmp_path):
    """State rows touched per batch stay the same while the tags seen grow."""
    src = str(tmp_path / "src")
    for b in range(5):
        _write(spark, src, [(b * 20 + i, "en", f"#t{b}x{i} #all", {"joy": 1.0}) for i in range(20)])
        time.sleep(0.05)
    query = StreamJob(lambda: tags.stored_metrics(
        _source(spark, src), str(tmp_path / "top"), str(tmp_path / "cp"), pl.write_message_folder(str(tmp_path / "out")))
    ).run_available().query
    state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"] and p["numInputRows"]]
    assert [s["numRowsUpdated"] for s in state] == [22] * 5  # twenty tags, the common one and the total
    assert [s["numRowsTotal"] for s in state] == [2 + 20 * (k + 1) for k in range(5)]
    total = StreamJob(lambda: pl.published_total(
        _source(spark, src), str(tmp_path / "cp2"), pl.write_message_folder(str(tmp_path / "total")))).run_available().query
    state = [p["stateOperators"][0] for p in total.recentProgress if p["stateOperators"] and p["numInputRows"]]
    assert [s["numRowsTotal"] for s in state] == [1] * 5
    told = spark.read.parquet(str(tmp_path / "total")).orderBy("batch_id").collect()
    assert [r.value for r in told] == [f'[["total_tweets",{20 * (k + 1)}]]' for k in range(5)]


def test_slices_of_a_joined_table_are_told_once(spark, tmp_path):
    from chorale.plans.stream_queries import write_slices

    told = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            told.add(batch.num_rows)
            yield batch

    rows = [(i, None if i % 5 == 4 else i % 5) for i in range(100)]
    frame = spark.createDataFrame(rows, "id int, piece int").mapInArrow(count, "id int, piece int")
    path = str(tmp_path / "slices")
    assert write_slices(frame, F.col("piece"), path) == 1 and told.value == 100
    found = spark.read.schema("id int, piece int").parquet(path).withColumn("at", F.col("_metadata.file_modification_time"))
    assert sorted((r.id, r.piece) for r in found.collect()) == sorted(rows)
    order = [r.piece for r in found.groupBy("piece").agg(F.min("at").alias("at")).orderBy("at").collect()]
    assert order == [None, 0, 1, 2, 3]


def test_throttle_calls_python_for_buckets_and_not_for_keys(spark, tmp_path):
    ddl = "k string, id bigint, ms bigint"
    (tmp_path / "many").mkdir()
    draw, last, expected = random.Random(6), {}, []
    for batch in range(3):
        rows = [(f"k{draw.randrange(500)}", batch * 10_000 + i, 1000 + batch * 1000 + draw.randrange(1000)) for i in range(2000)]
        for k, i, ms in sorted(rows, key=lambda r: (r[2], r[1])):
            if k not in last or ms > last[k] + 200:
                last[k] = ms
                expected.append((k, ms, i))
        _write(spark, str(tmp_path / "many"), rows, ddl)
        time.sleep(0.05)
    stream = _source(spark, str(tmp_path / "many"), ddl).withColumn("ts", F.timestamp_millis("ms"))
    out = str(tmp_path / "many-out")
    query = StreamJob(lambda: pl.capture(throttled(stream, "k", "ts", "id", 200), out, str(tmp_path / "many-cp"))).run_available().query
    assert _sent(spark, out) == sorted(expected)
    # 500 keys in each batch; with a bucket for each there would be that many states.
    buckets = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(buckets) <= 450
