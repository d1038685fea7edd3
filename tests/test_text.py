from pyspark.sql import functions as F

from chorale.functions import text as tx
from chorale.operators import rows, tags


def _kept(spark, keywords, ignore_case):
    posts = spark.createDataFrame(
        [
            ("en", "I like Spark"),
            ("en-gb", "spark rocks"),
            ("fr", "Spark"),
            (None, "Spark"),
            ("en", "Spark café"),
            ("en", "Spark\u0085"),
            ("en", None),
        ],
        "lang string, text string",
    )
    return [r.text for r in rows.admit(posts, keywords, ignore_case).collect()]


def test_admission_modes(spark):
    assert _kept(spark, ["Spark"], False) == ["I like Spark"]
    assert _kept(spark, ["Spark"], True) == ["I like Spark", "spark rocks"]
    assert _kept(spark, [""], False) == ["I like Spark", "spark rocks"]
    assert _kept(spark, [], False) == ["I like Spark", "spark rocks"]


def test_hashtags_ranking_and_stream_forms(spark):
    posts = spark.createDataFrame([("#a #a, # #A #a\nx#no\t#t",)], "text string")
    counts = {r.tag: r.n for r in tags.hashtag_counts(posts).collect()}
    assert counts == {"#a": 2, "#a,": 1, "#": 1, "#A": 1, "#t": 1}
    streamed = posts.select(tx.hashtags(F.col("text"), bare=False).alias("t")).first().t
    assert streamed == ["#a", "#a,", "#A", "#a", "#t"]


def test_top_hashtags_breaks_ties_by_name(spark):
    posts = spark.createDataFrame([("#b #a #c #c",)], "text string")
    assert [tuple(r) for r in tags.top_hashtags(posts, 2).collect()] == [("#c", 2), ("#a", 1)]


def test_word_admission(spark):
    posts = spark.createDataFrame(
        [("http://x.y/z Volkswagen wagon wagon This this café over tiny é abc",)], "text string"
    )
    found = {r.word: r.n for r in tags.word_counts(posts).collect()}
    assert found == {"wagon": 2, "This": 1, "tiny": 1}


def test_stop_words_from_a_table(spark):
    words = spark.createDataFrame([("wagon",), ("over",)], "word string")
    stop = spark.createDataFrame([("over",)], "w string")
    assert [r.word for r in tags.without_words(words, stop).collect()] == ["wagon"]


def test_tag_tone_breakdown_merges_stripped_tags(spark):
    top = spark.createDataFrame([("#ab", 3), ("#a-b", 1)], "tag string, n bigint")
    posts = spark.createDataFrame(
        [("#abc", 10.0), ("#a-b", 30.0), ("none", 90.0)], "text string, Joy double"
    )
    means = tags.tag_tone_breakdown(posts, top, ["Joy"]).collect()
    assert [tuple(r) for r in means] == [("#ab", "Joy", 20.0)]
    arrays = tags.tag_tone_arrays(posts, top, ["Joy"]).collect()
    assert [tuple(r) for r in arrays] == [("#ab", ["Joy"], [20.0], 3)]


def test_unranked_label_goes_last(spark):
    top = spark.createDataFrame([("#a-b", 9), ("#c", 1)], "tag string, n bigint")
    posts = spark.createDataFrame([("#a-b #c", 10.0)], "text string, Joy double")
    arrays = tags.tag_tone_arrays(posts, top, ["Joy"]).collect()
    assert [(r.tag, r.n) for r in arrays] == [("#c", 1), ("#ab", 0)]


def test_breakdown_plans_no_cartesian_join(spark):
    posts = spark.createDataFrame([("#a", 1.0)], "text string, Joy double")
    plan = tags.tag_tone_breakdown(posts, tags.top_hashtags(posts), ["Joy"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_ascii_copy_and_word_count(spark):
    row = spark.range(1).select(
        tx.ascii_only(F.lit("café 你ok")).alias("a"), tx.word_count(F.lit("one two_3 -- x")).alias("n")
    ).first()
    assert tuple(row) == ("caf ok", 3)


def test_columns_first_and_half_open_span(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rows.columns_first(df, ["c"]).columns == ["c", "a", "b"]
    days = spark.sql(
        "select timestamp_ntz'2015-09-14' t union all select timestamp_ntz'2015-09-15' "
        "union all select timestamp_ntz'2015-10-14' union all select timestamp_ntz'2015-10-15'"
    )
    kept = rows.within(days, "t", "2015-09-15 00:00:00", "2015-10-15 00:00:00").collect()
    assert sorted(str(r.t.date()) for r in kept) == ["2015-09-15", "2015-10-14"]


def test_first_per_group_with_a_hot_group(spark):
    hot = spark.range(0, 20_000, 1, 16).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    cold = spark.range(50).select(F.concat(F.lit("k"), F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    out = rows.first_per_group(hot.unionByName(cold), ["k"], [F.desc("v")], 7, strands=4)
    got = {}
    for r in out.collect():
        got.setdefault(r.k, []).append(r.v)
    assert sorted(got["hot"], reverse=True) == list(range(19_999, 19_992, -1))
    assert all(len(v) == 7 for v in got.values()) and len(got) == 6


def test_share_sums_to_hundred(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n bigint")
    shares = {r.k: r.share for r in rows.with_share(counts, "n").collect()}
    assert shares == {"a": 25.0, "b": 75.0}


def test_category_and_missing_rows(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.k for r in rows.matching(df, "k", "a").collect()] == ["a"]
    assert [r.k for r in rows.matching(df, "k", None).collect()] == [None]


def test_wordy(spark):
    df = spark.createDataFrame([("a b c",), ("a b",)], "text string")
    assert [r.text for r in rows.wordy(df, more_than=2).collect()] == ["a b c"]
