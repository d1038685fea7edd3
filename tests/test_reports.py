import datetime as dt

from pyspark.sql import functions as F

from chorale.functions import messages as ms
from chorale.operators import mentions, reports, timelines
from chorale.session import cached


def test_polarity_means_and_labels(spark):
    messages = spark.createDataFrame([("m1",), ("m2",), ("m3",), ("m4",), ("m5",)], "MESSAGE_ID string")
    records = spark.createDataFrame(
        [("m1", "POSITIVE"), ("m1", "NEGATIVE"), ("m2", "POSITIVE"), ("m2", "AMBIVALENT"),
         ("m3", "NEUTRAL"), ("m4", None), ("m9", "POSITIVE")],
        "MESSAGE_ID string, SENTIMENT_POLARITY string",
    )
    got = {tuple(r) for r in mentions.message_polarity(messages, records).collect()}
    assert got == {
        ("m1", 0.0, "AMBIVALENT"), ("m2", 0.5, "POSITIVE"), ("m3", -1.0, "NEGATIVE"), ("m4", -1.0, "NEGATIVE"),
    }
    mild = mentions.message_polarity(messages, records, neutral_as=0).where("MESSAGE_ID = 'm3'").first()
    assert mild.SENTIMENT == "AMBIVALENT"


def test_polarity_keeps_repeated_messages_like_a_join_first_plan(spark):
    messages = spark.createDataFrame([("m", 1), ("m", 2)], "MESSAGE_ID string, n int")
    records = spark.createDataFrame(
        [("m", "POSITIVE"), ("m", "POSITIVE"), ("m", "NEGATIVE")], "MESSAGE_ID string, SENTIMENT_POLARITY string"
    )
    value = ms.polarity_value(F.col("SENTIMENT_POLARITY"))
    first = messages.join(records, "MESSAGE_ID").groupBy("MESSAGE_ID").agg(F.avg(value).alias("p"))
    expected = sorted(tuple(r) for r in messages.join(first, "MESSAGE_ID").select("n", "p").collect())
    ours = mentions.message_polarity(messages, records).select("n", "SENTIMENT_POLARITY").collect()
    assert sorted(tuple(r) for r in ours) == expected
    split = mentions.message_polarity(messages.repartition(4), records)
    assert sorted(tuple(r) for r in split.select("n", "SENTIMENT_POLARITY").collect()) == expected
    assert split.columns == ["MESSAGE_ID", "n", "SENTIMENT_POLARITY", "SENTIMENT"]


def test_clean_up(spark):
    df = spark.createDataFrame(
        [(i, dt.datetime(2015, 3, 4, 17, 20, 1), "b", "male", None, c, "Rome", "en", place, 1, 2, "POSITIVE")
         for i, c, place in [(1, None, "pos (42.5 -71.1)"), (2, "Italy", "pos (42.5)"), (3, "x", "xyz"), (4, "x", None),
                                 (5, "x", "pos (1.5f inf)")]],
        "MESSAGE_ID int, MESSAGE_POSTED_TIME timestamp, MESSAGE_BODY string, USER_GENDER string, USER_STATE string, "
        "USER_COUNTRY string, USER_CITY string, MESSAGE_LANGUAGE string, MESSAGE_LOCATION string, "
        "USER_FOLLOWERS_COUNT int, USER_FRIENDS_COUNT int, SENTIMENT string",
    )
    out = {r.MESSAGE_ID: r for r in mentions.clean_messages(df).collect()}
    assert out["1"].POSTING_TIME == dt.datetime(2015, 3, 4)
    assert (out["1"].USER_COUNTRY, out["2"].USER_COUNTRY, out["1"].USER_STATE) == ("NONE", "ITALY", "NONE")
    place = [(r.MESSAGE_LOCATION_LONGITUDE, r.MESSAGE_LOCATION_LATITUDE) for _, r in sorted(out.items())]
    assert place[0][0] == 42.5 and abs(place[0][1] + 71.1) < 1e-5
    assert place[1:] == [(42.5, None), (None, None), (None, None), (None, float("inf"))]
    assert len(mentions.clean_messages(df).columns) == 13


def _cleaned(spark, rows):
    return spark.createDataFrame(
        rows,
        "MESSAGE_ID string, MESSAGE_BODY string, SENTIMENT string, USER_GENDER string, USER_COUNTRY string, "
        "POSTING_TIME date, USER_FOLLOWERS_COUNT int, USER_FRIENDS_COUNT int",
    )


D1, D2, D3 = dt.date(2015, 1, 1), dt.date(2015, 1, 2), dt.date(2015, 1, 3)


def test_mention_flags(spark):
    df = _cleaned(
        spark,
        [("1", "Mercedes and VW", "POSITIVE", "male", "x", D1, 3, 4), ("2", "a segment", None, None, "x", D1, 1, None),
         ("3", "Hybrid Car", None, None, "x", D1, 0, 0), ("4", None, None, None, "x", D1, 0, 0)],
    )
    names = mentions.label_names(mentions.MAKERS)
    assert names == ["BMW", "DAIMLER", "GM", "TESLA", "TOYOTA", "VW"]
    out = {r.MESSAGE_ID: r for r in mentions.mention_flags(df).collect()}
    assert [n for n in names if out["1"][n]] == ["DAIMLER", "VW"]
    assert [n for n in names if out["2"][n]] == ["GM"]
    assert out["3"].ELECTRIC_CARS is True
    assert not any(out["4"][n] for n in names)
    assert (out["1"].INFLUENCE, out["2"].INFLUENCE) == (3.5, None)
    exact = mentions.mention_flags(df, exact_terms=True).where("MESSAGE_ID = '3'").first()
    assert exact.ELECTRIC_CARS is False


ROWS = [
    ("1", "bmw vw", "POSITIVE", "male", "US", D1, 2, 2),
    ("2", "bmw", "NEGATIVE", "female", "US", D1, 4, 4),
    ("3", "vw electric car", None, None, "DE", D3, 6, 6),
    ("4", "vw electric car", "NEUTRAL", "robot", "UK", D3, 8, 8),
    ("5", "other", "POSITIVE", "male", "UK", D2, 0, 0),
]
NAMES = ["BMW", "VW", "TESLA"]


def _flags(spark):
    return mentions.mention_flags(_cleaned(spark, ROWS))


def test_label_reports_keep_zeros_and_add_up(spark):
    with cached(_flags(spark)) as flags:
        totals = {r.LABEL: r.TOTAL for r in reports.label_totals(flags, NAMES).collect()}
        assert totals == {"BMW": 2, "VW": 3, "TESLA": 0}
        for r in reports.label_sentiment_split(flags, NAMES).collect():
            assert r.POSITIVE + r.NEGATIVE + r.OTHER == r.TOTAL == totals[r.LABEL]
        for r in reports.label_gender_split(flags, NAMES).collect():
            assert r.MALE + r.FEMALE + r.UNKNOWN == r.TOTAL
        influence = {r.LABEL: r.AVE_INFLUENCE for r in reports.label_influence(flags, NAMES).collect()}
        assert influence == {"BMW": 3.0, "VW": 16 / 3, "TESLA": None}
        matrix = {r.LABEL: (r.US, r.UK) for r in reports.label_country_matrix(flags, NAMES, ["US", "UK"]).collect()}
        assert matrix == {"BMW": (2, 0), "VW": (1, 1), "TESLA": (0, 0)}


def test_top_countries_per_label(spark):
    top = reports.label_top_countries(_flags(spark), NAMES, 2).collect()
    assert sorted(tuple(r) for r in top) == [("BMW", "US", 2), ("VW", "DE", 1), ("VW", "UK", 1)]


def test_percentages(spark):
    assert spark.range(1).select(ms.percentage(F.lit(0), F.lit(0))).first()[0] == 0
    report = {r.LABEL: r for r in reports.feature_report(_flags(spark), "ELECTRIC_CARS", NAMES).collect()}
    vw = report["VW"]
    assert (vw.TOTAL, vw.NEUTRAL, vw.NEUTRAL_PCT, vw.UNKNOWN_PCT) == (2, 1, 100.0, 100.0)
    assert report["TESLA"].UNKNOWN_PCT == 0.0 and report["BMW"].TOTAL == 0


def test_percentages_leave_missing_sentiment_out(spark):
    rows = (
        [("p", "vw electric car", "POSITIVE", "male", "US", D1, 0, 0)]
        + [("n", "vw electric car", "NEGATIVE", "female", "US", D1, 0, 0)]
        + [("u", "vw electric car", "NEUTRAL", None, "US", D1, 0, 0)] * 2
        + [("x", "vw electric car", None, None, "US", D1, 0, 0)] * 4
    )
    vw = reports.feature_report(mentions.mention_flags(_cleaned(spark, rows)), "ELECTRIC_CARS", ["VW"]).first()
    assert (vw.POSITIVE_PCT, vw.NEGATIVE_PCT, vw.NEUTRAL_PCT, vw.AMBIVALENT_PCT) == (25.0, 25.0, 50.0, 0.0)
    assert (vw.MALE_PCT, vw.FEMALE_PCT, vw.UNKNOWN_PCT) == (12.5, 12.5, 75.0)


def test_gap_fill(spark):
    spine = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "POSTING_TIME string")
    series = spark.createDataFrame([("d1", 5), ("d3", 2)], "POSTING_TIME string, NUM_TWEETS bigint")
    filled = timelines.fill_gaps(spine, series).orderBy("POSTING_TIME").collect()
    assert [tuple(r) for r in filled] == [("d1", 5), ("d2", 0), ("d3", 2)]


def test_daily_fill_equals_join_with_spine(spark):
    df = _cleaned(spark, ROWS)
    daily = timelines.daily_sentiment(df)
    totals = {r.POSTING_TIME: r.NUM_TWEETS for r in timelines.daily_totals(daily).collect()}
    filled = timelines.daily_filled(df)
    assert filled.count() == 3 * 5
    per_day = {r.POSTING_TIME: r.n for r in filled.groupBy("POSTING_TIME").agg(F.sum("NUM_TWEETS").alias("n")).collect()}
    assert per_day == totals
    spine = df.select("POSTING_TIME").distinct()
    for name, rows in (("POSITIVE", daily.where("SENTIMENT = 'POSITIVE'")), ("NONE", daily.where("SENTIMENT is null"))):
        joined = timelines.fill_gaps(spine, rows.drop("SENTIMENT")).collect()
        direct = filled.where(F.col("SENTIMENT") == name).drop("SENTIMENT").collect()
        assert sorted(map(tuple, joined)) == sorted(map(tuple, direct))


def test_rollup_tells_totals_from_missing_sentiment(spark):
    out = {(r.POSTING_TIME, r.SENTIMENT, r.IS_TOTAL): r.NUM_TWEETS for r in timelines.daily_rollup(_cleaned(spark, ROWS)).collect()}
    assert out[(D3, None, False)] == 1 and out[(D3, None, True)] == 2 and out[(D1, "POSITIVE", False)] == 1
    assert sum(n for (_, _, total), n in out.items() if total) == len(ROWS)


def test_label_timelines(spark):
    flags = _flags(spark)
    daily = sorted(tuple(r) for r in timelines.label_daily(flags, NAMES).collect())
    assert daily == [("BMW", D1, 2), ("VW", D1, 1), ("VW", D3, 2)]
    both = timelines.label_daily_sentiment(flags, NAMES)
    assert both.count() == 3 * 3 * 2
    assert both.where("LABEL = 'BMW' and COUNT > 0").count() == 2


def test_calendar_and_month_starts(spark):
    series = spark.createDataFrame([(D1, 1), (dt.date(2015, 2, 1), 2), (D3, 3)], "POSTING_TIME date, NUM_TWEETS bigint")
    assert timelines.calendar(series).count() == 32
    starts = timelines.month_starts(series).orderBy("POSTING_TIME").collect()
    assert [(r.LABEL, r.NUM_TWEETS) for r in starts] == [("2015-01-01", 1), ("2015-02-01", 2)]


def test_display_place(spark):
    df = spark.createDataFrame([("NONE",), ("US",)], "c string")
    assert [r[0] for r in df.select(ms.display_place(F.col("c"))).collect()] == ["UNKNOWN", "US"]
