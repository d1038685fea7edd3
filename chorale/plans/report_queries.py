"""Queries over messages: polarity, clean-up, flags, breakdowns, timelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.functions import messages as ms
from chorale.functions import text as tx
from chorale.operators import mentions, reports, rows, tags, timelines
from chorale.plans import views
from chorale.plans.registry import query
from chorale.plans.views import with_views

GROUPS = [["urgent"], ["high"], ["medium"], ["low", "specified"], ["build"], ["furn", "house"]]
FEATURES = {"MOVING": ["machinery", "Auto"], "OPEN_ENDED": ["not spec"]}
LABELS = mentions.label_names(GROUPS)


def _polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.message_polarity(
        views.messages(spark, sf_dir), views.sentiments(spark, sf_dir)
    )


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.clean_messages(_polarity(spark, sf_dir))


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.mention_flags(_cleaned(spark, sf_dir), GROUPS, FEATURES)


@query(with_views('SELECT "MESSAGE_ID", "SENTIMENT_POLARITY", "SENTIMENT", "MESSAGE_BODY" FROM polarity', "polarity"))
def message_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _polarity(spark, sf_dir).select(
        "MESSAGE_ID", "SENTIMENT_POLARITY", "SENTIMENT", "MESSAGE_BODY"
    )


@query(with_views("SELECT * FROM cleaned", "cleaned"))
def clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir)


@query(with_views("SELECT * FROM flags", "flags"))
def mention_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir)


@query(
    with_views(
        """, counts AS (SELECT "USER_COUNTRY", count("MESSAGE_BODY") AS "NUM_TWEETS" FROM cleaned GROUP BY 1)
        SELECT CASE WHEN "USER_COUNTRY" = 'NONE' THEN 'UNKNOWN' ELSE "USER_COUNTRY" END AS "USER_COUNTRY", "NUM_TWEETS",
        "NUM_TWEETS" * CAST(100 AS DOUBLE) / CAST((SELECT sum("NUM_TWEETS") FROM counts) AS DOUBLE) AS share FROM counts""",
        "cleaned",
    )
)
def country_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = reports.country_counts(_cleaned(spark, sf_dir))
    return rows.with_share(counts, "NUM_TWEETS").withColumn(
        "USER_COUNTRY", ms.display_place(F.col("USER_COUNTRY"))
    )


@query(
    with_views(
        """, counts AS (SELECT "SENTIMENT", count("MESSAGE_ID") AS "NUM_TWEETS" FROM cleaned GROUP BY 1)
        SELECT *, "NUM_TWEETS" * CAST(100 AS DOUBLE) / CAST((SELECT sum("NUM_TWEETS") FROM counts) AS DOUBLE) AS share
        FROM counts""",
        "cleaned",
    )
)
def sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.with_share(reports.sentiment_counts(_cleaned(spark, sf_dir)), "NUM_TWEETS")


@query(
    with_views(
        """, counts AS (SELECT "SENTIMENT", count("MESSAGE_ID") AS "NUM_TWEETS" FROM cleaned
                        WHERE "SENTIMENT" IN ('POSITIVE', 'NEGATIVE') GROUP BY 1)
        SELECT *, "NUM_TWEETS" * CAST(100 AS DOUBLE) / CAST((SELECT sum("NUM_TWEETS") FROM counts) AS DOUBLE) AS share
        FROM counts""",
        "cleaned",
    )
)
def sentiment_share_defined(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _cleaned(spark, sf_dir).where(F.col("SENTIMENT").isin("POSITIVE", "NEGATIVE"))
    return rows.with_share(reports.sentiment_counts(known), "NUM_TWEETS")


@query(with_views('SELECT "USER_GENDER", count("MESSAGE_BODY") AS "NUM_TWEETS" FROM cleaned GROUP BY 1', "cleaned"))
def gender_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.gender_counts(_cleaned(spark, sf_dir))


@query(
    with_views(
        'SELECT "POSTING_TIME", "SENTIMENT", count("MESSAGE_BODY") AS "NUM_TWEETS" FROM cleaned GROUP BY 1, 2',
        "cleaned",
    )
)
def daily_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timelines.daily_sentiment(_cleaned(spark, sf_dir))


_DAILY = 'SELECT "POSTING_TIME", count("MESSAGE_BODY") AS "NUM_TWEETS" FROM cleaned GROUP BY 1'


@query(with_views(_DAILY, "cleaned"))
def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timelines.daily_totals(timelines.daily_sentiment(_cleaned(spark, sf_dir)))


@query(
    with_views(
        f"""SELECT "POSTING_TIME", "SENTIMENT", count("MESSAGE_BODY") AS "NUM_TWEETS", FALSE AS "IS_TOTAL"
            FROM cleaned GROUP BY 1, 2
            UNION ALL SELECT "POSTING_TIME", NULL, "NUM_TWEETS", TRUE FROM ({_DAILY})""",
        "cleaned",
    )
)
def daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timelines.daily_rollup(_cleaned(spark, sf_dir))


@query(
    with_views(
        """, named AS (SELECT "POSTING_TIME", coalesce("SENTIMENT", 'NONE') AS "SENTIMENT", "MESSAGE_BODY" FROM cleaned),
        spine AS (SELECT DISTINCT "POSTING_TIME" FROM cleaned),
        kinds AS (SELECT unnest(['POSITIVE', 'NEGATIVE', 'NEUTRAL', 'AMBIVALENT', 'NONE']) AS "SENTIMENT"),
        series AS (SELECT "POSTING_TIME", "SENTIMENT", count("MESSAGE_BODY") AS n FROM named GROUP BY 1, 2)
        SELECT "POSTING_TIME", "SENTIMENT", coalesce(n, 0) AS "NUM_TWEETS"
        FROM (SELECT * FROM spine, kinds) LEFT JOIN series USING ("POSTING_TIME", "SENTIMENT")""",
        "cleaned",
    )
)
def daily_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timelines.daily_filled(_cleaned(spark, sf_dir))


@query(
    with_views(
        f"""SELECT *, strftime("POSTING_TIME", '%Y-%m-%d') AS "LABEL" FROM ({_DAILY}) WHERE day("POSTING_TIME") = 1""",
        "cleaned",
    )
)
def month_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timelines.month_starts(daily_totals(spark, sf_dir))


@query(
    with_views(
        """, positive AS (SELECT "POSTING_TIME", count(*) AS n FROM cleaned WHERE "SENTIMENT" = 'POSITIVE' GROUP BY 1),
        spine AS (SELECT CAST(unnest(generate_series(min("POSTING_TIME"), max("POSTING_TIME"), INTERVAL 1 DAY)) AS TIMESTAMP)
                  AS "POSTING_TIME" FROM cleaned)
        SELECT "POSTING_TIME", coalesce(n, 0) AS "NUM_TWEETS" FROM spine LEFT JOIN positive USING ("POSTING_TIME")""",
        "cleaned",
    )
)
def calendar_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timelines.calendar_filled(_cleaned(spark, sf_dir), F.col("SENTIMENT") == "POSITIVE")


@query(with_views('SELECT "LABEL", "POSTING_TIME", count(*) AS "COUNT" FROM labelled GROUP BY 1, 2', "labelled"))
def label_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timelines.label_daily(_flags(spark, sf_dir), LABELS)


_LABEL_ROWS = "labels_all AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in LABELS) + ']) AS "LABEL")'


@query(
    with_views(
        f""", {_LABEL_ROWS}, spine AS (SELECT DISTINCT "POSTING_TIME" FROM flags),
        kinds AS (SELECT unnest(['POSITIVE', 'NEGATIVE']) AS "SENTIMENT"),
        series AS (SELECT "LABEL", "POSTING_TIME", "SENTIMENT", count(*) AS n FROM labelled GROUP BY 1, 2, 3)
        SELECT "LABEL", "POSTING_TIME", "SENTIMENT", coalesce(n, 0) AS "COUNT"
        FROM (SELECT * FROM spine, kinds, labels_all) LEFT JOIN series USING ("LABEL", "POSTING_TIME", "SENTIMENT")""",
        "labelled",
    )
)
def label_daily_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timelines.label_daily_sentiment(_flags(spark, sf_dir), LABELS)


def _labels_sql(*columns: str) -> str:
    """Label rows in all, with counts over the labelled messages, 0 where none."""
    return with_views(
        f', {_LABEL_ROWS} SELECT a."LABEL", {", ".join(columns)} '
        'FROM labels_all a LEFT JOIN labelled l ON a."LABEL" = l."LABEL" GROUP BY 1',
        "labelled",
    )


def _n(name: str, condition: str | None = None) -> str:
    return f'count(l."LABEL"){f" FILTER (WHERE {condition})" if condition else ""} AS "{name}"'


_POS, _NEG = "l.\"SENTIMENT\" = 'POSITIVE'", "l.\"SENTIMENT\" = 'NEGATIVE'"
_MALE, _FEMALE = "l.\"USER_GENDER\" = 'male'", "l.\"USER_GENDER\" = 'female'"


@query(_labels_sql(_n("TOTAL")))
def label_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_totals(_flags(spark, sf_dir), LABELS)


@query(
    _labels_sql(
        _n("TOTAL"),
        _n("POSITIVE", _POS),
        _n("NEGATIVE", _NEG),
        _n("OTHER", f"NOT coalesce({_POS} OR {_NEG}, FALSE)"),
    )
)
def label_sentiment_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_sentiment_split(_flags(spark, sf_dir), LABELS)


@query(
    _labels_sql(
        _n("TOTAL"),
        _n("MALE", _MALE),
        _n("FEMALE", _FEMALE),
        _n("UNKNOWN", f"NOT coalesce({_MALE} OR {_FEMALE}, FALSE)"),
    )
)
def label_gender_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_gender_split(_flags(spark, sf_dir), LABELS)


@query(_labels_sql('avg(l."INFLUENCE") AS "AVE_INFLUENCE"'))
def label_influence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_influence(_flags(spark, sf_dir), LABELS)


@query(
    with_views(
        """SELECT "LABEL", "USER_COUNTRY", "COUNT" FROM (
            SELECT *, row_number() OVER (PARTITION BY "LABEL" ORDER BY "COUNT" DESC, "USER_COUNTRY") AS rn
            FROM (SELECT "LABEL", "USER_COUNTRY", count(*) AS "COUNT" FROM labelled GROUP BY 1, 2))
        WHERE rn <= 5""",
        "labelled",
    )
)
def label_top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_top_countries(_flags(spark, sf_dir), LABELS)


COUNTRIES = ["NATION_1", "NATION_7", "NATION_13"]


@query(_labels_sql(*[_n(c, f"l.\"USER_COUNTRY\" = '{c}'") for c in COUNTRIES]))
def label_country_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_country_matrix(_flags(spark, sf_dir), LABELS, COUNTRIES)


def _feature_sql(feature: str) -> str:
    kinds = reports.SENTIMENTS
    known = " + ".join(f'"{s}"' for s in kinds)
    shares = [(f"{s}_PCT", f'"{s}"', known) for s in kinds] + [
        ("MALE_PCT", '"MALE"', '"TOTAL"'),
        ("FEMALE_PCT", '"FEMALE"', '"TOTAL"'),
        ("UNKNOWN_PCT", '("TOTAL" - "MALE" - "FEMALE")', '"TOTAL"'),
    ]
    columns = [_n("TOTAL"), _n("MALE", _MALE), _n("FEMALE", _FEMALE)] + [
        _n(s, f"l.\"SENTIMENT\" = '{s}'") for s in kinds
    ]
    return with_views(
        f""", {_LABEL_ROWS}, counts AS (SELECT a."LABEL", {", ".join(columns)} FROM labels_all a
            LEFT JOIN (SELECT * FROM labelled WHERE "{feature}") l ON a."LABEL" = l."LABEL" GROUP BY 1)
        SELECT *, {", ".join(
            f'CASE WHEN {total} = 0 THEN CAST(0 AS DOUBLE) ELSE {part} * CAST(100 AS DOUBLE) / ({total}) END AS "{name}"'
            for name, part, total in shares)} FROM counts""",
        "labelled",
    )


def _feature(spark: SparkSession, sf_dir: str, feature: str) -> DataFrame:
    return reports.feature_report(_flags(spark, sf_dir), feature, LABELS)


@query(_feature_sql("MOVING"))
def feature_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature(spark, sf_dir, "MOVING")


@query(_feature_sql("OPEN_ENDED"))
def feature_report_open_ended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature(spark, sf_dir, "OPEN_ENDED")


@query(with_views('SELECT "USER_COUNTRY", count("MESSAGE_BODY") AS "NUM_TWEETS" FROM flags WHERE "MOVING" GROUP BY 1', "flags"))
def feature_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.country_counts(rows.flagged(_flags(spark, sf_dir), "MOVING"))


_STOP = ", ".join(f"('{w}')" for w in tx.STOP_WORDS)
SLICE = ("1997-09-15 00:00:00", "1997-10-15 00:00:00")
_IN_SLICE = f"\"POSTING_TIME\" >= TIMESTAMP '{SLICE[0]}' AND \"POSTING_TIME\" < TIMESTAMP '{SLICE[1]}'"


def _slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.within(rows.flagged(_flags(spark, sf_dir), "LOW"), "POSTING_TIME", *SLICE)


@query(with_views(f'SELECT "MESSAGE_ID", "MESSAGE_BODY", "POSTING_TIME" FROM flags WHERE "LOW" AND {_IN_SLICE}', "flags"))
def label_window_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slice(spark, sf_dir).select("MESSAGE_ID", "MESSAGE_BODY", "POSTING_TIME")


@query(
    with_views(
        f"""SELECT word, count(*) AS n FROM (
            SELECT unnest(regexp_split_to_array("MESSAGE_BODY", '\\s')) AS word FROM flags WHERE "LOW" AND {_IN_SLICE})
        WHERE length(word) > 3 AND NOT starts_with(word, 'http') AND NOT regexp_matches(word, '[^\\x00-\\x7F]')
          AND word NOT IN (SELECT w FROM (VALUES {_STOP}) s(w))
        GROUP BY 1 ORDER BY n DESC, word LIMIT 10""",
        "flags",
    )
)
def slice_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.top_words(_slice(spark, sf_dir), text="MESSAGE_BODY")
