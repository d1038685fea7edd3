"""The given tables read as posts, messages, events and a graph.

Every view has an SQL twin of the same name in ``SQL``, for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.schemas import FACTORS, TONES


# Stated shapes save the reader a job that looks into file footers.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def five_days(events: DataFrame):
    """Number of the five days an event falls in, counted from the first date."""
    first = events.agg(F.min(F.to_date("ts"))).scalar()
    return F.floor(F.date_diff(F.to_date("ts"), first) / 5)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts with a source tag and a language tag."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.col("source").alias("author"),
        F.col("source").alias("userid"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
        .cast("string")
        .alias("date"),
        "lang",
        F.concat(F.lit("#"), "source", F.lit(" #"), "lang", F.lit(" "), "text").alias("text"),
        F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("long"),
    )


def _tone(i: int):
    e = F.col("embedding")
    scaled = F.floor(F.least(F.lit(1.0), F.abs(e[i].cast("double")) * 4) * 100 + 0.5)
    return F.when(e.isNull(), F.lit(0.0)).otherwise(scaled.cast("double"))


def scored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with the thirteen score columns, whole numbers from 0 to 100."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return (
        posts(spark, sf_dir)
        .join(vectors, "doc_id", "left")
        .withColumns({name: _tone(i) for i, name in enumerate(TONES)})
        .drop("embedding")
    )


def payload_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document ids with a nested tone payload; null where there is no vector."""

    def tone(i: int):
        name, tone_id = FACTORS[i]
        return F.struct(
            F.least(F.lit(1.0), F.abs(F.col("embedding")[i].cast("double")) * 4).alias("score"),
            F.lit(tone_id).alias("tone_id"),
            F.lit(name).alias("tone_name"),
        )

    def category(name: str, ids: range):
        return F.struct(
            F.lit(name).alias("category_id"),
            F.lit(name).alias("category_name"),
            F.array(*[tone(i) for i in ids]).alias("tones"),
        )

    payload = F.struct(
        F.struct(
            F.array(
                category("emotion", range(0, 5)),
                category("language", range(5, 8)),
                # The last tone is left out, so its column takes the default.
                category("social", range(8, 12)),
            ).alias("tone_categories")
        ).alias("document_tone")
    )
    d = table(spark, sf_dir, "documents").select("doc_id")
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return d.join(e, "doc_id", "left").select(
        "doc_id", F.when(F.col("embedding").isNotNull(), payload).alias("payload")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer and nation as messages."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    key = F.col("o_orderkey")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .select(
            key.alias("MESSAGE_ID"),
            (F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int"))).alias(
                "MESSAGE_POSTED_TIME"
            ),
            F.concat_ws(" ", "c_mktsegment", "o_orderpriority").alias("MESSAGE_BODY"),
            F.when(key % 2 == 0, "en").otherwise("de").alias("MESSAGE_LANGUAGE"),
            F.when(key % 3 == 1, F.concat(F.lit("pos ("), "c_acctbal", F.lit(" "), "o_custkey", F.lit(")")))
            .when(key % 3 == 2, F.concat(F.lit("pos ("), "c_acctbal", F.lit(")")))
            .alias("MESSAGE_LOCATION"),
            F.when(F.col("c_mktsegment") == "BUILDING", "male")
            .when(F.col("c_mktsegment") == "MACHINERY", "female")
            .alias("USER_GENDER"),
            F.lower("c_mktsegment").alias("USER_STATE"),
            F.when(F.col("n_regionkey") != 0, F.col("n_name")).alias("USER_COUNTRY"),
            F.col("c_name").alias("USER_CITY"),
            F.floor("o_totalprice").cast("int").alias("USER_FOLLOWERS_COUNT"),
            F.col("c_custkey").cast("int").alias("USER_FRIENDS_COUNT"),
        )
    )


def sentiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as polarity records of their order."""
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("MESSAGE_ID"),
        F.when(flag == "A", "POSITIVE")
        .when(flag == "N", "AMBIVALENT")
        .otherwise("NEGATIVE")
        .alias("SENTIMENT_POLARITY"),
    )


def timed_sentiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polarity records with a time in the week after their message, and when they arrive: one of seven 30 days late."""
    flag, key = F.col("l_returnflag"), F.col("l_orderkey")
    lines, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    scored = (F.col("o_orderdate") + F.make_dt_interval(F.col("l_linenumber") % 6, key % 24)).cast("timestamp")
    return lines.join(o, lines.l_orderkey == o.o_orderkey).select(
        key.alias("MESSAGE_ID"),
        F.when(flag == "A", "POSITIVE").when(flag == "N", "AMBIVALENT").otherwise("NEGATIVE").alias("SENTIMENT_POLARITY"),
        scored.alias("SCORED"),
        (scored + F.make_dt_interval(F.when(F.col("l_partkey") % 7 == 0, 30).otherwise(0))).alias("ARRIVED"),
    )


def user_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as short posts of their supplier; some are reposts or replies."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("userid"),
        F.col("l_shipdate").alias("created_at"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_returnflag") == "A").alias("is_repost"),
        (F.col("l_linenumber") == 7).alias("is_reply"),
    )


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as dated posts of their source; toxic ones count as reposts."""
    d = table(spark, sf_dir, "documents")
    marks = table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    return d.join(marks, "doc_id", "left").select(
        F.col("source").alias("userid"),
        F.col("doc_id").alias("created_at"),
        "text",
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("is_repost"),
        F.coalesce(F.col("quality") == 0, F.lit(False)).alias("is_reply"),
    )


def event_posts(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events as tagged posts with a score map of one or two tones."""
    e = table(spark, sf_dir, "events") if events is None else events
    k = F.get_json_object("props", "$.k").cast("double")
    scores = F.map_filter(
        F.create_map(
            F.lit("anger"),
            F.floor("value").cast("double"),
            F.lit("joy"),
            F.when(k % 5 != 0, k),
        ),
        lambda _, v: v.isNotNull(),
    )
    return e.select(
        "event_id",
        "ts",
        "user_id",
        F.when(F.col("event_type") == "error", "fr").otherwise("en").alias("lang"),
        F.concat(
            F.lit("#"), "event_type", F.lit(" # "), F.lit("#u"), (F.col("user_id") % 10).cast("string")
        ).alias("text"),
        scores.alias("scores"),
    )


def event_messages(
    spark: SparkSession, sf_dir: str, events: DataFrame | None = None
) -> DataFrame:
    """Events as JSON topic messages, some with gaps and some broken."""
    e = table(spark, sf_dir, "events") if events is None else events
    key = F.col("event_id")
    body = F.to_json(
        F.struct(
            F.struct(
                F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name"),
                F.when(key % 3 != 0, F.col("user_id").cast("string")).alias("userid"),
                F.lit("en").alias("lang"),
            ).alias("user"),
            F.col("event_type").alias("text"),
            F.when(
                key % 4 != 0,
                F.struct(F.col("value").alias("long"), F.when(key % 5 != 0, F.col("value")).alias("lat")),
            ).alias("geo"),
        )
    )
    return e.select("event_id", F.when(key % 7 == 0, F.lit("no json")).otherwise(body).alias("value"))


def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations, customers and suppliers; suppliers have an unknown type."""

    def kind(name: str, key: str, code: int, node_type: str, **props: str) -> DataFrame:
        entries = [F.lit("type"), F.lit(node_type)]
        for prop, column in props.items():
            entries += [F.lit(prop), F.col(column).cast("string")]
        return table(spark, sf_dir, name).select(
            (F.col(key).cast("bigint") * 4 + code).alias("id"), F.create_map(*entries).alias("properties")
        )

    # Every region comes a second time under a longer name: ids are not unique.
    again = table(spark, sf_dir, "region").select(
        (F.col("r_regionkey").cast("bigint") * 4).alias("id"),
        F.create_map(F.lit("type"), F.lit("continent"), F.lit("desc"), F.concat("r_name", F.lit(" (old)"))).alias("properties"),
    )
    return (
        kind("region", "r_regionkey", 0, "continent", desc="r_name")
        .unionByName(again)
        .unionByName(kind("nation", "n_nationkey", 1, "country", desc="n_name"))
        .unionByName(kind("customer", "c_custkey", 2, "airport", desc="c_name", segment="c_mktsegment"))
        .unionByName(kind("supplier", "s_suppkey", 3, "version", desc="s_name"))
    )


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys as edges; the edge id goes last into the properties."""

    def link(name: str, key: str, code: int, target: str, target_code: int, label: str) -> DataFrame:
        src = F.col(key).cast("bigint") * 4 + code
        return table(spark, sf_dir, name).select(
            src.alias("src"),
            (F.col(target).cast("bigint") * 4 + target_code).alias("dst"),
            F.create_map(
                F.lit("label"), F.lit(label), F.lit("id"), (src + 1_000_000_000).cast("string")
            ).alias("properties"),
        )

    return (
        link("nation", "n_nationkey", 1, "n_regionkey", 0, "nation's region")
        .unionByName(link("customer", "c_custkey", 2, "c_nationkey", 1, "lives in"))
        .unionByName(link("supplier", "s_suppkey", 3, "s_nationkey", 1, "sits in"))
    )


_TONES_SQL = ",\n".join(
    f"CASE WHEN e.embedding IS NULL THEN CAST(0 AS DOUBLE) ELSE "
    f"floor(least(1.0, abs(CAST(e.embedding[{i + 1}] AS DOUBLE)) * 4) * 100 + 0.5) END AS \"{name}\""
    for i, name in enumerate(TONES)
)

SQL = {
    "posts": """
        SELECT doc_id, source AS author, source AS userid,
               CAST(CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS VARCHAR) AS date, lang,
               '#' || source || ' #' || lang || ' ' || text AS text,
               CAST(0 AS DOUBLE) AS lat, CAST(0 AS DOUBLE) AS long
        FROM documents""",
    "scored_posts": f"""
        SELECT p.*, {_TONES_SQL}
        FROM posts p LEFT JOIN embeddings e ON p.doc_id = e.vec_id""",
    "messages": """
        SELECT o_orderkey AS "MESSAGE_ID", o_orderdate + to_hours(o_orderkey % 24) AS "MESSAGE_POSTED_TIME",
               c_mktsegment || ' ' || o_orderpriority AS "MESSAGE_BODY",
               CASE WHEN o_orderkey % 2 = 0 THEN 'en' ELSE 'de' END AS "MESSAGE_LANGUAGE",
               CASE WHEN o_orderkey % 3 = 1 THEN c_acctbal END AS place_lon,
               CASE WHEN o_orderkey % 3 = 1 THEN o_custkey END AS place_lat,
               CASE WHEN o_orderkey % 3 = 2 THEN c_acctbal END AS place_lone,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'male' WHEN 'MACHINERY' THEN 'female' END AS "USER_GENDER",
               lower(c_mktsegment) AS "USER_STATE",
               CASE WHEN n_regionkey <> 0 THEN n_name END AS "USER_COUNTRY",
               c_name AS "USER_CITY",
               CAST(floor(o_totalprice) AS INTEGER) AS "USER_FOLLOWERS_COUNT",
               CAST(c_custkey AS INTEGER) AS "USER_FRIENDS_COUNT"
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "sentiments": """
        SELECT l_orderkey AS "MESSAGE_ID",
               CASE l_returnflag WHEN 'A' THEN 'POSITIVE' WHEN 'N' THEN 'AMBIVALENT' ELSE 'NEGATIVE' END
               AS "SENTIMENT_POLARITY"
        FROM lineitem""",
    "polarity": """
        SELECT m.*, s."SENTIMENT_POLARITY",
               CASE WHEN s."SENTIMENT_POLARITY" > 0 THEN 'POSITIVE' WHEN s."SENTIMENT_POLARITY" < 0 THEN 'NEGATIVE'
                    ELSE 'AMBIVALENT' END AS "SENTIMENT"
        FROM messages m JOIN (
            SELECT "MESSAGE_ID", avg(CASE "SENTIMENT_POLARITY" WHEN 'AMBIVALENT' THEN 0 WHEN 'POSITIVE' THEN 1
                                     ELSE -1 END) AS "SENTIMENT_POLARITY"
            FROM sentiments GROUP BY 1) s ON m."MESSAGE_ID" = s."MESSAGE_ID" """,
    "cleaned": """
        SELECT CAST("MESSAGE_ID" AS VARCHAR) AS "MESSAGE_ID",
               CAST(CAST("MESSAGE_POSTED_TIME" AS DATE) AS TIMESTAMP) AS "POSTING_TIME",
               "MESSAGE_BODY", "USER_GENDER", upper("USER_STATE") AS "USER_STATE",
               coalesce(upper("USER_COUNTRY"), 'NONE') AS "USER_COUNTRY", upper("USER_CITY") AS "USER_CITY",
               "MESSAGE_LANGUAGE",
               CAST(coalesce(place_lon, place_lone) AS FLOAT) AS "MESSAGE_LOCATION_LONGITUDE",
               CAST(place_lat AS FLOAT) AS "MESSAGE_LOCATION_LATITUDE",
               "SENTIMENT", "USER_FOLLOWERS_COUNT", "USER_FRIENDS_COUNT"
        FROM polarity""",
    "flags": """
        SELECT "MESSAGE_ID", "MESSAGE_BODY", "SENTIMENT", "USER_GENDER", "USER_COUNTRY", "POSTING_TIME",
               ("USER_FOLLOWERS_COUNT" + "USER_FRIENDS_COUNT") / 2.0::DOUBLE AS "INFLUENCE",
               contains(lower("MESSAGE_BODY"), 'urgent') AS "URGENT",
               contains(lower("MESSAGE_BODY"), 'high') AS "HIGH",
               contains(lower("MESSAGE_BODY"), 'medium') AS "MEDIUM",
               contains(lower("MESSAGE_BODY"), 'low') OR contains(lower("MESSAGE_BODY"), 'specified') AS "LOW",
               contains(lower("MESSAGE_BODY"), 'build') AS "BUILD",
               contains(lower("MESSAGE_BODY"), 'furn') OR contains(lower("MESSAGE_BODY"), 'house') AS "FURN",
               contains(lower("MESSAGE_BODY"), 'machinery') OR contains(lower("MESSAGE_BODY"), 'auto') AS "MOVING",
               contains(lower("MESSAGE_BODY"), 'not spec') AS "OPEN_ENDED"
        FROM cleaned""",
    "labelled": """
        SELECT * FROM (
            UNPIVOT (SELECT "MESSAGE_ID", "SENTIMENT", "USER_GENDER", "USER_COUNTRY", "POSTING_TIME", "INFLUENCE",
                            "URGENT", "HIGH", "MEDIUM", "LOW", "BUILD", "FURN", "MOVING", "OPEN_ENDED" FROM flags)
            ON "URGENT", "HIGH", "MEDIUM", "LOW", "BUILD", "FURN" INTO NAME "LABEL" VALUE held)
        WHERE held""",
    "event_posts": """
        SELECT event_id, ts, user_id, CASE WHEN event_type = 'error' THEN 'fr' ELSE 'en' END AS lang,
               '#' || event_type || ' # #u' || CAST(user_id % 10 AS VARCHAR) AS text,
               floor(value) AS anger, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k,
               CAST(ts AS DATE) AS day,
               dense_rank() OVER (ORDER BY date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) // 5) - 1 AS slice
        FROM events""",
    "tag_tones": """
        SELECT *, unnest(['#' || split_part(substr(text, 2), ' ', 1), '#' || split_part(text, '# #', 2)]) AS tag
        FROM (SELECT day, slice, lang, text, 'anger' AS tone, anger AS score FROM event_posts
              UNION ALL SELECT day, slice, lang, text, 'joy', k FROM event_posts WHERE k % 5 <> 0)""",
    "vertices": """
        SELECT CAST(r_regionkey AS BIGINT) * 4 AS id, 'continent' AS node_type,
               'desc=' || r_name || ';type=continent' AS properties,
               ',''desc'',''' || r_name || ''',''type'',''continent''' AS args FROM region
        UNION ALL SELECT CAST(n_nationkey AS BIGINT) * 4 + 1, 'country', 'desc=' || n_name || ';type=country',
               ',''desc'',''' || n_name || ''',''type'',''country''' FROM nation
        UNION ALL SELECT c_custkey * 4 + 2, 'airport', 'desc=' || c_name || ';segment=' || c_mktsegment || ';type=airport',
               ',''desc'',''' || c_name || ''',''segment'',''' || c_mktsegment || ''',''type'',''airport''' FROM customer""",
    "edges": """
        SELECT src, dst, 'id=' || (src + 1000000000) || ';label=' || label AS properties,
               ',''id'',''' || (src + 1000000000) || ''',''label'',''' || replace(label, '''', '\\''') || '''' AS args
        FROM (SELECT CAST(n_nationkey AS BIGINT) * 4 + 1 AS src, CAST(n_regionkey AS BIGINT) * 4 AS dst,
                     'nation''s region' AS label FROM nation
              UNION ALL SELECT c_custkey * 4 + 2, CAST(c_nationkey AS BIGINT) * 4 + 1, 'lives in' FROM customer
              UNION ALL SELECT s_suppkey * 4 + 3, CAST(s_nationkey AS BIGINT) * 4 + 1, 'sits in' FROM supplier)""",
}

_NEEDS = {
    "scored_posts": ["posts"],
    "polarity": ["messages", "sentiments"],
    "cleaned": ["polarity"],
    "flags": ["cleaned"],
    "labelled": ["flags"],
    "tag_tones": ["event_posts"],
}


def with_views(sql: str, *names: str) -> str:
    """An SQL text with the named views, and those they need, put in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in order) + "\n" + sql
