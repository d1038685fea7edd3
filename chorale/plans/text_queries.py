"""Queries over posts: admission, scores, tags, words, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale import sinks
from chorale.functions import text as tx
from chorale.functions import vectors as vx
from chorale.operators import enrich, frequent, numbers, profiles, rows, tags, terms, tones
from chorale.plans import views
from chorale.plans.registry import query
from chorale.plans.views import with_views
from chorale.schemas import DOCUMENT, FACTORS, TONES
from chorale.session import scratch_path

KEYWORDS = ["With", "there"]


@query(
    "SELECT round(avg(l_quantity), 6) AS mean, round(var_pop(l_quantity), 6) AS variance FROM lineitem"
)
def mean_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = numbers.mean_variance(views.table(spark, sf_dir, "lineitem"), "l_quantity")
    return stats.select(F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"))


_ENGLISH_ASCII = r"starts_with(lang, 'en') AND NOT regexp_matches(text, '[^\x00-\x7F]')"


@query(
    with_views(
        f"SELECT doc_id, lang, text FROM posts WHERE {_ENGLISH_ASCII} "
        "AND (contains(text, 'With') OR contains(text, 'there'))",
        "posts",
    )
)
def admit_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.admit(views.posts(spark, sf_dir), KEYWORDS).select("doc_id", "lang", "text")


@query(
    with_views(
        f"SELECT doc_id, lang, text FROM posts WHERE {_ENGLISH_ASCII} "
        "AND (contains(lower(text), 'with') OR contains(lower(text), 'there'))",
        "posts",
    )
)
def admit_texts_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.admit(views.posts(spark, sf_dir), KEYWORDS, ignore_case=True).select(
        "doc_id", "lang", "text"
    )


@query(with_views(f"SELECT doc_id, lang FROM posts WHERE {_ENGLISH_ASCII}", "posts"))
def admit_all_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.admit(views.posts(spark, sf_dir)).select("doc_id", "lang")


@query(with_views('SELECT doc_id, author, text, "Anger" FROM scored_posts WHERE "Anger" > 60', "scored_posts"))
def score_over_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = views.scored_posts(spark, sf_dir)
    return rows.above(scored, "Anger", 60).select("doc_id", "author", "text", "Anger")


@query(with_views('SELECT "Joy", lang, doc_id, author, "Anger" FROM scored_posts', "scored_posts"))
def reorder_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = views.scored_posts(spark, sf_dir).select("doc_id", "author", "lang", "Anger", "Joy")
    return rows.columns_first(scored, ["Joy", "lang"])


_ALL_TONES = ", ".join(f'"{t}"' for t in TONES)


@query(
    with_views(
        " UNION ALL ".join(
            f"SELECT '{t}' AS emotion, count(*) FILTER (WHERE \"{t}\" > 60) AS n FROM scored_posts"
            for t in TONES
        ),
        "scored_posts",
    )
)
def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tones.score_distribution(views.scored_posts(spark, sf_dir))


@query(
    with_views(
        "SELECT doc_id, author, emotion, score FROM (UNPIVOT (SELECT doc_id, author, "
        f"{_ALL_TONES} FROM scored_posts) ON {_ALL_TONES} INTO NAME emotion VALUE score) WHERE score > 60",
        "scored_posts",
    )
)
def score_long_over_60(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tones.scores_above(views.scored_posts(spark, sf_dir), ["doc_id", "author"])


_FLAT = ", ".join(
    f"CASE WHEN e.embedding IS NULL THEN CAST(0 AS DOUBLE) ELSE "
    f"round(least(1.0, abs(CAST(e.embedding[{i + 1}] AS DOUBLE)) * 4), 2) * 100 END AS \"{name}\""
    if i < 12
    else f'CAST(0 AS DOUBLE) AS "{name}"'
    for i, (name, _) in enumerate(FACTORS)
)


@query(f"SELECT doc_id, {_FLAT} FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id")
def flatten_tones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tones.flatten_payload(views.payload_posts(spark, sf_dir))


@query(
    with_views(
        """SELECT p.author, p.date, p.lang AS language, p.text, p.lat, p.long, e.embedding IS NOT NULL AS has_tones,
                  CASE WHEN e.embedding IS NULL THEN 0 ELSE 12 END AS n_tones
           FROM posts p LEFT JOIN embeddings e ON p.doc_id = e.vec_id""",
        "posts",
    )
)
def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts written as nested JSON documents and read back."""
    posts = views.posts(spark, sf_dir).join(views.payload_posts(spark, sf_dir), "doc_id")
    path = scratch_path(spark, "documents")
    sinks.write_documents(posts.withColumn("sentiment", F.col("payload.document_tone")), path)
    tones_in = F.flatten(F.transform("sentiment.tone_categories", lambda c: c["tones"]))
    return spark.read.schema(DOCUMENT).json(path).select(
        "author",
        "date",
        "language",
        "text",
        "geo.lat",
        "geo.long",
        F.col("sentiment").isNotNull().alias("has_tones"),
        F.coalesce(F.size(tones_in), F.lit(0)).alias("n_tones"),
    )


_TAGS = """tag_counts AS (
    SELECT tag, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(text, '\\s')) AS tag FROM posts)
    WHERE starts_with(tag, '#') GROUP BY tag),
top AS (SELECT tag, n FROM tag_counts ORDER BY n DESC, tag LIMIT 10)"""


def _with_tags(sql: str, *names: str) -> str:
    return with_views("", *names).rstrip() + ",\n" + _TAGS + "\n" + sql


@query(_with_tags("SELECT tag, n FROM top", "posts"))
def top_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.top_hashtags(views.posts(spark, sf_dir))


@query(_with_tags("SELECT tag, n, n * CAST(100 AS DOUBLE) / CAST((SELECT sum(n) FROM tag_counts) AS DOUBLE) AS share FROM tag_counts", "posts"))
def hashtag_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.with_share(tags.hashtag_counts(views.posts(spark, sf_dir)), "n")


_MEANS = (
    "means AS (SELECT translate(tag, ':-', '') AS tag, "
    + ", ".join(f'round(CAST(avg("{t}") AS DECIMAL(30, 12)), 2)::DOUBLE AS "{t}"' for t in TONES)
    + " FROM scored_posts JOIN top ON contains(text, tag) GROUP BY 1)"
)


@query(
    _with_tags(
        f", {_MEANS} SELECT tag, tone, mean FROM (UNPIVOT means ON {_ALL_TONES} INTO NAME tone VALUE mean)",
        "scored_posts",
    )
)
def tag_tone_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = views.scored_posts(spark, sf_dir)
    return tags.tag_tone_breakdown(scored, tags.top_hashtags(views.posts(spark, sf_dir)))


@query(
    _with_tags(
        f", {_MEANS} SELECT m.tag, coalesce(t.n, 0) AS n, "
        + "'"
        + ",".join(sorted(TONES))
        + "' AS tones, concat_ws(',', "
        + ", ".join(f'm."{t}"' for t in sorted(TONES))
        + ") AS means FROM means m LEFT JOIN top t ON m.tag = t.tag",
        "scored_posts",
    )
)
def tag_tone_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = views.scored_posts(spark, sf_dir)
    arrays = tags.tag_tone_arrays(scored, tags.top_hashtags(views.posts(spark, sf_dir)))
    # Arrays as text, so that the comparison sees plain values.
    return arrays.select(
        "tag",
        "n",
        F.array_join("tones", ",").alias("tones"),
        F.array_join(F.transform("means", lambda m: m.cast("string")), ",").alias("means"),
    )


_STOP = ", ".join(f"('{w}')" for w in tx.STOP_WORDS)


@query(
    f"""SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(text, '\\s')) AS word FROM documents)
    WHERE NOT starts_with(word, 'http') AND NOT regexp_matches(word, '[^\\x00-\\x7F]') AND length(word) > 3
      AND word NOT IN (SELECT w FROM (VALUES {_STOP}) s(w))
    GROUP BY word ORDER BY n DESC, word LIMIT 10"""
)
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.top_words(views.table(spark, sf_dir, "documents").select("text"))


@query(
    with_views(
        'SELECT author, userid, avg("Anger") AS "Anger", avg("Disgust") AS "Disgust" '
        "FROM scored_posts GROUP BY 1, 2",
        "scored_posts",
    )
)
def author_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tones.author_averages(views.scored_posts(spark, sf_dir))


_CORPUS = """WITH own AS (
        SELECT d.source AS userid, d.doc_id, regexp_replace(d.text, '[^\\x00-\\x7F]', '', 'g') AS part,
               row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id DESC) AS rn
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        WHERE coalesce(l.toxic, 0) <> 1 AND coalesce(l.quality, 1) <> 0),
    corpus AS (
        SELECT userid, count(*) AS n_posts, string_agg(part, chr(10) ORDER BY doc_id) AS text
        FROM own WHERE {} GROUP BY userid)
    SELECT userid, CAST(n_posts AS INTEGER) AS n_posts, text,
           CAST(len(regexp_extract_all(text, '\\w+')) AS INTEGER) AS n_words
    FROM corpus WHERE len(regexp_extract_all(text, '\\w+')) > 100"""


@query(_CORPUS.format("true"))
def author_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.author_corpus(views.document_posts(spark, sf_dir))


@query(
    """WITH own AS (
        SELECT d.source AS userid, d.doc_id, regexp_replace(d.text, '[^\\x00-\\x7F]', '', 'g') AS part
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        WHERE coalesce(l.toxic, 0) <> 1 AND coalesce(l.quality, 1) <> 0),
    placed AS (
        SELECT *, sum(length(part) + 1) OVER (PARTITION BY userid ORDER BY doc_id) - length(part) - 1 AS before FROM own)
    SELECT userid, CAST(before // 65536 AS BIGINT) AS part, count(*) AS n_posts, string_agg(part, chr(10) ORDER BY doc_id) AS text
    FROM placed WHERE userid IN (SELECT userid FROM own GROUP BY 1 HAVING sum(len(regexp_extract_all(part, '\\w+'))) > 100)
    GROUP BY 1, 2"""
)
def author_corpus_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every author's whole corpus in parts of 64 Ki characters."""
    return profiles.corpus_parts(views.document_posts(spark, sf_dir), part_chars=1 << 16)


@query(_CORPUS.format("rn <= 200"))
def recent_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of every author's latest 200 posts."""
    posts = views.document_posts(spark, sf_dir)
    recent = profiles.recent_per_user(posts, [F.desc("created_at"), F.desc("text")])
    return profiles.author_corpus(recent)


@query(
    """SELECT userid, created_at, l_orderkey, l_linenumber, l_partkey FROM (
        SELECT l_suppkey AS userid, l_shipdate AS created_at, l_orderkey, l_linenumber, l_partkey,
               row_number() OVER (PARTITION BY l_suppkey
                   ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey) AS rn
        FROM lineitem WHERE l_returnflag <> 'A' AND l_linenumber <> 7)
    WHERE rn <= 200"""
)
def recent_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("created_at"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return profiles.recent_per_user(views.user_posts(spark, sf_dir), order).drop(
        "is_repost", "is_reply"
    )


# The traits summarised one by one.
TRAITS = ["Emotional range", "Agreeableness", "Extraversion", "Conscientiousness", "Openness"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{t}' AS trait, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS stddev,
            min(v) AS low, max(v) AS high FROM (SELECT CAST(embedding[{i + 1}] AS DOUBLE) AS v FROM embeddings)"""
        for i, t in enumerate(TRAITS)
    )
)
def trait_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = views.table(spark, sf_dir, "embeddings")
    summary = profiles.describe_traits(
        vectors, {t: F.col("embedding")[i].cast("double") for i, t in enumerate(TRAITS)}
    )
    return summary.select(
        "trait",
        F.col("count").alias("n"),
        F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"),
        F.col("min").alias("low"),
        F.col("max").alias("high"),
    )


@query(
    """SELECT vec_id, round(da, 6) AS dist_a, round(db, 6) AS dist_b,
              CASE WHEN db < da THEN 'Yes' ELSE 'No' END AS closer_b
       FROM (SELECT v.vec_id,
                    list_distance(CAST(v.embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)) AS da,
                    list_distance(CAST(v.embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 1)) AS db
             FROM embeddings v)"""
)
def profile_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = views.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    measured = profiles.profile_distances(
        vectors, vectors, {"dist_a": 0, "dist_b": 1}, "vec_id", "embedding"
    )
    labelled = profiles.closer_of_two(measured, "dist_b", "dist_a", "closer_b")
    return rows.columns_first(labelled.drop("embedding"), ["vec_id"]).select(
        "vec_id",
        F.round("dist_a", 6).alias("dist_a"),
        F.round("dist_b", 6).alias("dist_b"),
        "closer_b",
    )


@query(
    """WITH lists AS (
        SELECT vec_id, CAST(embedding[1:1 + vec_id % 5] AS DOUBLE[]) AS a, CAST(embedding[1:1 + label % 7] AS DOUBLE[]) AS b FROM embeddings),
    means AS (
        SELECT vec_id, list_transform(list_zip(a, b), lambda x: (coalesce(x[1], 0) + coalesce(x[2], 0)) / 2) AS m FROM lists)
    SELECT vec_id, CAST(len(m) AS INTEGER) AS n, round(list_sum(m), 6) AS total, round(m[len(m)], 6) AS last FROM means"""
)
def padded_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element-wise means of lists of uneven length (SCL-18)."""
    vectors = views.table(spark, sf_dir, "embeddings")
    part = lambda n: F.slice("embedding", 1, (1 + F.col(n[0]) % n[1]).cast("int")).cast("array<double>")
    means = vectors.select("vec_id", vx.padded_mean(part(("vec_id", 5)), part(("label", 7))).alias("m"))
    total = F.aggregate("m", F.lit(0.0), lambda s, x: s + x)
    return means.select(
        "vec_id", F.size("m").alias("n"), F.round(total, 6).alias("total"), F.round(F.element_at("m", -1), 6).alias("last"))


@query(
    """WITH lexicon AS (
        SELECT term, 'tone' || (ascii(term) % 13) AS tone, (length(term) % 5) / 4.0::DOUBLE AS weight
        FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\w+')) AS term FROM benchmark)),
    words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\w+')) AS term FROM documents)
    SELECT doc_id, tone, round(greatest(0, least(1, avg(weight))), 9) AS score
    FROM words JOIN lexicon USING (term) GROUP BY doc_id, tone"""
)
def lexicon_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.regexp_extract_all(F.lower("text"), F.lit(r"(\w+)"), F.lit(1))
    lexicon = (
        views.table(spark, sf_dir, "benchmark")
        .select(F.explode(word).alias("term"))
        .distinct()
        .select(
            "term",
            F.concat(F.lit("tone"), (F.ascii("term") % 13).cast("string")).alias("tone"),
            ((F.length("term") % 5) / 4.0).alias("weight"),
        )
    )
    documents = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = enrich.lexicon_scores(documents, lexicon, "doc_id")
    return scored.withColumn("score", F.round("score", 9))


_TERMS = """WITH terms AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\w+')) AS term FROM benchmark)"""


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.regexp_extract_all(F.lower("text"), F.lit(r"(\w+)"), F.lit(1))
    return views.table(spark, sf_dir, "benchmark").select(F.explode(word).alias("term"))


@query(
    _TERMS
    + """ SELECT term, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids
    FROM documents JOIN terms ON contains(lower(text), term) GROUP BY term"""
)
def term_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that hold each of all benchmark words as a substring (FIL-13, JOIN-5)."""
    documents = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = terms.term_matches(documents, "doc_id", F.lower("text"), _terms(spark, sf_dir))
    return found.groupBy("term").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query(
    _TERMS
    + """, labelled AS (SELECT 'length ' || CAST(length(term) AS VARCHAR) AS label, term FROM terms WHERE length(term) > 7)
    SELECT label, count(DISTINCT doc_id) AS n FROM documents JOIN labelled ON contains(lower(text), term) GROUP BY 1"""
)
def term_label_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of texts per label, for labels with a term table (PRJ-7)."""
    documents = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    label = F.concat(F.lit("length "), F.length("term").cast("string")).alias("label")
    labelled = _terms(spark, sf_dir).where(F.length("term") > 7).select(label, "term")
    return terms.label_matches(documents, "doc_id", F.lower("text"), labelled).groupBy("label").agg(F.count("*").alias("n"))


@query(
    """SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 10"""
)
def heavy_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent tokens, counted only where a summary of bounded size allows them to be (TOP-1)."""
    words = views.table(spark, sf_dir, "documents").select(F.explode(tx.tokens(F.col("text"))).alias("word"))
    return frequent.top_frequent(words.where("word <> ''"), "word", 10)


@query(
    """SELECT source, count(*) AS n, count(*) FILTER (WHERE text IS NOT NULL AND NOT contains(text, ' the ')) AS failed,
        count(*) FILTER (WHERE contains(text, ' the ')) AS scored,
        CAST(sum(CASE WHEN contains(text, ' the ') THEN length(text) END) AS DOUBLE) AS total
    FROM documents GROUP BY 1"""
)
def scored_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer loaded once a task that fails on some texts; failures are kept and counted (UDF-1)."""

    def load():
        import re

        wanted = re.compile(" the ")

        def score(texts):
            if not all(wanted.search(t) for t in texts):
                raise ValueError("no article")
            return [{"chars": float(len(t))} for t in texts]

        return score

    documents = views.table(spark, sf_dir, "documents").select("source", "text")
    scored = documents.select("source", enrich.loaded_scores(load, F.col("text")).alias("s"))
    return scored.groupBy("source").agg(
        F.count("*").alias("n"), F.count("s.error").alias("failed"), F.count("s.scores").alias("scored"),
        F.sum(F.element_at("s.scores", "chars")).alias("total"),
    )
