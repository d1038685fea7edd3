from pyspark.sql import functions as F

from chorale.functions import vectors as vx
from chorale.operators import enrich, numbers, profiles, tones
from chorale.schemas import FACTORS, SCORED_POST, STATUS, TONE_PAYLOAD, TONES
from chorale.sources import tables


def _payload(*categories):
    return {
        "document_tone": {
            "tone_categories": [
                None
                if c is None
                else {"category_id": "c", "category_name": "c",
                      "tones": None if c == "null" else [{"score": s, "tone_id": i, "tone_name": i} for s, i in c]}
                for c in categories
            ]
        }
    }


def test_payload_flattening(spark):
    rows = [
        (1, _payload([(0.61, "anger"), (0.285, "joy")], [(0.5, "neuroticism_big5")])),
        (2, None),
        (3, {"document_tone": None}),
        (4, _payload("null", None, [(0.1, "anger"), (0.2, "anger")])),
    ]
    df = spark.createDataFrame(rows, f"id int, payload struct<{TONE_PAYLOAD.replace(' ', ': ', 1)}>")
    out = {r.id: r.asDict() for r in tones.flatten_payload(df).collect()}
    zeros = {name: 0.0 for name in TONES}
    assert out[1] == {"id": 1, **zeros, "Anger": 61.0, "Joy": 28.999999999999996, "EmotionalRange": 50.0}
    assert out[2] == {"id": 2, **zeros}
    assert out[3] == {"id": 3, **zeros}
    assert out[4] == {"id": 4, **zeros, "Anger": 20.0}


def test_distribution_keeps_zero_counts(spark):
    df = spark.createDataFrame([(60.0, 0.0), (61.0, 0.0), (0.0, 0.0)], "Anger double, Joy double")
    got = {r.emotion: r.n for r in tones.score_distribution(df, ["Anger", "Joy"]).collect()}
    assert got == {"Anger": 1, "Joy": 0}
    empty = tones.score_distribution(df.where("Anger > 99"), ["Anger", "Joy"]).collect()
    assert [r.n for r in empty] == [0, 0]


def test_scores_above(spark):
    df = spark.createDataFrame([(1, 60.0, 70.0)], "id int, Anger double, Joy double")
    assert [tuple(r) for r in tones.scores_above(df, ["id"], ["Anger", "Joy"]).collect()] == [(1, "Joy", 70.0)]


def test_schemas():
    assert len(FACTORS) == 13 and len(SCORED_POST) == 20 and len(STATUS) == 7
    assert STATUS.simpleString() == (
        "struct<userName:string,userId:string,userLang:string,createdAt:string,text:string,long:double,lat:double>")


def test_mean_variance_closed_form(spark):
    one = numbers.mean_variance(tables.number_range(spark, 1, 500_000, 5), "id").first()
    zero = numbers.mean_variance(tables.number_range(spark, 0, 500_000, 5), "id").first()
    assert tuple(one) == (250000.0, 20833250000.0)
    assert zero.mean == 249999.5 and abs(zero.variance - 20833333333.25) < 1e-3


def test_distances_and_closer_label(spark):
    users = spark.createDataFrame([("u", [0.0, 0.0])], "userid string, v array<float>")
    refs = spark.createDataFrame(
        [("a", [3.0, 4.0]), ("b", [0.0, 5.0]), ("c", [0.0, 6.0])], "userid string, v array<float>"
    )
    out = profiles.profile_distances(users, refs, {"da": "a", "db": "b", "dc": "c"}, "userid", "v")
    out = profiles.closer_of_two(out, "da", "db", "tie")
    out = profiles.closer_of_two(out, "da", "dc", "yes").drop("v")
    assert tuple(out.first()) == ("u", 5.0, 5.0, 6.0, "No", "Yes")


def test_padded_mean(spark):
    row = spark.range(1).select(
        vx.padded_mean(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0))).alias("m")
    ).first()
    assert row.m == [2.0, 1.0]


def test_corpus_word_limit(spark):
    def words(n):
        return " ".join(f"w{i}" for i in range(n))

    df = spark.createDataFrame(
        [
            ("keep", 2, words(41), False, False),
            ("keep", 1, words(60) + " é", False, False),
            ("drop", 1, words(60), False, False),
            ("drop", 2, words(40), False, False),
            ("drop", 3, words(99), True, False),
            ("drop", 4, words(99), False, True),
        ],
        "userid string, created_at int, text string, is_repost boolean, is_reply boolean",
    )
    out = profiles.author_corpus(df).collect()
    assert [(r.userid, r.n_posts, r.n_words) for r in out] == [("keep", 2, 101)]
    assert out[0].text == words(60) + " \n" + words(41)


def test_describe_matches_spark(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    ours = profiles.describe_traits(df, {"x": F.col("x")}).first()
    theirs = {r.summary: float(r.x) for r in df.describe("x").collect()}
    assert {k: float(ours[k]) for k in theirs} == theirs


def test_lexicon_enrichment(spark):
    posts = spark.createDataFrame([(1, "Good good bad"), (2, "nothing")], "id int, text string")
    lexicon = spark.createDataFrame(
        [("good", "joy", 1.0), ("bad", "joy", 0.25), ("bad", "anger", 3.0)],
        "term string, tone string, weight double",
    )
    out = enrich.enrich(posts, enrich.lexicon_scorer(lexicon, "id"), "id")
    assert {r.id: r.scores for r in out.collect()} == {1: {"joy": 0.75, "anger": 1.0}, 2: None}
    assert [r.id for r in enrich.scored_only(out).collect()] == [1]


def test_python_scorer_survives_failures(spark):
    def score(text):
        if text == "bad":
            raise ValueError(text)
        return {"len": float(len(text))}

    posts = spark.createDataFrame([(1, "abc"), (2, "bad"), (3, None)], "id int, text string")
    out = posts.withColumn("found", enrich.score_column(score, F.col("text"))).select("id", "found.*").collect()
    assert {r.id: r.scores for r in out} == {1: {"len": 3.0}, 2: None, 3: None}
    assert {r.id: r.error for r in out} == {1: None, 2: "ValueError: bad", 3: None}


def test_corpus_takes_all_posts(spark):
    rows = [("u", k, f"word{k}", False, False) for k in range(450)]
    df = spark.createDataFrame(rows, "userid string, created_at int, text string, is_repost boolean, is_reply boolean")
    assert profiles.author_corpus(df).first().n_posts == 450
    recent = profiles.recent_per_user(df, [F.desc("created_at")])
    assert profiles.author_corpus(recent).first().text.startswith("word250\n")
