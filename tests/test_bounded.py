"""Operators whose groups, summaries or term tables may be of any size."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chorale.operators import enrich, frequent, profiles, terms
from chorale.operators.running import running_sums


def _before(rows):
    sums, out = Counter(), []
    for group, at, size in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        out.append((group, at, sums[group]))
        sums[group] += size
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", ["1", "4", "7"])
def test_running_sums_over_partition_ends(spark, width):
    draw = random.Random(int(width))
    rows = [("hot" if i % 3 else draw.choice(["a", "b", None, "zz"]), i, draw.randrange(1, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, at int, n bigint").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        got = running_sums(df, "g", ["at"], "n").select("g", "at", "size_before").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got), key=repr) == _before(rows)


def test_running_sums_of_small_and_empty_frames(spark):
    one = spark.createDataFrame([(None, 1, 4)], "g string, at int, n bigint")
    assert [r.size_before for r in running_sums(one, "g", ["at"], "n").collect()] == [0]
    assert running_sums(one.where("at > 1"), "g", ["at"], "n").count() == 0


POST = "userid string, created_at int, text string, is_repost boolean, is_reply boolean"


def test_corpus_parts_put_together_are_the_corpus(spark):
    draw = random.Random(2)
    rows = [(draw.choice("ab"), i, " ".join(["wörd"] * draw.randrange(0, 30)), i % 11 == 0, i % 13 == 0) for i in range(400)]
    rows += [("few", 1, "two words", False, False), ("long", 1, "word " * 2000, False, False), ("a", 1000, None, False, False)]
    posts = spark.createDataFrame(rows, POST)
    parts = profiles.corpus_parts(posts, part_chars=500).orderBy("part").collect()
    joined, n = {}, Counter()
    for r in parts:
        joined.setdefault(r.userid, []).append(r.text)
        n[r.userid] += r.n_posts
    whole = {r.userid: r for r in profiles.author_corpus(posts.fillna("", ["text"])).collect()}
    assert {u: "\n".join(t) for u, t in joined.items()} == {u: r.text for u, r in whole.items()}
    assert n == {u: r.n_posts for u, r in whole.items()} and "few" not in n
    assert max(len(r.text) for r in parts if r.userid != "long") < 500 + 30 * 5
    assert [r.part for r in parts if r.userid == "long"] == [0]


def test_a_user_with_a_third_of_all_posts_is_held_in_parts(spark):
    posts = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 500).cast("string"))).alias("userid"),
        F.col("id").cast("int").alias("created_at"), F.repeat(F.lit("word "), 20).alias("text"),
        F.lit(False).alias("is_repost"), F.lit(False).alias("is_reply"),
    )
    parts = profiles.corpus_parts(posts, part_chars=10_000)
    hot = parts.where("userid = 'hot'").agg(
        F.count("*").alias("parts"), F.max(F.length("text")).alias("longest"), F.sum("n_posts").alias("n")).first()
    assert hot.n == 20_000 and hot.parts == -(-20_000 * 101 // 10_000) and hot.longest <= 10_000 + 101


def _pairs(spark, texts, words):
    frame = spark.createDataFrame(list(texts.items()), "id int, text string")
    table = spark.createDataFrame([(w,) for w in words], "term string")
    return sorted(tuple(r) for r in terms.term_matches(frame, "id", F.col("text"), table).collect())


def test_terms_are_found_as_substrings(spark):
    draw = random.Random(9)
    letters = "abé \U0001f600\n."
    texts = {i: "".join(draw.choice(letters) for _ in range(draw.randrange(0, 60))) for i in range(80)}
    texts |= {90: None, 91: "", 92: "x" * 300, 93: "?" * 8, 94: "the self driving car"}
    words = {"".join(draw.choice(letters) for _ in range(draw.randrange(1, 8))) for _ in range(150)}
    words |= {"x" * 200, "x" * 301, "?", "????", "self driving", "rivi", "car"}
    expected = sorted((i, w) for i, t in texts.items() if t is not None for w in words if w in t)
    assert _pairs(spark, texts, [*words, "", None, "car"]) == expected
    assert _pairs(spark, texts, []) == [] and _pairs(spark, {}, ["a"]) == []


def test_labels_and_any_term(spark):
    texts = spark.createDataFrame([(1, "a hybrid car"), (2, "autonomous"), (3, "bus")], "id int, text string")
    labelled = spark.createDataFrame([("E", "hybrid"), ("E", "electric"), ("A", "auton"), ("A", "omous"), ("B", "car")], "label string, term string")
    got = sorted(tuple(r) for r in terms.label_matches(texts, "id", F.col("text"), labelled).collect())
    assert got == [(1, "B"), (1, "E"), (2, "A")]
    assert sorted(r.id for r in terms.with_any_term(texts, "id", F.col("text"), labelled).collect()) == [1, 2]


def test_the_plan_is_the_same_for_ten_terms_and_ten_thousand(spark):
    texts = spark.createDataFrame([(i, f"word{i} and more") for i in range(50)], "id int, text string")

    def shape(n):
        table = spark.range(n).select(F.concat(F.lit("word"), "id").alias("term"))
        plan = terms.term_matches(texts, "id", F.col("text"), table)._jdf.queryExecution().optimizedPlan().toString()
        return [line.split("#")[0].split("[")[0].split("(")[0] for line in plan.splitlines()]

    assert shape(10) == shape(10_000)


def test_frequent_values_are_exact(spark):
    draw = random.Random(4)
    values = [f"v{min(int(draw.paretovariate(0.9)), 5000)}" for _ in range(20_000)] + [None] * 5000
    df = spark.createDataFrame([(v,) for v in values], "w string").repartition(6)
    expected = sorted(Counter(v for v in values if v).items(), key=lambda x: (-x[1], x[0]))[:10]
    for tracked, most in ((64, 1_000_000), (4096, 1_000_000), (64, 100)):
        assert [tuple(r) for r in frequent.top_frequent(df, "w", 10, tracked, most).collect()] == expected


def test_frequent_values_without_heavy_ones(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("w"))
    got = [tuple(r) for r in frequent.top_frequent(df, "w", 3, tracked=16, most=200).collect()]
    assert got == [("0", 2), ("1", 2), ("10", 2)]
    few = spark.createDataFrame([("a",), ("b",), ("a",)], "w string")
    assert [tuple(r) for r in frequent.top_frequent(few, "w", 10).collect()] == [("a", 2), ("b", 1)]
    assert frequent.top_frequent(few.where("w = 'c'"), "w", 10).count() == 0


def test_a_scorer_is_loaded_once_a_task_and_its_failures_are_kept(spark):
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)

        def score(texts):
            if "bad" in texts:
                raise ValueError("no score")
            if "short" in texts and len(texts) > 1:
                return []
            return [None if t == "none" else {"n": len(t)} for t in texts]

        return score

    rows = [(i, t) for i, t in enumerate(["one", "bad", None, "none", "short", "three"] * 40)]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(2)
    got = df.select("id", "text", enrich.loaded_scores(load, F.col("text")).alias("s")).collect()
    wanted = {"one": ({"n": 3.0}, None), "bad": (None, "ValueError: no score"), None: (None, None), "none": (None, None),
              "short": ({"n": 5.0}, None), "three": ({"n": 5.0}, None)}
    assert all((r.s.scores, r.s.error) == wanted[r.text] for r in got) and len(got) == 240
    assert loads.value <= 2
    assert df.where("id < 0").select(enrich.loaded_scores(load, F.col("text")).alias("s")).count() == 0


def test_terms_of_words_are_looked_for_once_in_a_word(spark):
    # The plan sends a text's words, and places of different words alone.
    texts = spark.createDataFrame([(i, "the carpet and the car-park " * 20) for i in range(50)], "id int, text string")
    table = spark.createDataFrame([(w,) for w in ("carp", "car", "park", "r-pa", "the ")], "term string")
    found = terms.term_matches(texts, "id", F.col("text"), table)
    assert sorted(map(tuple, found.collect())) == sorted((i, w) for i in range(50) for w in ("carp", "car", "park", "r-pa", "the "))
    words = table.where("term in ('carp', 'park')")
    plan = terms.term_matches(texts, "id", F.col("text"), words)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "{4,4}" in line)
    assert any("Aggregate" in line for line in lines[at:]) and "[\\p{L}" in plan


def test_unequal_words_and_repeated_keys(spark):
    texts = spark.createDataFrame([(1, "abcd ab"), (1, "abcd ab"), (None, "éab_9 x"), (2, "ab-cd"), (3, None)], "id int, text string")
    table = spark.createDataFrame([("ab",), ("abcd",), ("ab_9",), ("b-c",), ("é",)], "term string")
    got = sorted(map(tuple, terms.term_matches(texts, "id", F.col("text"), table).collect()), key=repr)
    # Terms of GRAM and more once a key; shorter ones once a row.
    assert got == sorted([(1, "ab"), (1, "ab"), (1, "abcd"), (None, "ab"), (None, "ab_9"), (None, "é"), (2, "ab"), (2, "b-c")], key=repr)
