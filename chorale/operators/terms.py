"""Texts that hold terms as substrings, for terms in a table of any size (FIL-13, JOIN-5, PRJ-7).

A term occurs in a text where the text goes on like the term. So every place of a text
offers the few characters that follow, and terms are found by an equi-join on the first
``GRAM`` of these; the rest of a term is compared where its start was found. What a text
costs does not depend on the number of terms. Terms shorter than that are joined on the
distinct sequences of their own length.

A term of letters, digits and underscores alone lies within a word of these, so such terms
are looked for once in every different word of all texts, and a text has the terms of its
words: it sends a row for a word, and not one for every place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 4
# Characters compared at a place; longer terms found that far are looked up in the text.
LONGEST = 64
# A character that words are made of.
WORD = r"[\p{L}\p{N}_]"


def _following(text: Column, least: int, most: int) -> Column:
    """At every place of a text with so many left, the characters from there on."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{least},{most}}}))."), F.lit(1))


def _by_places(body: DataFrame, wanted: DataFrame, kinds: list) -> DataFrame:
    """(key, term) of texts (key, text) and the terms that start at any place of theirs."""
    found = None
    for kind in kinds:
        of_kind = wanted.where(F.least(F.length("term"), F.lit(GRAM)) == kind["w"])
        if kind["w"] < GRAM:
            grams = body.select("key", F.explode(F.array_distinct(_following(F.col("text"), kind["w"], kind["w"]))).alias("term"))
            hits = grams.join(of_kind, "term").select("key", "term")
        else:
            most = min(kind["most"], LONGEST)
            places = body.select("key", F.explode(_following(F.col("text"), GRAM, most)).alias("tail")).withColumn(
                "gram", F.substring("tail", 1, GRAM))
            begun = of_kind.select("term", F.substring("term", 1, GRAM).alias("gram"), F.substring("term", 1, most).alias("head"))
            hits = places.join(begun, "gram").where(F.col("tail").startswith(F.col("head"))).select("key", "term").distinct()
            if kind["most"] > LONGEST:
                long = hits.where(F.length("term") > LONGEST).join(body, "key").where(F.col("text").contains(F.col("term")))
                hits = hits.where(F.length("term") <= LONGEST).unionByName(long.select("key", "term"))
        found = hits if found is None else found.unionByName(hits)
    return found


def _by_words(body: DataFrame, wanted: DataFrame, kinds: list) -> DataFrame:
    """(key, term) of texts (key, text) and the terms within their words."""
    words = body.withColumn("row", F.monotonically_increasing_id()).select(
        "key", "row", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(f"({WORD}+)"), F.lit(1)))).alias("word"))
    within = _by_places(words.select(F.col("word").alias("key")).distinct().withColumn("text", F.col("key")), wanted, kinds)
    # A word has fewer terms than it has substrings.
    held = within.groupBy(F.col("key").alias("word")).agg(F.collect_list("term").alias("terms"))
    # Lists of terms are brought to their text before they are opened, so repeats meet there without another exchange.
    # Rows with one key are told apart for the terms that places tell apart too, those shorter than ``GRAM``.
    opened = words.join(held, "word").select("key", "row", "terms").repartition("key").select("key", "row", F.explode("terms").alias("term"))
    return opened.withColumn("row", F.when(F.length("term") < GRAM, F.col("row"))).distinct().select("key", "term")


def term_matches(texts: DataFrame, key: str, text: Column, terms: DataFrame, term: str = "term") -> DataFrame:
    """(key, term) of every text and every term it contains, once each.

    Case counts. A null text contains nothing; null and empty terms are left out, and
    repeated ones count once. Keys are taken to be unique. Without terms there are no rows.
    """
    wanted = terms.select(F.col(term).alias("term")).where("length(term) > 0").distinct().withColumn(
        "inside", F.col("term").rlike(f"^{WORD}+\\z"))
    # At most twice GRAM rows: how many characters terms are found by, and the longest of each kind.
    kinds = wanted.groupBy("inside", F.least(F.length("term"), F.lit(GRAM)).alias("w")).agg(F.max(F.length("term")).alias("most")).collect()
    body = texts.select(F.col(key).alias("key"), text.alias("text"))
    found = body.select("key", F.lit("").alias("term")).where(F.lit(False))
    for inside, by in ((True, _by_words), (False, _by_places)):
        of_these = sorted((k for k in kinds if k["inside"] == inside), key=lambda k: k["w"])
        if of_these:
            found = found.unionByName(by(body, wanted.where(F.col("inside") == inside).select("term"), of_these))
    return found.withColumnRenamed("key", key)


def with_any_term(texts: DataFrame, key: str, text: Column, terms: DataFrame, term: str = "term") -> DataFrame:
    """The texts that contain any term (FIL-13)."""
    return texts.join(term_matches(texts, key, text, terms, term).select(key).distinct(), key, "left_semi")


def label_matches(texts: DataFrame, key: str, text: Column, labelled: DataFrame) -> DataFrame:
    """(key, label) of every text and every label any of whose terms it contains; ``labelled`` has label and term (PRJ-7)."""
    return term_matches(texts, key, text, labelled).join(labelled.select("label", "term").distinct(), "term").select(
        key, "label").distinct()
