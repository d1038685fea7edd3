"""Column expressions against plain Python on generated texts."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chorale.functions import messages as ms
from chorale.functions import text as tx
from chorale.operators import tags

PIECES = st.sampled_from(
    ["#", "#a", "#a,", "##", "a#b", " ", "  ", "\t", "\n", "\x0b", "\u00a0", "\u2003", "\u0085", "é", "x_1", "http://a", "-", "word"]
)
TEXTS = st.lists(st.lists(PIECES, max_size=8).map("".join), min_size=1, max_size=60)
WHITE = re.compile("[ \t\n\r\f\v]")


def _brute_tags(text):
    return [w for w in WHITE.split(text) if w.startswith("#")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_text_expressions(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    col = F.col("text")
    rows = df.select(
        col,
        tx.hashtags(col).alias("tags"),
        tx.hashtags(col, bare=False).alias("named"),
        tx.is_ascii(col).alias("ascii"),
        tx.ascii_only(col).alias("copy"),
        tx.word_count(col).alias("words"),
    ).collect()
    for r in rows:
        assert r.tags == _brute_tags(r.text)
        assert r.named == [t for t in _brute_tags(r.text) if len(t) > 1]
        assert r.ascii == r.text.isascii()
        assert r.copy == r.text.encode("ascii", "ignore").decode()
        assert r.words == len(re.findall(r"\w+", r.text, re.ASCII))
    counted = {r.tag: r.n for r in tags.hashtag_counts(df).collect()}
    assert counted == Counter(t for text in texts for t in _brute_tags(text))


PLACES = st.sampled_from(["pos ", "(", ")", " ", "42.5", "-71.1", "1e2", "x", "", "5f", "nan"])


def _brute_part(place, index):
    try:
        return float(place.split("(")[1].split(")")[0].split(" ")[index])
    except (IndexError, ValueError):
        return None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PLACES, max_size=7).map("".join), min_size=1, max_size=60))
def test_point_parts(spark, places):
    df = spark.createDataFrame([(p,) for p in places], "place string")
    for r in df.select("place", *[ms.point_part(F.col("place"), i + 1).alias(f"p{i}") for i in (0, 1)]).collect():
        for i in (0, 1):
            want, got = _brute_part(r.place, i), r[f"p{i}"]
            same = want is got is None or (want is not None and got is not None and (
                abs(want - got) <= 1e-5 * max(1.0, abs(want)) or want != want and got != got))
            assert same, (r.place, i, want, got)
