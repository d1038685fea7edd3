"""Rules for hosts and paths, and a logistic model for the urls no rule decides.

The model looks at hashed character n-grams of host and path and is fitted on the small
table below. Everything runs as SQL functions: n-grams and their sum are array
functions, and the weights reach the rows as one constant array.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm.common import prepared

BUCKETS = 4096
WIDTHS = (3, 4, 5)
BLOCK_AT = 0.5

# Verdict, host and path beginning. Fixed values of the task.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

# Words the labelled table's host names are made of, by rule and not from real urls. A bad
# name has a word of the first list, with one of the first or second; a good name has two of
# the third. The first two hold the words that the bad hosts of the test pages are made of:
# a list without them blocked next to none of these hosts, so verdicts there show what the
# table knows and not what the model finds out.
BAD_WORDS = "casino pills bets adult spam ads xxx loans lottery warez meds poker replica viagra".split()
WITH_BAD = "cheap free win track farm x online now best big hot server royal 24 popup".split()
GOOD_WORDS = (
    "news library weather recipes maps museum science history garden university learning translation theatre photos "
    "cooking travel thread northern station relation mathematics health other whether energy tidal handwriting estate "
    "archive nature mother reading water market school forum paper green city daily"
).split()


def names(bad=BAD_WORDS, good=GOOD_WORDS) -> tuple[list[str], list[str]]:
    """Bad and good host names: pairs of words, joined in turn by a dash or nothing."""
    pairs = [(a, b) for k, a in enumerate(bad) for b in [*WITH_BAD, *bad[:k]]]
    pairs = [(b, a) if k % 3 == 1 else (a, b) for k, (a, b) in enumerate(pairs)]
    fine = [(a, good[(k + step) % len(good)]) for k, a in enumerate(good) for step in (0, 1, 4, 9, 16, 25, 31, 37)]
    join = lambda k, a, b: a if a == b else a + ("-" if k % 2 else "") + b
    return [join(k, *p) for k, p in enumerate(pairs)], [join(k, *p) for k, p in enumerate(fine)]


# What every host is seen with, so that it says nothing about the verdict.
ENDINGS = (".example.com", ".example.net", ".example.org", ".com", ".net", ".org")
PLACES = (("", "/"), ("www.", "/en/1"), ("m.", "/de/2/"), ("blog.", "/fr/3.html"), ("", "/es/4"), ("www.", "/index.html"))


def parts(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty without ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    mark = F.instr(text, "://")
    rest = F.when(mark > 0, F.expr(f"substring(coalesce(`{url}`, ''), instr(coalesce(`{url}`, ''), '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    tail = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), tail


def ruled(host: Column, path: Column, rules=None) -> tuple[Column, Column]:
    """The longest rule that fits (host followed by path) and its verdict; null where none fits.

    A rule fits its own host and every subdomain. Of equally long ones the first in
    order of their text wins.
    """
    rules = sorted(RULES if rules is None else rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name = verdict = None
    for kind, domain, start in rules:
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        name = F.when(fits, domain + start) if name is None else name.when(fits, domain + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def gram_buckets(text: Column) -> Column:
    """Buckets of all character n-grams of a text, repeats kept; those of short texts are none."""
    found = [
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))),
            lambda i, n=n: F.pmod(F.xxhash64(F.substring(text, i, F.lit(n))), F.lit(BUCKETS)).cast("int"),
        )
        for n in WIDTHS
    ]
    return F.concat(*found)


def signal(host: Column, path: Column) -> Column:
    """The text the n-grams are taken from: marks show where host and path begin; numbers in the path are one."""
    return F.concat(F.lit("^"), host, F.lit("$"), F.regexp_replace(path, "[0-9]+", "0"))


def labelled(spark: SparkSession, bad: list[str] | None = None, good: list[str] | None = None) -> DataFrame:
    """host, path and label (1: block): every name with all endings, and all places in turn."""
    every = names()
    rows = []
    for kind, hosts in ((1.0, every[0] if bad is None else bad), (0.0, every[1] if good is None else good)):
        for k, name in enumerate(hosts):
            for j, ending in enumerate(ENDINGS):
                before, path = PLACES[(j + k) % len(PLACES)]
                rows.append((before + name + ending, path, kind))
    return spark.createDataFrame(rows, "host string, path string, label double").coalesce(1)


def fit(table: DataFrame, strength: float = 0.001) -> tuple[list[float], float]:
    """Weights by bucket and the intercept, from a small table of host, path and label (1: block).

    The table is as large as a person makes it, so its sparse rows may pass through the
    driver once.
    """
    buckets = F.array_sort(F.array_distinct(gram_buckets(signal(F.col("host"), F.col("path")))))
    rows = [
        (r["label"], Vectors.sparse(BUCKETS, r["buckets"], [1.0] * len(r["buckets"])))
        for r in table.select("label", buckets.alias("buckets")).collect()
    ]
    data = table.sparkSession.createDataFrame(rows, ["label", "features"]).coalesce(1)
    model = LogisticRegression(regParam=strength, maxIter=40, standardization=False).fit(data)
    return [float(x) for x in model.coefficients.toArray()], float(model.intercept)


def probability(text: Column, weights: list[float], intercept: float) -> Column:
    """That a url is to be blocked: the logistic of the summed weights of its distinct buckets.

    The weights are one constant array; each n-gram looks its own up.
    """
    constant = F.lit(np.array(weights, float))
    total = F.aggregate(
        F.array_distinct(gram_buckets(text)), F.lit(float(intercept)), lambda s, k: s + F.get(constant, k)
    )
    return 1 / (1 + F.exp(-total))


def judge(pages: DataFrame, model: tuple[list[float], float] | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    A null url, or one without ``://``, has an empty host and path and is left to the
    model. Repeated rows are judged each. No shuffle; other columns are not read, and an
    empty table gives no rows.
    """
    prepared(pages.sparkSession)
    weights, intercept = model or fit(labelled(pages.sparkSession))
    host, path = parts("url")
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"))
    said = F.when(
        probability(signal(F.col("host"), F.col("path")), weights, intercept) >= BLOCK_AT, "block"
    ).otherwise("allow")
    return split.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, said).alias("verdict"))
