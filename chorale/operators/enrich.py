"""Pluggable scoring of texts (UDF-5)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Scorer = Callable[[DataFrame], DataFrame]


def enrich(posts: DataFrame, scorer: Scorer, key: str) -> DataFrame:
    """Posts with a ``scores`` map; a post the scorer says nothing of keeps null.

    The join moves the columns that are asked for afterwards: a report that reads no text
    moves none.
    """
    return posts.join(scorer(posts), key, "left")


def scored_only(posts: DataFrame, scores: str = "scores") -> DataFrame:
    return posts.where(F.col(scores).isNotNull())


def score_column(score: Callable[[str], Mapping[str, float] | None], text: Column) -> Column:
    """Scores of a user's own Python function, by Arrow batches (UDF-1).

    A struct of ``scores`` and ``error``: where the function fails on a text the scores are
    null, the message is kept and the job goes on. Being row by row, it serves streams too.
    """

    @F.pandas_udf("scores map<string,double>, error string")
    def run(texts: pd.Series) -> pd.DataFrame:
        def one(t):
            try:
                return (dict(found) if t is not None and (found := score(t)) is not None else None), None
            except Exception as problem:
                return None, f"{type(problem).__name__}: {problem}"

        rows = [one(t) for t in texts]
        return pd.DataFrame({"scores": pd.Series([r[0] for r in rows], dtype=object),
                             "error": pd.Series([r[1] for r in rows], dtype=object)})

    return run(text)


def loaded_scores(
    load: Callable[[], Callable[[Sequence[str]], Sequence[Mapping[str, float] | None]]], text: Column
) -> Column:
    """Scores of a model that is loaded once per task and takes many texts at a time (UDF-1).

    ``load`` runs in the worker before its first text and gives a function from a list of
    texts to their scores, one entry each. Where that function fails on a list, its texts
    are scored one by one, so only those that fail themselves come out with null scores and
    an ``error``. Null texts are not handed to it and have neither.
    """

    def one_by_one(score, texts: list[str]) -> list[tuple]:
        rows = []
        for t in texts:
            try:
                rows.append((score([t])[0], None))
            except Exception as problem:
                rows.append((None, f"{type(problem).__name__}: {problem}"))
        return rows

    @F.arrow_udf("scores map<string,double>, error string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = load()
        kind = pa.struct([("scores", pa.map_(pa.string(), pa.float64())), ("error", pa.string())])
        for batch in batches:
            texts = batch.to_pylist()
            given = [t for t in texts if t is not None]
            try:
                scored = [(s, None) for s in score(given)] if given else []
                if len(scored) != len(given):
                    raise ValueError(f"{len(scored)} scores of {len(given)} texts")
            except Exception:
                scored = one_by_one(score, given)
            left = iter(scored)
            rows = [next(left) if t is not None else (None, None) for t in texts]
            yield pa.array(
                [{"scores": None if s is None else [(k, float(v)) for k, v in s.items()], "error": e} for s, e in rows], kind
            )

    return run(text)


def lexicon_scores(posts: DataFrame, lexicon: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Mean term weight per post and tone, held to 0–1, in long form.

    ``lexicon`` has (term, tone, weight). Words go from the text into the join, with no
    shuffle of their own before it: a lexicon Spark finds small enough to broadcast drops the
    others where they are read, and what is left is added up per post and tone there; a larger
    one is joined by term, where the words of a common term are split by AQE.
    """
    words = posts.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"\w+"), F.lit(0))).alias("term"))
    mean = F.avg("weight")
    return (
        words.join(lexicon, "term")
        .groupBy(key, "tone")
        .agg(F.least(F.lit(1.0), F.greatest(F.lit(0.0), mean)).alias("score"))
    )


def lexicon_scorer(lexicon: DataFrame, key: str, text: str = "text") -> Scorer:
    """A scorer that gives every post its map of lexicon scores."""

    def score(posts: DataFrame) -> DataFrame:
        # One entry per tone, so the list is as long as the tone set at most.
        return (
            lexicon_scores(posts, lexicon, key, text)
            .groupBy(key)
            .agg(F.map_from_entries(F.collect_list(F.struct("tone", "score"))).alias("scores"))
        )

    return score
