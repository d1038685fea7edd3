"""Score reports over posts with one column per tone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.functions import scores as sc
from chorale.operators.rows import unpivot_row
from chorale.schemas import TONES


def flatten_payload(posts: DataFrame, payload: str = "payload") -> DataFrame:
    """Replace a nested tone payload by the fixed score columns (PRJ-1, PRJ-2)."""
    flat = posts.withColumn("_scores", sc.payload_scores(F.col(payload)))
    kept = [c for c in posts.columns if c != payload]
    return flat.select(*kept, *sc.score_columns(F.col("_scores")))


def score_distribution(
    posts: DataFrame, tones: Sequence[str] = tuple(TONES), limit: float = 60
) -> DataFrame:
    """Posts above the limit per tone, in one pass; zero counts stay (AGG-2)."""
    totals = posts.agg(*[F.count_if(F.col(t) > limit).alias(t) for t in tones])
    return unpivot_row(
        totals, [F.struct(F.lit(t).alias("emotion"), F.col(t).alias("n")) for t in tones]
    )


def scores_above(
    posts: DataFrame,
    ids: Sequence[str],
    tones: Sequence[str] = tuple(TONES),
    limit: float = 60,
) -> DataFrame:
    """Long form (id…, emotion, score) of the scores above the limit (AGG-3)."""
    return posts.unpivot(list(ids), list(tones), "emotion", "score").where(F.col("score") > limit)


def author_averages(posts: DataFrame, tones: Sequence[str] = ("Anger", "Disgust")) -> DataFrame:
    return posts.groupBy("author", "userid").agg(*[F.avg(t).alias(t) for t in tones])
