"""Message polarity, clean-up and multi-label mention flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.functions import messages as ms
from chorale.functions import text as tx

# Spelling variants per maker; the first one names the column.
MAKERS = [
    ["bmw"],
    ["daimler", "mercedes"],
    ["gm", "general motors"],
    ["tesla"],
    ["toyota"],
    ["vw", "volkswagen"],
]
# Terms of the two feature flags.
FEATURES = {
    "ELECTRIC_CARS": [
        "electric car", "electric vehicle", "electric motor", "hybrid vehicle",
        "Hybrid car", "elektroauto", "elektrofahrzeug", "hybridautos",
        "voiture hyprid", "coche híbrido", "Auto Hibrido", "vehículo híbrido",
        "elektrovehikel", "voiture électrique", "coche eléctrico",
    ],
    "AUTO_DRIVE": [
        "auto drive", "autodrive", "autonomous", "driverless", "self driving",
        "robotic", "autonomes", "selbstfahrendes", "autonome", "autónomo",
    ],
}


def label_names(groups: Sequence[Sequence[str]]) -> list[str]:
    return [variants[0].upper() for variants in groups]


def message_polarity(messages: DataFrame, sentiments: DataFrame, neutral_as: int = -1) -> DataFrame:
    """Messages with their mean polarity and its label (JOIN-1/2, AGG-10).

    The records are averaged first and joined once. A repeated message id would
    repeat all of its records alike, so the means equal those of a join before
    the grouping, and the shuffle carries one row per message and map task.
    Messages without records drop out.

    A message id may be repeated very often. AQE splits such an id where both sides of the
    join come straight from an exchange, so the means get one of their own, by a second key
    that follows from the id; where Spark broadcasts them it falls away.
    """
    means = (
        sentiments.groupBy("MESSAGE_ID")
        .agg(
            F.avg(ms.polarity_value(F.col("SENTIMENT_POLARITY"), neutral_as)).alias(
                "SENTIMENT_POLARITY"
            )
        )
        .withColumn("SENTIMENT", ms.polarity_label(F.col("SENTIMENT_POLARITY")))
    )
    twin = F.hash("MESSAGE_ID")
    return messages.withColumn("_twin", twin).join(means.withColumn("_twin", twin), ["MESSAGE_ID", "_twin"]).drop("_twin")


def clean_messages(joined: DataFrame) -> DataFrame:
    """The thirteen-column analysis table (PRJ-6)."""
    place = F.col("MESSAGE_LOCATION")
    return joined.select(
        F.col("MESSAGE_ID").cast("string").alias("MESSAGE_ID"),
        ms.midnight(F.col("MESSAGE_POSTED_TIME")).alias("POSTING_TIME"),
        "MESSAGE_BODY",
        "USER_GENDER",
        ms.upper_or_none(F.col("USER_STATE")).alias("USER_STATE"),
        ms.upper_or_none(F.col("USER_COUNTRY")).alias("USER_COUNTRY"),
        ms.upper_or_none(F.col("USER_CITY")).alias("USER_CITY"),
        "MESSAGE_LANGUAGE",
        ms.point_part(place, 1).alias("MESSAGE_LOCATION_LONGITUDE"),
        ms.point_part(place, 2).alias("MESSAGE_LOCATION_LATITUDE"),
        "SENTIMENT",
        F.col("USER_FOLLOWERS_COUNT").cast("int").alias("USER_FOLLOWERS_COUNT"),
        F.col("USER_FRIENDS_COUNT").cast("int").alias("USER_FRIENDS_COUNT"),
    )


def mention_flags(
    cleaned: DataFrame,
    groups: Sequence[Sequence[str]] = MAKERS,
    features: Mapping[str, Sequence[str]] = FEATURES,
    exact_terms: bool = False,
) -> DataFrame:
    """One boolean per label: any variant is a substring of the body (PRJ-7/8).

    Bodies are lower-cased. Feature terms are too, unless ``exact_terms`` asks
    for them as written, in which case a term with capitals never matches.
    """
    low = F.lower("MESSAGE_BODY")
    makers = [
        tx.contains_any(low, variants).alias(name)
        for name, variants in zip(label_names(groups), groups)
    ]
    parts = [
        tx.contains_any(low, [t if exact_terms else t.lower() for t in terms]).alias(name)
        for name, terms in features.items()
    ]
    return cleaned.select(
        "MESSAGE_ID",
        "MESSAGE_BODY",
        "SENTIMENT",
        "USER_GENDER",
        F.upper("USER_COUNTRY").alias("USER_COUNTRY"),
        "POSTING_TIME",
        ms.influence(F.col("USER_FOLLOWERS_COUNT"), F.col("USER_FRIENDS_COUNT")).alias("INFLUENCE"),
        *makers,
        *parts,
    )


def by_label(flags: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per message and label that holds, as column LABEL."""
    held = F.array_compact(F.array(*[F.when(F.col(name), F.lit(name)) for name in labels]))
    return flags.withColumn("LABEL", F.explode(held))
