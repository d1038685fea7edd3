"""Toxicity as ordered severity grades: cumulative-link regression on sparse text features.

Features are hashed words and word beginnings. Those that go with toxic labels are chosen
on a bounded sample of labelled documents. The labels say toxic or not and no more, so the
grades 1 to 3 of a toxic document are made here, from how often the chosen features occur in
it: severity beyond the label is read off the same words that the model sees, and says how
much of them a document holds. One weight vector serves
all thresholds: P(grade >= k) = logistic(weights . x - threshold k). A document's severity
is its expected grade, and it is rejected when grade 1 or more is likelier than not.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import kept, per_batch, prepared, text_column
from chorale.llm.words import U, word_hashes

SAMPLE = 20_000  # labelled documents the model is fitted on at most, by a hash of their id
# What of the sample's features the model is made of; parameters of fit().
CANDIDATES = 50_000  # looked at closely at most, the most frequent in toxic documents
FEATURES = 2_000  # taken at most, those that tell most
LEAST_SHARE = 0.004  # of toxic documents a feature must occur in
LEAST_ODDS = 12.0  # times it must be likelier in toxic documents than in others
PREFIXES = (4, 5, 6, 7)
GRADES = (1, 4, 8)  # occurrences from which a toxic document has grade 1, 2, 3

# Bytes that part words here: everything in ASCII but letters.
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_BETWEEN = ~_LETTERS


@dataclass(frozen=True)
class Model:
    """Feature hashes (sorted), their weights, and the thresholds of the grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """P(grade >= k) of n documents from their sparse features."""
        score = np.bincount(rows, self.weights[columns] * values, n) if len(rows) else np.zeros(n)
        return 1 / (1 + np.exp(self.thresholds[None, :] - score[:, None]))


def _hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash rows (words and beginnings) and the text of each word."""
    *_, hashed, first = word_hashes(column, True, _BETWEEN, PREFIXES)
    return hashed, np.repeat(np.arange(len(column)), np.diff(first))


def _counts(column: pa.Array, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature position and number of occurrences, for the features given (sorted)."""
    hashed, row = _hashes(column)
    if not len(features) or not hashed.size:
        return (np.zeros(0, np.int64),) * 3
    maybe = np.zeros(1 << 20, bool)
    maybe[features >> U(44)] = True
    line, word = np.nonzero(maybe[hashed >> U(44)])
    value = hashed[line, word]
    at = np.minimum(np.searchsorted(features, value), len(features) - 1)
    hit = features[at] == value
    pairs, times = np.unique(row[word[hit]] * len(features) + at[hit], return_counts=True)
    return pairs // len(features), pairs % len(features), times


def _frequencies(features: np.ndarray | None):
    """In how many documents features occur: of all features, or of those given."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = text_column(batch, "text")
        if features is None:
            hashed, row = _hashes(column)
            order = np.argsort(hashed, axis=None, kind="stable")
            flat, rows = hashed.ravel()[order], np.tile(row, len(hashed))[order]
            new = np.r_[True, (flat[1:] != flat[:-1]) | (rows[1:] != rows[:-1])] if len(flat) else np.zeros(0, bool)
            found, times = np.unique(flat[new & (flat != 0)], return_counts=True)
        else:
            at, times = np.unique(_counts(column, features)[1], return_counts=True)
            found = features[at]
        return pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(times, pa.int64())], names=["feature", "n"]
        )

    return per_batch(work)


def _examples(features: np.ndarray):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, at, times = _counts(text_column(batch, "text"), features)
        ends = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (at, times)]
        return pa.RecordBatch.from_arrays([batch.column("toxic"), *lists], names=["toxic", "at", "times"])

    return per_batch(work)


def cumulative_link(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int, top: int,
    strength: float = 1e-5, steps: int = 800,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of a cumulative logit model, by Adam on all examples.

    The first threshold and the logarithms of the gaps to the next ones are the free
    parameters, so thresholds stay in order.
    """
    n = len(grades)
    weights, shape = np.zeros(width), np.r_[2.0, np.zeros(top - 1)]
    first, second = np.zeros(width + top), np.zeros(width + top)
    for step in range(1, steps + 1):
        gaps = np.exp(shape[1:])
        cut = shape[0] + np.r_[0, np.cumsum(gaps)]
        score = np.bincount(rows, weights[columns] * values, n) if len(rows) else np.zeros(n)
        above = 1 / (1 + np.exp(np.clip(cut[None, :] - score[:, None], -40, 40)))
        edge = np.c_[np.ones(n), above, np.zeros(n)]
        slope = np.c_[np.zeros(n), above * (1 - above), np.zeros(n)]
        k = np.arange(n)
        chance = np.maximum(edge[k, grades] - edge[k, grades + 1], 1e-12)
        up = -slope / chance[:, None]
        by_cut = np.zeros((n, top + 2))
        by_cut[k, grades] += up[k, grades]
        by_cut[k, grades + 1] -= up[k, grades + 1]
        toward = by_cut.sum(1) / n  # d loss / d score
        g_weights = np.bincount(columns, toward[rows] * values, width) + strength * weights if len(rows) else strength * weights
        g_cut = -by_cut[:, 1:-1].sum(0) / n
        g_shape = np.r_[g_cut.sum(), [g_cut[j:].sum() * gaps[j - 1] for j in range(1, top)]]
        grad = np.r_[g_weights, g_shape]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, shape = weights - move[:width], shape - move[width:]
    return weights, shape[0] + np.r_[0, np.cumsum(np.exp(shape[1:]))]


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, candidates: int = CANDIDATES, most: int = FEATURES,
    least_share: float = LEAST_SHARE, least_odds: float = LEAST_ODDS,
) -> Model:
    """A model from the documents of at most ``sample`` labels.

    The model is sparse: of the features that occur in ``least_share`` of the sample's toxic
    documents, the ``candidates`` most frequent are compared with the other documents, and of
    those ``least_odds`` times likelier in toxic ones the ``most`` telling are taken. All of
    this is a choice on the bounded sample; documents are scored whole. Labels without a
    doc_id or grade, or of documents that are not there, are left out; repeated labels of a
    document count as the highest, repeated rows of a document each. Without any toxic
    example, as with either table empty, nothing is rejected.
    """
    prepared(docs.sparkSession)
    chosen = (
        labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # At most ``sample`` rows of two numbers.
    seen = kept(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic"))
    sizes = {int(r["toxic"]): r["count"] for r in seen.groupBy("toxic").count().collect()}
    bad, fine = sizes.get(1, 0), sizes.get(0, 0)
    if not bad:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(len(GRADES), 30.0))

    def frequencies(rows: DataFrame, features: np.ndarray | None) -> DataFrame:
        return rows.select("text").mapInArrow(_frequencies(features), "feature bigint, n bigint").groupBy("feature").agg(
            F.sum("n").alias("n"))

    toxic = (
        frequencies(seen.where("toxic = 1"), None).where(F.col("n") >= max(3, least_share * bad))
        .orderBy(F.desc("n"), "feature").limit(candidates).collect()
    )
    names = np.array([r["feature"] for r in toxic], np.int64).view(np.uint64)
    order = np.argsort(names)
    names, often = names[order], np.array([r["n"] for r in toxic])[order]
    rare = {r["feature"]: r["n"] for r in frequencies(seen.where("toxic = 0"), names).collect()}
    other = np.array([rare.get(int(x), 0) for x in names.view(np.int64)])
    odds = (often / bad) / ((other + 0.5) / (fine + 1))
    good = np.flatnonzero(odds >= least_odds)
    good = np.sort(good[np.argsort(-odds[good] * np.sqrt(often[good]), kind="stable")[:most]])
    features = names[good]
    examples = seen.mapInArrow(_examples(features), "toxic int, at array<int>, times array<int>").collect()
    counts = np.array([len(r["at"]) for r in examples])
    rows = np.repeat(np.arange(len(examples)), counts)
    columns = np.array([x for r in examples for x in r["at"]], np.int64)
    times = np.array([x for r in examples for x in r["times"]], float)
    label = np.array([int(r["toxic"] or 0) for r in examples])
    # A word counts once, though it may be a feature by itself and by its beginnings.
    most = np.zeros(len(examples))
    np.maximum.at(most, rows, times)
    total = np.maximum(most, np.bincount(rows, times, len(examples)) / (1 + len(PREFIXES)) if len(rows) else 0)
    grades = np.where(label > 0, 1 + sum((total >= g).astype(int) for g in GRADES[1:]), 0)
    weights, thresholds = cumulative_link(rows, columns, np.log1p(times), grades, len(features), len(GRADES))
    return Model(features, weights, thresholds)


def _score(model: Model, severity: str, grade: str):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = text_column(batch, "text")
        rows, at, times = _counts(column, model.features)
        chances = model.chances(rows, at, np.log1p(times), len(column))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(chances.sum(1)), pa.array((chances >= 0.5).sum(1).astype(np.int32))],
            names=[*batch.schema.names, severity, grade],
        )

    return per_batch(work)


def graded(docs: DataFrame, model: Model, severity: str = "severity", grade: str = "grade") -> DataFrame:
    """All columns of the documents, severity (expected grade, 0 to 3) and grade (0: not toxic).

    A null or empty text has the lowest severity. Columns of these names are replaced.
    Rows are scored where they are read.
    """
    prepared(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (severity, grade)]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    return docs.select(*rest).mapInArrow(
        _score(model, severity, grade), f"{fields}, `{severity}` double, `{grade}` int"
    )


def severities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, severity, grade and toxic (0/1) of every document, repeated rows each; none of an empty table."""
    found = graded(docs.select("doc_id", "text"), fit(docs, labels))
    return found.select("doc_id", "severity", "grade", (F.col("grade") > 0).cast("int").alias("toxic"))


def tolerable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, columns as they were."""
    found = graded(docs, fit(docs, labels), "_severity_", "_grade_")
    return found.where("_grade_ = 0").select(*docs.columns)
