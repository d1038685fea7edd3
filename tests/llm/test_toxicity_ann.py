import random

import numpy as np
import pytest

from chorale.llm import ann, toxicity

INSULTS = ["scumbag", "idiots", "wretch"]


def labelled(n, seed):
    draw = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "ba ko mi tu".split() for b in "lor nem sid".split() for c in "ta ve zu po".split()]
    docs, labels = [], []
    for k in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(5, 120))]
        toxic = k % 7 == 0
        if toxic:
            for _ in range(draw.randrange(1, 9)):
                words.insert(draw.randrange(len(words)), draw.choice(INSULTS) + draw.choice(["", "!", ","]))
        docs.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = labelled(900, 1)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    return toxicity.fit(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_held_out_documents(spark, model):
    docs, labels = labelled(500, 2)
    found = {r.doc_id: r for r in toxicity.graded(spark.createDataFrame(docs, "doc_id bigint, text string"), model).collect()}
    wrong = sum((found[k].grade > 0) != bool(t) for k, _, t in labels)
    assert wrong <= 5
    few = [found[k].severity for k, _, t in labels if t and sum(dict(docs)[k].count(w) for w in INSULTS) <= 2]
    many = [found[k].severity for k, _, t in labels if t and sum(dict(docs)[k].count(w) for w in INSULTS) >= 8]
    assert np.mean(few) + 0.5 < np.mean(many) and all(0 <= r.severity <= 3 for r in found.values())


def test_thresholds_are_ordered_and_shared(model):
    assert (np.diff(model.thresholds) > 0).all() and len(model.weights) == len(model.features)


def test_odd_rows(documents, odd_rows, model):
    df = documents(odd_rows, extra=("g",)).withColumnRenamed("x0", "grade")
    assert toxicity.graded(df, model).count() == len(odd_rows)
    assert {r.severity for r in toxicity.graded(df.where("text is null or text = ''"), model).collect()}.__len__() == 1
    assert toxicity.graded(documents([]), model).count() == 0


def test_filter_keeps_columns_and_clean_rows(spark, documents):
    docs, labels = labelled(300, 3)
    df = documents(docs, extra=("s",)).withColumnRenamed("x0", "severity")
    rows = labels + [(None, 1, 1), (10**9, 1, 1), (5, None, None)]
    kept = toxicity.tolerable(df, spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int"))
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum((k in ids) == bool(t) for k, _, t in labels) <= 3
    none = toxicity.tolerable(df, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert none.count() == df.count()


def test_gradients_by_differences():
    draw = np.random.default_rng(1)
    rows, columns = np.repeat(np.arange(200), 3), draw.integers(0, 5, 600)
    truth = np.array([2.0, -1.0, 0.5, 0.0, 1.0])
    score = np.bincount(rows, truth[columns], 200)
    grades = (score[:, None] + draw.logistic(size=(200, 1)) > np.array([0.5, 2.0, 3.0])).sum(1)
    weights, cuts = toxicity.cumulative_link(rows, columns, np.ones(600), grades, 5, 3)

    def loss(w, c):
        above = 1 / (1 + np.exp(c[None, :] - np.bincount(rows, w[columns], 200)[:, None]))
        edge = np.c_[np.ones(200), above, np.zeros(200)]
        k = np.arange(200)
        return -np.log(edge[k, grades] - edge[k, grades + 1]).mean() + 0.5e-5 * (w @ w)

    best = loss(weights, cuts)
    for _ in range(50):
        assert loss(weights + draw.normal(0, 0.05, 5), np.sort(cuts + draw.normal(0, 0.05, 3))) >= best - 1e-4


def exact(rows, queries, top):
    out = {}
    for q, x in queries:
        near = sorted(((-float((np.array(v) * np.array(x)).sum()), i) for i, v in rows if i != q))[:top]
        out[q] = [(i, -s) for s, i in near]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_against_brute_force(spark):
    draw = np.random.default_rng(7)
    vectors = draw.normal(size=(1500, 16)) * draw.uniform(0.2, 3, (1500, 1))
    vectors[40:400] = vectors[3]  # a group of equal vectors
    rows = [(k, [float(a) for a in v]) for k, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    queries = [r for r in rows if r[0] % 20 == 0]
    found, wanted = result(ann.nearest(df, df.where("vec_id % 20 = 0"), shard_rows=400)), exact(rows, queries, 20)
    assert found.keys() == wanted.keys()
    hits = 0
    for q, near in wanted.items():
        assert len(found[q]) == 20
        scores = dict(near)
        for i, s in found[q]:
            assert s == pytest.approx(float(vectors[i] @ vectors[q]), abs=1e-12)
        assert found[q] == sorted(found[q], key=lambda p: (-p[1], p[0]))
        hits += len(scores.keys() & {i for i, _ in found[q]})
    assert hits >= 0.95 * 20 * len(wanted)


def test_unusable_and_repeated_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]),
            (5, [None, 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 2.0]), (7, [1.0, 2.0, 3.0]), (40, [2.0, 2.0]), (40, [2.0, 2.0]), (8, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, score string")
    found = result(ann.nearest(df, df.where("vec_id % 20 = 0")))
    assert found == {
        0: [(40, 2.0), (40, 2.0), (1, 1.0), (1, 1.0), (20, 0.0)], 20: [(40, 2.0), (40, 2.0), (1, 1.0), (1, 1.0), (0, 0.0)],
        40: [(1, 4.0), (1, 4.0), (0, 2.0), (20, 2.0)],
    }
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0
    one = df.where("vec_id = 0")
    assert ann.nearest(one, one).count() == 0


def recall(found, wanted):
    """Share of the wanted rows that are found, or one as near."""
    hits = total = 0
    for q, near in wanted.items():
        least = near[-1][1]
        hits += sum(s >= least - 1e-9 * abs(least) for _, s in found.get(q, []))
        total += len(near)
    return hits / total


@pytest.mark.parametrize("long", [None, 1e5, 1e20])
def test_recall_over_shards_and_uneven_lengths(spark, long):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(6000, 32))
    if long:
        vectors[17] *= long
        vectors[18:30] *= np.geomspace(1e-6, long, 12)[:, None]
    rows = [(k, [float(a) for a in v]) for k, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(8)
    asked = df.where("vec_id % 50 = 0")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = result(ann.nearest(df, asked, shard_rows=1500))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") in (before, str(256))
    assert recall(found, exact(rows, [r for r in rows if r[0] % 50 == 0], 20)) >= 0.95


def test_graphs_larger_than_their_first_nodes(monkeypatch):
    """Nodes inserted a batch at a time are found as well as the first ones."""
    monkeypatch.setattr(ann, "FIRST", 300)
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(60, 24))
    vectors = centres[draw.integers(0, 60, 5000)] + 0.2 * draw.normal(size=(5000, 24))
    vectors[100:400] = vectors[3]
    ids = np.arange(5000)
    index = ann.build(ids, vectors)
    on, links = index["layers"][0]
    assert len(on) == 5000 - 300 and links.max() < len(on)
    assert all(len(set(r[r >= 0].tolist())) == (r >= 0).sum() and k not in r for k, r in enumerate(links))
    q = ids[::25]
    wanted = {}
    for i, j, s in zip(*ann.search(index, q, vectors[::25], 20, None)):
        wanted.setdefault(int(i), []).append((int(j), float(s)))
    found = {}
    for i, j, s in zip(*ann.search(index, q, vectors[::25], 20, 128)):
        found.setdefault(int(i), []).append((int(j), float(s)))
    assert recall(found, wanted) >= 0.95
