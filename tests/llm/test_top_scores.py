import math
import random

import pytest

from chorale.llm import top_scores as ts


def brute(rows, top=5):
    fine = [
        (i, [math.floor(x) * 256 if abs(x) > 2**60 else math.floor(x * 256) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    askers = {}
    for i, v in rows:
        if i is not None and i % 50 == 0 and v is not None and all(x is not None and math.isfinite(x) for x in v):
            askers[i] = min(askers.get(i, v), v)
    out = []
    for q, vector in askers.items():
        own = [math.floor(x) * 256 if abs(x) > 2**60 else math.floor(x * 256) for x in vector]
        hold = lambda s: max(-ts.LIMIT, min(ts.LIMIT, s))
        found = sorted((-hold(sum(a * b for a, b in zip(own, v))), i) for i, v in fine if i != q and len(v) == len(own))
        out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(found[:top])]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    return sorted(tuple(r) for r in ts.top_scores(df, df.where("vec_id % 50 = 0"), **options).collect())


@pytest.mark.parametrize("bins", [4, 1024])
def test_matches_brute_force(spark, bins):
    draw = random.Random(bins)
    rows = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    rows += [(400 + i, [0.5] * 8) for i in range(200)]  # ties
    assert run(spark, rows, bins=bins, block_rows=90, block_queries=5) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, [None, 1.0]), (5, [0.0, 0.0]), (6, []), (50, []),
        (100, [1.0, 1.0, 1.0]), (7, [2.0, 2.0, 2.0]), (150, [-0.001, 3.0]), (None, [9.0, 9.0]),
    ]
    rows += [(8, [1.0, 1.0])] * 7 + [(9, [1.0, 1.0])] * 3 + [(0, [0.5, 7.0])] * 2
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, [(0, [1.0])]) == []


def test_large_numbers_stay_exact_or_held(spark):
    rows = [(0, [2.0**20, 1.0]), (50, [3e18, 1.0]), (100, [1e300, -1e300]), (1, [2.0**20, 3.0]), (2, [2.0**20, 2.0]),
            (3, [2.0**22 + 0.004, 1.0]), (4, [1e200, 1.0]), (5, [-1e307, 4.0])]
    assert run(spark, rows, bins=64) == brute(rows)


def test_one_vector_under_many_ids_and_rows_of_one_id(spark):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(900)] + [(77, [3.0, 3.0, 3.0, 3.0])] * 500
    assert run(spark, rows, block_rows=100) == brute(rows)
    df = spark.createDataFrame([(0, [1.0], "a", 5), (1, [2.0], "b", 6)], "vec_id bigint, embedding array<double>, score string, low int")
    assert [tuple(r) for r in ts.top_scores(df, df.where("vec_id = 0")).collect()] == [(0, 1, 1, 131072)]
