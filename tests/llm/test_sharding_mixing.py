import random
import zlib

import numpy as np
import pytest

from chorale.llm import mixing, sharding


def test_shards_are_contiguous_and_near_equal(documents):
    draw = random.Random(1)
    rows = [(k, "é" * draw.randrange(60)) for k in draw.sample(range(10_000), 700)] + [(10_001, None), (None, "x"), (10_002, "")]
    found = sorted(sharding.shard_documents(documents(rows)).collect(), key=lambda r: (r.shard, r.slot))
    assert len(found) == len(rows) and {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    sizes = [sum(r.size for r in found if r.shard == k) for k in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in found)
    for k in range(8):
        assert [r.slot for r in found if r.shard == k] == list(range(sum(r.shard == k for r in found)))
    ids = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert ids == sorted(ids)
    texts = dict(rows)
    for r in found:
        body = (texts[r.doc_id] or "").encode()
        assert r.size == len(body) + 1 and r.text_crc32 == zlib.crc32(body)


def test_repeated_rows_few_rows_and_no_rows(documents):
    same = sharding.shard_documents(documents([(1, "same")] * 40)).collect()
    assert sorted((r.shard, r.slot) for r in same) == [(k, s) for k in range(8) for s in range(5)]
    assert sharding.shard_documents(documents([(1, "a")])).first().slot == 0
    assert sharding.shard_documents(documents([])).count() == 0


def test_positions_are_prefix_sums(spark):
    df = spark.range(1000).selectExpr("(id * 37) % 1000 as k", "id % 7 as size", "'c' as row_text")
    placed, rows, total = sharding.positions(df, ["k"], "size")
    found = sorted(placed.collect(), key=lambda r: r.k)
    assert rows == 1000 and total == sum(r["size"] for r in found)
    before = 0
    for k, r in enumerate(found):
        assert (r.row_number, r.size_before) == (k, before)
        before += r["size"]


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in fixed]
        if not open_:
            return fixed
        level = (total - sum(fixed.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > most * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in open_}
        fixed |= {s: most * sizes[s] for s in over}


def mixed_rows(seed, n=3000):
    draw = random.Random(seed)
    sources = ["a", "b", "B", "é", None, "tiny"]
    rows = []
    for k in range(n):
        s = draw.choices(sources, [30, 10, 5, 5, 5, 0.5])[0]
        rows.append((k, " ".join(["w"] * min(600, int(draw.paretovariate(1.2) * 3))), s))
    return rows + [(n, None, "a"), (n + 1, "", "a")]


def test_targets_and_words_taken(documents):
    rows = mixed_rows(4)
    df = documents(rows)
    found = mixing.mixed_sizes(df).collect()
    assert len(found) == len(rows)
    source = {r[0]: r[2] for r in rows}
    sizes, taken, count = {}, {}, {}
    for r in found:
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    wanted = targets(sizes)
    for r in found:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(wanted[s], rel=1e-12)
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= max(3, 0.002 * wanted[s])
    again = mixing.mixed_sizes(df.repartition(7)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_flight_keeps_both_sums():
    draw = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 500):
        p, sizes = draw.random(n), draw.integers(1, 40, n).astype(float)
        before = p.sum(), p @ sizes
        left = mixing.flight(p, sizes, draw.random)
        assert len(left) <= 2 and all(0 < p[x] < 1 for x in left)
        assert all(p[k] in (0, 1) for k in range(n) if k not in left)
        assert np.allclose((p.sum(), p @ sizes), before)


def test_inclusion_follows_the_probability():
    hits = np.zeros(30)
    for seed in range(1500):
        p = np.full(30, 0.3)
        mixing.flight(p, np.arange(1.0, 31.0), np.random.default_rng(seed).random)
        hits += p
    assert np.abs(hits / 1500 - 0.3).max() < 0.06


def test_many_blocks_meet_in_rounds(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 40)
    rows = mixed_rows(9, 1200)
    found = mixing.mixed_sizes(documents(rows)).collect()
    source = {r[0]: r[2] for r in rows}
    for s in set(source.values()):
        mine = [r for r in found if source[r.doc_id] == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)


def test_rows_of_one_id_are_drawn_as_one(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 50)
    rows = mixed_rows(2, 300) + [(5000, "w w w w", "a")] * 2000 + [(None, "w w", "b")] * 500
    found = mixing.mixed_sizes(documents(rows)).collect()
    assert len(found) == len(rows)
    same = [r for r in found if r.doc_id == 5000]
    rate = same[0].target / same[0].source_size
    assert len(same) == 2000 and abs(sum(r.taken for r in same) - 2000 * 4 * rate) <= 4
    assert {r.taken // 4 for r in same} <= {int(rate), int(rate) + 1}
    again = mixing.mixed_sizes(documents(rows).repartition(5)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))


def test_mixture_repeats_rows(documents):
    rows = mixed_rows(6, 400) + [(7, "w w w", "b"), (7, "w w w", "b"), (None, "q q", None)]
    df = documents(rows, extra=("z",)).withColumnRenamed("x0", "copies")
    drawn, out = mixing.choose(df), mixing.mixture(df)
    assert out.columns == df.columns and out.count() == drawn.agg({"copies": "sum"}).first()[0]
    assert mixing.mixture(documents([])).count() == 0 and mixing.mixed_sizes(documents([(1, None)])).first().taken == 0
