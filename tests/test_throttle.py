import random

from pyspark.sql import functions as F

from chorale.operators import throttle as th


def _brute(events, gap, carry=None):
    """events: (key, ms, id). Greedy scan per key."""
    last, out = dict(carry or {}), []
    for key, ms, mid in sorted(events, key=lambda e: (e[1], e[2])):
        if key not in last or ms - last[key] > gap:
            last[key] = ms
            out.append((key, ms, mid))
    return sorted(out), last


def _frame(spark, events):
    df = spark.createDataFrame(events, "key string, ms bigint, id bigint")
    return df.withColumn("ts", F.timestamp_millis("ms"))


def _run(spark, events, gap, **more):
    out = th.throttle(_frame(spark, events), "key", "ts", "id", gap, **more)
    return sorted(tuple(r) for r in out.collect())


def test_golden_gap(spark):
    events = [("k", ms, i) for i, ms in enumerate([1000, 1100, 1200, 1201, 1350, 1402])]
    assert [ms for _, ms, _ in _run(spark, events, 200)] == [1000, 1201, 1402]


def test_dense_hot_key_across_many_small_blocks(spark):
    rng = random.Random(7)
    events = [("hot", rng.randrange(0, 20_000), i) for i in range(6000)]
    events += [(f"k{i % 9}", rng.randrange(0, 20_000), 10_000 + i) for i in range(400)]
    for gap, block in ((200, 250), (37, 1000), (0, 500), (900, 300)):
        assert _run(spark, events, gap, block_ms=block) == _brute(events, gap)[0], (gap, block)


def test_times_before_1970(spark):
    events = [("k", ms, ms + 5000) for ms in (-1500, -1400, -1299, -1, 0, 150, 201)]
    assert _run(spark, events, 200, block_ms=300) == _brute(events, 200)[0]


def test_two_runs_with_carry_equal_one(spark):
    rng = random.Random(3)
    events = [(f"k{rng.randrange(3)}", rng.randrange(0, 9000), i) for i in range(900)]
    early, late = [e for e in events if e[1] < 4000], [e for e in events if e[1] >= 4000]
    first = th.throttle(_frame(spark, early), "key", "ts", "id", 200, block_ms=500)
    carry = th.last_sent(first)
    second = th.throttle(_frame(spark, late), "key", "ts", "id", 200, carry=carry, block_ms=500)
    both = sorted(tuple(r) for r in first.unionByName(second).collect())
    assert both == _brute(events, 200)[0]
    merged = {r.key: r.sent_ms for r in th.last_sent(second, carry).collect()}
    assert merged == _brute(events, 200)[1]


def test_carry_inside_a_block_and_late_messages(spark):
    rng = random.Random(11)
    events = [(f"k{rng.randrange(3)}", rng.randrange(0, 9000), i) for i in range(900)]
    # Runs split inside a block, and some early messages arrive with the second run.
    early = [e for e in events if e[1] < 4321 and e[2] % 5]
    late = [e for e in events if e not in early]
    for block in (100, 700, 5000, 100_000):
        first = th.throttle(_frame(spark, early), "key", "ts", "id", 200, block_ms=block)
        sent, last = _brute(early, 200)
        assert sorted(tuple(r) for r in first.collect()) == sent
        second = th.throttle(
            _frame(spark, late), "key", "ts", "id", 200, carry=th.last_sent(first), block_ms=block
        )
        assert sorted(tuple(r) for r in second.collect()) == _brute(late, 200, last)[0], block


def test_wall_clock_millis(spark):
    df = spark.sql("select timestamp_ntz'2024-03-31 02:30:00.123999' a, timestamp'2024-03-31 02:30:00.123999' b")
    row = df.select(th.millis(df, "a").alias("a"), th.millis(df, "b").alias("b")).first()
    assert row.a == row.b == 1711852200123


def test_no_row_holds_a_long_block_or_a_batch(spark, monkeypatch):
    # A dense key over more than a block, at a gap of many blocks, without and with a carry.
    kept, plain = [], th.stored
    monkeypatch.setattr(th, "BLOCK_ROWS", 600_000 // 400)
    monkeypatch.setattr(th, "stored", lambda df: kept.append(plain(df)) or kept[-1])
    events = [("hot", ms, ms) for ms in range(0, 2_400_000, 400)] + [("b", 5, -1), ("b", 30_000_000, -2)]
    for gap, carry in ((7_000, None), (900_000, None), (7_000, 350_100), (200, 350_100)):
        kept.clear()
        given = None if carry is None else spark.createDataFrame([("hot", carry), ("x", 1)], "key string, sent_ms bigint")
        found = _run(spark, events, gap, carry=given)
        assert found == _brute(events, gap, carry and {"hot": carry})[0], (gap, carry)
        assert max(r[0] for r in kept[0].select(F.size("rows")).collect()) == 600_000 // 400
        # The summaries hold the first gap of each block, not its messages.
        assert kept[1].groupBy("key", "block").count().agg(F.max("count")).first()[0] <= gap // 400 + 2
        assert all(t not in str(k.dtypes) for k in kept[1:] for t in ("array", "map"))


def test_left_out_messages_are_counted(spark):
    rows = [(None, 1, 1), (None, None, 2), ("k", None, 3), ("k", 5, 4), ("k", 100, 5), ("k", 900, 6), ("new", 1, 7)]
    carry = spark.createDataFrame([("k", 100)], "key string, sent_ms bigint")
    assert tuple(th.left_out(_frame(spark, rows), "key", "ts", carry).first()) == (2, 1, 1)
    assert tuple(th.left_out(_frame(spark, rows), "key", "ts").first()) == (2, 1, 0)


def test_blocks_are_as_long_as_their_messages_allow(spark, monkeypatch):
    timed = spark.createDataFrame([("k", ms) for ms in range(0, 4_800_000, 4000)] + [("x", 5)], "key string, ms bigint")
    assert th.block_length(timed) == 600_000 * 8**7
    for most, length in ((1199, 600_000), (1200, 600_000 * 8**7), (10, 600_000)):
        monkeypatch.setattr(th, "BLOCK_ROWS", most)
        assert th.block_length(timed) == length
    later = timed.unionByName(timed.select("key", (F.col("ms") + 600_000 * 64).alias("ms")))
    monkeypatch.setattr(th, "BLOCK_ROWS", 1200)
    assert th.block_length(later) == 600_000 * 64
    assert th.block_length(timed.where("ms < 0")) == 600_000
