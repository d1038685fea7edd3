import random
import re

import numpy as np
import pytest

from chorale.llm import jaccard_join as jj
from chorale.llm.components import components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = list(range(len(sets)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                label[root(a)] = root(b)
    groups = {}
    for k in range(len(sets)):
        groups.setdefault(root(k), []).append(sets[k][0])
    smallest = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(
        ((i, len(s), smallest[root(k)] if s else i) for k, (i, s) in enumerate(sets)), key=repr
    )


def families(seed, edits):
    draw = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(300)]
    rows = []
    for _ in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([3, 6, 12, 30, 80, 250]))]
        for _ in range(draw.randrange(1, 8)):
            words = list(base)
            for _ in range(draw.randrange(edits)):
                at = draw.randrange(len(words))
                words[at : at + draw.randrange(2)] = [draw.choice(vocabulary)]
            if draw.random() < 0.3:
                words = words[: max(1, int(len(words) * draw.uniform(0.7, 1)))]
            rows.append((len(rows), " ".join(w.upper() if draw.random() < 0.1 else w for w in words)))
    return rows


@pytest.mark.parametrize("seed,edits", [(1, 2), (2, 5), (3, 9)])
def test_matches_brute_force(documents, seed, edits):
    rows = families(seed, edits)
    found = sorted((tuple(r) for r in jj.similar(documents(rows)).collect()), key=repr)
    assert found == brute(rows)


def test_odd_rows(documents, odd_rows):
    rows = odd_rows + [(9, "ONE"), (10, "A B C D E F")]
    assert sorted((tuple(r) for r in jj.similar(documents(rows)).collect()), key=repr) == brute(rows)
    assert jj.similar(documents([])).count() == 0


def test_linked_sets_always_share_a_key():
    draw = np.random.default_rng(5)
    for _ in range(300):
        n = int(draw.integers(1, 400))
        a = np.unique(draw.integers(0, 2**63, n, dtype=np.uint64))
        n = len(a)
        drop = int(draw.integers(0, n // 4 + 1))
        add = int(draw.integers(0, n // 3 + 1))
        b = np.unique(np.r_[a[drop:], draw.integers(0, 2**63, add, dtype=np.uint64)])
        if not jj.linked(a, b):
            continue
        shared = set(jj.roles(len(a))) & set(jj.roles(len(b)))
        assert any(set(jj.join_keys(a, k).tolist()) & set(jj.join_keys(b, k).tolist()) for k in shared)
        for k in shared:
            x, y = jj.parity(a, k), jj.parity(b, k)
            assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64).tolist()) <= len(np.setxor1d(a, b))


def test_a_chain_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    found = {r.node: r.label for r in components(links).collect()}
    assert found == {**{k: 1 for k in range(1, 41)}, 100: 100, 101: 100}


def test_one_of_each_keeps_the_first(documents):
    text = " ".join(f"x{k}" for k in range(60))
    rows = [(5, text), (3, text + " more"), (9, "other words here"), (2, None), (4, ""), (None, text)]
    kept = jj.one_of_each(documents(rows, extra=("y",)))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([3, 9, 2, 4, None], key=repr)


def test_members_a_star_leaves_apart_are_joined(documents):
    # b is like a and like c, a and c are not alike: the component needs both links.
    words = [f"k{i}" for i in range(200)]
    a, b, c = words[:160], words[10:180], words[25:200]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))]
    assert sorted((tuple(r) for r in jj.similar(documents(rows)).collect()), key=repr) == brute(rows)


def test_small_sets_meet_the_whole_of_larger_partners(documents):
    # Sets of 25 to 45 shingles, each with a larger one around J = 0.75 that holds it.
    rows = []
    for n in range(25, 46):
        for more in (n // 3 - 1, n // 3, n // 3 + 1):
            for turn in range(2):
                words = [f"p{n}x{more}x{turn}x{i}" for i in range(n + 4 + more)]
                rows += [(len(rows), " ".join(words[: n + 4])), (len(rows) + 1, " ".join(words))]
    assert sorted((tuple(r) for r in jj.similar(documents(rows)).collect()), key=repr) == brute(rows)


def _components(rows):
    """Like ``brute``, on bit sets."""
    place, masks, first = {}, [], {}
    for i, t in rows:
        mask = 0
        for g in shingles(t):
            mask |= 1 << place.setdefault(g, len(place))
        masks.append(mask)
        first[mask] = min(first.get(mask, i), i)
    nodes = list(first)
    label = {m: m for m in nodes}

    def root(m):
        while label[m] != m:
            label[m] = m = label[label[m]]
        return m

    for a, x in enumerate(nodes):
        for y in nodes[:a]:
            if root(x) != root(y) and 100 * (x & y).bit_count() >= 75 * (x | y).bit_count():
                label[root(x)] = root(y)
    smallest = {}
    for m in nodes:
        smallest[root(m)] = min(smallest.get(root(m), first[m]), first[m])
    return sorted((i, m.bit_count(), smallest[root(m)]) for (i, _), m in zip(rows, masks))


def test_a_large_group_of_near_copies_with_many_unlike_the_hub(documents):
    draw = random.Random(8)
    words = [f"w{k}" for k in range(3000)]
    base = [draw.choice(words) for _ in range(130)]
    passage = [draw.choice(words) for _ in range(14)]
    rows = []
    for i in range(2000):
        # From copies to texts that are like a few others or none.
        copy = list(base)
        for at in draw.sample(range(len(base)), draw.randrange(0, 22)):
            copy[at] = draw.choice(words)
        rows.append((i, " ".join(copy)))
    # Texts that have a passage in common with many others and nothing else.
    rows += [(2000 + i, " ".join(passage + [draw.choice(words) for _ in range(70)])) for i in range(400)]
    found = sorted(tuple(r) for r in jj.similar(documents(rows).repartition(8)).collect())
    assert found == _components(rows)
    sizes = {}
    for _, _, c in found:
        sizes[c] = sizes.get(c, 0) + 1
    assert max(sizes.values()) > 300 and sum(n == 1 for n in sizes.values()) > 600


def test_a_passage_of_many_documents_groups_no_one(spark, documents):
    draw = random.Random(1)
    passage = [f"common{k}" for k in range(12)]
    rows = [(i, " ".join(passage + [f"x{draw.randrange(10**6)}" for _ in range(120)])) for i in range(300)]
    rows += [(1000, rows[0][1] + " more"), (1001, rows[1][1] + " more words")]
    texts = spark.createDataFrame([(i, t) for i, t in rows], "node bigint, text string")
    marks = texts.mapInArrow(
        jj.per_batch(jj._marks),
        "node bigint, n bigint, band int, own array<bigint>, below array<bigint>, need int, need_below int")
    left = jj._groups(texts, marks).groupBy("key").count()
    assert left.agg({"count": "max"}).first()[0] <= 10  # of 300
    assert sorted((tuple(r) for r in jj.similar(documents(rows)).collect()), key=repr) == brute(rows)


def test_members_left_apart_meet_whatever_their_smallest_keys_are(spark):
    words = [f"z{k}" for k in range(300)]
    texts = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words + ["more"])), (3, "other words altogether")], "node bigint, text string")
    marks = texts.mapInArrow(
        jj.per_batch(jj._marks),
        "node bigint, n bigint, band int, own array<bigint>, below array<bigint>, need int, need_below int")
    # A hundred small keys of each are shared with a third class only, the larger ones with each other.
    small = {1: range(0, 400, 4), 2: range(2, 402, 4)}
    keys = [(k, i) for i, ks in small.items() for k in ks] + [(k, 3) for ks in small.values() for k in ks]
    keys += [(k, i) for i in (1, 2) for k in range(1000, 1400, 2)]
    groups = spark.createDataFrame([(k, i, True, 3 if i == 3 else 296) for k, i in keys], "key bigint, node bigint, own boolean, n bigint")
    labels = spark.createDataFrame([], "node bigint, label bigint")
    assert [tuple(r) for r in jj._left_apart(groups, labels, marks).collect()] == [(1, 2)]


def test_a_key_of_the_band_below_both_is_not_needed(spark):
    texts = spark.createDataFrame([(i, " ".join(f"z{k}" for k in range(300 + i))) for i in (1, 2, 3)], "node bigint, text string")
    marks = texts.mapInArrow(
        jj.per_batch(jj._marks),
        "node bigint, n bigint, band int, own array<bigint>, below array<bigint>, need int, need_below int")
    rows = [(7, 1, False, 297), (7, 2, False, 298), (9, 2, False, 298), (9, 3, True, 299)]
    groups = spark.createDataFrame(rows, "key bigint, node bigint, own boolean, n bigint")
    labels = spark.createDataFrame([], "node bigint, label bigint")
    assert [tuple(r) for r in jj._left_apart(groups, labels, marks).collect()] == [(2, 3)]


MARKS = "node bigint, n bigint, band int, own array<bigint>, below array<bigint>, need int, need_below int"


def test_a_large_label_and_many_others_meet_as_blocks(spark):
    # 1500 members of one label and 90 others in one key: 1500 * 90 pairs of rows, few of blocks.
    draw = random.Random(3)
    base = [f"w{k}" for k in range(90)]
    texts = []
    for i in range(1590):
        copy = list(base)
        for at in draw.sample(range(90), 2 if i < 1500 else draw.choice([4, 12])):
            copy[at] = f"y{draw.randrange(10**6)}"
        texts.append((i, " ".join(copy)))
    sets = {i: shingles(t) for i, t in texts}
    k = jj.band(86)
    assert {jj.band(len(s)) for s in sets.values()} == {k}
    marks = spark.createDataFrame(texts, "node bigint, text string").repartition(8).mapInArrow(jj.per_batch(jj._marks), MARKS)
    groups = spark.createDataFrame([(7, i, True, len(s)) for i, s in sets.items()], "key bigint, node bigint, own boolean, n bigint")
    labels = spark.createDataFrame([(i, 0) for i in range(1500)], "node bigint, label bigint")
    met = jj._blocks_met(groups, labels, marks).collect()
    assert len(met) <= 8 and max(len(r.x) for r in met) <= jj.BLOCK
    found = {tuple(r) for r in jj._left_apart(groups, labels, marks).collect()}
    must = {
        (a, b) for b in range(1500, 1590) for a in range(b)
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    }
    assert must and must <= found and len(found) < 3 * len(must) + 100
    assert all(a < b and b >= 1500 for a, b in found)


def test_blocks_and_turns_of_any_size_give_the_same_pairs(spark, monkeypatch):
    rows = families(4, 9)
    texts = spark.createDataFrame([(i + 1, t) for i, t in rows if shingles(t)], "node bigint, text string")
    marks = jj.kept(texts.mapInArrow(jj.per_batch(jj._marks), MARKS))
    groups = jj.kept(jj._groups(texts, marks))
    labels = spark.createDataFrame([(i, i // 3) for i in range(1, 40)], "node bigint, label bigint")
    whole = sorted(map(tuple, jj._left_apart(groups, labels, marks).collect()))
    monkeypatch.setattr(jj, "BLOCK", 2)
    met = jj._blocks_met(groups, labels, marks)
    assert sorted(map(tuple, jj._left_apart(groups, labels, marks).collect())) == whole and whole
    batch = met.toArrow().combine_chunks().to_batches()[0]
    pairs = []
    for at_once in (1, 5, 1 << 17):
        monkeypatch.setattr(jj, "AT_ONCE", at_once)
        pairs.append(jj._compare(batch).to_pydict())
    assert pairs[0] == pairs[1] == pairs[2]


def test_sketches_laid_over_themselves_differ_in_no_more_bits(spark):
    draw = np.random.default_rng(2)
    values = draw.integers(-(2**63), 2**63, 50, dtype=np.int64)
    for n in (0, 3, jj.LONGS, jj.LONGS + 1, 50):
        frame = spark.createDataFrame([(values[:n].tolist(),)], "s array<bigint>")
        want = values[:n].tolist() if n <= jj.LONGS else [
            int(np.bitwise_xor.reduce(values[:n][i :: jj.LONGS])) for i in range(jj.LONGS)]
        assert frame.select(jj._folded("s")).first()[0] == want


def test_keys_needed_follow_the_size_of_a_set():
    draw = np.random.default_rng(7)
    more = 0
    for _ in range(400):
        n = int(draw.integers(1, 400))
        a = np.unique(draw.integers(0, 2**63, n, dtype=np.uint64))
        drop, add = int(draw.integers(0, n // 4 + 1)), int(draw.integers(0, n // 3 + 1))
        b = np.unique(np.r_[a[drop:], draw.integers(0, 2**63, add, dtype=np.uint64)])
        if not jj.linked(a, b):
            continue
        for k in (set(jj.roles(len(a))) & set(jj.roles(len(b)))) - {min(jj.band(len(a)), jj.band(len(b))) - 1}:
            both = len(np.intersect1d(jj.join_keys(a, k), jj.join_keys(b, k)))
            assert both >= jj.needed(a, k) and both >= jj.needed(b, k)
            for s in (a, b):
                assert len(np.setxor1d(a, b)) <= jj.differing(len(s), k) <= jj.bound(k)
                more += jj.needed(s, k) > len(jj.sketch_words(s, k)[0]) - jj.bound(k) > 0
    assert more > 50
