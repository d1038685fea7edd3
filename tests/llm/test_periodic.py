import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from chorale.llm import periodic as pr


def brute_runs(words):
    """Every maximal stretch with its smallest period, by trying all periods."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - i + q
            if length >= max(24, 3 * q):
                found.setdefault((i, length), q)
            i = e + 1
    return sorted((s, q, length) for (s, length), q in found.items())


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    top = (None,) * 4
    if runs:
        s, q, length = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]))
        top = (s, length, q, 1000 * length // q)
    lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *top, sha(lines), sha(left))


def result(df):
    rows = pr.digest(df, pr.planted).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def _texts(seed, number, largest):
    draw = random.Random(seed)
    out = []
    for _ in range(number):
        words = []
        while len(words) < draw.randrange(1, largest):
            kind, few = draw.random(), [f"w{k}" for k in range(draw.choice([1, 2, 3, 400]))]
            unit = [draw.choice(few) for _ in range(draw.randrange(1, max(2, largest // 12)))]
            words += (unit * 12)[: draw.randrange(1, 6 * len(unit) + 30)] if kind < 0.6 else unit
            if draw.random() < 0.2:
                words += words[-40:]
        out.append(draw.choice([" ", "\n", " \t"]).join(words))
    return out


@pytest.mark.parametrize("seed,largest", [(1, 60), (2, 300), (3, 1500)])
def test_matches_brute_force(documents, seed, largest):
    rows = list(enumerate(_texts(seed, 60, largest)))
    assert result(documents(rows)) == sorted((brute_row(*r) for r in rows), key=repr)


def test_dealt_tiles_match_brute_force(documents, monkeypatch):
    """Long texts, whose tiles are rows of their own."""
    rows = [(100 + i, t) for i, t in enumerate(_texts(4, 12, 6000))]
    rows += [(1, "same " * 30000), (2, " ".join(f"u{i % 7000}" for i in range(30000))), (3, "a b c " * 12000 + "x " * 9000)]
    df = documents(rows)
    whole = result(df)
    for name, value in (("LONG", 200), ("REGION", 128), ("LOW", 16)):
        monkeypatch.setattr(pr, name, value)
    assert result(df) == whole
    short = [r for r in rows if r[0] >= 100]
    assert result(documents(short)) == sorted((brute_row(*r) for r in short), key=repr)


def test_tiles_overlap_by_what_a_boundary_sees():
    for n in (23, 24, 100, 5000, 70_000):
        for group, a, b, first, stop in pr.tiles(n):
            assert a <= max(0, first - 2 * group[-1]) and b >= min(n, stop + 4 * group[-1]) and first % (2 * group[-1]) == 0
    assert pr.tiles(23) == []


def test_random_sequences_solved_whole():
    draw = np.random.default_rng(5)
    for few in (1, 2, 3):
        texts = [draw.integers(0, few, draw.integers(0, 400)).astype(np.uint64) + np.uint64(9) for _ in range(40)]
        doc, q, s, e = pr.solve_documents(texts)
        got = sorted(zip(doc.tolist(), s.tolist(), q.tolist(), (e - s + q).tolist()))
        assert got == sorted((k, *r) for k, w in enumerate(texts) for r in brute_runs(w.tolist()))


def test_odd_rows(documents, odd_rows):
    rows = odd_rows + [(8, "x y " * 20), (8, "x y " * 20), (None, "z " * 50), (None, "z " * 50)]
    assert result(documents(rows)) == sorted((brute_row(*r) for r in rows), key=repr)
    assert result(documents([])) == []
    extra = documents([(1, "p q " * 30)], extra=("e", "f")).withColumnsRenamed({"x0": "runs", "x1": "h"})
    assert result(extra) == [brute_row(1, "p q " * 30)]


def test_runs_and_collapsed_words(documents):
    row = pr.periodic_runs(documents([(1, "head " + "a b c " * 10 + "tail")])).first()
    assert [tuple(r) for r in row.runs] == [(1, 3, 30)] and row.collapsed == "head a b c tail"
    assert pr.periodic_runs(documents([(1, None)])).first().runs == []
