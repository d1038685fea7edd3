import random
import re
from collections import Counter

import pytest

from chorale.llm import substring_dedup as sd


def brute(rows, window):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    seen = Counter(tuple(w[s : s + window]) for _, w in split for s in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] > 1:
                gone[s : s + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def result(df, window, seed):
    rows = sd.remove_repeats(df, window, seed).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows), key=repr)


@pytest.mark.parametrize("window,seed,few", [(35, 10, 400), (12, 4, 12), (6, 6, 4)])
def test_matches_brute_force(documents, window, seed, few):
    draw = random.Random(window)
    vocabulary = [f"w{k}" for k in range(few)]
    passages = [[draw.choice(vocabulary) for _ in range(draw.randrange(window - 2, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(draw.randrange(0, 4)):
            words += [draw.choice(vocabulary) for _ in range(draw.randrange(0, 2 * window))]
            if draw.random() < 0.6:
                p = list(draw.choice(passages))
                if draw.random() < 0.4:
                    p[draw.randrange(len(p))] = "changed"
                words += p
        rows.append((i, " ".join(words)))
    rows += [(100 + k, rows[3][1]) for k in range(30)]  # a group of copies
    assert result(documents(rows), window, seed) == brute(rows, window)


def test_odd_rows(documents, odd_rows):
    rows = odd_rows + [(8, "word " * 40)]
    assert result(documents(rows), 35, 10) == brute(rows, 35)
    assert sd.remove_repeats(documents([])).count() == 0


def test_other_columns_stay_and_texts_without_repeats_too(documents):
    long = " ".join(f"t{k}" for k in range(50))
    df = documents([(1, "keep\nthis  text"), (2, long), (3, "x " + long), (4, None)], extra=("e",)).withColumnRenamed("x0", "row")
    out = {r.doc_id: r for r in sd.shortened(df).collect()}
    assert out[1].text == "keep\nthis  text" and out[2].text == "" and out[3].text == "x" and out[4].text is None
    assert out[3].n_chars == 1 and out[1].row == "e" and sd.shortened(df).columns == df.columns


def test_rows_with_one_id_are_documents_of_their_own(documents):
    rows = [(1, " ".join(f"a{k}" for k in range(40))), (1, " ".join(f"b{k}" for k in range(40)))]
    assert result(documents(rows), 35, 10) == brute(rows, 35)


def test_many_rows_equal_in_id_and_text(documents):
    import time

    text = " ".join(f"t{k}" for k in range(2000))
    took = {}
    for name, ids in (("other ids", range(400)), ("one id", [7] * 400), ("no id", [None] * 400)):
        start = time.perf_counter()
        out = sd.remove_repeats(documents([(i, text) for i in ids])).collect()
        took[name] = time.perf_counter() - start
        assert len(out) == 400 and all((r.n_words, r.n_removed, r.kept) == (2000, 2000, "") for r in out)
    assert took["one id"] < 2 * took["other ids"] + 5 and took["no id"] < 2 * took["other ids"] + 5
