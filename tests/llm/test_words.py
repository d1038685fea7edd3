import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from chorale.llm import words

TEXTS = st.lists(st.text(alphabet="ab \t\n\x0bé漢\x1f", max_size=30), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_the_runs_between_white_space(texts):
    column = pa.array(texts, pa.large_string())
    starts, ends, hashes, first = words.word_hashes(column)
    data = "".join(texts).encode()
    found = [data[a:b].decode() for a, b in zip(starts, ends)]
    wanted = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert found == [w for ws in wanted for w in ws]
    assert np.diff(first).tolist() == [len(w) for w in wanted]
    by_word = {}
    assert all(by_word.setdefault(w, h) == h for w, h in zip(found, hashes.tolist()))
    assert len(set(by_word.values())) == len(by_word)


def test_blocks_do_not_change_hashes(monkeypatch):
    texts = ["some words of a text " * 20, "x" * 300, "", "a b"]
    column = pa.array(texts, pa.large_string())
    whole = words.word_hashes(column)
    monkeypatch.setattr(words, "BLOCK", 64)
    for a, b in zip(whole, words.word_hashes(column)):
        assert (a == b).all()


def test_grams_follow_the_words():
    w = words.mix(np.arange(1, 40, dtype=np.uint64))
    for n in (1, 2, 3, 5, 10, 35):
        rolled = words.grams(w, n)
        assert len(rolled) == 39 - n + 1
        for i in (0, len(rolled) - 1):
            assert words.grams(w[i : i + n].copy(), n)[0] == rolled[i]
    assert len(words.grams(w[:3], 4)) == 0


def test_short_texts_have_one_shingle():
    a, b, c, d = words.shingle_sets(pa.array(["A b c", "a  B\nc", "", "a b c d e f"], pa.large_string()))
    assert len(a) == 1 and (a == b).all() and len(c) == 0 and len(d) == 2
