import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from chorale.llm import byte_bpe as bpe

SIGNS = "ab'std rvelmZ  \n\t\x1c\xa0　1²٣!?.-é漢😀"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(bpe.RANKS), special_tokens={})


def test_pieces_are_the_matches_of_the_pattern():
    draw = random.Random(3)
    for _ in range(5000):
        text = "".join(draw.choice(SIGNS) for _ in range(draw.randrange(14)))
        assert bpe.piece_ends(text).tolist() == [m.end() for m in bpe.FINDER.finditer(text)]


def texts():
    draw = random.Random(11)
    make = lambda n: "".join(draw.choice(SIGNS + "aaaabbbb   ") for _ in range(n))
    long = make(900)
    return ["", None, "plain text, it's", make(70), make(300), long[:300] + "q" * 400 + long[300:], "a" * 500, " " * 300 + "x",
            "\n" * 250, "'" * 200 + "s", "<|endoftext|>", long, long]


@pytest.mark.parametrize("chunk,overlap", [(40, 20), (64, 32), (1 << 16, 1 << 12)])
def test_ids_are_the_library_s_and_decode_to_the_text(documents, library, monkeypatch, chunk, overlap):
    # Local mode runs the functions in worker processes, which get the values by closure of the module.
    rows = [(k, t) for k, t in enumerate(texts())]
    if chunk < 1000:
        monkeypatch.setattr(bpe, "CHUNK", chunk)
        monkeypatch.setattr(bpe, "OVERLAP", overlap)
        for _, text in rows:
            text = text or ""
            if len(text) <= chunk + overlap:
                continue
            assert bpe.stitch(parts(text), text) == np.array(library.encode_ordinary(text), "<u4").tobytes()
        return
    found = {r.doc_id: r for r in bpe.round_trip(documents(rows)).collect()}
    for k, text in rows:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        assert found[k].n_tokens == len(ids)
        assert found[k].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert found[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def parts(text):
    """What the chunk tasks give for one text."""
    import pyarrow as pa

    starts = list(range(0, len(text), bpe.CHUNK))
    batch = pa.RecordBatch.from_pydict({
        "start": pa.array(starts, pa.int32()), "n": pa.array([len(text)] * len(starts), pa.int32()),
        "chunk": [text[s : s + bpe.CHUNK + bpe.OVERLAP] for s in starts],
    })
    return next(bpe._encode_chunks(bpe.RANKS)([batch])).to_pylist()


def test_long_texts_are_stitched_over_tasks(documents, library):
    draw = random.Random(2)
    words = ["alpha", "béta", "gam'ma", "漢字", "x", "123", "\n"]
    long = " ".join(draw.choice(words) for _ in range(90_000))
    assert len(long) > 2 * bpe.CHUNK
    rows = [(1, long), (1, long), (2, "z" * (bpe.CHUNK + 2 * bpe.OVERLAP)), (None, "short")]
    found = sorted((r.doc_id or 0, r.n_tokens, r.decoded_sha256) for r in bpe.round_trip(documents(rows)).collect())
    wanted = sorted((i or 0, len(library.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert found == wanted


def test_odd_rows_and_clashing_names(documents, odd_rows):
    df = documents(odd_rows, extra=("ids",)).withColumnRenamed("x0", "ids")
    assert bpe.round_trip(df).count() == len(odd_rows)
    assert bpe.tokens(documents([])).count() == 0
    row = bpe.tokens(documents([(1, "a b")]), keep=("doc_id", "source")).first()
    assert row.source == "s" and b"".join(
        bytes(bpe.decode(np.array([t], "<u4").tobytes())) for t in row.tokens) == b"a b"


def test_long_texts_behind_a_shuffle(spark, documents, library):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice(["alpha", "béta", f"n{i}", "漢字"]) for _ in range(40_000))) for i in range(6)]
    rows += [(0, rows[1][1]), (0, rows[1][1])]  # equal rows, and an id that is told twice
    shuffled = documents(rows).repartition(5).union(documents(rows[:2])).repartition(3, "doc_id")
    found = sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in bpe.round_trip(shuffled).collect())
    wanted = sorted((i, len(library.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows + rows[:2])
    assert found == wanted


def test_time_follows_the_length_of_a_text(documents):
    import time

    took = []
    for n in (1, 1, 4):
        df = documents([(1, "some words of a long text " * (n * 80_000))])
        start = time.perf_counter()
        assert bpe.round_trip(df).first().n_tokens > n * 400_000
        took.append(time.perf_counter() - start)
    assert took[2] < 6 * took[1] + 2  # four times the length of 2 MB
