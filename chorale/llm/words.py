"""Words of whole texts and hashes of word sequences, over the bytes of Arrow columns.

A word is a run of bytes other than 0x20 and 0x09-0x0D. Texts are hashed in blocks
that end at white space or at a text's end, so memory follows the block, not the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from chorale.llm.common import utf8

BLOCK = 1 << 20
U = np.uint64
_MULTIPLY = 0x9E3779B97F4A7C15
_STEP = U(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = x ^ (x >> U(31))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(29)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(32)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(_MULTIPLY))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base))
    out[:1] = 1
    return np.cumprod(out)


_UP = _powers(_MULTIPLY, BLOCK)
_DOWN = _powers(pow(_MULTIPLY, -1, 1 << 64), BLOCK)


def _block_ends(data: np.ndarray, marks: np.ndarray, between: np.ndarray = SPACE) -> list[int]:
    """Where blocks end: at a text's end, else at white space, never inside a word."""
    ends, at, total = [], 0, int(marks[-1])
    while at < total:
        to = min(at + BLOCK, total)
        text_end = int(marks[np.searchsorted(marks, to, "right") - 1])
        if text_end > at:
            to = text_end
        else:
            stop = int(marks[np.searchsorted(marks, at, "right")])
            while to < stop and not between[data[to]]:
                to += 1
        ends.append(to)
        at = to
    return ends


def word_hashes(
    column: pa.Array, lower: bool = False, between: np.ndarray = SPACE, prefixes: tuple[int, ...] = ()
):
    """Of all texts: word starts, word ends, 64-bit hashes, and each text's first word.

    ``lower`` lower-cases A-Z first; ``between`` says which bytes part words. With
    ``prefixes`` the hashes have a row for the words and one for the first so many bytes
    of each (0 for a shorter word). The last array has one entry more than texts.
    """
    data, marks = utf8(column)
    if lower:
        data = LOWER[data]
    starts, ends, hashes, at = [], [], [], 0
    for to in _block_ends(data, marks, between):
        part = data[at:to]
        inside = ~between[part]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = marks[np.searchsorted(marks, at, "left") : np.searchsorted(marks, to, "left")] - at
        first[cuts] |= inside[cuts]
        cuts = cuts[cuts > 0] - 1
        last[cuts] |= inside[cuts]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = (_UP, _DOWN) if len(part) <= BLOCK else (
            _powers(_MULTIPLY, len(part)), _powers(pow(_MULTIPLY, -1, 1 << 64), len(part)))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        starts.append(s + at)
        ends.append(e + at)
        whole = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        if prefixes:
            rows = [whole]
            for n in prefixes:
                short = mix((sums[np.minimum(s + n, e)] - sums[s]) * down[s] + U(n << 32))
                short[e - s < n] = 0
                rows.append(short)
            whole = np.stack(rows)
        hashes.append(whole)
        at = to
    if not starts:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros((1 + len(prefixes), 0) if prefixes else 0, np.uint64), np.zeros(len(marks), np.int64)
    starts = np.concatenate(starts)
    return starts, np.concatenate(ends), np.concatenate(hashes, axis=-1), np.searchsorted(starts, marks, "left")


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (empty when there are fewer)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    done, out, step, power = 0, None, words, np.array(_STEP)
    width, bits = 1, n
    # Widths double; the set bits of n are put together from the left.
    while bits:
        if bits & 1:
            out = step if out is None else out[: len(words) - done - width + 1] * power + step[done : len(words) - width + 1]
            done += width
        bits >>= 1
        if bits:
            step = step[:-width] * power + step[width:]
            power = np.multiply(power, power)
            width *= 2
    return mix(out + U(n))


def shingle_sets(column: pa.Array, n: int = 5, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct n-word shingle hashes of each text.

    A text of fewer than n words has its whole sequence as one shingle; one without
    words has none.
    """
    _, _, words, first = word_hashes(column, lower)
    with np.errstate(over="ignore"):
        whole = grams(words, n)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= n:
                out.append(np.unique(whole[a : b - n + 1]))
            else:
                out.append(grams(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
        return out
