"""Text predicates and token expressions; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_ASCII = r"[^\x00-\x7F]"


def is_ascii(text: Column) -> Column:
    # Any other character takes more than one byte. Unlike an anchored pattern
    # this also sees a trailing U+0085, and it needs no regular expression.
    return F.length(text) == F.octet_length(text)


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, NON_ASCII, "")


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """True when any term is a substring; null text counts as no match."""
    found = reduce(or_, [text.contains(t) for t in terms], F.lit(False))
    return F.coalesce(found, F.lit(False))


def admitted(
    lang: Column,
    text: Column,
    keywords: Sequence[str] = ("",),
    ignore_case: bool = False,
) -> Column:
    """English, pure ASCII and holding a keyword (FIL-1).

    An empty keyword is part of every text, so it admits everything.
    """
    keep = F.coalesce(lang, F.lit("")).startswith("en") & is_ascii(text)
    if keywords and "" not in keywords:
        if ignore_case:
            keep = keep & contains_any(F.lower(text), [k.lower() for k in keywords])
        else:
            keep = keep & contains_any(text, keywords)
    return F.coalesce(keep, F.lit(False))


def tokens(text: Column) -> Column:
    return F.split(text, r"\s+")


def hashtags(text: Column, bare: bool = True) -> Column:
    """Whitespace-delimited tokens that begin with ``#``.

    Only the tags are materialised, not every token. ``bare`` keeps a lone
    ``#``, as the ranking does and the stream does not.
    """
    body = r"\S*" if bare else r"\S+"
    return F.regexp_extract_all(text, F.lit(rf"#(?<!\S#){body}"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\w+"))


def worthy_word(word: Column, stop_words: Sequence[str]) -> Column:
    """Word admission for the word ranking (FIL-9); case matters."""
    keep = (F.length(word) > 3) & is_ascii(word) & ~word.startswith("http")
    if stop_words:
        keep = keep & ~word.isin(list(stop_words))
    return keep


def tag_label(tag: Column) -> Column:
    """Tag with ``:`` and ``-`` taken out, so ``#a-b`` and ``#ab`` are one label."""
    return F.translate(tag, ":-", "")


# The usual English stop list ...
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
""".split()
# ... and the words added to it for the slice report.
EXTRA_STOP_WORDS = ["Volkswagen", "VW", "de", "el", "que", "en"]
STOP_WORDS = ENGLISH_STOP_WORDS + EXTRA_STOP_WORDS
