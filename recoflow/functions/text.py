"""Text expressions: tags, words, per-document term counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_tags(text: Column) -> Column:
    """Remove every ``<...>`` run from an HTML string."""
    return F.regexp_replace(text, "<.*?>", "")


def sentence(*parts: Column) -> Column:
    """Join channel, title and content into the one text that is analysed."""
    return F.concat_ws(",", *parts)


def split_words(text: Column) -> Column:
    """Lower-cased runs of letters, in text order (an edge may be empty)."""
    return F.split(F.lower(text), r"[^\p{L}]+")


def is_keyword(word: Column, min_len: int = 3, stopwords: Sequence[str] = ()) -> Column:
    """Whether a word may become a keyword: long enough, not a stop-word."""
    keep = F.length(word) >= min_len
    if stopwords:
        keep = keep & ~word.isin(list(stopwords))
    return keep
