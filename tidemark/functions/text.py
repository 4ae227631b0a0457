"""Text cleaning, word tests and markup removal."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import as_column

# Vowels accepted at the end of a word, and the shape of a tag.
VOWELS = ("a", "e", "i", "o", "u", "à", "è", "é", "í", "ï", "ò", "ó", "ú", "ü")
TAG = "<[^>]+>"

# One run of anything that is not a letter, digit or underscore, in any script.
# Blanks are in that run too, so one pass both clears punctuation and leaves
# single spaces.
SEPARATORS = r"[^\p{L}\p{N}_]+"


def normalized(c: str | Column) -> Column:
    """Lower case, punctuation out, single spaces, no blank at either end."""
    return F.trim(F.regexp_replace(F.lower(as_column(c)), SEPARATORS, " "))


def split_words(c: str | Column) -> Column:
    """The words of the normalized text in one pass; the first or last may be empty."""
    return F.split(F.lower(as_column(c)), SEPARATORS)


def ends_with_any(c: str | Column, endings: Iterable[str] = VOWELS) -> Column:
    """Whether the text ends with one of the endings, of any length; none for no endings."""
    return reduce(Column.__or__, [F.endswith(as_column(c), F.lit(e)) for e in endings], F.lit(False))


def char_length(c: str | Column) -> Column:
    """Length in characters, not bytes."""
    return F.length(as_column(c))


def without_tags(c: str | Column) -> Column:
    return F.regexp_replace(as_column(c), TAG, "")


def _entity_decoder():
    # Defined inside a function so that it travels to executors by value: they
    # need no copy of this package.
    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from html import unescape
        for texts in batches:
            yield texts.map(unescape, na_action="ignore")

    return decode


def html_to_text(c: str | Column) -> Column:
    """Drop tags, then decode entities.

    Tags go inside the JVM, so only visible text crosses to Python, in Arrow
    batches; the entity table is the standard library's.
    """
    return _entity_decoder()(without_tags(c))
