"""From texts to word counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.payload import json_field
from tidemark.functions.text import VOWELS, ends_with_any, split_words
from tidemark.operators.aggregates import count_by
from tidemark.operators.ranking import top_k


def texts_of(lines: DataFrame, field: str, line: str = "line", text_as: str = "text") -> DataFrame:
    """One text per JSON line; bad lines and missing or empty texts are dropped."""
    texts = lines.select(json_field(line, field).alias(text_as))
    return texts.where(F.length(F.trim(text_as)) > 0)


def tokens(df: DataFrame, text: str | Column, *keep: str, max_len: int = 6,
           word_as: str = "word") -> DataFrame:
    """One row per word of the normalized text, at most ``max_len`` characters long."""
    return (df.select(*keep, F.explode(split_words(text)).alias(word_as))
            .where(F.length(word_as).between(1, max_len)))


def word_count(words: DataFrame, word: str = "word", name: str = "n") -> DataFrame:
    return count_by(words, word, name)


def top_words_ending(counts: DataFrame, k: int = 5, endings: Iterable[str] = VOWELS,
                     word: str = "word", count: str = "n",
                     rank_as: str | None = None) -> DataFrame:
    """Most frequent words with one of the endings, words in order within a tie."""
    chosen = counts.where(ends_with_any(word, endings))
    return top_k(chosen, k, F.col(count).desc(), F.col(word).asc(), rank_as=rank_as)
