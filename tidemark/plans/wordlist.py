"""Most frequent short words in a file of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.words import texts_of, tokens, top_words_ending, word_count
from tidemark.sources.files import scan_lines


def frequent_words(spark: SparkSession, path: str, field: str, k: int = 5,
                   max_len: int = 6) -> DataFrame:
    texts = texts_of(scan_lines(spark, path), field)
    return top_words_ending(word_count(tokens(texts, "text", max_len=max_len)), k)
