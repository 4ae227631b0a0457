"""Texts, words and markup, over whole documents and pages."""

from pyspark.sql import functions as F

from tidemark.functions.payload import json_field
from tidemark.functions.text import char_length, html_to_text, normalized, without_tags
from tidemark.operators.reuse import reuse
from tidemark.operators.words import tokens, top_words_ending, word_count
from tidemark.plans.wordlist import frequent_words
from tidemark.registry import QueryBook, read
from tidemark.registry.aggregates import WORDS
from tidemark.scratch import scratch_path, stage

book = QueryBook()

COUNTS = WORDS.rstrip() + """,
     counts AS (SELECT word, count(*) AS n FROM words WHERE length(word) BETWEEN 1 AND 6 GROUP BY word)
"""


@book.query("TXT-1", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_text_field(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", json_field("props", "k").alias("k"))


@book.query("TXT-2", r"""SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text),
                                  '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS cleaned
                         FROM documents""")
def cleaned_texts(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", normalized("text").alias("cleaned"))


@book.query("TXT-3", r"""
WITH words AS (SELECT doc_id, unnest(string_split(trim(regexp_replace(lower(text),
                      '[^\p{L}\p{N}_]+', ' ', 'g')), ' ')) AS word FROM documents)
SELECT doc_id, word, count(*) AS n FROM words WHERE length(word) BETWEEN 1 AND 6 GROUP BY ALL""")
def words_per_document(spark, sf_dir):
    words = tokens(read(spark, sf_dir, "documents"), "text", "doc_id")
    return words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


@book.query("TXT-4 AGG-1", COUNTS + "SELECT word, n FROM counts")
def word_counts(spark, sf_dir):
    return word_count(tokens(read(spark, sf_dir, "documents"), "text"))


def shares_of_words(spark, sf_dir, how="auto"):
    """Three jobs over the word counts, which take a pass over all texts: their total, the greatest, and the shares."""
    counts = word_count(tokens(read(spark, sf_dir, "documents"), "text"))
    with reuse(counts, how=how) as kept:
        total, most = kept.agg(F.sum("n")).first()[0], kept.agg(F.max("n")).first()[0]
        return stage(kept.select("word", "n", (F.col("n") / F.lit(total)).alias("share"), (F.col("n") == F.lit(most)).alias("most")), "shares")


@book.query("PHY-1 TXT-4", COUNTS + """
SELECT word, n, n::DOUBLE / (SELECT sum(n) FROM counts) AS share, n = (SELECT max(n) FROM counts) AS most FROM counts""")
def word_shares(spark, sf_dir):
    """The counts are kept for the jobs that read them."""
    return shares_of_words(spark, sf_dir)


@book.query("TXT-5 SRT-2 TXT-1 SRC-1", COUNTS + """
SELECT word, n FROM counts
WHERE right(word, 1) IN ('a', 'e', 'i', 'o', 'u', 'à', 'è', 'é', 'í', 'ï', 'ò', 'ó', 'ú', 'ü')
ORDER BY n DESC, word LIMIT 5""")
def words_ending_in_vowel(spark, sf_dir):
    """From JSON lines to the five words, as the whole job."""
    path = scratch_path(spark, "document-lines")
    read(spark, sf_dir, "documents").select(F.to_json(F.struct("doc_id", "text"))).write.text(path)
    return frequent_words(spark, path, "text")


@book.query("TXT-5 SRT-2", COUNTS + """
SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS place FROM counts
WHERE right(word, 1) IN ('n', 's') ORDER BY n DESC, word LIMIT 20""")
def words_ending_in_letters(spark, sf_dir):
    counts = word_count(tokens(read(spark, sf_dir, "documents"), "text"))
    return top_words_ending(counts, 20, ("n", "s"), rank_as="place")


@book.query("TXT-5", COUNTS + """
SELECT word, n FROM counts
WHERE right(word, 3) = 'ing' OR right(word, 2) IN ('er', 'en') ORDER BY n DESC, word LIMIT 20""")
def words_ending_in_syllables(spark, sf_dir):
    """Endings of two and three letters."""
    counts = word_count(tokens(read(spark, sf_dir, "documents"), "text"))
    return top_words_ending(counts, 20, ("ing", "er", "en"))


# The pages hold four entities, and titles cut short leave an ampersand without
# its semicolon; the ampersand has to come last.
@book.query("TXT-6", """
SELECT page_id, regexp_replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'),
       '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') AS body FROM pages""")
def page_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", html_to_text("html").alias("body"))


@book.query("TXT-7 TXT-6", """SELECT page_id, length(html) AS page_length,
                                     length(regexp_replace(html, '<[^>]+>', '', 'g')) AS text_length
                              FROM pages""")
def page_lengths(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(
        "page_id", char_length("html").cast("bigint").alias("page_length"),
        char_length(without_tags("html")).cast("bigint").alias("text_length"))
