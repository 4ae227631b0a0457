"""Posts that arrive as JSON in broker records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.nested import first_filled
from tidemark.functions.numbers import int_or_zero
from tidemark.functions.text import char_length, html_to_text
from tidemark.functions.timing import parse_timestamp
from tidemark.operators.payloads import parse_json, quarantine
from tidemark.operators.projections import flatten, originals

PERSON = "STRUCT<acct STRING, username STRING, display_name STRING, followers_count STRING>"
# The reshared post is declared as text: all that matters is whether there is one.
POST_SCHEMA = (f"id STRING, created_at STRING, content STRING, text STRING, language STRING, "
               f"reblog STRING, account {PERSON}, user {PERSON}")

POST_FIELDS = {
    "id": "payload.id", "created_at": "payload.created_at", "content": "payload.content",
    "language": "payload.language", "username": "payload.account.username",
    "followers_count": "payload.account.followers_count",
}


def parsed_posts(records: DataFrame, schema: str = POST_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Records split into (parsed, unreadable)."""
    return quarantine(parse_json(records, "value", schema))


def original_posts(records: DataFrame, schema: str = POST_SCHEMA) -> DataFrame:
    """The usual fields of readable posts that reshare nothing."""
    good, _ = parsed_posts(records, schema)
    flat = flatten(originals(good, "payload.reblog"), POST_FIELDS)
    return flat.withColumn("followers_count", int_or_zero("followers_count"))


def timed_posts(records: DataFrame) -> DataFrame:
    """(created_at, language) of original posts that have both."""
    posts = original_posts(records).select(
        parse_timestamp("created_at").alias("created_at"), "language")
    return posts.where(F.col("created_at").isNotNull() & F.col("language").isNotNull())


def dashboard_posts(records: DataFrame, *keep: str) -> DataFrame:
    """(language, size, user, followers) of original posts that have a language.

    The text is ``content``, else ``text``, without markup.  The person is
    ``account`` or, where that is missing or blank, ``user``, under the first
    name that is filled in.  An empty language is a language.
    """
    good, _ = parsed_posts(records)
    posts = originals(good, "payload.reblog").where(F.col("payload.language").isNotNull())
    names = ("acct", "username", "display_name", "followers_count")
    has_account = F.coalesce(*(F.col(f"payload.account.{n}") for n in names)).isNotNull()
    person = F.when(has_account, F.col("payload.account")).otherwise(F.col("payload.user"))
    text = first_filled(["payload.content", "payload.text"], "")
    return posts.select(
        *keep, F.col("payload.language").alias("language"), text.alias("text"),
        person.alias("person")).select(
        *keep, "language", char_length(html_to_text("text")).alias("size"),
        first_filled([f"person.{n}" for n in names[:3]], "unknown").alias("user"),
        int_or_zero("person.followers_count").alias("followers"))
