"""Counts, profiles and two-level averages.

All of these aggregate before they shuffle, so a key that holds a third of the
rows reaches its reducer as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_column
from tidemark.functions.numbers import floor_to
from tidemark.functions.timing import day_of, hour_of
from tidemark.operators.projections import require


def total(df: DataFrame, name: str = "n") -> DataFrame:
    """One row: how many rows there are."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, keys: str | Sequence[str | Column], name: str = "n") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    """One row: how many different keys there are, a null key included."""
    return df.groupBy(*columns).agg(F.lit(1)).agg(F.count(F.lit(1)).alias(name))


def user_profile(posts: DataFrame, user: str, counters: Mapping[str, str],
                 only: Column | None = None, user_as: str = "user",
                 posts_as: str = "posts") -> DataFrame:
    """Per user: number of posts and the largest value of each counter.

    Counters such as followers drift while data is gathered; the maximum keeps a
    user from splitting into several rows.
    """
    chosen = posts if only is None else posts.where(only)
    return (chosen.where(F.col(user).isNotNull())
            .groupBy(F.col(user).alias(user_as))
            .agg(*(F.max(path).alias(name) for name, path in counters.items()),
                 F.count(F.lit(1)).alias(posts_as)))


def received_counts(posts: DataFrame, author_of_original: str, user_as: str = "user",
                    name: str = "received", times: str | None = None) -> DataFrame:
    """Reshares received per author, whatever the author's language.

    ``times`` names a column that says how many reshares a row stands for, if rows were
    counted before.
    """
    author = F.col(author_of_original).alias(user_as)
    if times is None:
        return count_by(require(posts, author_of_original), [author], name)
    return require(posts, author_of_original).groupBy(author).agg(F.sum(times).alias(name))


def counts_by_place(posts: DataFrame, place: str = "place.name", place_as: str = "name",
                    name: str = "posts") -> DataFrame:
    """Posts per place; pass an identifier rather than a name to keep homonyms apart."""
    return count_by(require(posts, place), [F.col(place).alias(place_as)], name)


def counts_by_place_sql(spark: SparkSession, view: str, place: str = "place.name",
                        place_as: str = "name", name: str = "posts") -> DataFrame:
    """The same in SQL over a registered view."""
    parts = place.split(".")
    guards = " AND ".join(f"{'.'.join(parts[:n])} IS NOT NULL" for n in range(1, len(parts) + 1))
    return spark.sql(f"SELECT {place} AS {place_as}, COUNT(*) AS {name} "
                     f"FROM {view} WHERE {guards} GROUP BY {place}")


def counts_by_pairs(df: DataFrame, key: str, key_as: str = "name", name: str = "posts") -> DataFrame:
    """The same as key-value pairs: every row is (key, 1) and the ones are added up."""
    pairs = require(df, key).select(F.col(key).alias(key_as), F.lit(1).cast("bigint").alias("one"))
    return pairs.groupBy(key_as).agg(F.sum("one").alias(name))


def hourly_counts(posts: DataFrame, ts: str, name: str = "posts") -> DataFrame:
    """Posts per (day, hour), keyed on the real date."""
    return count_by(posts.where(F.col(ts).isNotNull()),
                    [day_of(ts).alias("day"), hour_of(ts).alias("hour")], name)


def hourly_profile(posts: DataFrame, ts: str, name: str = "posts",
                   zero_fill: bool = False) -> DataFrame:
    """Average number of posts per hour of the day.

    An hour is averaged over the days that have it; with ``zero_fill`` over all
    days seen, so that missing hours count as zero, and all 24 hours are there.
    """
    counts = hourly_counts(posts, ts, name)
    if not zero_fill:
        return counts.groupBy("hour").agg(F.avg(name).alias(name))
    # One row with the number of days and a total per hour: the table is read once.
    totals = [F.coalesce(F.sum(F.when(F.col("hour") == h, F.col(name))), F.lit(0)) for h in range(24)]
    whole = counts.agg(F.countDistinct("day").alias("days"), F.array(*totals).alias("totals"))
    return (whole.select("days", F.posexplode("totals").alias("hour", name))
            .where(F.col("days") > 0).select("hour", (F.col(name) / F.col("days")).alias(name)))


def expand_estimate(df: DataFrame, column: str, fraction: float) -> DataFrame:
    """Scale a figure measured on a sample up to the whole."""
    return df.withColumn(column, F.col(column) / F.lit(float(fraction)))


def min_ratio_floor(df: DataFrame, column: str, name: str = "min_ratio",
                    decimals: int | None = 2) -> DataFrame:
    """One row: the smallest ratio, floored; nulls are no candidates."""
    low = F.min(as_column(column))
    return df.agg((low if decimals is None else floor_to(low, decimals)).alias(name))
