"""Joins between aggregates.

No side is broadcast by hint.  Spark broadcasts a side whose known size is below
``autoBroadcastJoinThreshold`` and shuffles it otherwise; adaptive execution
corrects that at run time and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.operators.aggregates import received_counts


def engagement_ratio(users: DataFrame, posts: DataFrame, author_of_original: str,
                     user: str = "user", posts_made: str = "posts",
                     received_as: str = "received", ratio_as: str = "ratio",
                     times: str | None = None) -> DataFrame:
    """Reshares received per post made, for users who received any.

    Reshares are counted per author first, so both sides of the join hold one
    row per user and no raw post row is joined.
    """
    received = received_counts(posts, author_of_original, user, received_as, times)
    return (users.join(received, user, "inner")
            .withColumn(ratio_as, ratio(received_as, posts_made)))


def ratio_to_capacity(dimension: DataFrame, counts: DataFrame, dimension_key: str,
                      counts_key: str, capacity: str, measure: str,
                      ratio_as: str = "ratio") -> DataFrame:
    """Measure per unit of capacity for keys present on both sides; null at capacity 0."""
    left = dimension.select(dimension_key, capacity)
    right = counts.select(F.col(counts_key).alias("_counts_key"), measure)
    return (left.join(right, F.col(dimension_key) == F.col("_counts_key"), "inner")
            .select(dimension_key, measure, capacity, ratio(measure, capacity).alias(ratio_as)))


def least_pair(user: str, weight: str) -> Column:
    """Aggregate whose fields ``u`` and ``w`` are the user of greatest weight and that weight negated."""
    w = F.col(weight)
    return F.min(F.struct(w.isNull().alias("unknown"), (-w).alias("w"), F.col(user).alias("u")))


def aggregate_with_top(df: DataFrame, key: str | Column, size: str, user: str, weight: str,
                       count_as: str = "n", mean_as: str = "avg_size",
                       decimals: int = 2) -> DataFrame:
    """Per key: row count, mean size, and the user of greatest weight (then first by name).

    Rows are first reduced to one per key and user, with plain numbers that a hash
    aggregate holds; the best user, the least (-weight, user) pair with unknown weights
    last, is then taken from those few.  No ranking and no join back is needed.
    """
    key_column = F.col(key) if isinstance(key, str) else key
    per_user = per_user_totals(df.groupBy(key_column.alias("_key") if isinstance(key, str) else key_column, F.col(user).alias("_user")),
                               size, weight)
    name = "_key" if isinstance(key, str) else per_user.columns[0]
    best = per_user.groupBy(name).agg(*combined_totals(count_as, mean_as, decimals))
    return best.select(F.col(f"`{name}`").alias(key if isinstance(key, str) else name), count_as, mean_as,
                       F.col("_best.u").alias(user), (-F.col("_best.w")).alias(weight))


def per_user_totals(grouped: GroupedData, size: str, weight: str) -> DataFrame:
    """Rows, sizes and greatest weight per group; the user is one of the grouping columns, ``_user``."""
    return grouped.agg(F.count(F.lit(1)).alias("_rows"), F.sum(size).alias("_sizes"), F.count(size).alias("_sized"),
                       F.max(weight).alias("_weight"))


def combined_totals(count_as: str, mean_as: str, decimals: int = 2) -> list[Column]:
    """Aggregates over per-user totals: row count, mean size, and ``_best`` with the best user."""
    mean = F.sum("_sizes").cast("double") / F.nullif(F.sum("_sized"), F.lit(0))
    return [F.sum("_rows").alias(count_as), F.round(mean, decimals).alias(mean_as), least_pair("_user", "_weight").alias("_best")]
