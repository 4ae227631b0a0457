"""Per language and sliding window: posts, mean length, most followed user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import plain_time
from tidemark.operators.joins import combined_totals, least_pair, per_user_totals
from tidemark.operators.ranking import top_k
from tidemark.streaming.windows import in_panes, paned, top_in_window, windows_of, with_watermark


def dashboard(posts: DataFrame, ts: str, size: str, slide: str, key: str = "language",
              length: str = "size", user: str = "user", weight: str = "followers",
              delay: str | None = None, count_as: str = "n",
              mean_as: str = "avg_size", panes: bool | None = None) -> DataFrame:
    """One row per window and key, from a stream or a table.

    Users of equal weight are taken in order of name.  No ranking is involved; the best
    user is a mergeable minimum, so a busy key is reduced before it is shuffled.  Rows are
    first reduced per user (and slide, where windows consist of slides) by hash
    aggregates, and only these few are compared.  On a stream with a delay that is two
    stateful aggregates, of which the second takes a user's window when it closes, so a
    late row counts in all windows still open; with ``panes=True`` the first is per slide
    (see ``paned``).  A stream without a delay never closes a window: take ``user_panes``
    there, and ``dashboard_of`` in the batch function.
    """
    rows = with_watermark(posts, ts, delay)
    by_pane = paned(posts, size, slide, delay, panes)
    first = F.window(ts, slide) if by_pane else F.window(ts, size, slide)
    if posts.isStreaming and delay is None:
        counted = rows.groupBy(first.alias("window"), key).agg(
            F.count(F.lit(1)).alias(count_as), F.round(F.avg(length), 2).alias(mean_as),
            least_pair(user, weight).alias("best"))
        return _flat(counted, key, count_as, mean_as, user, weight)
    per_user = per_user_totals(rows.groupBy(first.alias("pane"), key, F.col(user).alias("_user")), length, weight)
    return _per_window(per_user, windows_of("pane", size, slide) if by_pane else F.col("pane"), key, user, weight, count_as, mean_as)


def _per_window(per_user: DataFrame, window: Column, key: str, user: str, weight: str, count_as: str, mean_as: str) -> DataFrame:
    counted = per_user.groupBy(window.alias("window"), key).agg(*combined_totals(count_as, mean_as)).withColumnRenamed("_best", "best")
    return _flat(counted, key, count_as, mean_as, user, weight)


def _flat(counted: DataFrame, key: str, count_as: str, mean_as: str, user: str, weight: str) -> DataFrame:
    return counted.select(
        plain_time("window.start").alias("window_start"), plain_time("window.end").alias("window_end"),
        key, count_as, mean_as, F.col("best.u").alias(user), (-F.col("best.w")).alias(weight))


def user_panes(posts: DataFrame, ts: str, slide: str, key: str = "language", length: str = "size",
               user: str = "user", weight: str = "followers") -> DataFrame:
    """Totals per slide, key and user since a stream began: a row is counted once, whatever the windows."""
    return per_user_totals(posts.groupBy(F.window(ts, slide).alias("pane"), key, F.col(user).alias("_user")), length, weight)


def dashboard_of(panes: DataFrame, size: str, slide: str, key: str = "language", user: str = "user", weight: str = "followers",
                 count_as: str = "n", mean_as: str = "avg_size") -> DataFrame:
    """The dashboard from a table of ``user_panes``; windows have to consist of whole slides."""
    if not in_panes(size, slide):
        raise ValueError("windows have to consist of whole slides")
    return _per_window(panes, F.window(F.col("pane.start"), size, slide), key, user, weight, count_as, mean_as)


def busiest(rows: DataFrame, k: int = 10, key: str = "language", count: str = "n") -> DataFrame:
    """The ``k`` busiest keys of each window."""
    return top_in_window(rows, k, [key], count)


DASHBOARD_SQL = """
SELECT {key}, count(*) AS n, round(avg({length}), 2) AS avg_size,
       min_by({user}, struct({weight} IS NULL, -{weight}, {user})) AS {user}, max({weight}) AS {weight}
FROM {view} GROUP BY {key}
"""


def dashboard_sql(posts: DataFrame, view: str, key: str = "language", length: str = "size",
                  user: str = "user", weight: str = "followers", k: int = 10) -> DataFrame:
    """The same over one table without windows, in SQL: the ``k`` busiest keys."""
    posts.createOrReplaceTempView(view)
    rows = posts.sparkSession.sql(DASHBOARD_SQL.format(
        view=view, key=f"`{key}`", length=f"`{length}`", user=f"`{user}`", weight=f"`{weight}`"))
    return top_k(rows, k, F.col("n").desc(), F.col(key).asc())
