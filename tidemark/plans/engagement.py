"""Who gets reshared most for the number of posts they make."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import user_profile
from tidemark.operators.joins import engagement_ratio


def engagement(posts: DataFrame, reshares: DataFrame, user: str, author_of_original: str,
               counters: Mapping[str, str], only: Column | None = None,
               user_as: str = "user", times: str | None = None) -> DataFrame:
    """Profiles of the chosen users, reshares received and their ratio, best ratio first.

    ``posts`` and ``reshares`` may be the same table.  ``times`` names the column of
    ``reshares`` that holds counts, if they were counted before.
    """
    users = user_profile(posts, user, counters, only, user_as)
    rated = engagement_ratio(users, reshares, author_of_original, user_as, times=times)
    return rated.orderBy(F.col("ratio").desc(), F.col(user_as))
