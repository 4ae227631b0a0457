"""Sorting, top-k and best-in-group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import stage


def descending(*keys: str) -> list[Column]:
    return [F.col(k).desc() for k in keys]


def sort_by(df: DataFrame, *order: str | Column) -> DataFrame:
    """Total order over the whole table (a range shuffle, parallel)."""
    return df.orderBy(*order)


def numbered(df: DataFrame, *order: str | Column, name: str = "place", within: Sequence[str] = ()) -> DataFrame:
    """All rows with their place in a total order, or in that of their group ``within``, from 1 (runs jobs).

    The table is written once, sorted over as many tasks as it fills.  A place is the row's
    place in its task plus the rows of its group in the tasks before.  Sorted, only the first
    group of a task can have begun earlier, so one number per task settles that; these come
    to the driver, as many as tasks.
    """
    rows = stage(df.orderBy(*within, *order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_task", F.shiftright("_at", 33).cast("int"))
    groups = [F.col(c) for c in within]
    if not within:
        counts = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).orderBy("_task").collect()
        before, seen = {}, 0
        for task, n in counts:
            before[task], seen = seen, seen + n
        place = _by_task(before) + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
        return rows.withColumn(name, place).drop("_at", "_task")
    inside = Window.partitionBy("_task", *groups).orderBy("_at")
    per_group = rows.groupBy("_task", *groups).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    key = F.struct(*groups)
    ends = per_group.groupBy("_task").agg(
        F.min_by(key, "_first").alias("first"), F.max_by(key, "_first").alias("last"), F.max_by("_n", "_first").alias("n"),
        F.min("_first").alias("start")).orderBy("_task").collect()
    carried, starts, last, open_rows = {}, {}, None, 0
    for task, first, final, n, start in ends:
        carried[task] = open_rows if last is not None and first == last else 0
        open_rows = n + (carried[task] if first == final else 0)
        starts[task], last = start, final
    local = rows.withColumn(name, F.row_number().over(inside).cast("long")).withColumn("_first", F.min("_at").over(inside))
    begun = F.when(F.col("_first") == _by_task(starts), _by_task(carried)).otherwise(0)
    return local.withColumn(name, F.col(name) + begun).drop("_at", "_task", "_first")


def _by_task(values: dict[int, int]) -> Column:
    """The number that belongs to the row's task."""
    if not values:
        return F.lit(0).cast("long")
    listed = [values.get(task, 0) for task in range(max(values) + 1)]
    return F.get(F.lit(listed).cast("array<bigint>"), F.col("_task"))


def top_k(df: DataFrame, k: int, *order: str | Column, rank_as: str | None = None) -> DataFrame:
    """First ``k`` rows of an order; each task keeps only its own best ``k``.

    Give a total order, so that ties are settled.  ``rank_as`` numbers the ``k``
    rows that are left.
    """
    best = df.orderBy(*order).limit(k)
    if rank_as is None:
        return best
    return best.withColumn(rank_as, F.row_number().over(Window.orderBy(*order)))


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """A few rows to look at, the same ones every time."""
    return df.orderBy(*(order or [F.col(f"`{c}`") for c in df.columns])).limit(n)


def top_per_group(df: DataFrame, groups: str | Sequence[str], order: Sequence[str | Column],
                  n: int = 1, rank_as: str = "rank") -> DataFrame:
    """First ``n`` rows of each group, numbered.

    The rank filter lets Spark cut every group to ``n`` rows per task before the
    shuffle, so a huge group is never gathered.
    """
    groups = [groups] if isinstance(groups, str) else list(groups)
    by = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_as, F.row_number().over(by)).where(F.col(rank_as) <= n)
