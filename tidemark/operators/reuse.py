"""Keeping an intermediate result while several jobs read it."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tidemark.scratch import stage

WAYS = ("auto", "again", "cache", "stage")

# What a job repeats at no more than the cost of reading a kept copy: scans of columns, comparisons, plain arithmetic.
LIGHT_NODES = {"Project", "Filter", "Range", "LocalRelation", "LogicalRelation", "OneRowRelation", "SubqueryAlias"}
LIGHT_EXPRESSIONS = {
    "AttributeReference", "Alias", "Literal", "Cast", "IsNull", "IsNotNull", "Not", "And", "Or", "EqualTo", "EqualNullSafe", "LessThan",
    "LessThanOrEqual", "GreaterThan", "GreaterThanOrEqual", "In", "InSet", "Add", "Subtract", "Multiply", "Remainder", "UnaryMinus",
    "CheckOverflow", "GetStructField"}


def _all(items) -> list:
    return [items.apply(i) for i in range(items.size())]


def _light(expression) -> bool:
    return expression.getClass().getSimpleName() in LIGHT_EXPRESSIONS and all(_light(c) for c in _all(expression.children()))


def _repeatable(plan) -> bool:
    """Whether a plan only reads columns, compares and calculates."""
    return (plan.nodeName() in LIGHT_NODES and all(_light(e) for e in _all(plan.expressions()))
            and all(_repeatable(c) for c in _all(plan.children())))


def free_storage(df: DataFrame) -> int:
    """Bytes that executors could still cache."""
    held = df.sparkSession.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    free = 0
    while held.hasNext():
        free += held.next()._2()
    return free


def choose(df: DataFrame) -> str:
    """How best to read ``df`` several times: "again", "cache" or "stage".

    A plan without joins, aggregates, parsing or functions is read again, since that costs what
    reading a copy costs.  Of the others one whose size, as the planner knows it, takes no more than
    half of the memory left for caching is cached; a larger one is written, where the next
    jobs read only the columns they need and a lost executor costs nothing.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if _repeatable(plan):
        return "again"
    return "cache" if int(str(plan.stats().sizeInBytes())) <= free_storage(df) // 2 else "stage"


@contextmanager
def reuse(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, how: str = "auto") -> Iterator[DataFrame]:
    """``df`` for several jobs, kept in the way ``how`` says or ``choose`` finds best.

    A cache is filled by the first job that reads it and released on leaving; partitions that
    do not fit spill to disk, and those lost with an executor are computed again.  "stage" runs a
    job now.  Reading is never wrong, at worst slower.
    """
    if how not in WAYS:
        raise ValueError(f"unknown way {how!r}, expected one of {WAYS}")
    way = choose(df) if how == "auto" else how
    if way == "again":
        yield df
    elif way == "stage":
        yield stage(df, "reused")
    else:
        kept = df.persist(level)
        try:
            yield kept
        finally:
            kept.unpersist()
