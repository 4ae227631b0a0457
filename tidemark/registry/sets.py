"""Set operations."""

from pyspark.sql import functions as F

from tidemark.operators.sets import intersect, subtract, union_distinct
from tidemark.registry import QueryBook, read

book = QueryBook()


def _users(spark, sf_dir, kind):
    return read(spark, sf_dir, "events").where(F.col("event_type") == kind).select("user_id")


@book.query("SET-1", """SELECT user_id FROM events WHERE event_type = 'click'
                        INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase'""")
def users_in_both(spark, sf_dir):
    return intersect(_users(spark, sf_dir, "click"), _users(spark, sf_dir, "purchase"))


@book.query("SET-2", """
SELECT l_suppkey AS part_or_supplier FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_size < 40 AND p_partkey = l_suppkey)""")
def difference_with_repeats(spark, sf_dir):
    """Keys of all lines less those of some parts: what survives keeps its repeats."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("part_or_supplier"))
    parts = read(spark, sf_dir, "part").where("p_size < 40").select("p_partkey")
    return subtract(lines, parts)


@book.query("SET-3 SRT-1", """SELECT c_custkey AS id FROM customer UNION SELECT o_custkey FROM orders
                              ORDER BY id DESC""")
def union_without_repeats(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    buyers = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    return union_distinct(customers, buyers)
