"""Joins of aggregates.

Customers stand for users, their orders for posts, the lines of their orders for
reshares received, nations for places, suppliers of a nation for its seats.
"""

from pyspark.sql import functions as F

from tidemark.operators.aggregates import min_ratio_floor
from tidemark.operators.joins import aggregate_with_top, ratio_to_capacity
from tidemark.plans.dashboard import dashboard_sql
from tidemark.plans.engagement import engagement
from tidemark.plans.strata import place_ratios
from tidemark.registry import QueryBook, read

book = QueryBook()


def user_posts(spark, sf_dir):
    """Orders as posts with a nested user."""
    customers, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("lang"),
                 F.col("o_totalprice").alias("price"), F.col("c_acctbal").alias("balance")).alias("user"),
        F.col("o_orderkey").alias("id"))


def reshared_lines(spark, sf_dir):
    """Order lines as reshares of a post by the customer who ordered, one row per post with ``times``."""
    lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("times"))
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.struct(F.struct(F.col("o_custkey").alias("id")).alias("user")).alias("reshared"), "times")


@book.query("JOIN-1 AGG-2 AGG-3 SRT-1 PRJ-2 PRJ-4", """
WITH users AS (
  SELECT c_custkey AS user_id, max(o_totalprice) AS max_price, max(c_acctbal) AS balance,
         count(*) AS posts
  FROM customer JOIN orders ON c_custkey = o_custkey
  WHERE c_mktsegment = 'BUILDING' GROUP BY c_custkey
), received AS (
  SELECT o_custkey AS user_id, count(*) AS received
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey
)
SELECT user_id, max_price, balance, posts, received, received / CAST(posts AS DOUBLE) AS ratio
FROM users JOIN received USING (user_id) ORDER BY ratio DESC, user_id""")
def engagement_ratio(spark, sf_dir):
    return engagement(
        user_posts(spark, sf_dir), reshared_lines(spark, sf_dir), "user.id", "reshared.user.id",
        {"max_price": "user.price", "balance": "user.balance"},
        F.col("user.lang") == "BUILDING", "user_id", "times")


def places(spark, sf_dir):
    """Customers as posts with a nested place."""
    customers, nations = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.struct(F.col("n_name").alias("name")).alias("place"), F.col("c_custkey").alias("id"))


def seats(spark, sf_dir):
    """Nations with their number of suppliers."""
    suppliers, nations = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    counts = suppliers.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("seats"))
    return counts.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("capital"), "seats")


PLACE_RATIOS = """
WITH seats AS (SELECT n_name AS capital, count(*) AS seats FROM supplier
               JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name),
     posts AS (SELECT n_name AS capital, count(*) AS posts FROM customer
               JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
     ratios AS (SELECT capital, posts, seats, posts / CAST(seats AS DOUBLE) AS ratio
                FROM seats JOIN posts USING (capital))
"""


def ratios(spark, sf_dir):
    return place_ratios(places(spark, sf_dir), seats(spark, sf_dir), "place.name", "capital", "seats")


@book.query("JOIN-2 MTH-1 SRT-1", PLACE_RATIOS + "SELECT * FROM ratios ORDER BY ratio, capital")
def capacity_ratio(spark, sf_dir):
    return ratios(spark, sf_dir).orderBy("ratio", "capital")


@book.query("JOIN-2", """
WITH stock AS (SELECT l_partkey, count(*) AS lines FROM lineitem GROUP BY l_partkey)
SELECT p_partkey, lines, p_size AS capacity, CASE WHEN p_size = 0 THEN NULL
       ELSE lines / CAST(p_size AS DOUBLE) END AS ratio
FROM part JOIN stock ON p_partkey = l_partkey""")
def capacity_ratio_large(spark, sf_dir):
    """The same with a dimension that grows with the data."""
    parts = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("capacity"))
    lines = read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("lines"))
    return ratio_to_capacity(parts, lines, "p_partkey", "l_partkey", "capacity", "lines")


@book.query("AGG-13 MTH-1", PLACE_RATIOS + "SELECT floor(min(ratio) * 100) / 100 AS min_ratio FROM ratios")
def smallest_ratio(spark, sf_dir):
    return min_ratio_floor(ratios(spark, sf_dir), "ratio")


TYPE_SUMMARY = """
SELECT event_type, count(*) AS n, round(avg(length(props)), 2) AS avg_size,
       first(user_id ORDER BY value DESC, user_id) AS user_id, max(value) AS value
FROM events GROUP BY event_type"""


@book.query("JOIN-3 AGG-12 WIN-1", TYPE_SUMMARY)
def type_summary(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("size", F.length("props"))
    return aggregate_with_top(events, "event_type", "size", "user_id", "value")


@book.query("JOIN-3 SRT-2 SRC-10", TYPE_SUMMARY + " ORDER BY n DESC, event_type LIMIT 10")
def type_summary_sql(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("size", F.length("props"))
    return dashboard_sql(events, "event_sizes", "event_type", "size", "user_id", "value")
