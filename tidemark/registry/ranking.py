"""Orders, top-k, best in group."""

from pyspark.sql import functions as F

from tidemark.operators.aggregates import counts_by_place
from tidemark.operators.ranking import numbered, preview, sort_by, top_k, top_per_group
from tidemark.registry import QueryBook, read
from tidemark.registry.joins import places

book = QueryBook()


@book.query("WIN-1", """
SELECT event_type, user_id, value FROM (
  SELECT event_type, user_id, value,
         row_number() OVER (PARTITION BY event_type ORDER BY value DESC, user_id, event_id) AS rank
  FROM events) WHERE rank = 1""")
def top_user_per_type(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_type", "user_id", "value", "event_id")
    best = top_per_group(events, "event_type", [F.col("value").desc(), "user_id", "event_id"])
    return best.select("event_type", "user_id", "value")


@book.query("WIN-1", """
SELECT * FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
  FROM orders) WHERE rank <= 3""")
def top_orders_per_customer(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_per_group(orders, "o_custkey", [F.col("o_totalprice").desc(), "o_orderkey"], 3)


@book.query("SRT-1", """SELECT l_suppkey, count(*) AS lines,
                               row_number() OVER (ORDER BY count(*) DESC, l_suppkey) AS place
                        FROM lineitem GROUP BY l_suppkey ORDER BY lines DESC, l_suppkey""")
def sorted_suppliers(spark, sf_dir):
    """With its place in every row, so that the order is compared and not just the rows."""
    counts = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"))
    return sort_by(numbered(counts, F.col("lines").desc(), "l_suppkey"), "place")


@book.query("SRT-1 WIN-1", """
SELECT l_suppkey, l_orderkey, l_linenumber,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS place
FROM lineitem""")
def places_in_large_groups(spark, sf_dir):
    """Three groups, each sorted by as many tasks as it fills."""
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    placed = numbered(lines, F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", within=["l_returnflag"])
    return placed.select("l_suppkey", "l_orderkey", "l_linenumber", "place")


@book.query("SRT-2", """
SELECT o_custkey, orders, CAST(row_number() OVER (ORDER BY orders DESC, o_custkey) AS INTEGER) AS place
FROM (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey)
ORDER BY orders DESC, o_custkey LIMIT 25""")
def top_customers(spark, sf_dir):
    counts = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return top_k(counts, 25, F.col("orders").desc(), F.col("o_custkey"), rank_as="place")


@book.query("SRT-3 AGG-6", """
SELECT n_name AS name, count(*) AS posts FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name ORDER BY posts DESC, name LIMIT 10""")
def place_preview(spark, sf_dir):
    return preview(counts_by_place(places(spark, sf_dir)), 10, F.col("posts").desc(), "name")
