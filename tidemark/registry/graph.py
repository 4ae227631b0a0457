"""Interaction graph: customers order from suppliers."""

from pyspark.sql import functions as F

from tidemark.operators.graph import (degree_distribution, edge_list, filter_edges, in_degree,
                                      out_degree, out_strength, ranked_by, raw_edges)
from tidemark.plans.interactions import activity_distribution, interaction_graph
from tidemark.registry import QueryBook, read
from tidemark.registry.aggregates import HASHED

book = QueryBook()


def interactions(spark, sf_dir):
    """Order lines as reshares of a supplier's post by a customer."""
    lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.struct(F.col("o_custkey").alias("id")).alias("user"),
        F.struct(F.struct(F.col("l_suppkey").alias("id")).alias("user")).alias("reshared"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"))


SRC, DST = "user.id", "reshared.user.id"
RAW = """WITH raw AS (SELECT o_custkey AS src, l_suppkey AS dst,
                             l_orderkey || '-' || l_linenumber AS line
                      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
EDGES = RAW.rstrip() + """,
     edges AS (SELECT src, dst, count(*) AS weight FROM raw GROUP BY src, dst)
"""


@book.query("GRF-1", EDGES + "SELECT * FROM edges")
def weighted_edges(spark, sf_dir):
    return edge_list(interactions(spark, sf_dir), SRC, DST)


@book.query("GRF-2", EDGES + "SELECT * FROM edges WHERE weight >= 2")
def repeated_edges(spark, sf_dir):
    return filter_edges(edge_list(interactions(spark, sf_dir), SRC, DST))


@book.query("GRF-3 SRT-1", EDGES + """SELECT src AS "user", count(*) AS out_degree FROM edges
                                      WHERE weight >= 2 GROUP BY src""")
def out_degrees(spark, sf_dir):
    edges = filter_edges(edge_list(interactions(spark, sf_dir), SRC, DST))
    return ranked_by(out_degree(edges), "out_degree")


@book.query("GRF-4 SRT-1", EDGES + """SELECT dst AS "user", count(*) AS in_degree FROM edges
                                      WHERE weight >= 2 GROUP BY dst""")
def in_degrees(spark, sf_dir):
    edges = filter_edges(edge_list(interactions(spark, sf_dir), SRC, DST))
    return ranked_by(in_degree(edges), "in_degree")


@book.query("GRF-5", RAW + "SELECT src, dst FROM raw")
def interaction_rows(spark, sf_dir):
    return raw_edges(interactions(spark, sf_dir), SRC, DST)


@book.query("GRF-6", RAW + """SELECT src AS "user", count(*) AS out_strength FROM raw GROUP BY src""")
def out_strengths(spark, sf_dir):
    return out_strength(raw_edges(interactions(spark, sf_dir), SRC, DST))


@book.query("GRF-7", EDGES + """, degrees AS (SELECT src, count(*) AS out_degree FROM edges GROUP BY src)
SELECT out_degree, count(*) AS users FROM degrees GROUP BY out_degree""")
def degree_distribution_distinct(spark, sf_dir):
    degrees = out_degree(edge_list(interactions(spark, sf_dir), SRC, DST))
    return degree_distribution(degrees, "out_degree").orderBy("out_degree")


@book.query("GRF-7 GRF-6", RAW + """, strengths AS (SELECT src, count(*) AS out_strength FROM raw GROUP BY src)
SELECT out_strength, count(*) AS users FROM strengths GROUP BY out_strength""")
def degree_distribution_raw(spark, sf_dir):
    strengths = out_strength(raw_edges(interactions(spark, sf_dir), SRC, DST))
    return degree_distribution(strengths, "out_strength").orderBy("out_strength")


# Thresholds of a 50% and a 1% hash sample.
HALF, HUNDREDTH = 2147483648, 42949672


@book.query("GRF-2 GRF-3 SMP-1", f"""
WITH edges AS (SELECT o_custkey AS src, l_suppkey AS dst, count(*) AS weight
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               WHERE {HASHED.format(key="(l_orderkey || '-' || l_linenumber)")} < {HALF}
               GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT src AS "user", count(*) AS out_degree FROM edges GROUP BY src""")
def sampled_graph(spark, sf_dir):
    return interaction_graph(interactions(spark, sf_dir), SRC, DST, "line", 0.5).out_degree


@book.query("GRF-5 GRF-7 SMP-1", f"""
WITH strengths AS (SELECT o_custkey AS src, count(*) AS out_strength
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                   WHERE {HASHED.format(key="(l_orderkey || '-' || l_linenumber)")} < {HUNDREDTH}
                   GROUP BY 1)
SELECT out_strength, count(*) AS users FROM strengths GROUP BY out_strength""")
def sampled_activity(spark, sf_dir):
    return activity_distribution(interactions(spark, sf_dir), SRC, DST, "line")
