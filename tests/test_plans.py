"""What the plans must and must not contain, judged at sizes where nothing is broadcast for free."""

import importlib.util
import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.sampling import sample_stratified
from tidemark.registry import all_entries, read
from tidemark.scratch import stage

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("plans", os.path.join(ROOT, "tools", "plans.py"))
plans = importlib.util.module_from_spec(spec)
spec.loader.exec_module(plans)

# Streams run before they return; there is nothing left to plan.
BATCH = [n for n, e in all_entries().items() if e.run.__module__ != "tidemark.registry.streams"]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def gathered(df):
    """What is sent to one task without having been reduced before: the nodes below such exchanges.

    Allowed are partial aggregates, limits, and counts per task (``_task``).
    """
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    lines = [re.sub(r"^[\s:+\-*()\d]*", "", line) for line in lines]
    below = [lines[i + 1] for i, line in enumerate(lines) if line.startswith("Exchange SinglePartition")]
    return [b for b in below if not re.match(r"\w*Aggregate\(keys=\[.*\], functions=\[(partial_|merge_)|LocalLimit|"
                                             r".*output=\[_task|Project \[_task|TakeOrdered", b)]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_nothing_gathered(no_broadcast, sf_dir, name):
    found = all_entries()[name].run(no_broadcast, sf_dir)
    text = plans.plan_text(found)
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert gathered(found) == []


def test_a_bad_plan_is_found(no_broadcast, sf_dir):
    orders = read(no_broadcast, sf_dir, "orders")
    everything = Window.orderBy("o_orderkey")
    assert gathered(orders.withColumn("n", F.row_number().over(everything)))
    by_customer = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    assert gathered(by_customer.withColumn("place", F.row_number().over(Window.orderBy("n"))))


@pytest.mark.parametrize("name", ["type_summary", "language_dashboard_stored"])
def test_raw_rows_are_not_sorted_before_they_are_reduced(no_broadcast, sf_dir, name):
    """Below the first exchange there are hash aggregates only."""
    tree = plans.plan_text(all_entries()[name].run(no_broadcast, sf_dir)).split("\n\n")[0]
    below = tree[tree.rindex("Exchange ("):]
    assert "HashAggregate" in below and "Sort" not in below


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plans.plan_text(all_entries()["where_by_value"].run(spark, sf_dir))
    assert "EqualTo(lang,es)" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in text


def test_rank_filter_cuts_groups_before_the_shuffle(spark, sf_dir):
    tree = plans.plan_text(all_entries()["top_user_per_type"].run(spark, sf_dir)).split("\n\n")[0]
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")
    assert tree.count("WindowGroupLimit") == 2


def test_small_staged_fractions_spare_the_big_side_a_shuffle(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").withColumn("k", F.col("c_nationkey"))
    fractions = stage(customers.select("k").distinct().withColumn("fraction", F.lit(0.5)))
    text = plans.plan_text(sample_stratified(customers, "k", fractions, "c_custkey"))
    tree = text.split("\n\n")[0]
    assert "BroadcastHashJoin" in tree and not re.search(r"(?<!Broadcast)Exchange", tree)


def test_large_fractions_are_shuffled(no_broadcast, sf_dir):
    customers = read(no_broadcast, sf_dir, "customer").withColumn("k", F.col("c_nationkey"))
    fractions = stage(customers.select("k").distinct().withColumn("fraction", F.lit(0.5)))
    tree = plans.plan_text(sample_stratified(customers, "k", fractions, "c_custkey")).split("\n\n")[0]
    assert "SortMergeJoin" in tree


def test_engagement_joins_one_row_per_user(no_broadcast, sf_dir):
    text = plans.plan_text(all_entries()["engagement_ratio"].run(no_broadcast, sf_dir))
    tree = text.split("\n\n")[0]
    assert tree.count("SortMergeJoin") == 3
    # Two joins of tables (four shuffles), the received counts, the final order.
    assert len(re.findall(r"(?<!Broadcast)Exchange \(", tree)) <= 6
