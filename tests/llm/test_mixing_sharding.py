import collections

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, sharding


@pytest.fixture(scope="module")
def skewed(spark):
    """Source a holds two thirds of the rows."""
    return spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', int(1 + id * 7919 % 40))").alias("text"),
                                    F.expr("CASE WHEN id % 3 < 2 THEN 'a' WHEN id % 2 = 0 THEN 'b' END").alias("source"))


def targets(sizes, weights, share, most):
    """Shares by weight, the excess over each cap dealt out again until nothing is above."""
    left, fixed = dict(zip(sorted(sizes), weights)), {}
    budget = share * sum(sizes.values())
    while left:
        over = {s for s, w in left.items() if budget * w / sum(left.values()) > most * sizes[s] + 1e-9}
        if not over:
            return fixed | {s: budget * w / sum(left.values()) for s, w in left.items()}
        for s in over:
            fixed[s] = most * sizes[s]
            budget -= fixed[s]
            del left[s]
    return fixed


def test_sources_come_near_their_targets(skewed):
    rows = mixing.mix(skewed).collect()
    by = collections.defaultdict(int)
    for r in rows:
        by[r["source"] or "~"] += r["size"] * r["passes"]
        assert 0 <= r["passes"] <= 2
    sizes = {r["source"] or "~": r["source_size"] for r in rows}
    want = targets(sizes, [5, 2, 1], 1.5, 2)
    found = {r["source"] or "~": r["target"] for r in rows}
    assert found == pytest.approx(want)
    for source, target in want.items():
        assert abs(by[source] - target) <= 80
    again = mixing.mix(skewed.repartition(5)).select("doc_id", "passes").collect()
    assert sorted(again) == sorted((r["doc_id"], r["passes"]) for r in rows)


def test_small_slices_find_the_same_cut(skewed, monkeypatch):
    whole = sorted(mixing.mix(skewed).select("doc_id", "passes").collect())
    monkeypatch.setattr(mixing, "SMALL_SLICE", 1)
    assert sorted(mixing.mix(skewed).select("doc_id", "passes").collect()) == whole


def test_water_levels(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 0}
    df = spark.createDataFrame(list(sizes.items()), "skey string, source_size long")
    got = {r["skey"]: r["target"] for r in mixing.water_levels(df).collect()}
    assert got == pytest.approx(targets(sizes, [5, 2, 1, 5], 1.5, 2))


def test_mix_of_edge_rows(edge_docs, no_docs):
    mixed = mixing.mix(edge_docs)
    assert mixed.count() == edge_docs.count()
    assert mixed.where("source IS NULL").select("source_size").distinct().count() == 1
    assert set(edge_docs.columns) <= set(mixed.columns)
    assert mixing.taken_rows(mixed, edge_docs.columns).columns == edge_docs.columns
    assert mixing.mix(no_docs).count() == 0
    order = [r["finish"] for r in mixing.in_queue_order(mixed).collect()]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))


def test_shards_match_the_mixture(skewed):
    shards = 7
    rows = sharding.assign_shards(skewed, shards).collect()
    counts = collections.Counter(r["shard"] for r in rows)
    assert sorted(counts) == list(range(shards)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(counts[shard]))
    for source in ("a", "b", None):
        of = collections.Counter(r["shard"] for r in rows if r["source"] == source)
        assert max(of.values()) - min(of.values()) <= 3
    again = sharding.assign_shards(skewed.repartition(3), shards).select("doc_id", "shard", "slot").collect()
    assert sorted(again) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows)


def test_shards_of_edge_rows(edge_docs, no_docs, spark, folder):
    placed = sharding.assign_shards(edge_docs, 4)
    assert placed.count() == edge_docs.count() and placed.columns.count("shard") == 1
    assert sorted(r["count"] for r in placed.groupBy("shard").count().collect()) == [3, 3, 3, 4]
    assert sharding.assign_shards(no_docs, 4).count() == 0
    sharding.write_shards(placed, f"{folder}/shards")
    assert spark.read.parquet(f"{folder}/shards").count() == edge_docs.count()
