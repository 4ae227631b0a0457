import hashlib
import math

import numpy as np
import pytest

from tests.conftest import rows
from tidemark.llm import shallot


def brute(data, dims, count, rounds, scale=1024, seed=3):
    """Every vector against every centroid in Python's whole numbers."""
    kept = [(i, [math.floor(scale * x) for x in v], v) for i, v in data
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    at = [c for _, c, _ in sorted(kept, key=lambda r: (digest(r[0]), r[2]))[:count]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda c: min(range(len(at)), key=lambda j: (far(c, at[j]), j))
    for _ in range(rounds):
        of = [nearest(c) for _, c, _ in kept]
        for j in range(len(at)):
            mine = [c for (_, c, _), k in zip(kept, of) if k == j]
            if mine:
                at[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, k, far(c, at[k])) for i, c, _ in kept for k in [nearest(c)]]
    inertia = {k: sum(d for _, j, d in found if j == k) for k in range(len(at))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted([(i, k, d, inertia[k], sum(inertia.values()), names[k]) for i, k, d in found], key=repr)


def vectors(dims, number, groups, seed):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(groups, dims))
    data = [(i, [float(np.float32(x)) for x in centres[rnd.integers(groups)] + rnd.normal(size=dims) * 0.3]) for i in range(number)]
    data += [(1000 + i, data[i][1]) for i in range(5)] + [data[3], data[3], (7, data[9][1]), (None, data[2][1]), (None, data[4][1])]
    data += [(2000, None), (2001, [0.0] * dims), (2002, [float("nan")] * dims), (2003, [None] + [1.0] * (dims - 1)), (2004, [float("inf")] * dims),
             (2005, []), (2006, [1.0] * (dims + 1)), (2007, [-0.0001] * dims), (2008, [120000.0] * dims)]
    return data


@pytest.mark.parametrize("dims, number, groups, count, rounds", [(4, 300, 6, 8, 10), (3, 200, 2, 12, 4), (2, 60, 3, 1, 3), (5, 12, 1, 60, 2), (4, 50, 4, 3, 0)])
def test_clusters_are_those_of_brute_force(spark, monkeypatch, dims, number, groups, count, rounds):
    monkeypatch.setattr(shallot, "BLOCK", 16)
    data = vectors(dims, number, groups, dims * number)
    df = spark.createDataFrame([(i, v, "x") for i, v in data], "vec_id long, embedding array<double>, cluster string").repartition(3)
    tables = spark.catalog.listTables()
    got = shallot.clusters(df, dims=dims, count=count, rounds=rounds)
    assert rows(got) == brute(data, dims, count, rounds)
    assert spark.catalog.listTables() == tables


@pytest.mark.parametrize("seed", range(4))
def test_remembered_bounds_never_miss_a_nearer_centroid(seed):
    """Whole numbers on a small grid, so ties abound; the state goes through moves of many sizes."""
    rnd = np.random.default_rng(seed)
    codes = rnd.integers(-6, 7, (500, 2)).astype(np.int32)
    at = rnd.integers(-6, 7, (9, 2))
    centroids, state = shallot.centroids_of(at), None
    for _ in range(12):
        state = shallot.assign(codes, centroids, state)
        every = np.stack([shallot.squared(codes, c) for c in centroids.at], axis=1)
        assert (state.nearest == every.argmin(axis=1)).all()
        mine = every[np.arange(len(codes)), state.nearest].astype(float)
        rest = every.astype(float)
        rest[np.arange(len(codes)), state.nearest] = np.inf
        assert (state.upper >= np.sqrt(mine)).all() and (state.lower <= np.sqrt(rest.min(axis=1))).all()
        centroids = shallot.centroids_of(at := at + rnd.integers(-2, 3, at.shape), centroids.at)


def test_most_vectors_keep_their_centroid_without_a_look(monkeypatch):
    rnd = np.random.default_rng(1)
    codes = (rnd.integers(0, 4, 4000)[:, None] * 1000 + rnd.normal(size=(4000, 8)) * 20).astype(np.int32)
    centroids = shallot.centroids_of(codes[[0, 1, 2, 3, 4, 5]].astype(np.int64))
    state, looks = None, []
    plain = shallot.squared
    monkeypatch.setattr(shallot, "squared", lambda c, a: (looks.append(len(c)), plain(c, a))[1])
    for _ in range(8):
        looks.clear()
        state = shallot.assign(codes, centroids, state)
        at = np.array([codes[state.nearest == i].mean(axis=0) if (state.nearest == i).any() else c for i, c in enumerate(centroids.at)])
        centroids = shallot.centroids_of(np.floor(at).astype(np.int64), centroids.at)
    assert sum(looks) < 2 * len(codes)


def test_rounds_join_blocks_and_states_without_a_shuffle(spark):
    data = spark.range(500).selectExpr("id AS block", "CAST('x' AS BINARY) AS codes")
    names = [shallot._bucketed(data.repartition(4, "block"), 4), shallot._bucketed(data.selectExpr("block", "codes AS nearest").repartition(4, "block"), 4)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table(names[0]).join(spark.table(names[1]), "block")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in names:
            spark.sql(f"DROP TABLE {name}")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_empty_tables_and_huge_components(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert shallot.clusters(empty).count() == 0
    assert shallot.clusters(empty).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(ValueError, match="64 bits"):
        shallot.whole(np.array([[1e30]]), 1024)
