import math

import numpy as np
import pytest

from tidemark.llm import nearest as nn


def brute(rows, queries, k):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v):
            usable.setdefault(i, []).append(v)
    out = []
    for q in sorted(set(queries) & set(usable)):
        found = sorted((min(math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))) for x in usable[q] for y in ys if len(x) == len(y)), c)
                       for c, ys in usable.items() if c != q and any(len(x) == len(y) for x in usable[q] for y in ys))
        out += [(q, rank, c, d) for rank, (d, c) in enumerate(found[:k], 1)]
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = np.random.default_rng(3)
    data = [(i, [float(np.float32(x)) for x in rnd.normal(size=16)]) for i in range(700)]
    data += [(1000 + i, data[i][1]) for i in range(20)]                     # ties
    data += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] + [1.0] * 15), (2004, [float("inf")] * 16),
             (2005, []), (2006, [1.0, 2.0]), (2010, [1.0, 2.5]), (None, [1.0] * 16), (5, data[9][1]), (5, data[5][1]),
             (2007, [1e30] * 16), (2008, [1e-30] * 16)]
    return data


@pytest.mark.parametrize("blocks", [(4096, 512), (64, 8)])
def test_nearest_are_those_of_brute_force(spark, rows, blocks):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = nn.nearest(df, df.where("vec_id % 5 = 0"), 7, candidate_block=blocks[0], query_block=blocks[1])
    found = sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())
    want = brute(rows, [i for i, _ in rows if i is not None and i % 5 == 0], 7)
    assert [f[:3] for f in found] == [w[:3] for w in want]
    assert [f[3] for f in found] == pytest.approx([w[3] for w in want], rel=1e-12)


def test_bounds_hold():
    rnd = np.random.default_rng(0)
    a, b = rnd.normal(size=(200, 8)), rnd.normal(size=(200, 8)) * rnd.choice([1e-6, 1, 1e6], (200, 1))
    (ca, sa, ea), (cb, sb, eb) = nn.quantise(a), nn.quantise(b)
    coded = np.sqrt(((ca * sa[:, None] - cb * sb[:, None]) ** 2).sum(axis=1))
    assert ca.dtype == np.int8 and (np.abs(coded - nn.exact(a, b)) <= (ea + eb) * (1 + 1e-9) + 1e-9 * coded).all()


def test_fewer_candidates_than_asked_for_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in nn.nearest(df, df.where("vec_id = 0")).collect()] == [(0, 1, 1, math.sqrt(2))]
    assert nn.nearest(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0
    assert nn.nearest(df.limit(0), df.limit(0)).count() == 0


def test_no_query_is_lost_when_rows_arrive_in_another_order_at_each_evaluation(spark):
    rnd = np.random.default_rng(5)
    data = [(i, [float(x) for x in rnd.normal(size=4)]) for i in range(200)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").coalesce(1)

    def shuffled(batches):
        for batch in batches:
            yield batch.take(np.random.default_rng().permutation(batch.num_rows))

    reuse = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = nn.nearest(df, df.mapInArrow(shuffled, df.schema), 3, query_block=16)
        found = sorted(tuple(r)[:3] for r in got.collect())
    finally:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
    assert found == [w[:3] for w in brute(data, range(200), 3)]
