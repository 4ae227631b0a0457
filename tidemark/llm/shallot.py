"""Centroid clustering in whole numbers, with the shallot search for the nearest centroid.

Each vector remembers its nearest and second nearest centroid, an upper bound on the distance
to the one and a lower bound on the distance to all but that one.  When centroids move, the bounds
give way by the moves; a vector whose upper bound is below its lower bound, or below half the
distance from its centroid to the next one, keeps it without a look.  The others measure both
remembered centroids, start from the closer one and go through that centroid's neighbours in order
of their distance to it.  The ball searched ends where a neighbour cannot be nearer than the second
nearest found so far, and shrinks with each find.  Bounds are floating point with a margin;
whoever survives them is compared by squared distances in whole numbers, so assignments and
ties (to the smaller number) are exact.

Vectors are packed into blocks, written once into a bucketed table.  The state of a round is
a bucketed table of the same blocks, a tenth of the size, so a round joins the two without a
shuffle and never rewrites a vector.  What comes to the driver are sums per centroid and
component, their number bounded by centroids times components.

Vectors that are null, of another length, or hold null or non-finite components take no part.
Repeated rows count as often as they occur.  A null id is an id like any other, but starts as a
centroid last.  With fewer vectors than centroids there are as many centroids as vectors, and
without any the result is empty.  Components of ``2**27 / scale`` and more raise an error: their
squared distances would pass 64 bits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scratch import scratch_path, stage

BLOCK = 4096
LIMIT = 1 << 27
MARGIN = 1e-9
BLOCKS = "block long, ids binary, missing binary, codes binary"
STATE = "block long, nearest binary, second binary, upper binary, lower binary, sums binary"


class State(NamedTuple):
    """What the vectors of a block remember."""

    nearest: np.ndarray
    second: np.ndarray
    upper: np.ndarray
    lower: np.ndarray


class Centroids(NamedTuple):
    """Centroids with their distances to each other, each one's neighbours in order, and their last moves."""

    at: np.ndarray
    apart: np.ndarray
    order: np.ndarray
    half: np.ndarray
    moved: np.ndarray


def centroids_of(at: np.ndarray, before: np.ndarray | None = None) -> Centroids:
    squares = ((at[:, None, :] - at[None, :, :]) ** 2).sum(axis=2)
    apart = np.sqrt(squares.astype(float))
    order = np.argsort(squares, axis=1, kind="stable")
    order = np.array([[i, *[j for j in row if j != i]] for i, row in enumerate(order)]).reshape(len(at), len(at))
    half = np.array([apart[i, row[1]] / 2 if len(row) > 1 else np.inf for i, row in enumerate(order)])
    moved = np.zeros(len(at)) if before is None else np.sqrt(((at - before) ** 2).sum(axis=1).astype(float))
    return Centroids(at, apart, order, half, moved)


def squared(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of rows to rows, in whole numbers."""
    return ((codes.astype(np.int64) - at) ** 2).sum(axis=1)


def assign(codes: np.ndarray, centroids: Centroids, state: State | None) -> State:
    """Every vector's nearest centroid, by the remembered state or, without one, from the first two on."""
    number, count = len(codes), len(centroids.at)
    if count == 1:
        return State(np.zeros(number, np.int32), np.zeros(number, np.int32), np.zeros(number), np.full(number, np.inf))
    if state is None:
        state = State(np.zeros(number, np.int32), np.ones(number, np.int32), np.full(number, np.inf), np.zeros(number))
    nearest, second = state.nearest.copy(), state.second.copy()
    others = np.array([np.delete(centroids.moved, i).max() for i in range(count)])
    upper = (state.upper + centroids.moved[nearest]) * (1 + MARGIN)
    lower = np.maximum(state.lower - others[nearest], 0.0) * (1 - MARGIN)
    safe = np.maximum(lower, centroids.half[nearest] * (1 - MARGIN))
    left = np.flatnonzero(upper >= safe)
    here = squared(codes[left], centroids.at[nearest[left]])
    upper[left] = np.sqrt(here.astype(float)) * (1 + MARGIN)
    wide = upper[left] >= safe[left]
    left, here = left[wide], here[wide]
    there = squared(codes[left], centroids.at[second[left]])
    first, other = nearest[left], second[left]
    swap = (there < here) | ((there == here) & (other < first))
    first, other = np.where(swap, other, first), np.where(swap, first, other)
    here, there = np.where(swap, there, here), np.where(swap, here, there)
    start, known, reach = first.copy(), other.copy(), np.sqrt(here.astype(float))
    going = np.arange(len(left))
    for rank in range(1, count):
        candidate = centroids.order[start[going], rank]
        radius = (reach[going] + np.sqrt(there[going].astype(float))) * (1 + MARGIN)
        inside = centroids.apart[start[going], candidate] <= radius
        going, candidate = going[inside], candidate[inside]
        if not len(going):
            break
        new = candidate != known[going]
        at, candidate = going[new], candidate[new]
        found = squared(codes[left[at]], centroids.at[candidate])
        best = (found < here[at]) | ((found == here[at]) & (candidate < first[at]))
        then = ~best & ((found < there[at]) | ((found == there[at]) & (candidate < other[at])))
        pushed = at[best]
        other[pushed], there[pushed] = first[pushed], here[pushed]
        first[pushed], here[pushed] = candidate[best], found[best]
        other[at[then]], there[at[then]] = candidate[then], found[then]
    nearest[left], second[left] = first, other
    upper[left], lower[left] = np.sqrt(here.astype(float)) * (1 + MARGIN), np.sqrt(there.astype(float)) * (1 - MARGIN)
    return State(nearest, second, upper, lower)


def usable(vector: Column, dims: int) -> Column:
    """The vector in double precision, or null if it takes no part."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when((F.size(wide) == dims) & finite, wide)


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """Components as whole numbers, rounded down."""
    codes = np.floor(vectors * float(scale))
    if len(codes) and np.abs(codes).max() >= LIMIT:
        raise ValueError(f"components must stay below {LIMIT} / {scale}, or squared distances pass 64 bits")
    return codes.astype(np.int32)


def _bucketed(df: DataFrame, buckets: int) -> str:
    """``df`` as a table bucketed by block, whose files lie in the shared folder; returns its name (runs a job)."""
    name = f"shallot_{uuid.uuid4().hex}"
    (df.write.bucketBy(buckets, "block").sortBy("block").format("parquet")
     .option("path", scratch_path(df.sparkSession, "shallot")).saveAsTable(name))
    return name


def _blocks(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(id, vector) rows as blocks of whole numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)
                missing = part.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = part.column(0).fill_null(0).to_numpy()
                block = (part.column(2)[0].as_py() << 32) + number
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in
                                                      (ids.astype(np.int64), missing.astype(np.uint8), whole(flat, scale))]],
                    ["block", "ids", "missing", "codes"])

    return vectors.select("id", "vector", F.spark_partition_id().alias("part")).mapInArrow(run, BLOCKS)


def _codes(raw: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(raw, np.int32).reshape(-1, dims)


def _state(raw: tuple) -> State | None:
    if raw[0] is None:
        return None
    return State(*(np.frombuffer(r, t) for r, t in zip(raw, (np.int32, np.int32, np.float64, np.float64))))


def _joined(spark: SparkSession, blocks: str, states: str | None) -> DataFrame:
    """Blocks with their state, null before the first round."""
    names = ("nearest", "second", "upper", "lower")
    if states is None:
        return spark.table(blocks).select("*", *[F.lit(None).cast("binary").alias(n) for n in names])
    return spark.table(blocks).join(spark.table(states).select("block", *names), "block")


def _assigned(joined: DataFrame, centroids: Centroids, dims: int) -> DataFrame:
    """The state after a round, with the number and the sums of each centroid's vectors."""
    count = len(centroids.at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["block", "codes", "nearest", "second", "upper", "lower"]).to_pylist():
                codes = _codes(row["codes"], dims)
                state = assign(codes, centroids, _state(tuple(row.values())[2:]))
                sums = np.zeros((count, dims + 1), np.int64)
                for i in range(count):
                    mine = codes[state.nearest == i]
                    sums[i, 0], sums[i, 1:] = len(mine), mine.sum(axis=0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in (*state, sums)]],
                    [f.split()[0] for f in STATE.split(", ")])

    return joined.mapInArrow(run, STATE)


def _moved(states: DataFrame, before: np.ndarray) -> np.ndarray:
    """Centroids at the floor of the mean of their vectors; those without vectors stay."""
    count, dims = before.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count * (dims + 1), np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += np.frombuffer(raw, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "total"])

    sums = states.select("sums").mapInArrow(run, "place int, total long").groupBy("place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals = {r["place"]: int(r["total"]) for r in sums.collect()}
    after = before.copy()
    for i in range(count):
        number = totals.get(i * (dims + 1), 0)
        if number:
            after[i] = [totals[i * (dims + 1) + 1 + c] // number for c in range(dims)]
    return after


def _placed(joined: DataFrame, centroids: Centroids, dims: int) -> DataFrame:
    """Every vector with its nearest centroid and its squared distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["ids", "missing", "codes", "nearest", "second", "upper", "lower"]).to_pylist():
                codes = _codes(row["codes"], dims)
                state = assign(codes, centroids, _state(tuple(row.values())[3:]))
                missing = np.frombuffer(row["missing"], np.uint8).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["ids"], np.int64), mask=missing), pa.array(state.nearest, pa.int32()),
                     pa.array(squared(codes, centroids.at[state.nearest]))], ["id", "cluster", "distance"])

    return joined.mapInArrow(run, "id long, cluster int, distance long")


def clusters(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = 64, count: int = 8, rounds: int = 10,
             scale: int = 1024, seed: int = 3) -> DataFrame:
    """Per vector: its id (a whole number), ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256``.

    Starts from the ``count`` vectors whose ids hash lowest under ``seed``, ties by components.
    Runs a job per round, and some before and after.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id).cast("long").alias("id"), usable(F.col(vector), dims).alias("vector")).where("vector IS NOT NULL")
    start = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = rows.orderBy(start.asc_nulls_last(), "vector").limit(count).collect()
    if not chosen:
        return spark.createDataFrame([], f"`{id}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = centroids_of(whole(np.array([r["vector"] for r in chosen], float), scale).astype(np.int64))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = [_bucketed(_blocks(rows, dims, scale).repartition(buckets, "block"), buckets)]
    try:
        for number in range(rounds):
            states = tables[-1] if number else None
            tables.append(_bucketed(_assigned(_joined(spark, tables[0], states), centroids, dims), buckets))
            centroids = centroids_of(_moved(spark.table(tables[-1]), centroids.at), centroids.at)
        placed = stage(_placed(_joined(spark, tables[0], tables[-1] if rounds else None), centroids, dims), "shallot-placed")
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    digests = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids.at)]
    inertia = {r["cluster"]: r["cluster_inertia"] for r in sums}
    facts = spark.createDataFrame([(i, inertia[i], sum(inertia.values()), digest) for i, digest in digests if i in inertia],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(facts, "cluster").select(F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
