"""Nearest neighbours by a block matrix join with int8 tiles and exact error bounds.

Vectors are packed into blocks: int8 codes with one scale per vector, and the length of each
vector's rounding error.  Query blocks meet candidate blocks on an equal key (each candidate
block is sent once per query block), and a tile of distances between codes is one matrix
product of int8 values.  By the triangle inequality the true distance differs from the
coded one by at most the two rounding errors, so in a tile only candidates whose lower
bound is not above the k-th upper bound can be among the k nearest.  These are recomputed
in double precision from the original vectors, and the k best of each tile go into a final
top k per query.  The result is exact; nothing is sampled or capped.

Vectors that are null, empty, zero, or hold null or non-finite components take no part.
Vectors meet only vectors of their own number of dimensions.  A query's own id is no
candidate.  Rows that repeat an id count as one candidate, at its nearest row; a repeated
query id is one query, with the nearest found from any of its rows.  Null ids take no part.
Ties go to the smaller id.  A query without candidates has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import stage

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 512
BLOCK = "dims int, n int, ids binary, codes binary, scales binary, errors binary, vectors binary"
FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """The vector in double precision, or null if it can take no part."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(finite & F.exists(wide, lambda x: x != 0), wide)


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, the scale of each vector, and the length of its rounding error (rounded up)."""
    scales = np.abs(vectors).max(axis=1) / 127.0
    scales = np.where(scales > 0, scales, np.finfo(float).tiny)
    codes = np.clip(np.rint(vectors / scales[:, None]), -127, 127).astype(np.int8)
    errors = np.sqrt(((vectors - codes * scales[:, None]) ** 2).sum(axis=1)) * (1 + 1e-9)
    return codes, scales, errors


def pack(rows: DataFrame, size: int) -> DataFrame:
    """(id, vector) rows of one number of dimensions each -> blocks of at most ``size`` vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(lengths)])
            for dims in np.unique(lengths):
                at = np.flatnonzero(lengths == dims)
                for cut in range(0, len(at), size):
                    some = at[cut:cut + size]
                    vectors = flat[starts[some][:, None] + np.arange(dims)]
                    codes, scales, errors = quantise(vectors)
                    yield pa.RecordBatch.from_pylist([{
                        "dims": int(dims), "n": len(some), "ids": ids[some].astype(np.int64).tobytes(), "codes": codes.tobytes(),
                        "scales": scales.tobytes(), "errors": errors.tobytes(), "vectors": vectors.astype(np.float64).tobytes()}],
                        pa.schema([("dims", pa.int32()), ("n", pa.int32())] + [(c, pa.binary()) for c in (
                            "ids", "codes", "scales", "errors", "vectors")]))

    return rows.mapInArrow(run, BLOCK)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, summed in order of dimension."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        gap = a[:, d] - b[:, d]
        total += gap * gap
    return np.sqrt(total)


def _unpacked(block, dims: int):
    n = block["n"]
    return (np.frombuffer(block["ids"], np.int64), np.frombuffer(block["codes"], np.int8).reshape(n, dims),
            np.frombuffer(block["scales"]), np.frombuffer(block["errors"]), np.frombuffer(block["vectors"]).reshape(n, dims))


def tile(queries: dict, candidates: dict, k: int, step: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, distance): the k nearest of this tile's candidates to each query."""
    dims = queries["dims"]
    q_ids, q_codes, q_scales, q_errors, q_vectors = _unpacked(queries, dims)
    c_ids, c_codes, c_scales, c_errors, c_vectors = _unpacked(candidates, dims)
    # Products of int8 codes are whole numbers that doubles hold exactly.
    c_wide = c_codes.astype(np.float64)
    c_square = (c_wide ** 2).sum(axis=1) * c_scales ** 2
    distinct = len(np.unique(c_ids)) == len(c_ids)
    found = []
    for start in range(0, len(q_ids), step):
        part = slice(start, start + step)
        q_wide = q_codes[part].astype(np.float64)
        product = (q_wide @ c_wide.T) * q_scales[part][:, None] * c_scales
        square = (q_wide ** 2).sum(axis=1)[:, None] * q_scales[part][:, None] ** 2 + c_square - 2 * product
        slack = 1e-9 * ((q_wide ** 2).sum(axis=1)[:, None] * q_scales[part][:, None] ** 2 + c_square)
        coded_low, coded_high = np.sqrt(np.maximum(square - slack, 0)), np.sqrt(np.maximum(square, 0) + slack)
        bound = q_errors[part][:, None] + c_errors
        own = q_ids[part][:, None] == c_ids
        high = np.where(own, np.inf, coded_high + bound)
        if distinct and k < high.shape[1]:
            limit = np.partition(high, k - 1, axis=1)[:, k - 1]
        elif distinct:
            limit = np.full(len(high), np.inf)
        else:  # the k-th upper bound over distinct ids
            limit = np.array([np.sort(pd.Series(row).groupby(c_ids).min().to_numpy())[:k][-1]
                              if len(np.unique(c_ids)) >= k else np.inf for row in high])
        q_at, c_at = np.nonzero((coded_low - bound <= limit[:, None]) & ~own)
        distance = exact(q_vectors[part][q_at], c_vectors[c_at])
        order = np.lexsort((c_ids[c_at], distance, q_ids[part][q_at]))
        pairs = pd.DataFrame({"q": q_ids[part][q_at][order], "c": c_ids[c_at][order], "d": distance[order]})
        if not distinct or len(np.unique(q_ids)) < len(q_ids):
            pairs = pairs.drop_duplicates(["q", "c"])
        found.append(pairs.groupby("q", sort=False).head(k))
    best = pd.concat(found)
    return best["q"].to_numpy(), best["c"].to_numpy(), best["d"].to_numpy()


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id: str = "vec_id", vector: str = "embedding",
            candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``vectors`` to each query.

    Runs jobs: counts the queries, to number their blocks, and writes the blocks.  A shuffle may
    deliver its rows in another order each time it is read, so the keys that send candidates to
    blocks and the blocks themselves must come from one evaluation.
    """
    def ready(df: DataFrame) -> DataFrame:
        return df.select(F.col(id).cast("long").alias("id"), usable(F.col(vector)).alias("vector")).where(
            "id IS NOT NULL AND vector IS NOT NULL")

    asked = ready(queries)
    parts = max(1, -(-asked.count() // query_block))
    dealt = asked.repartition(parts, F.xxhash64("id")).sortWithinPartitions("id")
    asked_blocks = stage(pack(dealt, query_block).withColumn(
        "part", F.expr("cast(pmod(xxhash64(ids), 1000000007) AS int)")), "query-blocks")
    keys = asked_blocks.select("part", "dims").distinct()
    blocks = pack(ready(vectors), candidate_block).join(keys, "dims")
    packs = [F.struct("dims", "n", "ids", "codes", "scales", "errors", "vectors")]
    pairs = blocks.select("part", "dims", packs[0].alias("c")).join(
        asked_blocks.select("part", "dims", packs[0].alias("q")), ["part", "dims"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                q, c, d = tile(row["q"], row["c"], k)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.float64())],
                                                 ["query_id", "vec_id", "score"])

    found = pairs.select("q", "c").mapInArrow(run, FOUND)
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
