"""Exact nearest neighbours by a block matrix join on int8 products.

Queries and vectors are dealt into blocks, and every pair of blocks is a tile, a task's
unit of work. In a tile, products of rounded vectors give each cosine with a bound of
what rounding can have changed. Pairs that may be among a query's best are recomputed
from the original vectors, and each tile's best are merged by query.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, table
from ledgerline.llm.registry import query
from ledgerline.llm.vectors import chosen, cosines, matrix, unit, usable

#: Rows of a block of queries and of a block of vectors.
QUERY_BLOCK = 1024
VECTOR_BLOCK = 8192
LEVELS = 127


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, the step of each, and the length of what rounding took from each."""
    step = np.abs(units).max(axis=1) / LEVELS
    codes = np.rint(units / step[:, None]).astype(np.int8)
    lost = np.sqrt(np.square(units - codes * step[:, None]).sum(axis=1))
    return codes, step, lost


def tile_best(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> list[tuple[int, int, float]]:
    """(query, id, cosine) of each query's k best of the tile, exactly."""
    q_codes, q_step, q_lost = quantised(unit(queries))
    v_codes, v_step, v_lost = quantised(unit(vectors))
    v_float = v_codes.T.astype(np.float32 if q_codes.shape[1] * LEVELS**2 < 1 << 24 else np.float64)
    found = []
    for at in range(0, len(queries), 128):
        rows = slice(at, at + 128)
        # whole numbers below 2^24 are exact as floats
        about = (q_codes[rows].astype(v_float.dtype) @ v_float).astype(np.float64)
        about *= q_step[rows, None] * v_step[None, :]
        # |q.v - q'.v'| <= |q - q'| |v| + |q'| |v - v'|, and |q'| <= 1 + |q - q'|
        bound = q_lost[rows, None] + (1 + q_lost[rows, None]) * v_lost[None, :] + 1e-9
        own = ids[None, :] == query_ids[rows, None]
        least = np.where(own, -np.inf, about - bound)
        if least.shape[1] > k:
            floor = -np.partition(-least, k - 1, axis=1)[:, k - 1]
        else:
            floor = np.full(len(least), -np.inf)
        who, which = np.nonzero(~own & (about + bound >= floor[:, None]))
        exact = np.empty(len(who))
        for part in range(0, len(who), 1 << 15):
            some = slice(part, part + (1 << 15))
            exact[some] = cosines(queries[at + who[some]], vectors[which[some]])
        edges = np.searchsorted(who, np.arange(len(least) + 1))
        for i, (x, y) in enumerate(zip(edges, edges[1:])):
            best = heapq.nsmallest(k, zip((-exact[x:y]).tolist(), ids[which[x:y]].tolist()))
            found += [(int(query_ids[at + i]), v, -s) for s, v in best]
    return found


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), the other's id, score: each query's ``k`` rows of
    ``vectors`` with the largest cosine in double precision, all if there are fewer; ties
    go to the smaller id.

    Null, empty and zero vectors and such with null or not finite components take no part
    on either side; all others need one length. Rows with the query's own id are no
    candidates; other repeated ids are candidates each for itself, and of repeated queries
    one is answered. Null ids take no part. Empty tables give no rows.

    A vector is copied once for each ``QUERY_BLOCK`` queries, and a query once for each
    ``VECTOR_BLOCK`` vectors.
    """

    def usable_rows(df: DataFrame) -> DataFrame:
        return chosen(df, id_column, vector_column).where(F.col("id").isNotNull() & usable(F.col("vector")))

    candidates = cut(usable_rows(vectors), "candidates")
    asked = cut(usable_rows(queries).dropDuplicates(["id"]), "queries")
    n_query_blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    n_vector_blocks = max(1, math.ceil(candidates.count() / VECTOR_BLOCK))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int, seed: int) -> DataFrame:
        # blocks are drawn by id and content, so equal ids do not meet in one
        block = F.pmod(F.xxhash64(F.lit(seed), "id", "vector"), F.lit(blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.select("id", "vector", block.alias(own), every.alias(other))

    left = dealt(asked, "qb", n_query_blocks, "vb", n_vector_blocks, 1)
    right = dealt(candidates, "vb", n_vector_blocks, "qb", n_query_blocks, 2)

    def tile(q: pa.Table, v: pa.Table) -> pa.Table:
        rows = []
        if q.num_rows and v.num_rows:
            rows = tile_best(q.column("id").to_numpy(), matrix(q.column("vector")),
                             v.column("id").to_numpy(), matrix(v.column("vector")), k)
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    best = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInArrow(
        tile, "query_id long, id long, score double"
    )

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        top = heapq.nsmallest(k, zip((-rows["score"]).tolist(), rows["id"].tolist()))
        return pd.DataFrame({"query_id": rows["query_id"].iloc[0], "rank": range(1, len(top) + 1),
                             id_column: [i for _, i in top], "score": [-s for s, _ in top]})

    # at most k rows for each block of vectors
    return best.groupBy("query_id").applyInPandas(merge, f"query_id long, rank int, `{id_column}` long, score double")


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))
