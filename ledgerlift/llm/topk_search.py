"""Exact top-k by inner product, with multi-resolution segment statistics.

Both sides are cut into blocks; each query block meets each candidate block once.
Within such a meeting a vector is summed up per segment by its mean and the norm
of its deviation from it. Since q.v = sum over segments of len * mean * mean plus
the product of the deviations, Cauchy-Schwarz bounds the score from above (and
the distance |q|^2 + |v|^2 - 2 q.v from below). Bounds go from one segment to
sixteen; only candidates that pass every level are scored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlift.llm.common import cut

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 2048
LEVELS = (1, 4, 16)
EXACT_FLOAT = float(1 << 52)


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per vector, for each segment: sqrt(len) * mean, then the norm of the deviation."""
    parts = np.array_split(x, min(segments, x.shape[1]), axis=1)
    means = [p.mean(axis=1) for p in parts]
    norms = [np.sqrt(((p - m[:, None]) ** 2).sum(axis=1)) for p, m in zip(parts, means)]
    return np.stack([m * np.sqrt(p.shape[1]) for p, m in zip(parts, means)] + norms, axis=1)


def best_of_block(q_ids, q, v_ids, v, k: int):
    """Per query (place in q_ids), the places of its k best candidates in this block and their scores."""
    order = np.argsort(v_ids, kind="stable")
    v_ids, v = v_ids[order], v[order]
    if np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1] < EXACT_FLOAT:
        q, v = q.astype(np.float64), v.astype(np.float64)
    own = q_ids[:, None] == v_ids[None, :]
    seeds = min(k + 1, len(v_ids))
    survivors, floor = ~own, None
    for level in LEVELS:
        bound = segment_statistics(q.astype(np.float64), level) @ segment_statistics(v.astype(np.float64), level).T
        bound += 0.5 + np.abs(bound) * 1e-9  # scores are whole numbers; covers rounding
        if floor is None:  # the k-th best of the most promising candidates is a floor for the k-th best of all
            likely = np.argpartition(-np.where(own, -np.inf, bound), seeds - 1, axis=1)[:, :seeds]
            exact = np.einsum("ij,ikj->ik", q, v[likely]).astype(np.float64)
            exact[np.take_along_axis(own, likely, 1)] = -np.inf
            floor = -np.sort(-exact, axis=1)[:, min(k, seeds) - 1]
        survivors &= bound >= floor[:, None]
    columns = np.flatnonzero(survivors.any(axis=0))
    scores = (q @ v[columns].T).astype(np.int64)
    for i in range(len(q_ids)):
        mine = np.flatnonzero(survivors[i, columns])
        best = mine[np.lexsort((v_ids[columns[mine]], -scores[i, mine]))[:k]]
        yield i, v_ids[columns[best]], scores[i, best]


BLOCK_DDL = "dim int, block int, ids binary, vectors binary"
BLOCK = pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])


def _pack(table: pa.Table) -> pa.Table:
    vectors = table.column("v").combine_chunks().flatten().to_numpy()
    row = {"dim": table.column("dim")[0].as_py(), "block": table.column("block")[0].as_py()}
    row |= {"ids": table.column("vec_id").combine_chunks().to_numpy().tobytes(), "vectors": vectors.tobytes()}
    return pa.Table.from_pylist([row], schema=BLOCK)


def _meet(k: int):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, v_ids = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["ids"], np.int64)
                q = np.frombuffer(r["q_vectors"], np.int64).reshape(len(q_ids), -1)
                v = np.frombuffer(r["vectors"], np.int64).reshape(len(v_ids), -1)
                found = list(best_of_block(q_ids, q, v_ids, v, k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.full(len(b), q_ids[i]) for i, b, _ in found]).astype(np.int64)),
                        pa.array(np.concatenate([b for _, b, _ in found]).astype(np.int64)),
                        pa.array(np.concatenate([s for _, _, s in found]).astype(np.int64)),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """The k highest integer inner products of each query with every other vector.

    ``vectors`` has vec_id and embedding; components become floor(scale * x).
    ``is_query`` picks the queries among the rows. Returns query_id, rank (from
    1), vec_id, score; ties go to the smaller vec_id.

    Rows whose id or embedding is null, or that hold a null or non-finite
    component, and empty embeddings take no part. A query meets vectors of its
    own length only, and never a row with its own vec_id. Repeated equal rows
    count once. Fewer than k candidates give fewer rows. Components stay exact
    while scores fit 64-bit integers.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size("embedding") > 0)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.size("embedding").alias("dim"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = cut(rows.distinct())
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    blocks, query_blocks = max(1, -(-total // CANDIDATE_BLOCK)), max(1, -(-asked // QUERY_BLOCK))

    def packed(part: DataFrame, n: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias("block")
        return part.select("dim", block, "vec_id", "v").groupBy("dim", "block").applyInArrow(_pack, BLOCK_DDL)

    candidates = packed(rows, blocks)
    asks = packed(rows.filter("is_query"), query_blocks).select(
        "dim",
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.col("ids").alias("q_ids"),
        F.col("vectors").alias("q_vectors"),
    )
    best = asks.join(candidates, ["dim", "block"]).mapInArrow(_meet(k), "query_id bigint, vec_id bigint, score bigint")
    ranked = best.distinct().withColumn(
        "rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    )
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
