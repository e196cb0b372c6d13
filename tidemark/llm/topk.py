"""Exact top-k inner products in three phases with one uniform threshold.

The components of a vector are dealt to two nodes, each of which can list its own partial scores.
Phase one gathers the k best of each node's local lists, with their full scores; the k-th best full
score of a query is a safe cutoff, since the answer is at least as good. Phase two sends the cutoff
back: a vector that reaches it has at least one partial score of cutoff / nodes, so every node
yields all its entries from there on. Phase three adds the other node's part for these entries
alone and keeps what reaches the cutoff.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Nodes (groups of components), vectors in a chunk, queries in a block, queries worked on at once.
NODES, CHUNK, BLOCK, STRIDE = 2, 8192, 4096, 256


def quantized(vector: Column, by: int = 1024) -> Column:
    """floor(by * x) of every component; null if the vector is null or any component is null or not finite."""
    d = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)),
                  F.transform(d, lambda x: F.floor(x * by).cast("long")))


def _matrix(t: pa.Table) -> np.ndarray:
    col = t.column("v").combine_chunks()
    flat = (col.flatten() if isinstance(col, pa.ListArray) else pa.concat_arrays([c.flatten() for c in col.chunks]))
    return flat.to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)


def _parts(q: np.ndarray, v: np.ndarray) -> list[np.ndarray]:
    """Partial scores per node, exact: in doubles while every sum stays below 2**53, else in integers."""
    top = lambda x: float(np.abs(x).max(initial=0))
    kind = np.float64 if top(q) * top(v) * max(1, q.shape[1]) < 2 ** 53 else np.int64
    cuts = [q.shape[1] * i // NODES for i in range(NODES + 1)]
    return [(q[:, a:b].astype(kind) @ v[:, a:b].T.astype(kind)).astype(np.int64) for a, b in zip(cuts, cuts[1:])]


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= least)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], -score[near]))[:k]]


def _table(rows: list[tuple]) -> pa.Table:
    names = ("query_id", "vec_id", "score")
    return pa.table({n: pa.array(np.concatenate([r[i] for r in rows]) if rows else [], pa.int64())
                     for i, n in enumerate(names)})


def _meet(k: int, cutoffs: bool):
    def task(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return _table([])
        qid, vid = (t.column("id").to_numpy() for t in (queries, vectors))
        q, v = _matrix(queries), _matrix(vectors)
        least = queries.column("cutoff").to_pylist()
        rows = []
        for at in range(0, len(qid), STRIDE):
            parts = _parts(q[at:at + STRIDE], v)
            for i, one in enumerate(qid[at:at + STRIDE].tolist()):
                other = vid != one
                if not cutoffs:
                    near = np.unique(np.concatenate(
                        [np.flatnonzero(other)[_best(p[i][other], vid[other], k)] for p in parts]))
                elif least[at + i] is None:
                    near = np.flatnonzero(other)
                else:
                    near = np.flatnonzero(other & np.any([NODES * p[i] >= least[at + i] for p in parts], axis=0))
                full = sum(p[i][near] for p in parts)
                if cutoffs:
                    if least[at + i] is not None:
                        near, full = near[full >= least[at + i]], full[full >= least[at + i]]
                    best = _best(full, vid[near], k)
                    near, full = near[best], full[best]
                rows.append((np.full(len(near), one), vid[near], full))
        return _table(rows)
    return task


def top_k(vectors: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best inner products of each row that ``queries`` marks.

    ``vector`` is array<long> or null. Rows with a null id or vector take no part. Repeated ids count
    once, with the smallest vector in array order. Vectors of different lengths have no score. Ties
    go to the smaller id. Fewer than k candidates give them all; an empty table gives no rows.
    Whole-number sums are exact within 64 bits.
    """
    rows = (vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"),
                           queries.alias("asks"))
            .where("id is not null and v is not null")
            .groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
            .withColumn("dim", F.size("v")))
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    chunks, blocks = -(-max(1, sizes.n) // CHUNK), -(-max(1, sizes.q) // BLOCK)
    chunk = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = rows.withColumn("chunk", chunk(chunks)).withColumn("block", every(blocks))
    asked = rows.where("asks").withColumn("block", chunk(blocks))

    def pass_(cut: DataFrame, cutoffs: bool) -> DataFrame:
        keys = ["dim", "chunk", "block"]
        left = cut.withColumn("chunk", every(chunks)).select(*keys, "id", "v", "cutoff")
        return (left.groupBy(*keys).cogroup(
                    stored.select(*[F.col(c).alias(c) for c in (*keys, "id", "v")]).groupBy(*keys))
                .applyInArrow(_meet(k, cutoffs), "query_id long, vec_id long, score long"))

    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    lists = pass_(asked.withColumn("cutoff", F.lit(None).cast("long")), False)
    safe = (lists.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("cutoff"))
            .withColumnRenamed("query_id", "id"))
    found = pass_(asked.join(safe, "id", "left"), True)
    return (found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
