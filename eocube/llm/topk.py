"""Exact top-k search by inner product: Fagin's threshold algorithm over sorted per-dimension lists.

Vectors are dealt to blocks of bounded size and queries to groups; each (block, group) pair is one task's work. A
block keeps, for each dimension, its vectors sorted by that component. A query reads the lists from their better
end (the top for a positive component, the bottom for a negative one), scores in full what it meets, and stops when
the best score that anything unread could have is below its k-th best. Only k rows per query leave a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eocube.llm.common import partitions

BLOCK, GROUP = 8_192, 8_192


def threshold_topk(x: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, first: int = 64):
    """(query id, id, score) of each query's k best rows of x in this block, its own row left out; ties by id."""
    n, dims = x.shape
    wide = float(np.abs(x).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, dims)
    kind = np.float64 if wide < 2**53 else np.int64 if wide < 2**63 else object
    x, queries = x.astype(kind), queries.astype(kind)
    order = np.argsort(x, axis=0, kind="stable")
    lists = np.take_along_axis(x, order, axis=0)
    for q, own in zip(queries, query_ids.tolist(), strict=True):
        up = np.flatnonzero(q > 0)
        down = np.flatnonzero(q < 0)
        seen = np.zeros(n, dtype=bool)
        best_ids, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=kind)
        at, depth = 0, first
        while at < n:
            to = min(n, at + depth)
            met = np.zeros(n, dtype=bool)
            met[order[n - to : n - at, up].ravel()] = True
            met[order[at:to, down].ravel()] = True
            if not len(up) and not len(down):
                met[:] = True
                to = n
            met &= ~seen
            seen |= met
            new = np.flatnonzero(met)
            new = new[ids[new] != own]
            score = x[new] @ q
            best_ids, best = np.concatenate([best_ids, ids[new]]), np.concatenate([best, score])
            if len(best) > k:
                keep = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[keep], best[keep]
            bound = (lists[n - to, up] * q[up]).sum() + (lists[to - 1, down] * q[down]).sum()
            if to == n or len(best) >= k and bound < best.min():
                break
            at, depth = to, depth * 2
        for i, s in zip(best_ids.tolist(), best.tolist(), strict=True):
            yield own, i, int(s)


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: for each row with is_query, the k other rows with the highest inner product of
    floor(scale * component), ties to the smaller vec_id.

    Rows whose vec_id or vector is null, or that hold a null or non-finite component, take no part. A query's own rows
    are all that have its vec_id; rows that repeat another vec_id are candidates of their own. Queries that repeat a
    vec_id are one query, whose k rows have the highest products with any of its vectors. Vectors of different lengths
    are not compared. Fewer candidates than k: all of them; a query without candidates gives no row. Empty tables give
    none.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).where(
        "vec_id is not null and e is not null and not exists(e, c -> c is null or isnan(c) or abs(c) = double('infinity'))"
    )
    v = v.select("vec_id", F.transform("e", lambda c: F.floor(scale * c).cast("long")).alias("e"), F.size("e").alias("dim"))
    n, nq = v.agg(F.count("*"), F.count_if(is_query)).first()
    blocks, groups = max(1, -(-n // block)), max(1, -(-nq // group))

    def pack(key):
        def run(batches):
            rows: dict = {}
            for b in batches:
                for d, w, i, e in zip(*(b.column(c).to_pylist() for c in ("dim", key, "vec_id", "e")), strict=True):
                    rows.setdefault((d, w), ([], []))[0].append(i)
                    rows[d, w][1].append(e)
            for (d, w), (ids, es) in rows.items():
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([w], pa.int32()), pa.array([np.array(ids, dtype=np.int64).tobytes()]), pa.array([np.array(es, dtype=np.int64).tobytes()])], ["dim", key, f"{key}_ids", f"{key}_data"])

        return run

    def packed(rows, key, count):
        dealt = rows.withColumn(key, F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(count)).cast("int")).repartition("dim", key)
        return dealt.select("dim", key, "vec_id", "e").mapInArrow(pack(key), f"dim int, {key} int, {key}_ids binary, {key}_data binary")

    def search(batches):
        for b in batches:
            out = []
            for d, xi, xd, qi, qd in zip(*(b.column(c).to_pylist() for c in ("dim", "b_ids", "b_data", "q_ids", "q_data")), strict=True):
                ids, asked = np.frombuffer(xi, dtype=np.int64), np.frombuffer(qi, dtype=np.int64)
                out += threshold_topk(np.frombuffer(xd, dtype=np.int64).reshape(len(ids), d), ids, np.frombuffer(qd, dtype=np.int64).reshape(len(asked), d), asked, k)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    p = min(blocks * groups, 4 * max(blocks, groups, partitions(spark)))
    each = lambda rows, key, count: rows.withColumn(key, F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).repartition(p, "dim", "b", "q")
    pairs = each(packed(v, "b", blocks), "q", groups).join(each(packed(v.where(is_query), "q", groups), "b", blocks).hint("shuffle_hash"), ["dim", "b", "q"])
    best = pairs.mapInArrow(search, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10(spark, sf_dir) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
