"""Connected components over a table of links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.llm.common import forget, written


#: Over how many tasks the links of one node are spread at most.
SPREAD = 64


def _with_least(pairs: DataFrame, spread: int) -> DataFrame:
    """pairs(u, v) with m, the smallest v of their u. The minimum is taken and handed back by u and a salt, so no
    task gets all links of a hub; in between a node has one row per salt."""
    salted = pairs.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(spread)).cast("int"))
    part = salted.groupBy("u", "s").agg(F.min("v").alias("m"))
    whole = part.groupBy(F.col("u").alias("_w")).agg(F.min("m").alias("_m"))
    given = part.join(whole, F.col("u") == F.col("_w")).select(F.col("u").alias("_u"), F.col("s").alias("_s"), F.col("_m").alias("m"))
    return salted.join(given, (F.col("u") == F.col("_u")) & (F.col("s") == F.col("_s"))).select("u", "v", "m")


#: Once so many links are left, at most, one task finishes them.
FEW = 500_000


def _finished(batches):
    """(node, root) of all links of a partition, by hooking every root to the least one beside it until nothing moves."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    t = pa.Table.from_batches(batches)
    ends = np.concatenate([t.column(c).to_numpy() for c in ("u", "v")])
    node, at = np.unique(ends, return_inverse=True)
    u, v = at[: t.num_rows], at[t.num_rows :]
    root = np.arange(len(node))
    while True:
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            break
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[root])], ["node", "root"])


def connected(links: DataFrame, spread: int = SPREAD, few: int = FEW) -> DataFrame:
    """(node, root) for every node of links(u, v), root being the smallest node reachable.

    Alternates the published large-star and small-star steps until a round changes nothing. The links of a hub are
    salted, so they are never gathered in one row or one task. Every round is written to the shared folder, and the one
    before it deleted. As soon as at most FEW links are left, one task does the rest. No links: no rows. Null ends and
    loops are ignored.
    """
    e = written(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u is not null and v is not null and u <> v").distinct()
    )
    before, numbers = None, all(kind == "bigint" for _, kind in e.dtypes)
    while True:
        if numbers and (e.count() if before is None else before[0]) <= few:
            done = written(e.repartition(1).mapInArrow(_finished, "node long, root long"))
            forget(e)
            return done
        both = _with_least(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))), spread)
        large = both.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        small = _with_least(large, spread).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        after = written(small.select("x.u", "x.v").where("u <> v").distinct())
        forget(e)
        e = after
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
