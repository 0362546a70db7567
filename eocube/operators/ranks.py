"""Slices and caps of large tables, by counts of ranges: no task orders or holds more than a range of the rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hash ranges of a cap, sampled keys and key ranges of a slice.
HASHES, SAMPLE, RANGES = 4096, 4096, 256


def slice_by_key(df: DataFrame, key: str, first: int, last: int, sample: int = SAMPLE, ranges: int = RANGES) -> DataFrame:
    """The rows of ranks first to last - 1, from 0, in the order of the key, which should be unique (null first).

    About `sample` distinct keys, chosen by their hash, give `ranges` ranges of keys; one count per range tells where the
    slice begins and ends, and only the ranges that it touches are read again, each ordered in a task of its own.
    """
    total = df.count()
    some = df.where(F.pmod(F.xxhash64(F.lit(11), key), F.lit(max(1, total // sample))) == 0).select(key).where(F.col(key).isNotNull()).distinct().orderBy(key)
    keys = [r[0] for r in some.collect()]
    bounds = sorted(set(keys[:: max(1, len(keys) // ranges)]), key=keys.index)
    literal = F.array(*[F.lit(b) for b in bounds]).cast(f"array<{dict(df.dtypes)[key]}>")
    ranged = df.withColumn("_range", F.size(F.filter(literal, lambda b: b <= F.col(key))))
    counts = {r[0]: r[1] for r in ranged.groupBy("_range").count().collect()}
    before = dict(zip(range(len(bounds) + 1), accumulate((counts.get(k, 0) for k in range(len(bounds) + 1)), initial=0), strict=False))
    touched = [k for k in range(len(bounds) + 1) if before[k] < last and before[k] + counts.get(k, 0) > first]
    if not touched:
        return df.where("false")
    if touched[0] > 0:  # in terms of the key, so that it reaches the scan
        ranged = ranged.where(F.col(key) >= F.lit(bounds[touched[0] - 1]))
    if touched[-1] < len(bounds):
        below = F.col(key) < F.lit(bounds[touched[-1]])
        ranged = ranged.where(below if touched[0] > 0 else below | F.col(key).isNull())
    at = F.element_at(F.map_from_arrays(F.array(*[F.lit(k) for k in touched]), F.array(*[F.lit(before[k]).cast("long") for k in touched])), F.col("_range"))
    rank = at + F.row_number().over(Window.partitionBy("_range").orderBy(F.asc_nulls_first(key))) - 1
    return ranged.withColumn("_rank", rank).where((F.col("_rank") >= first) & (F.col("_rank") < last)).select(*df.columns)


def capped(df: DataFrame, most: int, keys: list[str], seed: int = 0) -> DataFrame:
    """All rows if they are at most `most`, else so many of them, those first by a hash of the keys, which should be unique.
    Whole hash ranges are kept or left as their counts say; only the one in which the cap falls is ordered."""
    h = df.withColumns({"_h": F.xxhash64(F.lit(seed), *keys)}).withColumn("_range", F.shiftrightunsigned("_h", 52).cast("int"))
    counts = {r[0]: r[1] for r in h.groupBy("_range").count().collect()}
    if sum(counts.values()) <= most:
        return df
    before = list(accumulate((counts.get(k, 0) for k in range(HASHES)), initial=0))
    edge = next(k for k in range(HASHES) if before[k + 1] > most)
    part = h.where(F.col("_range") == edge).withColumn("_rank", F.row_number().over(Window.partitionBy("_range").orderBy("_h", *keys))).where(F.col("_rank") <= most - before[edge])
    return h.where(F.col("_range") < edge).select(*df.columns).unionByName(part.select(*df.columns))
