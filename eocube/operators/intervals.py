"""Joins of days with intervals of days, by dyadic covers.

An interval of n days is a union of at most 2 log2(n) blocks of 2^k days that begin at a multiple of 2^k. A day lies in one
block of each size, so an equi-join on (size, block) finds the intervals that hold it, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes of blocks up to 2^24 days, some 45,000 years.
LEVELS = 25


def day_number(date: Column) -> Column:
    return F.datediff(date.cast("date"), F.lit("1970-01-01").cast("date"))


def cover(start: Column, end: Column) -> Column:
    """Array of struct(level, block) that covers the days from start to end, both included; empty if end is before start."""
    a, b = day_number(start), day_number(end) + 1
    longest = F.least(F.lit(LEVELS - 1), F.floor(F.log2(F.greatest(b - a, F.lit(1)))) + 1).cast("int")  # no larger block fits
    shift = lambda x, k: F.call_function("shiftright", x, k)

    def blocks(k: Column) -> Column:
        first, behind = shift(a + F.call_function("shiftleft", F.lit(1), k) - 1, k), shift(b, k)
        both = F.array(F.when((first < behind) & (F.pmod(first, F.lit(2)) == 1), first), F.when((first < behind) & (F.pmod(behind, F.lit(2)) == 1), behind - 1))
        return F.transform(F.filter(both, lambda x: x.isNotNull()), lambda x: F.struct(k.alias("level"), x.alias("block")))

    return F.flatten(F.transform(F.sequence(F.lit(0), longest), blocks))


def covered(intervals: DataFrame, start: str = "step_start", end: str = "step_end") -> DataFrame:
    """A row for each block of each interval, with _level and _block."""
    return intervals.withColumn("_c", F.explode(cover(F.col(start), F.col(end)))).withColumns({"_level": F.col("_c.level"), "_block": F.col("_c.block")}).drop("_c")


def levels_of(blocks: DataFrame) -> list[int]:
    """The sizes that occur, at most LEVELS of them."""
    return sorted(r[0] for r in blocks.select("_level").distinct().collect())


def at_levels(points: DataFrame, date: Column, levels: list[int]) -> DataFrame:
    """A row for each point and size, with _level and _block."""
    day = day_number(date)
    each = F.array(*[F.struct(F.lit(k).alias("_level"), F.shiftright(day, k).alias("_block")) for k in levels])
    return points.withColumn("_c", F.explode(each.cast("array<struct<_level:int,_block:int>>"))).select(*points.columns, "_c.*")


def days_in_intervals(points: DataFrame, date: Column, intervals: DataFrame, keys: list[str] = (), how: str = "inner", start: str = "step_start", end: str = "step_end") -> DataFrame:
    """points joined with the intervals that hold their date and have the same keys; each pair once."""
    blocks = covered(intervals, start, end)
    return at_levels(points, date, levels_of(blocks)).join(blocks, [*keys, "_level", "_block"], how).drop("_level", "_block")
