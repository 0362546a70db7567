"""Statistics of items and catalogues, and merging of rasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.operators import boxes, intervals


def value_counts(df: DataFrame) -> DataFrame:
    """Counts per item and over all items (item_id null) in one pass."""
    return df.groupingSets([["item_id", "value"], ["value"]], "item_id", "value").agg(F.count("*").alias("n"))


def histogram(df: DataFrame, value: str, bins: int = 10, lo: float = 0, hi: float = 100) -> DataFrame:
    """Equal bins, the last one closed; values outside are left out."""
    v = F.col(value)
    return df.where(v.between(lo, hi)).groupBy(F.least(F.floor((v - lo) / ((hi - lo) / bins)), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def class_weights(counts: DataFrame, nodata: int) -> DataFrame:
    """All samples / (classes * count); counts is one row per class, so the unpartitioned window stays small."""
    w = Window.partitionBy()
    return counts.where(F.col("value") != nodata).withColumn("weight", F.sum("n").over(w) / (F.count("*").over(w) * F.col("n")))


def extent(df: DataFrame, time: str | None = None) -> DataFrame:
    out = [F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")]
    return df.agg(*out, *([F.min(time).alias("first"), F.max(time).alias("last")] if time else []))


def temporal_stats(cells: DataFrame, band: str, masked) -> DataFrame:
    """Per cell over time, masked values left out; ties to the earlier scene."""
    v = F.when(~masked, F.col(band))
    low = F.when(~masked, F.struct(F.col(band), F.col("idx")))
    high = F.when(~masked, F.struct(-F.col(band), F.col("idx")))
    return cells.groupBy("tile_id", "step_no", "r", "c").agg(F.avg(v).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"), F.min_by("idx", low).alias("at_low"), F.min_by("idx", high).alias("at_high"))


def merge_rasters(df: DataFrame, how: str, nodata: float) -> DataFrame:
    """sum, count, mean or first of the valid values of a cell."""
    agg = {"sum": F.sum("v"), "count": F.count("v"), "mean": F.avg("v"), "first": F.min_by("v", "file_order")}
    if how not in agg:
        raise ValueError(f"no merge {how}")
    return df.where(F.col("v") != nodata).groupBy("r", "c").agg(agg[how].alias("v"))


def overlapping_pairs(rects: DataFrame) -> DataFrame:
    """Pairs whose interiors meet, neither holding the other."""
    a, b = (rects.select(*[F.col(k).alias(f"{s}_{k}") for k in rects.columns]) for s in "ab")
    p = boxes.meeting(a, b, "a_", "b_").where("a_id < b_id and a_xmin < b_xmax and b_xmin < a_xmax and a_ymin < b_ymax and b_ymin < a_ymax")
    holds = lambda p, q: f"({p}_xmin <= {q}_xmin and {p}_ymin <= {q}_ymin and {p}_xmax >= {q}_xmax and {p}_ymax >= {q}_ymax)"
    return p.where(f"not {holds('a', 'b')} and not {holds('b', 'a')}").select("a_id", "b_id")


def overview_factors(height: int, width: int) -> list[int]:
    """2, 4, ..., 64 as far as they are below the smaller side."""
    return [2**a for a in range(1, 7) if 2**a < min(height, width)]


def pyramid(cells: DataFrame, factors: list[int], nearest: bool = False) -> DataFrame:
    """Overviews of cells(r, c, v) by factors that each divide the next: by averaging, as for floats, or the value of each
    block's first cell, as for whole numbers, whose mean may be no class. Averages are a cascade: sums and counts go
    from each level to the next, so a level costs a fraction of the one before, not another pass over the cells."""
    if nearest:
        f = cells.withColumn("factor", F.explode(F.filter(F.array(*[F.lit(x) for x in factors]), lambda x: (F.col("r") % x == 0) & (F.col("c") % x == 0))))
        return f.select("factor", *[F.floor(F.col(k) / F.col("factor")).cast("int").alias(k) for k in ("r", "c")], "v")
    level, before, out = cells.select("r", "c", F.col("v").cast("double").alias("_s"), F.col("v").isNotNull().cast("long").alias("_n")), 1, None
    for x in sorted(factors):
        if x % before:
            raise ValueError(f"{before} does not divide {x}")
        block = [F.floor(F.col(k) / (x // before)).cast("int").alias(k) for k in ("r", "c")]
        level, before = level.groupBy(*block).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n")), x
        one = level.select(F.lit(x).alias("factor"), "r", "c", F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")).alias("v"))
        out = one if out is None else out.unionByName(one)
    return cells.select(F.lit(0).alias("factor"), "r", "c", F.col("v").cast("double").alias("v")).where("false") if out is None else out


def nodata_counts(cells: DataFrame, keys: list[str], value: str, nodata: float) -> DataFrame:
    """How many cells of each image are nodata and how many valid."""
    return cells.groupBy(*keys).agg(F.count_if(F.col(value) == nodata).alias("nodata"), F.count_if(F.col(value) != nodata).alias("valid"))


def image_quality(cells: DataFrame, keys: list[str], bands: list[str], cloudy: Column, nodata: float = 0) -> DataFrame:
    """Each image's nodata values over all bands, and its cloudy cells."""
    return cells.groupBy(*keys).agg(F.sum(sum(((F.col(b) == nodata).cast("int") for b in bands), F.lit(0))).alias("nodata"), F.sum(cloudy.cast("int")).alias("clouds"))


def catalog_length(catalogs: DataFrame, links: DataFrame) -> DataFrame:
    """catalogs(catalog_id, is_collection) with n: a collection's child links, else the catalogue's item links, of
    links(catalog_id, rel)."""
    n = links.groupBy("catalog_id").agg(F.count_if(F.col("rel") == "child").alias("_children"), F.count_if(F.col("rel") == "item").alias("_items"))
    n = catalogs.join(n, "catalog_id", "left")
    return n.select(*catalogs.columns, F.coalesce(F.when(F.col("is_collection"), F.col("_children")).otherwise(F.col("_items")), F.lit(0)).alias("n"))


def missing_steps(steps: DataFrame, existing: DataFrame) -> DataFrame:
    """Steps (item, step_no, step_start, step_end) without a date of existing(item, date) in them. Both joins are on equal
    keys, and repeated dates count once."""
    blocks = intervals.covered(steps)
    dates = intervals.at_levels(existing.select("item", "date").distinct(), F.col("date"), intervals.levels_of(blocks))
    have = blocks.join(dates, ["item", "_level", "_block"], "left_semi").select("item", "step_no")
    return steps.join(have, ["item", "step_no"], "left_anti").select(*steps.columns)


def time_bubbles(missing: DataFrame) -> DataFrame:
    """Runs of consecutive missing steps, with their start and end."""
    island = F.col("step_no") - F.row_number().over(Window.partitionBy("item").orderBy("step_no"))
    return missing.withColumn("_k", island).groupBy("item", "_k").agg(F.min("step_start").alias("start"), F.max("step_end").alias("end")).drop("_k")


def catalog_index(df: DataFrame) -> DataFrame:
    """Distinct sorted paths per item."""
    return df.groupBy("item").agg(F.array_sort(F.collect_set("path")).alias("paths"))


def merge_index(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per item the newer entry."""
    both = old.withColumn("_o", F.lit(0)).unionByName(new.withColumn("_o", F.lit(1)))
    return both.groupBy("item").agg(F.max_by("path", "_o").alias("path"))
