"""Pixel grids of areas: definition, rasterising, clipping and resampling.

An area is a row with rings array<array<struct<x, y>>>; its grid starts at the top left of its box and rows count
downwards. Cells are rows (item, r, c, ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eocube.functions.cells import n_cells
from eocube.functions.projections import to_wgs84

RINGS = "array<array<struct<x:double,y:double>>>"


def bbox(rings: Column) -> Column:
    points = F.flatten(rings)
    side = lambda f, k: f(F.transform(points, lambda p: p[k])).alias
    return F.struct(side(F.array_min, "x")("xmin"), side(F.array_min, "y")("ymin"), side(F.array_max, "x")("xmax"), side(F.array_max, "y")("ymax"))


def grid(areas: DataFrame, scale: float) -> DataFrame:
    """areas with x0, y0 (top left), width and height, one cell at least."""
    out = areas.withColumn("_b", bbox(F.col("rings")))
    size = lambda hi, lo: F.greatest(F.lit(1), n_cells(F.col(f"_b.{hi}") - F.col(f"_b.{lo}"), scale)).cast("int")
    return out.withColumns({"x0": F.col("_b.xmin"), "y0": F.col("_b.ymax"), "width": size("xmax", "xmin"), "height": size("ymax", "ymin"), "scale": F.lit(float(scale))}).drop("_b")


def target_scale(scale: Column, source_epsg: Column, target_epsg: Column, source_scale: Column) -> Column:
    """The wanted scale, else the source's if both use one reference system, else an error."""
    return F.coalesce(scale, F.when(source_epsg == target_epsg, F.abs(source_scale)), F.raise_error(F.lit("a scale is needed across reference systems")).cast("double"))


def wgs84_bbox(areas: DataFrame) -> DataFrame:
    """areas(rings, epsg) with west, south, east and north of the box's two corners."""
    out = areas.withColumn("_b", bbox(F.col("rings")))
    out = out.withColumn("_sw", to_wgs84(F.col("_b.xmin"), F.col("_b.ymin"), F.col("epsg"))).withColumn("_ne", to_wgs84(F.col("_b.xmax"), F.col("_b.ymax"), F.col("epsg")))
    return out.withColumns({"west": F.col("_sw.lon"), "south": F.col("_sw.lat"), "east": F.col("_ne.lon"), "north": F.col("_ne.lat")}).drop("_b", "_sw", "_ne")


def _edges(areas: DataFrame) -> DataFrame:
    """One row per edge of each ring, closed if it isn't, in cell units from the grid's top left."""
    at = F.transform("_ring", lambda p: F.struct(((p["x"] - F.col("x0")) / F.col("scale")).alias("x"), ((F.col("y0") - p["y"]) / F.col("scale")).alias("y")))
    pairs = F.transform("_p", lambda p, i: F.struct(p.alias("a"), F.element_at("_p", (i + 1) % F.size("_p") + 1).alias("b")))
    e = areas.select("item", "width", "height", "x0", "y0", "scale", F.explode("rings").alias("_ring")).select("item", "width", "height", at.alias("_p"))
    return e.select("item", "width", "height", F.explode(pairs).alias("_e")).select("item", "width", "height", "_e.a", "_e.b").where("a != b")


def _inside(edges: DataFrame) -> DataFrame:
    """Cells whose centre is inside. Each edge is spread over the rows whose centre line it crosses, and the sorted
    crossings of a row bound its runs of cells, so the work is edges x rows, not edges x cells."""
    lo, hi = F.least("a.y", "b.y"), F.greatest("a.y", "b.y")
    first, last = F.greatest(F.lit(0), F.ceil(lo - 0.5)), F.least(F.col("height") - 1, F.ceil(hi - 0.5) - 1)
    rows = edges.where(lo != hi).withColumn("r", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    x = F.col("a.x") + (F.col("r") + 0.5 - F.col("a.y")) * (F.col("b.x") - F.col("a.x")) / (F.col("b.y") - F.col("a.y"))
    runs = rows.groupBy("item", "width", "r").agg(F.sort_array(F.collect_list(x)).alias("xs"))
    starts = F.filter("xs", lambda _, i: i % 2 == 0)
    ends = F.filter("xs", lambda _, i: i % 2 == 1)
    runs = runs.select("item", "width", "r", F.explode(F.arrays_zip(starts.alias("s"), ends.alias("e"))).alias("x"))
    first, last = F.greatest(F.lit(0), F.ceil(F.col("x.s") - 0.5)), F.least(F.col("width") - 1, F.ceil(F.col("x.e") - 0.5) - 1)
    return runs.where(first <= last).select("item", F.col("r").cast("int").alias("r"), F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("c"))


def _touched(edges: DataFrame) -> DataFrame:
    """Cells that an edge passes through: the edge is cut at the rows it spans, and each piece covers columns."""
    lo, hi = F.least("a.y", "b.y"), F.greatest("a.y", "b.y")
    first = F.greatest(F.lit(0), F.least(F.floor(lo), F.col("height") - 1))
    last = F.least(F.col("height") - 1, F.greatest(F.floor(lo), F.ceil(hi) - 1))
    rows = edges.withColumn("r", F.explode(F.sequence(first, F.greatest(first, last))))
    slope = F.try_divide(F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y"))
    at = lambda y: F.when(slope.isNull(), None).otherwise(F.col("a.x") + (y - F.col("a.y")) * slope)
    top, bottom = at(F.greatest(lo, F.col("r").cast("double"))), at(F.least(hi, F.col("r") + 1.0))
    left = F.when(slope.isNull(), F.least("a.x", "b.x")).otherwise(F.least(top, bottom))
    right = F.when(slope.isNull(), F.greatest("a.x", "b.x")).otherwise(F.greatest(top, bottom))
    rows = rows.select("item", "width", "r", F.floor(left).alias("s"), F.greatest(F.floor(left), F.ceil(right) - 1).alias("e"))
    rows = rows.withColumns({"s": F.greatest(F.lit(0), F.least("s", F.col("width") - 1)), "e": F.least(F.col("width") - 1, F.col("e"))}).where("s <= e")
    return rows.select("item", F.col("r").cast("int").alias("r"), F.explode(F.sequence(F.col("s").cast("int"), F.col("e").cast("int"))).alias("c"))


def rasterize(areas: DataFrame, all_touched: bool = False) -> DataFrame:
    """Cells (item, r, c) of areas(item, rings, x0, y0, width, height, scale): those with their centre inside by the
    even-odd rule, or also those that the outline touches. Holes are rings."""
    edges = _edges(areas)
    return _inside(edges).unionByName(_touched(edges)).distinct() if all_touched else _inside(edges)


def rasterize_samples(features: DataFrame, value: str, scale: float, nodata: int = 255) -> DataFrame:
    """One raster per feature(item, rings, date, value): every cell of its grid, burnt or nodata. Both sides are cells, of
    which Spark's estimate knows the features alone, so they are merged and never sent to the driver."""
    g = grid(features, scale)
    burnt = rasterize(g).withColumn("_in", F.lit(True)).hint("merge")
    cells = g.withColumn("r", F.explode(F.sequence(F.lit(0), F.col("height") - 1))).withColumn("c", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
    return cells.join(burnt, ["item", "r", "c"], "left").select("item", "date", "r", "c", F.when(F.col("_in"), F.col(value)).otherwise(nodata).alias("v"))


def clip(cells: DataFrame, mask: DataFrame, bands: list[str], keys: list[str] | None = None, nodata: int = 0) -> DataFrame:
    """Cells outside of mask(*keys, r, c) get nodata."""
    keys = [*(keys or ["item"]), "r", "c"]
    out = cells.join(mask.select(*keys).withColumn("_in", F.lit(True)), keys, "left")
    return out.withColumns({b: F.when(F.col("_in"), F.col(b)).otherwise(nodata) for b in bands}).drop("_in").select(*cells.columns)


def resample_nearest(source: DataFrame, grids: DataFrame) -> DataFrame:
    """Target cells with the source cell that holds their centre. source(item, r, c, ...), grids(item, x0, y0, width,
    height, scale, sx0, sy0, sscale): an equi-join on the computed source cell."""
    g = grids.withColumn("_r", F.explode(F.sequence(F.lit(0), F.col("height") - 1))).withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
    g = g.withColumn("r", F.floor((F.col("sy0") - F.col("y0") + (F.col("_r") + 0.5) * F.col("scale")) / F.col("sscale")).cast("int"))
    g = g.withColumn("c", F.floor((F.col("x0") - F.col("sx0") + (F.col("_c") + 0.5) * F.col("scale")) / F.col("sscale")).cast("int"))
    out = g.select("item", "r", "c", "_r", "_c").join(source, ["item", "r", "c"])
    return out.drop("r", "c").withColumnsRenamed({"_r": "r", "_c": "c"})


def resample_bilinear(source: DataFrame, grids: DataFrame, bands: list[str], nodata: int = 0) -> DataFrame:
    """Triangle kernel, widened to the ratio of the scales when shrinking, cut at the source's edge, nodata left out of
    the weights, rounded. A source cell is spread over the few target cells that it weighs in, and the weighted sums
    are partially aggregated before the one shuffle. Target cells that nothing reaches are absent."""
    s = source.join(grids.select("item", "x0", "y0", "width", "height", "scale", "sx0", "sy0", "sscale"), "item")
    ratio = F.col("scale") / F.col("sscale")
    reach = F.greatest(F.lit(1.0), ratio)

    def spread(df: DataFrame, cell: str, off: Column, size: str, to: str) -> DataFrame:
        df = df.withColumn("_off", off / F.col("sscale"))
        at = lambda d: (F.col(cell) + 0.5 + d - F.col("_off")) / ratio - 0.5
        first, last = F.greatest(F.lit(0), F.ceil(at(-reach))), F.least(F.col(size) - 1, F.floor(at(reach)))
        df = df.withColumn(to, F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
        far = F.abs(F.col(cell) + 0.5 - F.col("_off") - (F.col(to) + 0.5) * ratio)
        return df.withColumn(f"{to}w", 1 - far / reach).where(F.col(f"{to}w") > 0)

    s = spread(s, "r", F.col("sy0") - F.col("y0"), "height", "_r")
    s = spread(s, "c", F.col("x0") - F.col("sx0"), "width", "_c").withColumn("_w", F.col("_rw") * F.col("_cw"))
    valid = lambda b, v: F.sum(F.when(F.col(b) != nodata, v))
    out = s.groupBy("item", F.col("_r").cast("int").alias("r"), F.col("_c").cast("int").alias("c")).agg(
        *[F.coalesce(F.round(F.try_divide(valid(b, F.col("_w") * F.col(b)), valid(b, F.col("_w")))).cast("int"), F.lit(nodata)).alias(b) for b in bands]
    )
    return out
