"""Items of features and rasters, stacks of mosaics over many items, and incremental collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eocube.functions.cells import argmax
from eocube.operators import grid, mosaic, ranks, search, stats, warp
from eocube.sources import rasters


def item_date(tag: Column, feature: Column, reference: Column) -> Column:
    """The raster's tag, else the feature's date, else the reference date, else an error."""
    return F.coalesce(tag, feature, reference, F.raise_error(F.lit("no date")).cast("date"))


def vector_items(features: DataFrame, value: str, categorical: bool) -> DataFrame:
    """features(item, rings, date, value) as items with their box; the value is named class or value."""
    return features.select("item", grid.bbox(F.col("rings")).alias("_b"), "rings", "date", F.col(value).alias("class" if categorical else "value")).select("item", "_b.*", F.col("rings").alias("footprint"), "date", "class" if categorical else "value")


def raster_items(meta: DataFrame, cells: DataFrame) -> DataFrame:
    """meta(item, xmin.., date) with each item's value counts as a map; counts are aggregated before they are gathered,
    so a map holds an item's classes, not its cells."""
    counts = cells.groupBy("item", "value").agg(F.count("*").alias("n")).groupBy("item").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("value", "n")))).alias("stats"))
    return meta.join(counts, "item", "left")


def item_aoi(items: DataFrame) -> DataFrame:
    """Each item's box as GeoJSON text with its reference system."""
    x0, y0, x1, y1 = (F.col(k).cast("double") for k in ("xmin", "ymin", "xmax", "ymax"))
    ring = F.array(*[F.array(x, y) for x, y in ((x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0))])
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.create_map().cast("map<string,string>").alias("properties"), geometry.alias("geometry"))
    crs = F.struct(F.struct(F.concat(F.lit("EPSG:"), F.col("epsg").cast("string")).alias("name")).alias("properties"))
    return items.select("item", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"), crs.alias("crs"))).alias("geojson"))


def merge_collections(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """All of new, and what of old is not in it."""
    return new.unionByName(old.join(new.select(key), key, "left_anti").select(*new.columns))


def item_slice(items: DataFrame, key: str, job: int, n: int) -> DataFrame:
    """Items job * n to (job + 1) * n in the order of their key."""
    return ranks.slice_by_key(items, key, job * n, (job + 1) * n)


def merge_predictions(preds: DataFrame, rects: DataFrame, categorical: bool, nodata: float) -> DataFrame:
    """Mean where any rectangles overlap and values aren't classes, else first valid. Whether they overlap is one row
    joined to each cell, not a driver-side branch."""
    some = stats.overlapping_pairs(rects).limit(1).agg((F.count("*") > 0).alias("_some"))
    both = preds.where(F.col("v") != nodata).groupBy("r", "c").agg(F.avg("v").alias("_mean"), F.min_by("v", "file_order").alias("_first"))
    if categorical:
        return both.select("r", "c", F.col("_first").alias("v"))
    one = both.crossJoin(F.broadcast(some))  # one row
    return one.select("r", "c", F.when(F.col("_some"), F.col("_mean")).otherwise(F.col("_first")).alias("v"))


def merge_probabilities(preds: DataFrame) -> DataFrame:
    """Class of the summed probabilities: preds(r, c, probs), all arrays of one length."""
    p = preds.select("r", "c", F.posexplode("probs").alias("k", "p")).groupBy("r", "c", "k").agg(F.sum("p").alias("p"))
    p = p.groupBy("r", "c").agg(F.sort_array(F.collect_list(F.struct("k", "p"))).alias("s"))
    return p.select("r", "c", argmax(F.transform("s", lambda x: x["p"])).alias("class"))


def pixel_stack(matched: DataFrame, cells_of, bands: list[str], mode: str = "latest_pixel", limit: int = 10, cloudy: Column | None = None, score: Column | None = None, qa: str | None = None, mask: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Mosaics of many items and steps in one plan. matched(tile_id, step_no, step_start, scene_id, sensing_time,
    cloud_cover) are scenes of each item's steps; ranks cut them to limit before cells_of(scenes) reads their cells.

    Modes: latest_pixel, cloud_sorted_pixel, composite (cloudy), composite_qa (qa, a column's name), full (score) and
    all, every scene an image of its own, by scene_id. Scenes with a band that is 0 all over are passed over, images
    whose first band is empty are left out, and cells outside mask(tile_id, r, c) are set to 0. With stats(scene_id, a
    struct per band), zone maps of the scenes as the cells show them, empty scenes are told before and cells are read
    once; without, they are read a second time to tell. Of scenes with data, only the mode full can make an empty
    image: the others keep a first band that isn't 0 wherever the first scene has one."""
    by = "cloud_cover" if mode == "cloud_sorted_pixel" else "sensing_time"
    asked = search.limit_scenes(search.rank_scenes(matched, by), limit)
    if stats is None:
        cells = search.drop_empty_scenes(cells_of(asked), bands)
    else:
        cells = cells_of(search.scenes_with_data(asked, stats, bands, ["scene_id"]))
    if mode in ("latest_pixel", "cloud_sorted_pixel"):
        out = mosaic.first_valid(cells, bands)
    elif mode == "composite":
        out = mosaic.composite(cells, bands, cloudy)
    elif mode == "composite_qa":
        out = mosaic.composite_qa(cells, bands, qa)
    elif mode == "all":
        out = mosaic.all_scenes(cells, bands)
    elif mode == "full":
        out = mosaic.drop_empty_steps(mosaic.composite_full(cells, bands, score), bands[0])
    else:
        raise ValueError(f"no mode {mode}")
    return out if mask is None else grid.clip(out, mask, bands, ["tile_id"])


def area_stack(areas: DataFrame, scenes: DataFrame, steps: DataFrame, chunks: DataFrame, bands: list[str], scale: float, size: int, discrete: list[str] = (), clip: bool = False, all_touched: bool = False, tolerance: float = 0.125, reach: float | None = None, **stack) -> DataFrame:
    """Mosaics on the areas' own grids, from scenes of any supported reference system and resolution.

    areas(tile_id, rings, epsg) meet the scenes (scene_id, sensing_time, cloud_cover, lon/lat box, sx0, sy0, sscale, sepsg)
    whose boxes meet theirs, steps cut them by time, ranks by number; what is left is warped from its chunks, of which
    only those in an area's window are read, and stacked as pixel_stack() does. With clip, cells outside of the area's
    rings are 0."""
    g = grid.grid(areas, scale)
    boxes = grid.wgs84_bbox(areas).select("tile_id", F.col("west").alias("a_xmin"), F.col("south").alias("a_ymin"), F.col("east").alias("a_xmax"), F.col("north").alias("a_ymax"))
    met = search.match_scenes(boxes.withColumnRenamed("tile_id", "area_id"), scenes).select(F.col("area_id").alias("tile_id"), *[c for c in scenes.columns if c != "tile_id"])
    matched = search.assign_steps(met, steps)
    at = g.select("tile_id", *warp.GRID)

    def cells_of(asked: DataFrame) -> DataFrame:
        return warp.warp(asked.join(at, "tile_id"), chunks, ["tile_id", "step_no", "idx", "scene_id"], bands, discrete, size, tolerance=tolerance, reach=reach)

    mask = grid.rasterize(g.withColumnRenamed("tile_id", "item"), all_touched).withColumnRenamed("item", "tile_id") if clip else None
    return pixel_stack(matched, cells_of, bands, mask=mask, **stack)


def to_collect(steps: DataFrame, existing: DataFrame, overwrite: bool = False) -> DataFrame:
    """Steps (item, step_no, step_start, step_end) that still need an image, all of them when overwriting."""
    return steps if overwrite else stats.missing_steps(steps, existing)


def collect(steps: DataFrame, existing: DataFrame, scenes: DataFrame, cells_of, bands: list[str], overwrite: bool = False, **stack) -> DataFrame:
    """Incremental collection: mosaics of the missing steps only. Scenes of steps that have an image are dropped before any
    cell is read."""
    matched = search.assign_steps(scenes, to_collect(steps, existing, overwrite).withColumnRenamed("item", "tile_id"), ["tile_id"])
    return pixel_stack(matched, cells_of, bands, **stack)


def collect_into(path: str, steps: DataFrame, scenes: DataFrame, cells_of, bands: list[str], overwrite: bool = False, **stack) -> DataFrame:
    """Incremental collection to the end: mosaics of the steps (item, step_no, step_start, step_end) that the index below
    path doesn't have are written to path/images by item and date, and path/index, by item, gets what was written.
    Returns the index (item, date, cells).

    Images come first and replace only their own folders, the index of the items touched follows. So a run that is
    killed in between leaves images that the index lacks, and the next run makes these steps again, with the same
    result. A step without any data stays missing and is tried again.
    """
    spark = scenes.sparkSession
    kind = dict(steps.dtypes)["item"]
    index = read_index(spark, path, kind)
    asked = to_collect(steps, index.select("item", "date"), overwrite)
    made = pixel_stack(search.assign_steps(scenes, asked.withColumnRenamed("item", "tile_id"), ["tile_id"]), cells_of, bands, **stack)
    dated = made.join(asked.select(F.col("item").alias("tile_id"), "step_no", "step_start"), ["tile_id", "step_no"])
    rasters.write_stack(dated.select(F.col("tile_id").alias("item"), F.col("step_start").alias("t"), "r", "c", *bands), f"{path}/images")
    written = spark.read.schema(f"r int, item {kind}, t date").parquet(f"{path}/images").select("item", F.col("t").alias("date"))
    dates = asked.select("item", F.col("step_start").alias("date"))
    new = written.join(dates, ["item", "date"], "left_semi").groupBy("item", "date").agg(F.count("*").alias("cells"))
    touched = asked.select("item").distinct()
    kept = index.join(touched, "item", "left_semi").join(dates, ["item", "date"], "left_anti")
    new.unionByName(kept).select("date", "cells", "item").repartition("item").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("item").parquet(f"{path}/index")
    return read_index(spark, path, kind)


def read_index(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """The index (item, date, cells) of what has been collected below path; empty before the first run."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/index")
    schema = f"date date, cells long, item {kind}"
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return (spark.read.schema(schema).parquet(f"{path}/index") if there else spark.createDataFrame([], schema)).select("item", "date", "cells")


def stack_index(images: DataFrame) -> DataFrame:
    """Sorted image paths, first and last date of each item of images(item, date, path)."""
    return images.groupBy("item").agg(F.array_sort(F.collect_set("path")).alias("x_paths"), F.min("date").alias("first"), F.max("date").alias("last"))


def first_date(ranked: DataFrame) -> DataFrame:
    """Date of the top-ranked scene of each item and step, even if it is skipped later."""
    return ranked.groupBy("tile_id", "step_no").agg(F.min_by(F.to_date("sensing_time"), "idx").alias("date"))


def position(df: DataFrame, item: str, order: str) -> DataFrame:
    """Position of each row in its item, from 0."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy(item).orderBy(order)) - 1)
