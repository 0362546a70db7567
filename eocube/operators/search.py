"""Catalogue search: filters, dedup, ranking, and joins of scenes with areas and time steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.operators import boxes, intervals

# The catalogue platforms behind a requested one, and the collections that are searched for them.
SENTINEL, SENTINEL_PLATFORMS = "SENTINEL_2", ["sentinel-2a", "sentinel-2b", "sentinel-2c", "sentinel-2d"]
LANDSAT_PLATFORMS = ["LANDSAT_1", "LANDSAT_2", "LANDSAT_3", "LANDSAT_4", "LANDSAT_5", "LANDSAT_6", "LANDSAT_7", "LANDSAT_8"]
LANDSAT_COLLECTIONS, L2A_COLLECTIONS, L1C_COLLECTIONS = ["landsat-c2l2-sr"], ["sentinel-s2-l2a", "sentinel-s2-l2a-cogs"], ["sentinel-s2-l1c"]


def _requested(platforms: str | list[str]) -> list[str]:
    names = [platforms] if isinstance(platforms, str) else list(platforms)
    unknown = [p for p in names if p != SENTINEL and p not in LANDSAT_PLATFORMS]
    if unknown or not names:
        raise ValueError(f"no platform {', '.join(unknown)}")
    return names


def intersects_bbox(df: DataFrame, xmin, ymin, xmax, ymax) -> DataFrame:
    return df.where((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))


def filter_platform(df: DataFrame, platforms: str | list[str]) -> DataFrame:
    """Scenes of one platform or several; unknown names are an error."""
    return df.where(F.col("platform").isin([x for p in _requested(platforms) for x in (SENTINEL_PLATFORMS if p == SENTINEL else [p])]))


def filter_collection(df: DataFrame, platforms: str | list[str], level: str | None = None) -> DataFrame:
    """Scenes of the collections behind the platforms: level L2A has two of Sentinel-2, any other level its L1C one."""
    names = _requested(platforms)
    some = LANDSAT_COLLECTIONS if any(p != SENTINEL for p in names) else []
    if SENTINEL in names:
        some = some + (L2A_COLLECTIONS if level == "L2A" else L1C_COLLECTIONS)
    return df.where(F.col("collection_id").isin(some))


def filter_dates(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Both ends inclusive, and None open; a date as the end means its midnight."""
    if start is not None:
        df = df.where(F.col("sensing_time") >= F.lit(start).cast("timestamp"))
    return df if end is None else df.where(F.col("sensing_time") <= F.lit(end).cast("timestamp"))


def filter_cloud(df: DataFrame, most: float) -> DataFrame:
    return df.where(F.col("cloud_cover") < most)


def dedup_scenes(df: DataFrame) -> DataFrame:
    """One row per id: that of the last collection by name, then of the smallest scene_id."""
    w = Window.partitionBy("id").orderBy(F.desc("collection_id"), "scene_id")
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def search(df: DataFrame, platforms: str | list[str], level: str | None = None, start: str | None = None, end: str | None = None, most_cloud: float | None = None, bbox=None, limit: int | None = None, sort: str | None = "sensing_time") -> DataFrame:
    """The whole request; filters come first and reach the scan, then dedup (of level L2A alone), order and limit. sort is
    sensing_time (latest first), cloud_cover (least first, unknown last) or None; ties go to the smaller scene_id."""
    if sort not in ("sensing_time", "cloud_cover", None):
        raise ValueError(f"no order by {sort}")
    df = df if bbox is None else intersects_bbox(df, *bbox)
    df = filter_dates(filter_collection(filter_platform(df, platforms), platforms, level), start, end)
    df = df if most_cloud is None else filter_cloud(df, most_cloud)
    df = dedup_scenes(df) if level == "L2A" else df
    if sort:
        df = df.orderBy(F.desc("sensing_time") if sort == "sensing_time" else F.asc_nulls_last("cloud_cover"), "scene_id")
    return df if limit is None else df.limit(limit)


def resolve_bands(assets: Column, bands: list[str]) -> Column:
    """Map of band to link: by the asset's key, else by the name of its only band; alternate links first."""
    entries = F.transform(
        F.map_entries(assets),
        lambda e: F.struct(
            F.when(e["key"].isin(bands), e["key"]).when((F.size(e["value"]["eo_bands"]) == 1) & e["value"]["eo_bands"][0]["name"].isin(bands), e["value"]["eo_bands"][0]["name"]).alias("band"),
            F.coalesce(e["value"]["s3_href"], e["value"]["href"]).alias("href"),
        ),
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["band"].isNotNull()))


def missing_bands(bands: Column, wanted: list[str]) -> Column:
    return F.array_except(F.array(*[F.lit(b) for b in wanted]), F.map_keys(bands))


def require_bands(df: DataFrame, bands: Column, wanted: list[str]) -> DataFrame:
    """df with bands, an error for a scene that lacks one."""
    lacking = missing_bands(bands, wanted)
    return df.withColumn("bands", F.when(F.size(lacking) == 0, bands).otherwise(F.raise_error(F.concat(F.lit("missing bands: "), F.array_join(lacking, ", "))).cast("map<string,string>")))


def match_scenes(areas: DataFrame, scenes: DataFrame) -> DataFrame:
    """areas(area_id, a_xmin...) with the scenes whose boxes meet theirs."""
    return boxes.meeting(areas, scenes)


def assign_steps(scenes: DataFrame, steps: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Scenes of each step (of the same keys): step_start <= time <= step_end, the end being midnight."""
    return intervals.days_in_intervals(scenes, F.to_date("sensing_time"), steps, keys).where(F.col("sensing_time") <= F.col("step_end"))


def rank_scenes(matched: DataFrame, by: str = "sensing_time", to: str = "idx") -> DataFrame:
    order = F.desc("sensing_time") if by == "sensing_time" else F.asc_nulls_last("cloud_cover")
    return matched.withColumn(to, F.row_number().over(Window.partitionBy("tile_id", "step_no").orderBy(order, "scene_id")))


def limit_scenes(ranked: DataFrame, n: int, rank: str = "idx") -> DataFrame:
    return ranked.where(F.col(rank) <= n)


def drop_empty_scenes(cells: DataFrame, bands: list[str]) -> DataFrame:
    """Without the scenes that have a band which is 0 all over."""
    full = cells.groupBy("tile_id", "step_no", "scene_id").agg(*[F.max(F.abs(b)).alias(b) for b in bands])
    for b in bands:
        full = full.where(F.col(b) > 0)
    return cells.join(full.select("tile_id", "step_no", "scene_id"), ["tile_id", "step_no", "scene_id"], "left_semi")


def scenes_with_data(scenes: DataFrame, stats: DataFrame, bands: list[str], keys: list[str]) -> DataFrame:
    """Scenes with a valid value in every band, told by stats(keys, a struct with `valid` per band), the images' added-up
    zone maps: what drop_empty_scenes() finds, before a cell is read."""
    full = stats
    for b in bands:
        full = full.where(F.col(f"{b}.valid") > 0)
    return scenes.join(full.select(*keys), keys, "left_semi")
