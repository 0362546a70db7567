"""Mosaics: one picked observation per cell of an item and step, from scenes ranked by idx."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.functions.cells import qa_cloud

CELL = ["tile_id", "step_no", "r", "c"]
# Classes in the order of preference of the full composite, best first.
SCL_RANK = [4, 5, 6, 11, 2, 7, 10, 3, 8, 9, 1, 0]


def first_valid(cells: DataFrame, bands: list[str], idx: str = "idx") -> DataFrame:
    """The first scene whose first band is not 0; if none, the last one. One partially aggregated min_by for each band, by
    an order that is a number: such states are hashed, where those of structs would have all cells sorted. A missing
    first band comes before all."""
    b0, far = F.col(bands[0]), F.lit(1 << 40)
    order = F.when(b0 == 0, far - F.col(idx)).when(b0.isNull(), F.col(idx) - far).otherwise(F.col(idx))
    return cells.groupBy(*CELL).agg(*[F.min_by(b, order).alias(b) for b in bands])


def all_scenes(cells: DataFrame, bands: list[str]) -> DataFrame:
    return cells.select("scene_id", *CELL, *bands)


def drop_empty_steps(mosaic: DataFrame, band: str) -> DataFrame:
    """Without the steps whose first band is 0 all over."""
    full = mosaic.groupBy("tile_id", "step_no").agg(F.max(F.abs(band)).alias("_m")).where("_m > 0")
    return mosaic.join(full.select("tile_id", "step_no"), ["tile_id", "step_no"], "left_semi")


def composite(cells: DataFrame, bands: list[str], cloudy: Column, stop_share: float = 0.05) -> DataFrame:
    """Cloud-free composite with early finish. Scene 0 always fills a cell; a later one replaces it where all before
    were cloudy and its first band is not 0. The item and step end after the first scene that leaves no picked 0 and at
    most stop_share of the cells cloudy in all scenes so far; cells that this scene lacks are left out. Flags and the
    first band may not be null.

    What is left after each of a cell's scenes follows from three of its ranks (see _states), so nothing is gathered,
    however many scenes a step has: a cell's pick is the last scene with data up to its first clear one and the end.
    Cells that come dealt out by item and step are not shuffled again."""
    states = _states(cells, bands, cloudy)
    state = _residual(states)
    stop = state.groupBy("tile_id", "step_no").agg(F.coalesce(F.min(F.when((F.col("empty") == 0) & (F.col("share") <= stop_share), F.col("idx"))), F.max("idx")).alias("_stop"))
    fills = (F.col("idx") <= F.least("_clear", "_stop")) & ((F.col("idx") == F.col("_first")) | (F.col(bands[0]) != 0))
    at = F.when(fills, F.col("idx"))
    out = states.join(stop.hint("merge"), ["tile_id", "step_no"]).groupBy(*CELL).agg(*[F.max_by(b, at).alias(b) for b in bands], F.max(F.col("idx") == F.col("_stop")).alias("_there"))
    return out.where("_there").select(*CELL, *bands)


def _states(cells: DataFrame, bands: list[str], cloudy: Column) -> DataFrame:
    """Cells with the ranks of the first scene of theirs, of the first clear one and of the first with data, null if there is none."""
    w, idx = Window.partitionBy(*CELL), F.col("idx")
    x = cells.select("idx", *CELL, *bands, cloudy.alias("_cloud"))
    return x.withColumns({"_first": F.min(idx).over(w), "_clear": F.min(F.when(~F.col("_cloud"), idx)).over(w), "_data": F.min(F.when(F.col(bands[0]) != 0, idx)).over(w)}).drop("_cloud")


def _residual(states: DataFrame) -> DataFrame:
    masked, filled = F.coalesce(F.col("idx") < F.col("_clear"), F.lit(True)), F.coalesce(F.col("_data") <= F.least("idx", "_clear"), F.lit(False))
    return states.groupBy("tile_id", "step_no", "idx").agg(F.avg(masked.cast("int")).alias("share"), F.count_if(~filled).alias("empty"))


def full_score(scl: str, red: str, nir: str) -> Column:
    rank = F.element_at(F.array(*[F.lit(SCL_RANK.index(i)) for i in range(12)]), F.col(scl) + 1)
    ndvi = F.when(F.col(nir) + F.col(red) == 0, F.lit(1.0)).otherwise((F.col(nir) - F.col(red)).cast("double") / F.nullif(F.col(nir) + F.col(red), F.lit(0)))
    return rank + (1 - ndvi) / 100


def composite_full(cells: DataFrame, bands: list[str], score: Column) -> DataFrame:
    """The lowest score over all scenes, ties to the earlier one."""
    return cells.groupBy(*CELL).agg(F.min_by(F.struct(*bands), F.struct(score, "idx")).alias("p")).select(*CELL, "p.*")


def composite_qa(cells: DataFrame, bands: list[str], qa: str, stop_share: float = 0.05, sieved: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> DataFrame:
    """The composite with cloud flags from a quality band, each scene's flags sieved first: by `sieve`, which takes the
    bands along, or by `sieved`, which takes a mask and its keys and is joined to the cells (regions.sieve_regions merges
    into the largest neighbour, at any threshold)."""
    scene = ["tile_id", "step_no", "idx"]
    flagged = cells.select(*scene, "r", "c", *bands, qa_cloud(qa).cast("int").alias("m"))
    if sieved is None:
        flagged = _sieved(flagged, scene)
    else:
        flagged = flagged.drop("m").join(sieved(flagged.select(*scene, "r", "c", "m"), scene).hint("merge"), [*scene, "r", "c"])
    return composite(flagged, bands, F.col("m") == 1, stop_share)


def residual_by_scene(cells: DataFrame, bands: list[str], cloudy: Column) -> DataFrame:
    """After each scene of an item and step: the share of cells cloudy in all scenes so far, and how many picks are 0."""
    return _residual(_states(cells, bands, cloudy))


#: The band that a composite's cloud flags come from.
MASK_BANDS = {"scl": "scl", "full": "scl", "qa_pixel": "qa"}


def with_mask_band(bands: list[str], method: str) -> list[str]:
    """The bands to read for a composite: those asked for, and the method's mask band if it isn't among them."""
    return bands if MASK_BANDS[method] in bands else [*bands, MASK_BANDS[method]]


def without_mask_band(images: DataFrame, bands: list[str], method: str) -> DataFrame:
    """Composites without a mask band that was only added for them."""
    return images if MASK_BANDS[method] in bands else images.drop(MASK_BANDS[method])


def sieve(mask: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """mask(item, r, c, m) with groups of one or two equal 4-neighbours flipped, in masks of over three cells. No
    iteration: a cell is alone if it has no equal neighbour, and one of a pair if it and its only equal neighbour have
    one each. Neighbours are told by windows along rows and columns. A mask goes to one task, which spills what it can't
    hold; masks of that size are for regions.sieve_regions, which cuts them. keys name a mask, `item` if not given."""
    keys = keys or ["item"]
    return _sieved(mask.select(*keys, "r", "c", "m"), keys)


def _sieved(x: DataFrame, keys: list[str]) -> DataFrame:
    """x with m sieved; other columns stay. The size comes first, so all windows use one way of dealing, by the mask or
    what x is dealt by already, and no count is joined."""
    columns = x.columns
    x = x.withColumn("_size", F.count("*").over(Window.partitionBy(*keys)))
    along = {"c": Window.partitionBy(*keys, "r").orderBy("c"), "r": Window.partitionBy(*keys, "c").orderBy("r")}
    beside = lambda f, k, by: F.coalesce((f(k).over(along[k]) == F.col(k) + by) & (f("m").over(along[k]) == F.col("m")), F.lit(False))
    for k in ("c", "r"):
        x = x.withColumns({f"_{k}0": beside(F.lag, k, -1), f"_{k}1": beside(F.lead, k, 1)})
    sides = ["_c0", "_c1", "_r0", "_r1"]
    x = x.withColumn("_n", sum((F.col(y).cast("int") for y in sides), F.lit(0)))
    for k in ("r", "c"):
        x = x.withColumn(f"_{k}", F.when(F.col(f"_{k}0"), F.lag("_n").over(along[k])).when(F.col(f"_{k}1"), F.lead("_n").over(along[k])))
    flipped = (F.col("_size") > 3) & ((F.col("_n") == 0) | (F.col("_n") == 1) & (F.coalesce("_r", "_c") == 1))
    return x.withColumn("m", F.when(flipped, 1 - F.col("m")).otherwise(F.col("m"))).select(*columns)
