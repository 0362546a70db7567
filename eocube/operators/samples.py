"""Training samples, neighbourhoods, windows and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def samples_cell(cells: DataFrame, bands: list[str], nodata: int) -> DataFrame:
    """One row per cell: features [time][band]; cells with nothing but nodata are left out."""
    rows = cells.groupBy("tile_id", "r", "c").agg(F.array_sort(F.collect_list(F.struct("step_no", F.array(*bands).alias("v")))).alias("s"))
    rows = rows.select("tile_id", "r", "c", F.transform("s", lambda x: x["v"]).alias("features"))
    return rows.where(F.exists(F.flatten("features"), lambda v: v != nodata))


def latest_images(images: DataFrame, n: int) -> DataFrame:
    return images.withColumn("_k", F.row_number().over(Window.partitionBy("tile_id").orderBy(F.desc("step_no")))).where(F.col("_k") <= n).drop("_k")


def least_by(images: DataFrame, count: str, n: int) -> DataFrame:
    """The n images with the least nodata or clouds, ties to the earlier."""
    return images.withColumn("_k", F.row_number().over(Window.partitionBy("tile_id").orderBy(count, "step_no"))).where(F.col("_k") <= n).drop("_k")


def time_index(images: DataFrame) -> DataFrame:
    return images.withColumn("t_idx", F.row_number().over(Window.partitionBy("tile_id").orderBy("step_no")) - 1)


def hash_ranked(df: DataFrame, key: str, seed: int) -> DataFrame:
    """df with _rank, from 1 in the order of a hash of the key, and _all, the number of rows. Ranks come from one count
    per hash bucket, so no task orders all rows."""
    h = df.withColumn("_h", F.xxhash64(F.lit(seed), key)).withColumn("_b", F.shiftrightunsigned("_h", 52))
    counts = h.groupBy("_b").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    edges = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).withColumn("_all", F.sum("_n").over(Window.partitionBy()))
    ranked = h.join(edges, "_b").withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)))
    return ranked.select(*df.columns, "_rank", "_all")


def split_samples(df: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """The first ceil(n * share) by a hash are for training, the others for evaluation."""
    return hash_ranked(df, key, seed).select(*df.columns, (F.col("_rank") <= F.ceil(F.col("_all") * share)).alias("training"))


def shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.orderBy(F.xxhash64(F.lit(seed), key), key)


def upsample(cells: DataFrame, factor: int) -> DataFrame:
    steps = F.sequence(F.lit(0), F.lit(factor - 1))
    out = cells.withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps))
    return out.withColumns({"r": F.col("r") * factor + F.col("_i"), "c": F.col("c") * factor + F.col("_j")}).drop("_i", "_j")


def pad(cells: DataFrame, height: int, width: int, p: int) -> DataFrame:
    """Edge padding: each border cell stands for all target cells that clamp to it."""
    span = lambda x, n: F.explode(F.sequence(F.when(F.col(x) == 0, -p).otherwise(F.col(x)), F.when(F.col(x) == n - 1, n - 1 + p).otherwise(F.col(x))))
    return cells.withColumn("_r", span("r", height)).withColumn("_c", span("c", width)).withColumns({"r": F.col("_r") + p, "c": F.col("_c") + p}).drop("_r", "_c")


def flip(cells: DataFrame, kind: str, height: int, width: int) -> DataFrame:
    r, c = F.lit(height - 1) - F.col("r"), F.lit(width - 1) - F.col("c")
    return cells.withColumns({"both": {"r": r, "c": c}, "rows": {"r": r}, "columns": {"c": c}}[kind])


def fill_shape(cells: DataFrame, keys: list[str], height: int, width: int, bands: list[str]) -> DataFrame:
    grid = cells.select(*keys).distinct().withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    return grid.join(cells.select(*keys, "r", "c", *bands), [*keys, "r", "c"], "left").fillna(0, bands)


def windows(grids: DataFrame, size: int, ratio: float) -> DataFrame:
    """Sliding windows (row, col) over grids(item, height, width); the last one is moved back to the edge."""
    step = max(1, int(size * ratio))
    at = lambda n: F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.col(n) - 1, F.lit(0)), F.lit(step)), lambda i: F.greatest(F.lit(0), F.least(i, F.col(n) - size))))
    return grids.select("item", F.explode(at("height")).alias("row"), "width").select("item", "row", F.explode(at("width")).alias("col"))


def stitch(preds: DataFrame, nodata: float) -> DataFrame:
    """Mean of overlapping windows' predictions per cell and class."""
    return preds.groupBy("item", "r", "c", "class").agg(F.coalesce(F.avg("p"), F.lit(nodata)).alias("p"))


#: Metrics over (y_true, y_pred), with nodata labels left out where one is given.
def metric(name: str, nodata: float | None = None, value: float = 0.0) -> Column:
    t, p = F.col("y_true"), F.col("y_pred")
    keep = F.lit(True) if nodata is None else t != nodata
    known = {
        "mse": F.avg(F.when(keep, (p - t) * (p - t))),
        "rmse": F.sqrt(F.avg(F.when(keep, (p - t) * (p - t)))),
        "rmse_less": F.sqrt(F.avg(F.when(keep & (t <= value), (p - t) * (p - t)))),
        "rmse_more": F.sqrt(F.avg(F.when(keep & (t >= value), (p - t) * (p - t)))),
        "stretching": F.avg(F.when(keep, F.abs(p - t) * (t + 1))),
        "square_stretching": F.avg(F.when(keep, F.abs(p - t) * (t + 1) * (t + 1))),
    }
    if name not in known:
        raise ValueError(f"no metric {name}")
    return known[name]


def batch_ids(df: DataFrame, item: str, order: str, batch: int) -> DataFrame:
    """Batch i of an item holds its samples i, i + L, i + 2L, ... with L = ceil(n / batch)."""
    w = Window.partitionBy(item)
    n = F.ceil(F.count("*").over(w) / batch)
    return df.withColumn("batch", (F.row_number().over(w.orderBy(order)) - 1) % n)


def sample_weights(df: DataFrame, weights: DataFrame) -> DataFrame:
    """Each sample's class weight, the classes' weights summing to 1; 0 for a class without one."""
    total = weights.agg(F.sum("weight")).first()[0]
    return df.join(weights.select("value", (F.col("weight") / total).alias("weight")), "value", "left").fillna(0.0, ["weight"])
