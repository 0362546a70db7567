"""Training sets out of image stacks, cell models and their predictions.

Image cells are (item, t, r, c) and one column per band, labels (item, r, c, label).
"""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.functions.cells import multiclass_bins, multiclass_int, normalize, one_hot
from eocube.operators.ranks import capped
from eocube.operators.samples import fill_shape, hash_ranked, metric, pad, sample_weights, upsample
from eocube.operators.stats import class_weights, image_quality

#: Cells that a training set in memory takes at most.
MOST_ROWS = 100_000_000


def pair_xy(x: DataFrame, y: DataFrame) -> DataFrame:
    """Cells with their label: by item and cell for label images, by item for scalar labels."""
    return x.join(y, [k for k in ("item", "r", "c") if k in y.columns])


def drop_nodata_cells(samples: DataFrame, x_nodata: float, y_nodata: float | None) -> DataFrame:
    """Without samples whose features are nodata all over or whose label is nodata; a y_nodata of 0 or None is not used."""
    out = samples.where(F.exists(F.flatten("features"), lambda v: v != x_nodata))
    return out.where(F.col("label") != y_nodata) if y_nodata else out


def limit_shape(cells: DataFrame, times: int, height: int, width: int, bands: list[str]) -> DataFrame:
    return cells.where((F.col("t") < times) & (F.col("r") < height) & (F.col("c") < width)).select("item", "t", "r", "c", *bands)


def _image(cells: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Rows of cells as image[r][c][band]. Rows are gathered first and then images, so both groups are one image's. An
    image must fit a row of Spark's; larger ones are cut into windows or chunks before, or kept as cells."""
    rows = cells.groupBy(*keys, "r").agg(F.sort_array(F.collect_list(F.struct("c", F.array(*bands).alias("v")))).alias("s"))
    rows = rows.select(*keys, "r", F.transform("s", lambda x: x["v"]).alias("row"))
    out = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("r", "row"))).alias("s"))
    return out.select(*keys, F.transform("s", lambda x: x["row"]).alias("image"))


def samples_2d(cells: DataFrame, bands: list[str]) -> DataFrame:
    """One sample per item and date; dates that an item lacks are not filled."""
    return _image(cells, ["item", "t"], bands)


def samples_3d(cells: DataFrame, bands: list[str], times: int) -> DataFrame:
    """One sample per item: images[t][r][c][band] of its latest times, in time order; missing times are zero images."""
    images = _image(cells, ["item", "t"], bands)
    kept = images.withColumn("_k", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("t")))).where(F.col("_k") <= times)
    s = kept.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("t", "image"))).alias("s")).select("item", F.transform("s", lambda x: x["image"]).alias("images"))
    blank = F.transform(F.element_at("images", 1), lambda row: F.transform(row, lambda cell: F.transform(cell, lambda v: (v * 0))))
    return s.withColumn("images", F.concat("images", F.array_repeat(blank, F.lit(times) - F.size("images"))))


def valid_samples(samples: DataFrame, times: int, height: int, width: int) -> DataFrame:
    """Samples of samples_3d with the wanted shape."""
    ok = F.forall("images", lambda m: (F.size(m) == height) & F.forall(m, lambda row: F.size(row) == width))
    return samples.where((F.size("images") == times) & ok)


def frames(cells: DataFrame, bands: list[str], size: int, height: int, width: int, labels: DataFrame | None = None, y_nodata: float | None = None) -> DataFrame:
    """The size x size frame around each cell, edge cells repeated; even sizes are made odd. With labels the border and
    nodata labels are left out and identical frames keep the first cell's label.

    A cell is sent to the frames that it is part of, size ** 2 of them and more at an edge, instead of joining cells.
    """
    p = size // 2
    n = 2 * p + 1
    reach = lambda k, most: F.explode(F.sequence(F.greatest(F.lit(0), F.col(k) - p), F.least(F.lit(most - 1), F.col(k) + p)))
    s = cells.withColumn("fr", reach("r", height)).withColumn("fc", reach("c", width))
    inner = (F.col("fr").between(p, height - 1 - p)) & (F.col("fc").between(p, width - 1 - p))
    if labels is not None:
        s = s.where(inner)
    spots = lambda k, f, most: F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.greatest(F.lit(0), F.least(F.lit(most - 1), F.col(f) + i - p)) == F.col(k))
    s = s.withColumn("_y", F.explode(spots("r", "fr", height))).withColumn("_x", F.explode(spots("c", "fc", width)))
    g = s.groupBy("item", "fr", "fc").agg(F.sort_array(F.collect_list(F.struct("t", "_y", "_x", F.array(*bands).alias("v")))).alias("s"))
    out = g.select("item", F.col("fr").alias("r"), F.col("fc").alias("c"), F.transform("s", lambda x: x["v"]).alias("features"))
    if labels is None:
        return out
    out = out.join(labels, ["item", "r", "c"])
    if y_nodata is not None:
        out = out.where(F.col("label") != y_nodata)
    return out.groupBy("item", "features").agg(F.min(F.struct("r", "c", "label")).alias("f")).select("item", "f.*", "features")


def change_bright(bands: list[str]) -> dict[str, Column]:
    return {b: F.col(b) * 10 for b in bands}


def add_noise(images: DataFrame, bands: list[str], seed: int) -> DataFrame:
    """Uniform noise up to a tenth of the range of all bands of the image. The noise follows a hash of the cell, so reruns
    of a lost task agree."""
    both = bands if len(bands) > 1 else bands * 2
    stats = images.groupBy("item", "t").agg(F.max(F.greatest(*both)).alias("_hi"), F.min(F.least(*both)).alias("_lo"))
    u = lambda b: F.pmod(F.xxhash64(F.lit(seed), F.lit(b), "item", "t", "r", "c"), F.lit(1 << 30)) / float(1 << 30)
    out = images.join(stats, ["item", "t"])
    return out.withColumns({b: F.col(b) + (F.col("_hi") - F.col("_lo")) / 10 * u(b) for b in bands}).select(*images.columns)


def augment(images: DataFrame, bands: list[str], kinds: list[int], height: int, width: int, seed: int = 0) -> DataFrame:
    """The images (aug_id 0) followed by their augmentations: 1 both axes flipped, 2 rows, 3 columns, 4 noise, 5 brightness.
    Flips are one projection over all kinds, so the images are read once; noise needs the images' ranges."""
    if set(kinds) - {1, 2, 3, 4, 5}:
        raise ValueError("augmentations are 1 to 5")
    plain = F.array(*[F.lit(k) for k in (0, *[k for k in kinds if k != 4])])
    out = images.withColumn("aug_id", F.explode(plain))
    flip = {"r": F.when(F.col("aug_id").isin(1, 2), height - 1 - F.col("r")).otherwise(F.col("r")), "c": F.when(F.col("aug_id").isin(1, 3), width - 1 - F.col("c")).otherwise(F.col("c"))}
    bright = {b: F.when(F.col("aug_id") == 5, v).otherwise(F.col(b)).cast("double") for b, v in change_bright(bands).items()}
    out = out.withColumns({**flip, **bright})
    if 4 not in kinds:
        return out
    return out.unionByName(add_noise(images.withColumns({b: F.col(b).cast("double") for b in bands}), bands, seed).withColumn("aug_id", F.lit(4)))


def training_set(cells: DataFrame, labels: DataFrame, bands: list[str], divisor: float, x_nodata: float = 0, y_nodata: float | None = None, weights: DataFrame | None = None, usage: str = "training", times: int = 0) -> DataFrame:
    """Cell samples ready for a model: features over time, normalised and flattened to a vector, with label and weight.
    Training and evaluation give features and labels, prediction features only. Cells with fewer than `times` times get zero images after their last. One shuffle
    gathers a cell's times; labels meet it on the same key."""
    if usage not in ("training", "evaluation", "prediction"):
        raise ValueError(f"no usage {usage}")
    rows = cells.groupBy("item", "r", "c").agg(F.sort_array(F.collect_list(F.struct("t", F.array(*bands).alias("v")))).alias("s"))
    rows = rows.select("item", "r", "c", F.transform("s", lambda x: x["v"]).alias("features"))
    if times:
        zeros = F.array(*[F.lit(0)] * len(bands))
        rows = rows.withColumn("features", F.concat("features", F.array_repeat(zeros, F.greatest(F.lit(times) - F.size("features"), F.lit(0)))))
    if usage == "prediction":
        out = rows
    else:
        out = drop_nodata_cells(pair_xy(rows, labels), x_nodata, y_nodata)
        if weights is not None:
            out = out.join(weights.withColumnRenamed("value", "label"), "label", "left").fillna(1.0, ["weight"])
    flat = F.transform(F.flatten("features"), lambda v: normalize(v.cast("double"), divisor))
    return out.withColumn("features", array_to_vector(flat))


def image_tensors(cells: DataFrame, bands: list[str], times: int, height: int, width: int, nodata: float = 0, factor: int = 1, padding: int = 0, kinds: tuple = (), divisor: float | None = None) -> DataFrame:
    """The features of image samples as cells (item, aug_id, t, r, c, bands): the images with least nodata, at most
    `times` of them and renumbered in time order, cut and filled with 0 to times x height x width, upsampled, padded,
    augmented and normalised. All images of an item are joined to it by its key; no item is gathered in one row."""
    keys = ["item", "t"]
    blank = image_quality(cells, keys, bands, F.lit(False), nodata).select(*keys, F.col("nodata").alias("_n"))
    kept = blank.withColumn("_k", F.row_number().over(Window.partitionBy("item").orderBy("_n", "t"))).where(F.col("_k") <= times)
    kept = kept.select(*keys, (F.row_number().over(Window.partitionBy("item").orderBy("t")) - 1).alias("_t"))
    x = cells.join(kept, keys).withColumn("t", F.col("_t"))
    x = limit_shape(x, times, height, width, bands)
    items = x.select("item").distinct().withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    x = fill_shape(items.join(x, keys, "left").withColumns({"r": F.coalesce("r", F.lit(0)), "c": F.coalesce("c", F.lit(0))}), keys, height, width, bands)
    x = upsample(x, factor) if factor > 1 else x
    x = pad(x, height * factor, width * factor, padding) if padding else x
    x = augment(x, bands, list(kinds), height * factor + 2 * padding, width * factor + 2 * padding)
    return x if divisor is None else x.withColumns({b: normalize(F.col(b).cast("double"), divisor) for b in bands})


def label_tensors(labels: DataFrame, height: int, width: int, kinds: tuple = (), classes: int = 0, one_hot_labels: bool = True, weights: DataFrame | None = None) -> DataFrame:
    """The labels of image samples as cells (item, aug_id, r, c, label, hot, weight): cut and filled with 0 to height x
    width, augmented like the features (noise and brightness leave labels as they are), one-hot and weighted."""
    y = fill_shape(labels.where((F.col("r") < height) & (F.col("c") < width)), ["item"], height, width, ["label"])
    y = y.withColumn("aug_id", F.explode(F.array(*[F.lit(k) for k in (0, *kinds)])))
    y = y.withColumns({"r": F.when(F.col("aug_id").isin(1, 2), height - 1 - F.col("r")).otherwise(F.col("r")), "c": F.when(F.col("aug_id").isin(1, 3), width - 1 - F.col("c")).otherwise(F.col("c"))})
    y = y.withColumn("hot", one_hot(F.col("label"), classes)) if classes > 1 and one_hot_labels else y
    return y if weights is None else sample_weights(y.withColumnRenamed("label", "value"), weights).withColumnRenamed("value", "label")


def item_batches(items: DataFrame, batch: int, seed: int) -> DataFrame:
    """items(item) shuffled by a hash and dealt to ceil(n / batch) batches: batch i has the items i, i + L, i + 2L, ..."""
    ranked = hash_ranked(items.select("item").distinct(), "item", seed)
    return ranked.select("item", ((F.col("_rank") - 1) % F.ceil(F.col("_all") / batch)).alias("batch"))


def class_map(y: Column, definition, y_max: float | None = None, y_nodata: float = 0.0) -> Column:
    """Labels as classes: equal parts of y_max by a number of classes, or by sorted breaks."""
    return multiclass_int(y, definition, y_max, y_nodata) if isinstance(definition, int) else multiclass_bins(y, definition, y_nodata)


def fit_weights(counts: DataFrame, nodata: int) -> DataFrame:
    """Class weights (value, weight) of a label catalogue's counts (value, n), nodata left out."""
    return class_weights(counts, nodata).select(F.col("value").cast("int").alias("value"), "weight")


def evaluate(predictions: DataFrame, names: list[str], nodata: float | None = None) -> DataFrame:
    """The named metrics over predictions(y_true, y_pred) of the held-out samples, in one pass."""
    return predictions.agg(*[metric(n, nodata).alias(n) for n in names])


def cap_rows(samples: DataFrame, most: int = MOST_ROWS, keys: tuple = ("item", "r", "c")) -> DataFrame:
    """At most so many samples, told apart by their keys."""
    return capped(samples, most, list(keys))


def fit_cells(samples: DataFrame, estimator: Estimator) -> Transformer:
    """A model of spark.ml fitted to training_set rows; their weights are used if the estimator takes any."""
    if "weight" in samples.columns and estimator.hasParam("weightCol"):
        estimator = estimator.copy({estimator.getParam("weightCol"): "weight"})
    return Pipeline(stages=[estimator]).fit(samples)


def predict(samples: DataFrame, model: Transformer) -> DataFrame:
    """Class of each cell."""
    return model.transform(samples).select("item", "r", "c", F.col("prediction").cast("int").alias("class"))


def predict_windows(cells: DataFrame, windows: DataFrame, model, schema: str, size: int) -> DataFrame:
    """model(window's cells as pandas) for each window(item, row, col); its rows follow schema. Cells are sent to the
    windows that hold them by an equi-join on blocks of size, so a group is one window."""
    block = lambda k: F.floor(F.col(k) / size)
    spans = lambda k: F.explode(F.sequence(block(k), F.floor((F.col(k) + size - 1) / size)))
    w = windows.withColumn("_br", spans("row")).withColumn("_bc", spans("col"))
    c = cells.withColumns({"_br": block("r"), "_bc": block("c")})
    near = c.join(w, ["item", "_br", "_bc"]).where("r >= row and r < row + {0} and c >= col and c < col + {0}".format(size)).drop("_br", "_bc")
    return near.groupBy("item", "row", "col").applyInPandas(model, schema)


def trim_windows(preds: DataFrame, size: int, border: int, height: int, width: int) -> DataFrame:
    """Predictions (row, col, r, c) without border cells of their window, except at the edges of the image."""

    def keep(cell: str, start: str, n: int) -> Column:
        at = F.col(cell) - F.col(start)
        return ((at >= border) | (F.col(start) == 0)) & ((at < size - border) | (F.col(start) + size >= n))

    return preds.where(keep("r", "row", height) & keep("c", "col", width))


def cross_entropy(label: Column, probs: Column, ignore: int | None = None) -> Column:
    """Mean cross-entropy of (class, probabilities), rows of one class left out; probabilities are rescaled to sum 1."""
    total = F.aggregate(probs, F.lit(0.0), lambda a, x: a + x)
    p = F.least(F.greatest(F.try_divide(F.get(probs, label), total), F.lit(1e-7)), F.lit(1 - 1e-7))
    return F.avg(F.when(F.lit(True) if ignore is None else label != ignore, -F.log(p)))


def cross_entropy_dropped(label: Column, probs: Column, dropped: list[int]) -> Column:
    """Mean cross-entropy after some classes' probabilities are taken out and the others rescaled; a row of such a class
    counts as 0."""
    kept = F.filter(probs, lambda _, i: ~i.isin(dropped))
    total = F.aggregate(kept, F.lit(0.0), lambda a, x: a + x)
    p = F.least(F.greatest(F.try_divide(F.get(probs, label), total), F.lit(1e-7)), F.lit(1 - 1e-7))
    return F.avg(F.when(label.isin(dropped), F.lit(0.0)).otherwise(-F.log(p)))
