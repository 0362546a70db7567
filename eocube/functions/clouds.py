"""Sentinel-2 clouds, shadow and snow from seven bands, and the best observation of a cell over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

S2_BANDS = ["b02", "b03", "b04", "b08", "b8a", "b11", "b12"]
# Reflectance of full brightness; weights of haze and brightness by band.
FULL = 10000
HAZE = {"b02": -0.8239, "b03": 0.0849, "b04": 0.4396, "b8a": -0.058, "b11": 0.2013, "b12": -0.2773}
BRIGHT = {"b02": 0.3029, "b03": 0.2786, "b04": 0.4733, "b8a": 0.5599, "b11": 0.508, "b12": 0.1872}


def _is(condition: Column) -> Column:
    """A comparison with an undefined value is false, also below a negation."""
    return F.coalesce(condition, F.lit(False))


def _ratio(n: Column, d: Column) -> Column:
    """n / d; infinite for x / 0 and undefined for 0 / 0."""
    return F.when(d != 0, F.try_divide(n, d)).when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf")))


def _weighted(b: dict[str, Column], weights: dict[str, float]) -> Column:
    first, *rest = [F.lit(w) * b[k] for k, w in weights.items()]
    for term in rest:
        first = first + term
    return first


def s2_features(bands: dict[str, str] | None = None) -> dict[str, Column]:
    """Named measures of one observation, each a column of its own to be projected before the flags use it."""
    names = bands or {k: k for k in S2_BANDS}
    b = {k: F.least(F.greatest(F.col(v).cast("double"), F.lit(0.0)), F.lit(float(FULL))) / FULL for k, v in names.items()}
    return {
        "_green_swir": _ratio(b["b03"], b["b11"]),
        "_swir_green": _ratio(b["b11"], b["b03"]),
        "_rgb": (b["b02"] + b["b03"] + b["b04"]) / 3,
        "_haze": _weighted(b, HAZE),
        "_nir_swir": _ratio(b["b08"] - b["b11"], b["b08"] + b["b11"]),
        "_tcb": _weighted(b, BRIGHT),
        "_ndwi": _ratio(b["b03"] - b["b11"], b["b03"] + b["b11"]),
        "_ndvi": _ratio(b["b08"] - b["b04"], b["b08"] + b["b04"]),
        "_sum": b["b02"] + b["b03"] + b["b04"] + b["b08"],
        "_empty": b["b02"] == 0,
    }


def _dense() -> Column:
    rgb, haze, near = F.col("_rgb"), F.col("_haze"), F.col("_nir_swir")
    white = _is(F.col("_green_swir") > 1)
    dark = white & (rgb < 0.3)
    return (
        (white & (rgb > 0.3) & ((haze < -0.1) | ((haze > -0.08) & _is(near < 0.4))))
        | (haze < -0.2)
        | (dark & (haze < -0.055) & (rgb > 0.12))
        | (~dark & (haze < -0.09) & (rgb > 0.12))
    )


def _light() -> Column:
    rgb, haze, near = F.col("_rgb"), F.col("_haze"), F.col("_nir_swir")
    dark = _is(F.col("_green_swir") > 1) & (rgb < 0.2)
    return (
        (_is(F.col("_swir_green") > 1) & (rgb < 0.2) & ((haze < -0.1) | ((haze < -0.08) & _is(near < 0.4))))
        | (haze < -0.2)
        | (dark & (haze < -0.055) & (rgb > 0.12))
        | (~dark & (haze < -0.02) & (rgb > 0.12))
    )


def _snow() -> Column:
    return _is(F.col("_ndwi") > 0.7) & ~(_is(F.col("_green_swir") > 1) & (F.col("_tcb") < 0.36))


def with_s2_flags(cells: DataFrame, light: bool = False, snow: bool = True, shadow: float = 0.2, bands: dict[str, str] | None = None) -> DataFrame:
    """cells with _dense, _snow and cloud (any of cloud, no data, shadow, snow), and the measures. Bands may not be null."""
    out = cells.withColumns(s2_features(bands)).withColumns({"_dense": _dense(), "_snow": _snow()})
    cloud = F.col("_dense") | F.col("_empty")
    if shadow > 0:
        cloud = cloud | (F.col("_sum") < shadow)
    if snow:
        cloud = cloud | F.col("_snow")
    if light:
        cloud = cloud | _light()
    return out.withColumn("cloud", cloud)


def s2_cloud(cells: DataFrame, **options) -> DataFrame:
    """cells with the column cloud."""
    return with_s2_flags(cells, **options).select(*cells.columns, "cloud")


def best_observation(cells: DataFrame, keys: list[str], t: str, **options) -> DataFrame:
    """The time index t of each cell's best observation, by eight ordered criteria over the unmasked ones. One partially
    aggregated pass; ties go to the earliest, and a cell masked throughout falls back to its first observation."""
    free = ~F.col("cloud")
    at = lambda v, sign: F.min_by(F.col(t), F.when(free & F.col(v).isNotNull(), F.struct(F.col(v) * sign, F.col(t))))
    mean = lambda v: F.avg(F.when(free, F.col(v)))
    seen = F.struct(F.col(t).alias("t"), F.col("_dense"), F.col("_snow"), F.when(free, F.col("_tcb")).alias("tcb"))
    g = with_s2_flags(cells, **{"shadow": 0.5, **options}).groupBy(*keys).agg(
        F.min(t).alias("first"), F.min_by(seen, F.col(t)).alias("seen0"), F.min_by(seen, F.when(free, F.struct("_tcb", t))).alias("seen"),
        at("_ndwi", -1).alias("ndwi_max"), at("_ndvi", 1).alias("ndvi_min"), at("_ndvi", -1).alias("ndvi_max"),
        mean("_ndwi").alias("ndwi_mean"), mean("_ndvi").alias("ndvi_mean"), mean("_tcb").alias("tcb_mean"),
        F.min(F.when(free, F.col("_ndwi"))).alias("ndwi_low"), F.max(F.when(free, F.col("_ndvi"))).alias("ndvi_high"),
    )
    g = g.withColumns({"dark": F.coalesce("seen", "seen0"), **{k: F.coalesce(k, "first") for k in ("ndwi_max", "ndvi_min", "ndvi_max")}})
    pick = (
        F.when(F.expr("ndwi_mean < -0.55D and ndvi_high - ndvi_mean < 0.05D"), F.col("ndvi_max"))
        .when(F.expr("ndvi_mean < -0.3D and ndwi_mean - ndwi_low < 0.05D"), F.col("ndwi_max"))
        .when(F.expr("ndvi_mean > 0.6D and tcb_mean < 0.45D"), F.col("ndvi_max"))
        .when(~F.col("dark._dense"), F.col("dark.t"))
        .when(~F.col("dark._snow") & (F.col("dark.tcb") < 1), F.col("dark.t"))
        .when(F.col("ndvi_mean") < -0.2, F.col("ndwi_max"))
        .when(F.col("tcb_mean") > 0.45, F.col("ndvi_min"))
        .otherwise(F.col("ndvi_max"))
    )
    return g.select(*keys, pick.alias(t))
