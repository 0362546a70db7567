"""Links to images: recognising and rewriting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two stores' names, the archive's links, and each band's resolution in metres.
COG_BUCKET, JP2_BUCKET = "sentinel-cogs", "sentinel-s2-l2a"
ARCHIVE = (
    "https://storage.googleapis.com/gcp-public-data-sentinel-2/L2/tiles/%s/%s/%s/%s.SAFE/GRANULE/L2A_T%s_A%s_%s/"
    "IMG_DATA/R%sm/L2A_T%s_%s_%s_%sm.jp2"
)
RESOLUTION = {"B01": 60, "B02": 10, "B03": 10, "B04": 10, "B05": 20, "B06": 20, "B07": 20, "B08": 10, "B8A": 20, "B09": 60, "B10": 60, "B11": 20, "B12": 20, "SCL": 20}


def is_cog_url(url: Column) -> Column:
    return F.contains(url, F.lit(COG_BUCKET))


def is_jp2_url(url: Column) -> Column:
    return F.contains(url, F.lit(JP2_BUCKET)) & ~is_cog_url(url)


def cog_to_jp2(url: Column) -> Column:
    """Zone, band, square, year and month come from the folders, day and scene number from the product's id."""
    parts = F.split(url, "/")
    product = F.split(F.element_at(parts, -2), "_")
    band = F.split(F.element_at(parts, -1), r"\.")[0]
    table = F.create_map(*[F.lit(x) for k, v in RESOLUTION.items() for x in (k, f"R{v}m")])
    place = F.concat_ws("/", *[F.element_at(parts, i) for i in (-7, -6, -5, -4)], F.element_at(parts, -3).cast("int").cast("string"))
    return F.concat_ws("/", F.lit(f"s3://{JP2_BUCKET}/tiles"), place, F.substring(product[2], 7, 2).cast("int").cast("string"), product[3], table[band], F.concat(band, F.lit(".jp2")))


def parse_path(path: Column) -> Column:
    """scheme, archive and inner path of scheme://archive!/inner."""
    rest = F.regexp_replace(path, "^[a-z0-9]+://", "")
    inner = F.split(rest, "!")
    return F.struct(F.regexp_extract(path, "^([a-z0-9]+)://", 1).alias("scheme"), F.when(F.size(inner) > 1, inner[0]).otherwise("").alias("archive"), F.regexp_replace(F.element_at(inner, -1), "^/", "").alias("inner"))


def classify_source(path: Column) -> Column:
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.when(ext.isin("gpkg", "geojson"), "vector").when((ext == "zip") | path.endswith("/"), "raster").otherwise(F.raise_error(F.concat(F.lit("unknown source "), path)))


def item_id_from_path(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.tif", "")


def id_number(item: Column) -> Column:
    return F.get(F.filter(F.split(item, "_"), lambda x: x.rlike("^[0-9]+$")), F.lit(0)).cast("int")


def jp2_to_archive(urls: DataFrame, url: str, products: DataFrame) -> DataFrame:
    """urls with archive, the link in the public archive. products(path, name, datatake, zone, band, square, datastrip)
    is one row per tile folder; links without one get null."""
    u = urls.withColumn("_path", F.regexp_extract(url, r"(tiles/.*?)/R\d+m/", 1))
    p = products.withColumnsRenamed({c: f"_p_{c}" for c in products.columns})
    tile = F.concat(F.lpad(F.col("_p_zone").cast("string"), 2, "0"), F.col("_p_band"), F.col("_p_square"))
    res, band = F.regexp_extract(url, r"/R(\d+)m/", 1), F.regexp_extract(url, r"/([^/]+)\.jp2$", 1)
    taken, sensed = F.split("_p_datatake", "_")[2], F.substring(F.split("_p_datastrip", "_")[8], 2, 15)
    link = F.format_string(
        ARCHIVE, F.lpad(F.col("_p_zone").cast("string"), 2, "0"), F.col("_p_band"), F.col("_p_square"), F.col("_p_name"), tile, taken, sensed, res, tile, F.split("_p_name", "_")[2], band, res
    )
    out = u.join(p, F.col("_path") == F.col("_p_path"), "left").withColumn("archive", F.when(F.col("_p_path").isNotNull(), link))
    return out.select(*urls.columns, "archive")


def resolve_source(urls: DataFrame, url: str, available: DataFrame, products: DataFrame) -> DataFrame:
    """urls with source: the link itself if it is in available(url), else its copy in the second store, else the
    archive's; null where none is known."""
    have = lambda name: available.select(F.col("url").alias(name)).distinct()
    u = urls.withColumn("_jp2", F.when(is_cog_url(F.col(url)), cog_to_jp2(F.col(url))).otherwise(F.col(url)))
    u = jp2_to_archive(u, "_jp2", products)
    u = u.join(have("_first"), F.col(url) == F.col("_first"), "left").join(have("_second"), F.col("_jp2") == F.col("_second"), "left")
    return u.withColumn("source", F.coalesce("_first", "_second", "archive")).select(*urls.columns, "source")


def absolute_paths(paths: Column, root: str) -> Column:
    return F.transform(paths, lambda p: F.concat(F.lit(root.rstrip("/") + "/"), p))


def rewrite_paths(paths: Column, remote: str, local: str) -> Column:
    """Paths below the remote root as paths below the local one, without the marks of archives."""
    return F.transform(paths, lambda p: F.replace(F.replace(F.regexp_replace(p, "^zip://", ""), F.lit("!"), F.lit("")), F.lit(remote), F.lit(local)))
