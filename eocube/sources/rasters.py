"""Raster chunks, images, documents and feature files as Spark tables.

Chunks are rows (item, t, band, chunk_row, chunk_col, h, w, data) with data in row order; cells are (item, t, r, c)
and one column per band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Nodata of a sink, by whether its type is integer.
INT_NODATA, FLOAT_NODATA = 255, -9999
INTEGERS = {"byte", "short", "int", "bigint"}


def list_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """Paths below root that end in suffix, at any depth; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(root).select("path")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON files: file, position, epsg, properties (JSON text) and the geometry's rings, a multipolygon's
    joined. Without a crs the file is in EPSG 4326."""
    feature = "struct<properties:string,geometry:struct<type:string,coordinates:string>>"
    schema = f"type string, crs struct<properties:struct<name:string>>, features array<{feature}>"
    docs = spark.read.schema(schema).json(path, multiLine=True).withColumn("file", F.input_file_name())
    epsg = F.coalesce(F.nullif(F.regexp_extract("crs.properties.name", r"(\d+)$", 1), F.lit("")).cast("int"), F.lit(4326))
    f = docs.select("file", epsg.alias("epsg"), F.posexplode("features").alias("position", "_f"))
    one = F.from_json("_f.geometry.coordinates", "array<array<array<double>>>")
    many = F.flatten(F.from_json("_f.geometry.coordinates", "array<array<array<array<double>>>>"))
    rings = F.when(F.col("_f.geometry.type") == "MultiPolygon", many).otherwise(one)
    points = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return f.select("file", "position", "epsg", F.col("_f.properties").alias("properties"), points.alias("rings"))


def zip_chunks(chunks: DataFrame, bands: list[str]) -> DataFrame:
    """Chunk rows of one band each as rows (item, t, chunk_row, chunk_col, h, w) with one array per band, null where a
    chunk lacks the band. The band filter reaches the scan, and what is shuffled is chunks, not cells."""
    keys = ["item", "t", "chunk_row", "chunk_col"]
    kept = chunks.where(F.col("band").isin(bands))
    return kept.groupBy(*keys).agg(F.max("h").alias("h"), F.max("w").alias("w"), *[F.any_value(F.when(F.col("band") == b, F.col("data")), ignoreNulls=True).alias(b) for b in bands])


def explode_zipped(zipped: DataFrame, size: int, bands: list[str]) -> DataFrame:
    """Cells of zip_chunks() rows, all bands of a cell at once and without a shuffle; other columns stay."""
    full = {b: F.coalesce(F.col(b), F.array_repeat(F.lit(None).cast(zipped.schema[b].dataType.elementType), F.col("h") * F.col("w"))) for b in bands}
    rest = [c for c in zipped.columns if c not in (*bands, "h", "w", "chunk_row", "chunk_col")]
    kept = zipped.withColumns(full).select(*rest, "chunk_row", "chunk_col", "w", F.posexplode(F.arrays_zip(*bands)).alias("_p", "_v"))
    r, c = F.col("chunk_row") * size + F.floor(F.col("_p") / F.col("w")), F.col("chunk_col") * size + F.col("_p") % F.col("w")
    return kept.select(*rest, r.cast("int").alias("r"), c.cast("int").alias("c"), "_v.*")


def explode_chunks(chunks: DataFrame, size: int, bands: list[str]) -> DataFrame:
    """Cells of the chosen bands."""
    return explode_zipped(zip_chunks(chunks, bands), size, bands)


def explode_windows(zipped: DataFrame, windows: DataFrame, size: int, bands: list[str]) -> DataFrame:
    """Cells of zip_chunks() rows inside of windows(item, row0, row1, col0, col1, ...), ends included, with the windows'
    other columns. Windows meet the chunks that they touch on the chunk's place, so only these are exploded; where
    chunks are stored by chunk_row, others aren't even read."""
    cover = lambda k: F.explode(F.sequence(F.floor(F.col(f"{k}0") / size).cast("int"), F.floor(F.col(f"{k}1") / size).cast("int")))
    touched = windows.where("row0 <= row1 and col0 <= col1").withColumn("chunk_row", cover("row")).withColumn("chunk_col", cover("col"))
    cells = explode_zipped(zipped.select("item", "t", "chunk_row", "chunk_col", "h", "w", *bands).join(touched, ["item", "chunk_row", "chunk_col"]), size, bands)
    return cells.where("r between row0 and row1 and c between col0 and col1").drop("row0", "row1", "col0", "col1")


def chunk_stats(zipped: DataFrame, bands: list[str], nodata: float = 0, cloudy=None) -> DataFrame:
    """Zone maps: for each chunk and band a struct (least, most, nodata, valid), and clouds, how many values of the first
    array the condition cloudy(value) holds for. Made from the arrays in place, without a shuffle; nulls count as
    nodata. A chunk without the band has 0 valid values."""
    blank = lambda v: v.isNull() | (v == nodata)

    def of(b: str) -> Column:
        values = F.filter(b, lambda v: ~blank(v))
        return F.struct(F.array_min(values).alias("least"), F.array_max(values).alias("most"), (F.col("h") * F.col("w") - F.coalesce(F.size(values), F.lit(0))).alias("nodata"), F.coalesce(F.size(values), F.lit(0)).alias("valid")).alias(b)

    keys = [c for c in zipped.columns if c not in (*bands, "h", "w")]
    clouds = [] if cloudy is None else [F.size(F.filter(bands[0], cloudy)).alias("clouds")]
    return zipped.select(*keys, *[of(b) for b in bands], *clouds)


def image_stats(stats: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """chunk_stats() added up to whole images, partially before the shuffle."""
    of = lambda b: F.struct(F.min(f"{b}.least").alias("least"), F.max(f"{b}.most").alias("most"), F.sum(f"{b}.nodata").alias("nodata"), F.sum(f"{b}.valid").alias("valid")).alias(b)
    return stats.groupBy(*keys).agg(*[of(b) for b in bands], *([F.sum("clouds").alias("clouds")] if "clouds" in stats.columns else []))


def write_chunks(zipped: DataFrame, path: str, bands: list[str], nodata: float = 0) -> None:
    """Chunks below path/chunks, in folders by chunk_row, with their zone maps in path/stats. Rows are dealt out by ranges
    of their place first, so a folder gets a few files from a few tasks."""
    zipped.repartitionByRange("chunk_row", "item", "t").write.mode("overwrite").partitionBy("chunk_row").parquet(f"{path}/chunks")
    written = zipped.sparkSession.read.parquet(f"{path}/chunks")
    chunk_stats(written.select(zipped.columns), bands, nodata).write.mode("overwrite").parquet(f"{path}/stats")


def assemble_chunks(cells: DataFrame, size: int, bands: list[str], nodata: int = 0) -> DataFrame:
    """Chunks of size x size cells; cells missing within a chunk's extent get nodata. A group is one chunk."""
    rows = cells.select("item", "t", "r", "c", F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).alias("v")) for b in bands])).alias("_b"))
    rows = rows.select("item", "t", "_b.band", F.floor(F.col("r") / size).cast("int").alias("chunk_row"), F.floor(F.col("c") / size).cast("int").alias("chunk_col"), (F.col("r") % size).alias("y"), (F.col("c") % size).alias("x"), "_b.v")
    g = rows.groupBy("item", "t", "band", "chunk_row", "chunk_col").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"), F.map_from_entries(F.collect_list(F.struct(F.struct("y", "x"), "v"))).alias("_m"))
    at = lambda p: F.struct(F.floor(p / F.col("w")).cast("int").alias("y"), (p % F.col("w")).cast("int").alias("x"))
    data = F.transform(F.sequence(F.lit(0), F.col("h") * F.col("w") - 1), lambda p: F.coalesce(F.try_element_at("_m", at(p)), F.lit(nodata)))
    return g.withColumn("data", data).drop("_m")


def raster_meta(cells: DataFrame) -> DataFrame:
    return cells.groupBy("item", "t").agg((F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"))


def assert_square(meta: DataFrame) -> DataFrame:
    """meta(scale_x, scale_y, ...), an error for a raster whose cells aren't square."""
    bad = F.abs("scale_x") != F.abs("scale_y")
    return meta.withColumn("scale_x", F.when(bad, F.raise_error(F.lit("cells are not square")).cast("double")).otherwise(F.col("scale_x")))


def footprint(x0: Column, y0: Column, scale_x: Column, scale_y: Column, width: Column, height: Column) -> Column:
    """Box of a raster from its geotransform; scale_y is negative where rows count downwards."""
    x1, y1 = x0 + width * scale_x, y0 + height * scale_y
    return F.struct(F.least(x0, x1).alias("xmin"), F.least(y0, y1).alias("ymin"), F.greatest(x0, x1).alias("xmax"), F.greatest(y0, y1).alias("ymax"))


def cast_for_sink(df: DataFrame, band: str, dtype: str) -> DataFrame:
    """The band as dtype, its nulls as that type's nodata."""
    return df.withColumn(band, F.coalesce(F.col(band).cast(dtype), F.lit(INT_NODATA if dtype in INTEGERS else FLOAT_NODATA).cast(dtype)))


def write_stack(cells: DataFrame, path: str, rows: int = 4096) -> None:
    """Images by item and date. A date that is written again replaces only itself. Cells are dealt out by image first, and
    by strips of `rows` rows, so an image is one file or, if it is large, a file for each strip."""
    dealt = cells.repartition("item", "t", F.floor(F.col("r") / rows))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("item", "t").parquet(path)


def write_items(items: DataFrame, path: str, form: str = "json") -> None:
    items.write.mode("overwrite").format(form).save(path)


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one a file, with a given schema."""
    return spark.read.schema(schema).json(path, multiLine=True)


def catalog_from_items(items: DataFrame, catalog_id: str) -> DataFrame:
    """One row per catalogue with its size and extent; none without items."""
    out = items.groupBy(F.lit(catalog_id).alias("catalog_id")).agg(
        F.count("*").alias("items"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")
    )
    return out.where("items > 0")
