"""Catalogue scenes as a Spark table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what is read of a catalogue item's properties.
PROPERTIES = "struct<platform:string,`eo:cloud_cover`:double,`proj:epsg`:int,gsd:double,created:string>"


def scene_columns(items: DataFrame) -> DataFrame:
    """Catalogue items(id, collection_id, datetime, properties, ...), properties being JSON text, as scenes: sensing_time,
    platform, cloud_cover and epsg are columns, null where a property is missing or the text is no JSON."""
    p = items.withColumn("_p", F.from_json(F.col("properties").cast("string"), PROPERTIES))
    named = {"platform": F.col("_p.platform"), "cloud_cover": F.col("_p.`eo:cloud_cover`"), "epsg": F.col("_p.`proj:epsg`")}
    return p.withColumnRenamed("datetime", "sensing_time").withColumns(named).drop("_p", "properties")


def read_scenes(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Scenes of a catalogue kept as Parquet or JSON lines; filters and unread columns reach the scan."""
    return scene_columns(spark.read.format(form).load(path))


def read_catalogue(spark: SparkSession, url: str, table: str, column: str, partitions: int = 8, **options) -> DataFrame:
    """Scenes of a database table, read over JDBC in ranges of a number, date or timestamp column, each by a query of its
    own. Filters and the choice of columns go to the database; the ranges' ends are asked of it first, which leaves a
    table without rows with one query. Rows whose column is null are read with the first range."""
    jdbc = lambda: spark.read.format("jdbc").option("url", url).options(**options)  # noqa: E731  options stay with a reader
    quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
    lo, hi = jdbc().option("query", f"select min({quoted}) as lo, max({quoted}) as hi from {table}").load().first()
    if lo is None:
        return jdbc().option("dbtable", table).load()
    return jdbc().option("dbtable", table).option("partitionColumn", column).option("lowerBound", str(lo)).option("upperBound", str(hi)).option("numPartitions", partitions).load()
