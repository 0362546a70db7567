"""Collection that writes and indexes, and a catalogue in a database."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from eocube.operators import collect, search
from eocube.sources import scenes as scene_source

DAY = dt.date(2024, 1, 1)


def steps(spark, items, n):
    rows = [(i, k, DAY + dt.timedelta(7 * k), DAY + dt.timedelta(7 * k + 6)) for i in items for k in range(n)]
    return spark.createDataFrame(rows, "item long, step_no int, step_start date, step_end date")


def scenes(spark, rows):
    """(scene, item, day, value)"""
    return spark.createDataFrame([(s, i, dt.datetime(2024, 1, 1) + dt.timedelta(d), float(d), v) for s, i, d, v in rows], "scene_id long, tile_id long, sensing_time timestamp, cloud_cover double, v int")


def cells_of(asked):
    grid = asked.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(1)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return grid.withColumn("a", F.when(F.col("v") == 0, 0).otherwise(F.col("v") + F.col("r") * 10 + F.col("c")))


def images(spark, path):
    return sorted((r.item, str(r.t), r.r, r.c, r.a) for r in spark.read.parquet(f"{path}/images").collect())


def index(df):
    return sorted((r.item, str(r.date), r.cells) for r in df.collect())


def times(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


FIRST = [(1, 1, 0, 100), (2, 1, 3, 200), (3, 2, 8, 300), (4, 2, 9, 0)]
MORE = [*FIRST, (5, 1, 8, 400), (6, 3, 1, 500), (7, 1, 2, 900)]


def test_collection_adds_only_missing_steps(spark, tmp_path):
    path, full = str(tmp_path / "one"), str(tmp_path / "full")
    got = collect.collect_into(path, steps(spark, (1, 2), 2), scenes(spark, FIRST), cells_of, ["a"])
    assert index(got) == [(1, "2024-01-01", 6), (2, "2024-01-08", 6)]
    assert {x[:2]: x[4] for x in images(spark, path) if x[2:4] == (0, 0)} == {(1, "2024-01-01"): 200, (2, "2024-01-08"): 300}
    before = times(f"{path}/images")
    got = collect.collect_into(path, steps(spark, (1, 2, 3), 2), scenes(spark, MORE), cells_of, ["a"])
    want = [(1, "2024-01-01", 6), (1, "2024-01-08", 6), (2, "2024-01-08", 6), (3, "2024-01-01", 6)]
    assert index(got) == want
    after = times(f"{path}/images")
    assert all(after[f] == t for f, t in before.items()) and len(after) > len(before)  # images that were there aren't touched
    assert {x[4] for x in images(spark, path) if x[:4] == (1, "2024-01-01", 0, 0)} == {200}  # nor is the later scene 7 taken
    assert index(collect.collect_into(full, steps(spark, (1, 2, 3), 2), scenes(spark, MORE), cells_of, ["a"])) == want
    again = collect.collect_into(path, steps(spark, (1, 2, 3), 2), scenes(spark, MORE), cells_of, ["a"])
    assert index(again) == want and times(f"{path}/images") == after
    renewed = collect.collect_into(path, steps(spark, (1,), 1), scenes(spark, [*MORE, (8, 1, 5, 700)]), cells_of, ["a"], overwrite=True)
    assert index(renewed) == want and {x[4] for x in images(spark, path) if x[:4] == (1, "2024-01-01", 0, 0)} == {700}


def test_collection_goes_on_after_a_kill(spark, tmp_path, monkeypatch):
    """Images are written, the index isn't: the next run makes them again."""
    path = str(tmp_path)
    real = collect.rasters.write_stack

    def killed(cells, at):
        real(cells, at)
        raise KeyboardInterrupt

    monkeypatch.setattr(collect.rasters, "write_stack", killed)
    with pytest.raises(KeyboardInterrupt):
        collect.collect_into(path, steps(spark, (1, 2), 2), scenes(spark, FIRST), cells_of, ["a"])
    monkeypatch.undo()
    assert images(spark, path) and index(collect.read_index(spark, path)) == []
    got = collect.collect_into(path, steps(spark, (1, 2), 2), scenes(spark, FIRST), cells_of, ["a"])
    assert index(got) == [(1, "2024-01-01", 6), (2, "2024-01-08", 6)] and len(images(spark, path)) == 12


def test_catalogue_over_jdbc(spark):
    url, options = "jdbc:derby:memory:catalogue;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = [(k, f"S2_{k // 2}", ("sentinel-s2-l2a", "sentinel-s2-l1c")[k % 2], ("sentinel-2a", "LANDSAT_8")[k % 3 == 0], dt.datetime(2024, 1, 1) + dt.timedelta(hours=k), float(k % 100), k % 10 * 1.0, 0.0, k % 10 + 1.0, 1.0) for k in range(500)]
    made = spark.createDataFrame(rows, "scene_id long, id string, collection_id string, platform string, sensing_time timestamp, cloud_cover double, xmin double, ymin double, xmax double, ymax double")
    made.write.format("jdbc").option("url", url).options(**options).option("dbtable", "scenes").option("createTableColumnTypes", "id varchar(64), collection_id varchar(64), platform varchar(64)").save()
    read = scene_source.read_catalogue(spark, url, "scenes", "scene_id", 4, **options)
    assert read.rdd.getNumPartitions() == 4 and read.count() == 500
    asked = lambda df: search.search(df, "SENTINEL_2", "L2A", "2024-01-03", "2024-01-20", 60, (2, 0, 5, 1), sort=None)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")  # else the plan's text is cut
    plan = asked(read)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :].split("ReadSchema")[0].lower()
    assert all(k in pushed for k in ("platform", "collection_id", "sensing_time", "cloud_cover", "xmin", "ymax"))
    key = lambda df: sorted(r.scene_id for r in df.collect())
    assert key(asked(read)) == key(asked(made)) != []
    by_time = scene_source.read_catalogue(spark, url, "scenes", "sensing_time", 3, **options)
    assert by_time.rdd.getNumPartitions() == 3 and by_time.count() == 500
    made.where("false").write.format("jdbc").option("url", url).options(**options).option("dbtable", "nothing").save()
    assert scene_source.read_catalogue(spark, url, "nothing", "scene_id", 4, **options).count() == 0
