import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eocube.functions import cells as fc
from eocube.functions import dates, links, lookups
from eocube.operators import collect, mosaic, samples, search, stats, training
from eocube.plans import queries
from eocube.sources import rasters, scenes

DAY = dt.date


def test_time_steps(spark):
    items = spark.sql("select date'2021-01-01' as start, date'2021-02-01' as `end`")
    got = dates.time_steps(items, "weeks", 2).orderBy("step_no").collect()
    assert [(r.step_start, r.step_end) for r in got] == [(DAY(2021, 1, 1), DAY(2021, 1, 14)), (DAY(2021, 1, 15), DAY(2021, 1, 28))]
    drift = dates.time_steps(spark.sql("select date'2021-01-31' as start, date'2021-05-01' as `end`"), "months", 1).orderBy("step_no").collect()
    assert [r.step_start for r in drift] == [DAY(2021, 1, 31), DAY(2021, 2, 28), DAY(2021, 3, 28)]


def test_time_steps_of_a_long_range(spark):
    got = dates.time_steps(spark.sql("select date'1972-07-23' as start, date'2026-01-01' as `end`"), "days", 1)
    assert got.count() == 19521 and got.agg(F.max("step_end")).first()[0] == DAY(2026, 1, 1)
    assert dates.time_steps(spark.sql("select date'2021-02-01' as start, date'2021-01-01' as `end`"), "weeks", 1).count() == 0


def _catalogue(spark):
    rows = [(i, f"S{i // 2}", c, p, dt.datetime(2024, 1, 1 + i), cc, 0.0, 0.0, 1.0, 1.0) for i, (c, p, cc) in enumerate([
        ("sentinel-s2-l2a", "sentinel-2a", 5.0), ("sentinel-s2-l2a-cogs", "sentinel-2a", 5.0), ("sentinel-s2-l1c", "sentinel-2b", 9.0), ("sentinel-s2-l1c", "sentinel-2b", None),
        ("landsat-c2l2-sr", "LANDSAT_8", 30.0), ("landsat-c2l2-sr", "LANDSAT_5", 2.0), ("landsat-c2l2-sr", None, 2.0),
    ])]
    return spark.createDataFrame(rows, "scene_id long, id string, collection_id string, platform string, sensing_time timestamp, cloud_cover double, xmin double, ymin double, xmax double, ymax double")


def test_searches(spark):
    ids = lambda *a, **k: [r.scene_id for r in search.search(_catalogue(spark), *a, **k).collect()]
    assert ids("SENTINEL_2", "L2A") == [1] and ids("SENTINEL_2", "L1C") == [3, 2] and ids("SENTINEL_2", sort="cloud_cover") == [2, 3]
    assert ids(["LANDSAT_8", "LANDSAT_5"], sort="cloud_cover") == [5, 4] and ids("LANDSAT_8", most_cloud=20) == [] and ids(["LANDSAT_8", "SENTINEL_2"], "L2A", limit=1) == [4]
    for bad in (lambda: ids("SPOT_5"), lambda: ids("SENTINEL_2", sort="id"), lambda: ids([])):
        with pytest.raises(ValueError):
            bad()


def test_read_scenes(spark, tmp_path):
    spark.createDataFrame([("a", "c", dt.datetime(2024, 1, 1), '{"platform": "sentinel-2a", "eo:cloud_cover": 3.5, "proj:epsg": 32633}'), ("b", "c", None, "no json"), ("d", "c", None, None)], "id string, collection_id string, datetime timestamp, properties string").write.parquet(str(tmp_path / "s"))
    got = {r.id: r for r in scenes.read_scenes(spark, str(tmp_path / "s")).collect()}
    assert (got["a"].platform, got["a"].cloud_cover, got["a"].epsg) == ("sentinel-2a", 3.5, 32633) and got["b"].platform is None and got["d"].epsg is None


def test_items_and_documents_are_written_and_read(spark, tmp_path):
    items = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "item long, box array<double>")
    for form in ("json", "parquet"):
        rasters.write_items(items, str(tmp_path / form), form)
        back = spark.read.schema(items.schema).format(form).load(str(tmp_path / form))
        assert sorted((r.item, r.box) for r in back.collect()) == [(1, [1.0, 2.0]), (2, None)]
    (tmp_path / "docs").mkdir()
    for i in range(3):
        (tmp_path / "docs" / f"{i}.json").write_text('{\n "id": "x%d",\n "extent": {"n": %d}\n}' % (i, i))
    got = rasters.read_documents(spark, str(tmp_path / "docs"), "id string, extent struct<n:int>").orderBy("id").collect()
    assert [(r.id, r.extent.n) for r in got] == [("x0", 0), ("x1", 1), ("x2", 2)]


def test_usages(spark):
    x = spark.createDataFrame([(1, 0, 0, 0, 5)], "item int, t int, r int, c int, b02 int")
    y = x.select("item", "r", "c", F.lit(1).alias("label"))
    assert "label" in training.training_set(x, y, ["b02"], 10.0, usage="evaluation").columns and "label" not in training.training_set(x, y, ["b02"], 10.0, usage="prediction").columns
    with pytest.raises(ValueError):
        training.training_set(x, y, ["b02"], 10.0, usage="test")


def test_overview_factors():
    assert stats.overview_factors(50, 80) == [2, 4, 8, 16, 32] and stats.overview_factors(2, 100) == [] and stats.overview_factors(500, 500)[-1] == 64


def test_stack_passes_over_empty_scenes(spark):
    t = dt.datetime(2024, 1, 5)
    matched = spark.createDataFrame([(1, 0, i, t - dt.timedelta(days=i), float(i)) for i in range(3)], "tile_id long, step_no int, scene_id long, sensing_time timestamp, cloud_cover double")
    values = spark.createDataFrame([(0, 0, 7, 0), (0, 1, 8, 0), (1, 0, 0, 3), (1, 1, 2, 4), (2, 0, 5, 6), (2, 1, 0, 6)], "scene_id long, c int, b0 int, b1 int").withColumn("r", F.lit(0))
    of = lambda s: s.join(values, "scene_id")  # noqa: E731  scene 0 has an empty band
    got = {(x.r, x.c): (x.b0, x.b1) for x in collect.pixel_stack(matched, of, ["b0", "b1"]).collect()}
    assert got == {(0, 0): (5, 6), (0, 1): (2, 4)}
    assert {(x.scene_id, x.c, x.b0) for x in collect.pixel_stack(matched, of, ["b0", "b1"], "all").collect()} == {(1, 0, 0), (1, 1, 2), (2, 0, 5), (2, 1, 0)}


def test_sieve_leaves_tiny_masks(spark):
    df = spark.createDataFrame([(1, 0, 0, 1), (1, 0, 1, 0), (1, 0, 2, 1)], "item int, r int, c int, m int")
    assert sorted((x.c, x.m) for x in mosaic.sieve(df).collect()) == [(0, 1), (1, 0), (2, 1)]


def test_default_start(spark):
    assert spark.sql("select date'2022-01-31' as d").select(dates.default_start(F.col("d"))).first()[0] == DAY(2021, 12, 31)
    assert spark.sql("select cast(null as date) as d").select(dates.default_start(F.col("d"))).first()[0] == DAY(1972, 7, 23)


@pytest.mark.parametrize(
    ("url", "end"),
    [
        ("x/29/S/ND/2021/12/S2B_29SND_20211215_0_L2A/B06.tif", "29/S/ND/2021/12/15/0/R20m/B06.jp2"),
        ("x/31/N/HA/2019/10/S2B_31NHA_20191007_0_L2A/B11.tif", "31/N/HA/2019/10/7/0/R20m/B11.jp2"),
    ],
)
def test_cog_to_jp2(spark, url, end):
    assert spark.createDataFrame([(url,)], "u string").select(links.cog_to_jp2(F.col("u"))).first()[0] == f"s3://sentinel-s2-l2a/tiles/{end}"


def test_cell_counts(spark):
    d = spark.createDataFrame([(250.00001,), (150.000001,), (250.01,), (150.01,)], "d double")
    assert [r[0] for r in d.select(fc.n_cells(F.col("d"), 10)).collect()] == [25, 15, 26, 16]


def _cells(spark, seed):
    rnd = random.Random(seed)
    rows = [(1, 0, r, c, i, rnd.choice([0, 0, 5, 6, 7]), rnd.randrange(9), rnd.random() < 0.6) for r in range(3) for c in range(3) for i in range(1, 6)]
    return rows, spark.createDataFrame(rows, "tile_id long, step_no int, r int, c int, idx int, b0 int, b1 int, cloud boolean")


@pytest.mark.parametrize("seed", range(3))
def test_mosaics_equal_the_loops(spark, seed):
    rows, df = _cells(spark, seed)
    want = {}
    for _, _, r, c, _, b0, b1, _ in rows:  # in the order of idx within a cell
        if want.get((r, c), (0,))[0] == 0:
            want[r, c] = (b0, b1)
    assert {(x.r, x.c): (x.b0, x.b1) for x in mosaic.first_valid(df, ["b0", "b1"]).collect()} == want
    pick, mask = {}, {(r, c): True for r in range(3) for c in range(3)}
    for i in range(1, 6):
        for _, _, r, c, k, b0, b1, cloud in rows:
            if k == i:
                if i == 1 or mask[r, c] and b0 != 0:
                    pick[r, c] = (b0, b1)
                mask[r, c] = mask[r, c] and cloud
        if not any(p[0] == 0 for p in pick.values()) and sum(mask.values()) / 9 <= 0.05:
            break
    assert {(x.r, x.c): (x.b0, x.b1) for x in mosaic.composite(df, ["b0", "b1"], F.col("cloud")).collect()} == pick


@pytest.mark.parametrize("seed", range(2))
def test_sieve_equals_the_flood_fill(spark, seed):
    rnd = random.Random(seed)
    m = {(r, c): int(rnd.random() < 0.5) for r in range(12) for c in range(9)}
    want, seen = dict(m), set()
    for start in m:
        if start not in seen:
            group, todo = {start}, [start]
            while todo:
                r, c = todo.pop()
                for x in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                    if x not in group and m.get(x) == m[start]:
                        group.add(x)
                        todo.append(x)
            seen |= group
            if len(group) < 3:
                want.update({x: 1 - m[x] for x in group})
    df = spark.createDataFrame([(1, r, c, x) for (r, c), x in m.items()], "item int, r int, c int, m int")
    assert {(x.r, x.c): x.m for x in mosaic.sieve(df).collect()} == want


def test_sieve(spark):
    grid = ["1100", "0000", "0111", "0001"]
    df = spark.createDataFrame([(1, r, c, int(x)) for r, row in enumerate(grid) for c, x in enumerate(row)], "item int, r int, c int, m int")
    got = {(x.r, x.c): x.m for x in mosaic.sieve(df).collect()}
    assert [got[0, 0], got[0, 1], got[2, 1], got[3, 3]] == [0, 0, 1, 1]


def test_class_weights_and_merge(spark):
    counts = spark.createDataFrame([(0, 9), (1, 4), (2, 4)], "value int, n long")
    assert [r.weight for r in stats.class_weights(counts, 0).collect()] == [1.0, 1.0]
    with pytest.raises(ValueError):
        stats.merge_rasters(counts, "median", 0)


def test_unknown_names():
    for f in (lambda: lookups.spectral_index("none"), lambda: fc.calculate("none"), lambda: samples.metric("none")):
        with pytest.raises(ValueError):
            f()


def test_split_is_disjoint_and_complete(spark):
    got = samples.split_samples(spark.range(101), "id", 0.7, 3).groupBy("training").count().collect()
    assert {r.training: r["count"] for r in got} == {True: 71, False: 30}


def test_entry_imports():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_items_with_missing_times_are_predicted(spark, monkeypatch):
    rows = [(i, t, 0, c, 100 * c + t + 1, 200 * c + t + 1) for i, times in ((1, 4), (2, 4), (3, 2)) for t in range(times) for c in range(4)]
    x = spark.createDataFrame(rows, "item int, t int, r int, c int, b02 int, b04 int")
    y = x.where("t = 0").select("item", "r", "c", (F.col("c") % 2).alias("label"))
    got = training.training_set(x, y, ["b02", "b04"], 1000.0, usage="prediction", times=4).where("item = 3 and c = 1").first()
    assert got.features.toArray().tolist() == [0.101, 0.201, 0.102, 0.202, 0, 0, 0, 0]
    monkeypatch.setattr(queries, "images", lambda s, d: x)
    monkeypatch.setattr(queries, "image_labels", lambda s, d: y)
    assert {(r.item, r.c) for r in queries.fitted(spark, None).collect()} == {(i, c) for i in (1, 2, 3) for c in range(4)}
