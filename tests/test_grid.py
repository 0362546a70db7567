import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.functions import clouds, links, lookups, rules
from eocube.operators import collect, grid, training
from eocube.sources import rasters

TRIANGLE = [[(-1028560.0, 4689560.0), (-1028560.0, 4689000.0), (-1028000.0, 4689560.0), (-1028560.0, 4689560.0)]]
RECTANGLE = [[(-1020256.0, 4680000.0), (-1020000.0, 4680000.0), (-1020000.0, 4680156.0), (-1020256.0, 4680156.0)]]


def areas(spark, *rows):
    return spark.createDataFrame(list(rows), f"item int, epsg int, rings {grid.RINGS}")


def as_array(rows, n, name="v"):
    out = [[0] * n for _ in range(n)]
    for x in rows:
        out[x.r][x.c] = x[name]
    return out


@pytest.mark.parametrize(("scale", "want"), [(500, [[2956, 2996], [7003, 7043]]), (250, [[1453, 1475, 1500], [3714, 3737, 3762], [6214, 6237, 6262]])])
def test_bilinear(spark, scale, want):
    src = spark.range(10000).select(F.lit(1).alias("item"), F.floor(F.col("id") / 100).cast("int").alias("r"), (F.col("id") % 100).cast("int").alias("c"), F.col("id").cast("int").alias("v"))
    g = grid.grid(areas(spark, (1, 3857, TRIANGLE)), scale).withColumns({"sx0": F.lit(-1028560.0), "sy0": F.lit(4689560.0), "sscale": F.lit(10.0)})
    out = grid.resample_bilinear(src, g, ["v"])
    assert as_array(out.collect(), len(want)) == want
    if scale == 250:
        for touched, clipped in ((False, [[1453, 1475, 0], [3714, 0, 0], [0, 0, 0]]), (True, [[1453, 1475, 1500], [3714, 3737, 0], [6214, 0, 0]])):
            assert as_array(grid.clip(out, grid.rasterize(g, touched), ["v"]).collect(), 3) == clipped


def test_rasterize_with_a_hole(spark):
    square = lambda a, b: [(a, a), (a, b), (b, b), (b, a)]
    g = grid.grid(areas(spark, (1, 3857, [square(0.0, 6.0), square(2.0, 4.0)])), 1)
    got = {(x.r, x.c) for x in grid.rasterize(g).collect()}
    assert got == {(r, c) for r in range(6) for c in range(6)} - {(r, c) for r in (2, 3) for c in (2, 3)}


@pytest.mark.parametrize("seed", range(3))
def test_rasterize_equals_parity_per_cell(spark, seed):
    rnd = random.Random(seed)
    ring = [(rnd.uniform(0, 9), rnd.uniform(0, 9)) for _ in range(7)]
    g = grid.grid(areas(spark, (1, 3857, [ring])), 0.7)
    meta = g.first()
    want = set()
    for r in range(meta.height):
        for c in range(meta.width):
            x, y = meta.x0 + (c + 0.5) * 0.7, meta.y0 - (r + 0.5) * 0.7
            crossed = sum((a[1] > y) != (b[1] > y) and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in zip(ring, ring[1:] + ring[:1]))
            if crossed % 2:
                want.add((r, c))
    assert {(x.r, x.c) for x in grid.rasterize(g).collect()} == want
    assert want <= {(x.r, x.c) for x in grid.rasterize(g, True).collect()}


def test_wgs84(spark):
    rows = grid.wgs84_bbox(areas(spark, (1, 3857, RECTANGLE), (2, 32617, [[(630084.0, 4833438.0)]]), (3, 4326, [[(1.0, 2.0), (3.0, 4.0)]]))).orderBy("item").collect()
    assert [rows[0].west, rows[0].south, rows[0].east, rows[0].north] == pytest.approx([-9.165115585146461, 38.70848390053471, -9.162815898019115, 38.70957743561777], abs=1e-9)
    assert (rows[1].west, rows[1].south) == pytest.approx((-79.387143, 43.642562), abs=1e-5)
    assert (rows[2].west, rows[2].north) == (1.0, 4.0)
    with pytest.raises(Exception, match="not supported"):
        grid.wgs84_bbox(areas(spark, (1, 2154, RECTANGLE))).collect()


def test_target_scale(spark):
    at = lambda *v: spark.createDataFrame([v], "s double, a int, b int, k double").select(grid.target_scale(F.col("s"), F.col("a"), F.col("b"), F.col("k"))).first()[0]
    assert at(5.0, 1, 2, -10.0) == 5.0 and at(None, 1, 1, -10.0) == 10.0
    with pytest.raises(Exception, match="scale is needed"):
        at(None, 1, 2, -10.0)


def _best(b):
    """The eight criteria over one cell's observations, with numpy; b is [band][time]."""
    with np.errstate(all="ignore"):
        b2, b3, b4, b8, b8a, b11, b12 = (np.clip(x, 0, 10000) / 10000 for x in b)
        rgb, near, ndwi, ndvi = (b2 + b3 + b4) / 3, (b8 - b11) / (b8 + b11), (b3 - b11) / (b3 + b11), (b8 - b4) / (b8 + b4)
        haze = sum(w * x for w, x in zip(clouds.HAZE.values(), (b2, b3, b4, b8a, b11, b12)))
        tcb = sum(w * x for w, x in zip(clouds.BRIGHT.values(), (b2, b3, b4, b8a, b11, b12)))
        white = b3 / b11 > 1
        dense = (white & (rgb > 0.3) & ((haze < -0.1) | ((haze > -0.08) & (near < 0.4)))) | (haze < -0.2) | (white & (rgb < 0.3) & (haze < -0.055) & (rgb > 0.12)) | (~(white & (rgb < 0.3)) & (haze < -0.09) & (rgb > 0.12))
        snow = (ndwi > 0.7) & ~(white & (tcb < 0.36))
        masked = dense | snow | (b2 == 0) | (b2 + b3 + b4 + b8 < 0.5)
    v, w, t = (np.where(masked, np.nan, x) for x in (ndvi, ndwi, tcb))
    first = lambda f, x: 0 if np.isnan(x).all() else int(f(x))
    low, vi, vl, wi = first(np.nanargmin, t), first(np.nanargmax, v), first(np.nanargmin, v), first(np.nanargmax, w)
    mean = lambda x: np.nan if np.isnan(x).all() else np.nanmean(x)
    vx, wn = (np.nan if np.isnan(v).all() else np.nanmax(v)), (np.nan if np.isnan(w).all() else np.nanmin(w))
    rules_ = [(mean(w) < -0.55 and vx - mean(v) < 0.05, vi), (mean(v) < -0.3 and mean(w) - wn < 0.05, wi), (mean(v) > 0.6 and mean(t) < 0.45, vi), (not dense[low], low), (not snow[low] and t[low] < 1, low), (mean(v) < -0.2, wi), (mean(t) > 0.45, vl)]
    return next((i for ok, i in rules_ if ok), vi)


def test_best_observation_equals_the_arrays(spark):
    rnd = random.Random(5)
    data = {k: [[rnd.choice([0, 50, 400, 1500, 4000, 9000, 12000]) for _ in range(4)] for _ in clouds.S2_BANDS] for k in range(120)}
    rows = [(k, t, *[b[t] for b in bands]) for k, bands in data.items() for t in range(4)]
    df = spark.createDataFrame(rows, "k int, t int, " + ", ".join(f"{b} int" for b in clouds.S2_BANDS))
    got = {x.k: x.t for x in clouds.best_observation(df, ["k"], "t").collect()}
    assert got == {k: _best([np.array(x, float) for x in b]) for k, b in data.items()}
    assert len(set(got.values())) == 4


def test_index_bands():
    assert lookups.index_bands("rgb", "SENTINEL_2") == {"red": "B04", "green": "B03", "blue": "B02"}
    assert lookups.index_bands("ndvi", "LANDSAT_7") == {"nir1": "B4", "red": "B3"}
    assert lookups.index_bands("ndvi", "LANDSAT_1") == {"nir1": "B6", "red": "B5"}
    for bad in (("rgb", "LANDSAT_3"), ("none", "SENTINEL_2")):
        with pytest.raises(ValueError):
            lookups.index_bands(*bad)
    assert len(lookups.INDICES) == 17


def test_archive_link(spark):
    product = ("tiles/2/D/MG/2019/3/1/0", "S2B_MSIL2A_20190301T202209_N0211_R042_T02DMG_20190301T220107", "GS2B_20190301T202209_010364_N02.11", 2, "D", "MG", "S2B_OPER_MSI_L2A_DS_MTI__20190301T220107_S20190301T202210_N02.11")
    products = spark.createDataFrame([product], "path string, name string, datatake string, zone int, band string, square string, datastrip string")
    urls = spark.createDataFrame([("s3://sentinel-s2-l2a/tiles/2/D/MG/2019/3/1/0/R10m/B02.jp2",), ("s3://other/x.jp2",), (None,)], "u string")
    got = {x.u: x.archive for x in links.jp2_to_archive(urls, "u", products).collect()}
    assert got.pop("s3://sentinel-s2-l2a/tiles/2/D/MG/2019/3/1/0/R10m/B02.jp2") == (
        "https://storage.googleapis.com/gcp-public-data-sentinel-2/L2/tiles/02/D/MG/S2B_MSIL2A_20190301T202209_N0211_R042_T02DMG_20190301T220107.SAFE"
        "/GRANULE/L2A_T02DMG_A010364_20190301T202210/IMG_DATA/R10m/L2A_T02DMG_20190301T202209_B02_10m.jp2"
    )
    assert set(got.values()) == {None}


GOOD = {"platforms": "SENTINEL_2", "bands": ["B04", "B08"], "start": "2020-01-01", "end": "2020-02-01", "level": "L2A"}


@pytest.mark.parametrize(
    "change",
    [{"extra": 1}, {"start": "2020-99-01"}, {"platforms": ["SENTINEL_2", "LANDSAT_8"]}, {"platforms": "SPOT"}, {"platforms": "LANDSAT_8"}, {"level": "L2"}, {"level": "L1C", "bands": ["SCL"]}, {"limit": 0}, {"scale": -1}, {"start": None}, {"mode": "best"}, {"composite_method": "SCL"}, {"mode": "composite", "composite_method": "QA_PIXEL"}, {"mode": "composite", "bands": ["B04"]}, {"interval": "years"}],
)
def test_bad_requests(change):
    with pytest.raises(ValueError):
        rules.stack_request(**{**GOOD, **change})


def test_good_requests():
    assert rules.stack_request(**GOOD)["maxcloud"] == 20
    assert rules.stack_request(**{**GOOD, "mode": "composite"})["composite_method"] == "SCL"
    assert rules.search_request(**GOOD)["sort"] == "sensing_time"
    assert rules.epsg_code("urn:ogc:def:crs:EPSG::3857") == 3857
    for bad in ({"mode": "Pixel_Model"}, {"mode": "3D_Model", "class_definitions": 5}):
        with pytest.raises(ValueError):
            rules.generator_request(**bad)


def test_chunks_and_images_round_trip(spark, tmp_path):
    rows = [(1, dt.date(2020, 1, d), r, c, d * 100 + r * 5 + c) for d in (1, 2) for r in range(5) for c in range(7)]
    cells = spark.createDataFrame(rows, "item int, t date, r int, c int, v int")
    chunks = rasters.assemble_chunks(cells, 3, ["v"])
    assert chunks.count() == 2 * 2 * 3
    assert sorted(tuple(x) for x in rasters.explode_chunks(chunks, 3, ["v"]).collect()) == sorted(rows)
    path = str(tmp_path / "stack")
    rasters.write_stack(cells, path)
    rasters.write_stack(cells.where("day(t) = 2").withColumn("v", F.lit(7)), path)
    got = {x.t: (x.n, x.v) for x in spark.read.parquet(path).groupBy("t").agg(F.count("*").alias("n"), F.max("v").alias("v")).collect()}
    assert got == {dt.date(2020, 1, 1): (35, 126), dt.date(2020, 1, 2): (35, 7)}
    assert rasters.list_files(spark, path, ".parquet").count() >= 2


def test_features(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(
        '{"type":"FeatureCollection","crs":{"properties":{"name":"EPSG:3857"}},"features":['
        '{"properties":{"class":"x"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[0,1],[1,0],[0,0]]]}},'
        '{"properties":{"class":"y"},"geometry":{"type":"MultiPolygon","coordinates":[[[[5,5],[5,6],[6,5]]],[[[8,8],[8,9],[9,8]]]]}}]}'
    )
    rows = rasters.read_features(spark, str(tmp_path / "a.geojson")).orderBy("position").collect()
    assert [(x.position, x.epsg, len(x.rings)) for x in rows] == [(0, 3857, 1), (1, 3857, 2)]


def test_three_d_samples_fill_missing_times(spark):
    cells = spark.createDataFrame([(1, t, r, c, t + 1) for t in range(2) for r in range(2) for c in range(2)], "item int, t int, r int, c int, v int")
    images = training.samples_3d(cells, ["v"], 3)
    assert [m[0][0][0] for m in images.first().images] == [1, 2, 0]
    assert training.valid_samples(images, 3, 2, 2).count() == 1 and training.valid_samples(images, 3, 2, 3).count() == 0
    noisy = training.add_noise(cells, ["v"], 1).join(cells.withColumnRenamed("v", "w"), ["item", "t", "r", "c"])
    assert noisy.where("v < w or v > w + 0.2").count() == 0


def test_window_models(spark):
    cells = spark.createDataFrame([(1, r, c, r * 10 + c) for r in range(6) for c in range(6)], "item int, r int, c int, v int")
    windows = spark.createDataFrame([(1, r, c) for r in (0, 2) for c in (0, 2)], "item int, row int, col int")
    out = training.predict_windows(cells, windows, lambda p: p[["item", "row", "col", "r", "c"]].assign(p=p.v / 2.0), "item int, row int, col int, r int, c int, p double", 4)
    assert out.count() == 64
    assert training.trim_windows(out, 4, 1, 6, 6).select("r", "c").distinct().count() == 36


def test_items(spark):
    with pytest.raises(Exception, match="no date"):
        spark.sql("select cast(null as date) as d").select(collect.item_date(F.col("d"), F.col("d"), F.col("d"))).collect()
    preds = spark.createDataFrame([(0, 0, 1.0, 1), (0, 0, 3.0, 2), (0, 1, 5.0, 1)], "r int, c int, v double, file_order int")
    apart = spark.createDataFrame([(1, 0, 0, 1, 1), (2, 5, 5, 6, 6)], "id int, xmin int, ymin int, xmax int, ymax int")
    meet = spark.createDataFrame([(1, 0, 0, 3, 3), (2, 1, 1, 6, 6)], apart.schema)
    value = lambda rects, cat: {(x.r, x.c): x.v for x in collect.merge_predictions(preds, rects, cat, -1).collect()}[0, 0]
    assert (value(meet, False), value(apart, False), value(meet, True)) == (2.0, 1.0, 1.0)
    assert math.isclose(preds.select(training.cross_entropy(F.lit(0), F.array(F.lit(1.0), F.lit(1.0)))).first()[0], math.log(2), rel_tol=1e-9)
