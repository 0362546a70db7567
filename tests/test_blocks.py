"""Warping, chunk windows, zone maps and windows with a halo."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.functions import projections
from eocube.operators import boxes, collect, grid, intervals, ranks, search, stats, warp, windows
from eocube.sources import fixtures as fx
from eocube.sources import rasters

SF = "/root/testdata/sf0.001"
TRIANGLE = [[(-1028560.0, 4689560.0), (-1028560.0, 4689000.0), (-1028000.0, 4689560.0), (-1028560.0, 4689560.0)]]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def chunked(spark, image: np.ndarray, size: int, **columns):
    """An image as chunk rows."""
    rows = []
    for r in range(0, image.shape[0], size):
        for c in range(0, image.shape[1], size):
            part = image[r : r + size, c : c + size]
            rows.append((r // size, c // size, *part.shape, [int(v) for v in part.ravel()]))
    df = spark.createDataFrame(rows, "chunk_row int, chunk_col int, h int, w int, v array<int>")
    return df.withColumns({k: F.lit(v) for k, v in columns.items()})


@pytest.mark.parametrize(("lon", "lat", "epsg", "x", "y"), [(-9.0, 38.7, 32629, 500000.0, None), (-6.0, 0.0, 32629, 833978.6, 0.0), (151.2, -33.9, 32756, None, None), (10.0, 60.0, 3857, 1113194.9, 8399737.9)])
def test_projections_there_and_back(spark, lon, lat, epsg, x, y):
    got = spark.range(1).select(projections.from_wgs84(F.lit(lon), F.lit(lat), F.lit(epsg)).alias("p")).select("p.*").first()
    if y is None:  # on the middle meridian, the northing is the length of the meridian's arc
        e2, at = (2 - 1 / 298.257223563) / 298.257223563, np.linspace(0, np.radians(38.7), 100_001)
        y = 0.9996 * np.trapezoid(projections.RADIUS * (1 - e2) / (1 - e2 * np.sin(at) ** 2) ** 1.5, at)
    if x is not None:
        assert abs(got.x - x) < 0.1 and abs(got.y - y) < 0.1
    back = spark.range(1).select(projections.to_wgs84(F.lit(got.x), F.lit(got.y), F.lit(epsg)).alias("p")).select("p.*").first()
    assert abs(back.lon - lon) < 1e-8 and abs(back.lat - lat) < 1e-8
    a, b = projections.arrays_between(np.array([lon]), np.array([lat]), 4326, epsg)
    assert abs(a[0] - got.x) < 1e-6 and abs(b[0] - got.y) < 1e-6
    assert projections.arrays_between(1.0, 2.0, epsg, epsg) == (1.0, 2.0)


def test_unknown_systems_are_an_error(spark):
    with pytest.raises(ValueError, match="9999"):
        projections.arrays_between(np.zeros(1), np.zeros(1), 4326, 9999)
    with pytest.raises(Exception, match="not supported: 9999"):
        spark.range(1).select(projections.from_wgs84(F.lit(1.0), F.lit(1.0), F.lit(9999))).collect()


def pairs_of(spark, scale, rings=TRIANGLE, **source):
    a = grid.grid(spark.createDataFrame([(1, 3857, rings)], f"tile_id int, epsg int, rings {grid.RINGS}"), scale)
    s = {"scene_id": 7, "sx0": -1028560.0, "sy0": 4689560.0, "sscale": 10.0, "sepsg": 3857, **source}
    return a.withColumns({k: F.lit(v) for k, v in s.items()})


def as_array(rows, name="v"):
    out = np.full((max(x.r for x in rows) + 1, max(x.c for x in rows) + 1), -1)
    for x in rows:
        out[x.r, x.c] = x[name]
    return out.tolist()


ARANGE = np.arange(10_000).reshape(100, 100)


@pytest.mark.parametrize(("scale", "want"), [(500.0, [[2956, 2996], [7003, 7043]]), (250.0, [[1453, 1475, 1500], [3714, 3737, 3762], [6214, 6237, 6262]])])
@pytest.mark.parametrize("size", [16, 256])
def test_warp_within_one_system(spark, scale, want, size):
    out = warp.warp(pairs_of(spark, scale), chunked(spark, ARANGE, size, scene_id=7), ["tile_id"], ["v"], size=size)
    assert as_array(out.collect()) == want


def test_warp_copies_cells_of_the_same_grid(spark):
    square = [[(-1028560.0, 4689560.0), (-1028560.0, 4688560.0), (-1027560.0, 4688560.0), (-1027560.0, 4689560.0)]]
    for discrete in ([], ["v"]):
        out = warp.warp(pairs_of(spark, 10.0, square), chunked(spark, ARANGE, 30, scene_id=7), ["tile_id"], ["v"], discrete, 30)
        assert as_array(out.collect()) == ARANGE.tolist()
    small = warp.warp(pairs_of(spark, 5.0), chunked(spark, ARANGE, 64, scene_id=7), ["tile_id"], ["v"], ["v"], 64).collect()
    assert as_array(small) == np.repeat(np.repeat(ARANGE[:56, :56], 2, axis=0), 2, axis=1).tolist()


def test_warp_outside_of_the_source_and_without_chunks(spark):
    half = warp.warp(pairs_of(spark, 10.0, sx0=-1028560.0 + 300), chunked(spark, ARANGE + 1, 20, scene_id=7), ["tile_id"], ["v"], size=20)
    got = np.array(as_array(half.collect()))
    assert got.shape == (56, 56) and (got[:, :30] == 0).all() and (got[:, 30:] == (ARANGE + 1)[:56, :26]).all()
    none = warp.warp(pairs_of(spark, 10.0, sx0=0.0), chunked(spark, ARANGE + 1, 20, scene_id=7), ["tile_id"], ["v"], size=20)
    assert none.count() == 56 * 56 and none.where("v <> 0").count() == 0


@pytest.mark.parametrize("tolerance", [0.0, 0.125])
def test_warp_from_another_system(spark, tolerance):
    """Against positions projected one by one; a linear block may be off by the tolerance."""
    x, y = projections.arrays_between(np.array([-1028560.0]), np.array([4689560.0]), 3857, 32629)
    source = {"sx0": math.floor(x[0]) - 40.0, "sy0": math.ceil(y[0]) + 40.0, "sepsg": 32629}
    image = np.add.outer(np.arange(100) * 7, np.arange(100) * 3) + 1
    out = warp.warp(pairs_of(spark, 12.0, **source), chunked(spark, image, 32, scene_id=7), ["tile_id"], ["v"], size=32, tolerance=tolerance).collect()
    got = np.array(as_array(out))
    c, r = np.meshgrid(np.arange(got.shape[1]), np.arange(got.shape[0]))
    px, py = projections.arrays_between(-1028560.0 + (c + 0.5) * 12, 4689560.0 - (r + 0.5) * 12, 3857, 32629)
    row, col = (source["sy0"] - py) / 10, (px - source["sx0"]) / 10
    inner = (row > 1) & (row < 99) & (col > 1) & (col < 99)
    plane = 7 * (row - 0.5) + 3 * (col - 0.5) + 1  # of which bilinear weights give the exact value
    assert inner.mean() > 0.9 and np.abs(got - plane)[inner].max() <= 0.5 + 1e-6 + 10 * tolerance


def test_linear_blocks_keep_the_tolerance():
    x, y = -668000 + np.arange(256) * 10.0, 4680000 - np.arange(256) * 10.0
    exact = projections.arrays_between(*np.meshgrid(x, y), 3857, 32629)
    for tolerance, close in ((1.0, True), (1e-9, False)):
        got = warp.block_places(x, y, 3857, 32629, tolerance)
        off = max(np.abs(a - b).max() for a, b in zip(got, exact, strict=True))
        assert (0 < off <= tolerance * 1.01) if close else off == 0


def stored(spark, path):
    image = np.arange(40 * 30).reshape(40, 30)
    chunks = chunked(spark, image, 8, t=0).withColumn("item", F.explode(F.array(F.lit(1), F.lit(2)))).withColumnRenamed("v", "a").withColumn("b", F.transform("a", lambda v: v * 0))
    rasters.write_chunks(chunks, path, ["a", "b"])
    return image


def test_windows_read_only_their_chunks(spark, tmp_path):
    image = stored(spark, str(tmp_path))
    chunks = spark.read.parquet(f"{tmp_path}/chunks")
    asked = spark.createDataFrame([(1, 17, 20, 3, 12), (2, 39, 60, 29, 29), (2, 5, 4, 0, 3)], "item int, row0 int, row1 int, col0 int, col1 int")
    cells = rasters.explode_windows(chunks, asked, 8, ["a"])
    got = {(x.item, x.r, x.c): x.a for x in cells.collect()}
    assert got == {(1, r, c): int(image[r, c]) for r in range(17, 21) for c in range(3, 13)} | {(2, 39, 29): int(image[39, 29])}
    plan = plan_of(cells)
    assert "dynamicpruning" in plan and "b#" not in plan.split("ReadSchema")[1].split(">")[0]
    scan = cells._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert scan <= 2  # both on the chunk's place, before the explosion: none on cells
    assert chunks.where("chunk_row = 2").count() == 8 and chunks.count() == 40


def test_zipped_chunks_with_a_missing_band(spark):
    rows = [(1, 0, "a", 0, 0, 2, 3, [1, 2, 3, 4, 5, 6]), (1, 0, "b", 0, 0, 2, 3, [7, 8, 9, 10, 11, None]), (1, 0, "a", 0, 1, 2, 1, [12, 13]), (1, 0, "x", 0, 0, 2, 3, [0] * 6)]
    chunks = spark.createDataFrame(rows, "item int, t int, band string, chunk_row int, chunk_col int, h int, w int, data array<int>")
    got = {(x.r, x.c): (x.a, x.b) for x in rasters.explode_chunks(chunks, 3, ["a", "b"]).collect()}
    assert got == {(0, 0): (1, 7), (0, 1): (2, 8), (0, 2): (3, 9), (1, 0): (4, 10), (1, 1): (5, 11), (1, 2): (6, None), (0, 3): (12, None), (1, 3): (13, None)}
    stats = {(x.chunk_col): x for x in rasters.chunk_stats(rasters.zip_chunks(chunks, ["a", "b"]), ["a", "b"], 3, lambda v: v > 4).collect()}
    assert tuple(stats[0].a) == (1, 6, 1, 5) and tuple(stats[0].b) == (7, 11, 1, 5) and tuple(stats[1].b) == (None, None, 2, 0) and stats[0].clouds == 2


def test_zone_maps_decide_before_cells_are_read(spark, tmp_path):
    stored(spark, str(tmp_path))
    stats = spark.read.parquet(f"{tmp_path}/stats")
    whole = rasters.image_stats(stats, ["item", "t"], ["a", "b"]).collect()
    assert {tuple(x.a) for x in whole} == {(1, 1199, 1, 1199)} and {tuple(x.b) for x in whole} == {(None, None, 1200, 0)}
    scenes = spark.createDataFrame([(1,), (2,), (3,)], "item int")
    keep = lambda bands: sorted(x.item for x in search.scenes_with_data(scenes, rasters.image_stats(stats, ["item"], bands), bands, ["item"]).collect())
    assert keep(["a"]) == [1, 2] and keep(["a", "b"]) == []


def test_stack_with_zone_maps_equals_the_one_that_reads_twice(spark):
    from eocube.plans import queries

    matched = search.assign_steps(fx.scenes(spark, SF), queries.steps(spark))
    stats = rasters.image_stats(queries.scene_stats(spark, SF), ["scene_id"], ["b0", "b02"])
    key = lambda df: sorted(map(tuple, df.collect()))
    for mode in ("latest_pixel", "cloud_sorted_pixel", "all"):
        twice = collect.pixel_stack(matched, queries.holey, ["b0", "b02"], mode, 4)
        once = collect.pixel_stack(matched, queries.holey, ["b0", "b02"], mode, 4, stats=stats)
        assert key(once) == key(twice)


def brute_windows(x, model, window, ratio, border):
    h, w = x.shape[1:3]
    total, count = None, np.zeros((h, w))
    hh, ww = min(window, h), min(window, w)
    for r in windows.window_starts(h, window, ratio):
        for c in windows.window_starts(w, window, ratio):
            p = model(x[None, :, r : r + hh, c : c + ww])[0]
            total = np.zeros((h, w, p.shape[-1])) if total is None else total
            for i in range(hh):
                for j in range(ww):
                    if (i >= border or r == 0) and (i < hh - border or r + hh >= h) and (j >= border or c == 0) and (j < ww - border or c + ww >= w):
                        total[r + i, c + j] += p[i, j]
                        count[r + i, c + j] += 1
    return np.where(count[:, :, None] > 0, total / np.maximum(count, 1)[:, :, None], -9999)


@pytest.mark.parametrize(("shape", "size", "window", "ratio", "border"), [((23, 17), 5, 4, 0.5, 0), ((23, 17), 5, 12, 0.4, 1), ((9, 31), 8, 8, 1.0, 0), ((3, 7), 4, 5, 0.5, 0), ((16, 16), 16, 6, 0.9, 2)])
def test_windows_with_a_halo(spark, shape, size, window, ratio, border):
    rng = np.random.RandomState(0)
    x = rng.randint(0, 100, (2, *shape, 1)).astype(float)

    def model(v):
        top = v.max(axis=(1, 2, 3, 4))[:, None, None]
        return np.stack([np.broadcast_to(top, v.shape[:1] + v.shape[2:4]), v[:, 0, :, :, 0] - v[:, 1, :, :, 0]], axis=-1)

    chunks = chunked(spark, x[0, :, :, 0], size, t=0).unionByName(chunked(spark, x[1, :, :, 0], size, t=1)).withColumn("item", F.lit("a"))
    meta = spark.createDataFrame([("a", *shape)], "item string, height int, width int")
    got = np.full((*shape, 2), np.nan)
    for row in windows.predict_windows(chunks, meta, ["v"], model, 2, size, window, ratio, 2, border).collect():
        got[row.r, row.c] = row.probs
    assert np.allclose(got, brute_windows(x, model, window, ratio, border))


def test_small_images_are_sent_once_and_large_ones_cut(spark):
    images = {"a": np.arange(35).reshape(7, 5) * 1000 - 9000, "b": np.arange(23 * 17).reshape(23, 17) % 50, "c": np.arange(12).reshape(3, 4)}
    meta = spark.createDataFrame([(k, *x.shape) for k, x in images.items()] + [("none", 5, 5)], "item string, height int, width int")
    made = None
    for k, x in images.items():
        of = chunked(spark, x, 4, t=0).withColumn("item", F.lit(k))
        made = of if made is None else made.unionByName(of)
    model = lambda v: v[:, 0]
    out = windows.predict_windows(made, meta, ["v"], model, 1, 4, 3)
    got = {}
    for row in out.collect():
        got.setdefault(row.item, {})[row.r, row.c] = row.probs[0]
    assert got == {k: {(r, c): float(v) for (r, c), v in np.ndenumerate(x)} for k, x in images.items()}
    small = windows.predict_windows(made.where("item <> 'b'"), meta.where("item <> 'b'"), ["v"], model, 1, 4, 3)
    assert plan_of(small).count("Exchange") == 1 < plan_of(out).count("Exchange")
    sent = windows.sent_whole(made.where("item = 'c'"), meta.where("item = 'c'"), ["v"], 4).agg(F.sum(F.length("v"))).first()[0]
    assert sent == 12  # a byte a cell


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_halo_sends_strips_not_windows(spark):
    chunks = chunked(spark, np.ones((64, 64), dtype=int), 32, t=0, item=1, height=64, width=64)
    cells = windows.halo_strips(chunks, ["v"], 32, 7).agg(F.sum(F.size("v"))).first()[0]
    assert cells == 64 * 64 + 2 * 64 * 7 + 7 * 7


def test_covers_of_intervals(spark):
    rng = np.random.RandomState(0)
    rows = [(i, int(a), int(a + n)) for i, (a, n) in enumerate(zip(rng.randint(-800, 20_000, 200), rng.choice([-1, 0, 1, 6, 29, 365, 5_000, 19_521], 200), strict=True))]
    df = spark.createDataFrame(rows, "i int, a int, b int").select("i", "a", "b", *[F.date_add(F.lit("1970-01-01").cast("date"), F.col(k)).alias(f"step_{n}") for k, n in (("a", "start"), ("b", "end"))])
    found: dict = {}
    for x in intervals.covered(df).collect():
        found.setdefault(x.i, []).append((x._block << x._level, (x._block + 1 << x._level) - 1))
    for i, a, b in rows:
        blocks = sorted(found.get(i, []))
        assert [d for s, e in blocks for d in range(s, e + 1)] == list(range(a, b + 1))
        assert len(blocks) <= 2 * max(1, math.log2(max(1, b - a + 1))) + 1


def test_one_long_step_takes_a_few_rows(spark):
    step = spark.sql("select date'1972-07-23' as step_start, date'2026-01-01' as step_end")
    assert intervals.covered(step).count() <= 28  # of 19,521 days
    points = spark.sql("select explode(array(date'1972-07-22', date'1972-07-23', date'1999-12-31', date'2026-01-01', date'2026-01-02', null)) as date")
    assert intervals.days_in_intervals(points, F.col("date"), step).count() == 3


def test_boxes_of_many_sizes_meet(spark):
    rng = np.random.RandomState(1)

    def made(n, k):
        side = 10.0 ** rng.randint(-2, 7, (n, 2)) * (rng.rand(n, 2) < 0.9)
        at = rng.randint(-1_000_000, 1_000_000, (n, 2)) / 1.0
        return [(k + i, *at[i].tolist(), *(at[i] + side[i]).tolist()) for i in range(n)]

    a = [*made(300, 0), (900, 0.0, 0.0, 8.0, 8.0), (901, 5.0, 5.0, 4.0, 9.0), (902, None, 0.0, 1.0, 1.0)]
    b = [*made(300, 5000), (9000, 8.0, 8.0, 16.0, 16.0), (9001, 8.0, 8.0, 8.0, 8.0), (9002, float("nan"), 0.0, 1.0, 1.0)]
    side = "xmin double, ymin double, xmax double, ymax double"
    x, y = spark.createDataFrame(a, "id int, " + side).toDF("a_id", *[f"a_{k}" for k in boxes.SIDES]), spark.createDataFrame(b, "id int, " + side)
    got = sorted((r.a_id, r.id) for r in boxes.meeting(x, y).collect())
    sound = lambda p: None not in p and p[1] <= p[3] and p[2] <= p[4]
    want = sorted((p[0], q[0]) for p in a for q in b if sound(p) and sound(q) and p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    assert got == want and len(want) > 900
    levels = boxes.levels_of(y)
    assert boxes.in_cells(x.where("a_id < 300"), "a_", [], True).groupBy("a_id").count().agg(F.max("count")).first()[0] <= 4
    assert boxes.in_cells(x.where("a_id < 300"), "a_", levels, False).groupBy("a_id").count().agg(F.max("count")).first()[0] <= 4 * len(levels)


def test_pyramid_is_a_cascade(spark):
    cells = spark.range(64 * 48).select(F.floor(F.col("id") / 48).cast("int").alias("r"), (F.col("id") % 48).cast("int").alias("c"), F.when(F.col("id") % 7 != 0, F.col("id").cast("double")).alias("v")).where("r < 33 or c > 5")
    got = {(x.factor, x.r, x.c): x.v for x in stats.pyramid(cells, [2, 4, 8]).collect()}
    values = {(x.r, x.c): x.v for x in cells.collect()}
    for f in (2, 4, 8):
        blocks: dict = {}
        for (r, c), v in values.items():
            blocks.setdefault((f, r // f, c // f), []).append(v)
        for k, vs in blocks.items():
            some = [v for v in vs if v is not None]
            assert got[k] == (pytest.approx(sum(some) / len(some)) if some else None)
    with pytest.raises(ValueError, match="does not divide"):
        stats.pyramid(cells, [2, 3])


def test_slices_and_caps_without_one_task(spark):
    rng = np.random.RandomState(0)
    keys = [int(k) for k in rng.permutation(3_000)] + [None]
    df = spark.createDataFrame([(k, "x") for k in keys], "k long, v string").repartition(5)
    order = [None, *range(3_000)]
    for first, last in ((0, 10), (100, 700), (2_990, 4_000), (5_000, 6_000), (0, 3_001)):
        got = ranks.slice_by_key(df, "k", first, last, 200, 16)
        assert sorted((r.k for r in got.collect()), key=lambda k: -1 if k is None else k) == order[first:last] and got.columns == ["k", "v"]
        assert "SinglePartition" not in plan_of(got)
    text = spark.createDataFrame([(f"é{k:04d}",) for k in range(500)], "k string")
    assert sorted(r.k for r in ranks.slice_by_key(text, "k", 40, 60, 50, 7).collect()) == [f"é{k:04d}" for k in range(40, 60)]
    some = ranks.capped(df, 1_234, ["k"])
    kept = {r.k for r in some.collect()}
    assert len(kept) == some.count() == 1_234 and kept <= set(keys) and "SinglePartition" not in plan_of(some)
    assert kept == {r.k for r in ranks.capped(df.repartition(2), 1_234, ["k"]).collect()}
    assert ranks.capped(df, 3_001, ["k"]).count() == 3_001 and ranks.capped(df, 0, ["k"]).count() == 0
    assert ranks.slice_by_key(df.where("false"), "k", 0, 5).count() == 0
