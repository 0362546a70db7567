"""Scenes, cells, labels and predictions as views over the driver's tables, and the same views as DuckDB SQL."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.functions.projections import mercator_to_wgs84, wgs84_to_utm

#: (scene, row, column) factors of each band's value.
BANDS = {"b01": (73, 61, 67), "b05": (79, 67, 71), "b02": (41, 7, 11), "b03": (43, 13, 17), "b04": (47, 19, 23), "b08": (53, 29, 31), "b8a": (59, 37, 41), "b11": (61, 43, 47), "b12": (67, 53, 59)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Cells that one task makes of its scenes, about.
TASK_CELLS = 1 << 20


def tasks(spark: SparkSession, sf_dir: str, cells: int = 16) -> int:
    """Tasks to deal scenes to before each becomes `cells` cells. Spark sizes tasks by the scenes' few bytes; what they
    become would fill a task's memory and spill, and run on a few cores."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "events").count() * cells // TASK_CELLS))


def dealt(spark: SparkSession, sf_dir: str, cells: int, *keys: str) -> DataFrame:
    """Scenes dealt out by keys, scene_id if there are none, to tasks for `cells` cells of each."""
    return scenes(spark, sf_dir).repartition(tasks(spark, sf_dir, cells), *(keys or ("scene_id",)))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    platform = F.when(F.col("event_type") == "view", "sentinel-2a").when(F.col("event_type") == "click", "sentinel-2b").when(F.col("event_type") == "signup", "LANDSAT_8").when(F.col("event_type") == "purchase", "LANDSAT_7")
    x, y = F.col("user_id") % 12 * 1000.0, F.floor(F.col("user_id") / 12) * 1000.0
    return e.select(
        F.col("event_id").alias("scene_id"), F.concat(F.lit("S2_"), F.floor(F.col("event_id") / 2).cast("string")).alias("id"),
        F.when(F.col("event_id") % 2 == 0, "sentinel-s2-l2a").otherwise("sentinel-s2-l2a-cogs").alias("collection_id"),
        F.col("user_id").alias("tile_id"), F.col("ts").alias("sensing_time"), platform.alias("platform"),
        F.get_json_object("props", "$.k").cast("double").alias("cloud_cover"), x.alias("xmin"), y.alias("ymin"), (x + 1500).alias("xmax"), (y + 1500).alias("ymax"),
    )


SCENE = """scene as (select event_id as scene_id, 'S2_' || (event_id // 2)::varchar as id,
 case when event_id % 2 = 0 then 'sentinel-s2-l2a' else 'sentinel-s2-l2a-cogs' end as collection_id, user_id as tile_id, ts as sensing_time,
 case event_type when 'view' then 'sentinel-2a' when 'click' then 'sentinel-2b' when 'signup' then 'LANDSAT_8' when 'purchase' then 'LANDSAT_7' end as platform,
 json_extract_string(props, '$.k')::double as cloud_cover, (user_id % 12) * 1000.0::double as xmin, (user_id // 12) * 1000.0::double as ymin,
 (user_id % 12) * 1000.0::double + 1500 as xmax, (user_id // 12) * 1000.0::double + 1500 as ymax from events)"""
STEP = """step as (select i::int as step_no, date '2024-01-01' + (7 * i)::int as step_start, date '2024-01-01' + (7 * i + 6)::int as step_end from range(4) t(i))"""
RANKED = (
    SCENE + ", " + STEP + """, ranked as (select s.*, step_no, row_number() over (partition by tile_id, step_no order by sensing_time desc, scene_id)::int as idx,
 row_number() over (partition by tile_id, step_no order by cloud_cover nulls last, scene_id)::int as idc from scene s join step on sensing_time >= step_start and sensing_time <= step_end)"""
)


def cells(scenes: DataFrame, size: int = 4) -> DataFrame:
    """size x size cells of each scene, with its columns."""
    grid = scenes.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(size - 1)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    s, r, c = F.col("scene_id"), F.col("r"), F.col("c")
    b0 = F.when((s * 7 + r * 3 + c * 5) % 4 == 0, F.lit(0)).otherwise(1 + (s * 37 + r * 101 + c * 59) % 9999).cast("int")
    grid = grid.withColumn("b0", b0).withColumns({k: ((s * p + r * q + c * t) % 10000).cast("int") for k, (p, q, t) in BANDS.items()})
    grid = grid.withColumns({"scl": ((s * 11 + r * 5 + c * 3) % 12).cast("int"), "qa": ((s * 13 + r * 7 + c) % 32).cast("int")})
    return grid.withColumn("scl_clear", F.when(F.col("b0") == 0, 0).when(s % 3 == 0, 4).otherwise(F.col("scl")))


CELL = (
    RANKED + ", cell0 as (select *, (case when (scene_id * 7 + r * 3 + c * 5) % 4 = 0 then 0 else 1 + (scene_id * 37 + r * 101 + c * 59) % 9999 end)::int as b0, "
    + ", ".join(f"((scene_id * {p} + r * {q} + c * {t}) % 10000)::int as {k}" for k, (p, q, t) in BANDS.items())
    + ", ((scene_id * 11 + r * 5 + c * 3) % 12)::int as scl, ((scene_id * 13 + r * 7 + c) % 32)::int as qa from ranked, (select i::int as r from range(4) t(i)), (select i::int as c from range(4) t(i))),"
    " cell as (select *, case when b0 = 0 then 0 when scene_id % 3 = 0 then 4 else scl end as scl_clear from cell0)"
)


def labels(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select((F.col("p_partkey") % 20).alias("item_id"), F.floor(F.col("p_partkey") / 20).alias("position"), (F.col("p_size") % 5).cast("int").alias("value"), F.col("p_retailprice").cast("double").alias("y"))


LABEL = "label as (select p_partkey % 20 as item_id, p_partkey // 20 as position, (p_size % 5)::int as value, p_retailprice::double as y from part)"


def predictions(spark, sf_dir) -> DataFrame:
    q, d = F.col("l_quantity").cast("double"), F.col("l_discount").cast("double")
    return table(spark, sf_dir, "lineitem").select(q.alias("y_true"), (q * (1 - d)).alias("y_pred"))


PRED = "pred as (select l_quantity::double as y_true, l_quantity::double * (1 - l_discount::double) as y_pred from lineitem)"


def rectangles(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    x, y, side = F.col("s_suppkey") % 10 * 10, F.floor(F.col("s_suppkey") / 10) * 10, 5 + F.col("s_nationkey") % 10
    return s.select(F.col("s_suppkey").alias("id"), x.alias("xmin"), y.alias("ymin"), (x + side).alias("xmax"), (y + side).alias("ymax"))


RECT = "rect as (select s_suppkey as id, s_suppkey % 10 * 10 as xmin, s_suppkey // 10 * 10 as ymin, s_suppkey % 10 * 10 + 5 + s_nationkey % 10 as xmax, s_suppkey // 10 * 10 + 5 + s_nationkey % 10 as ymax from supplier)"


def rasters(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    order = F.struct("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return li.select(F.col("l_suppkey").alias("raster"), (F.col("l_partkey") % 50).cast("int").alias("r"), (F.col("l_orderkey") % 50).cast("int").alias("c"), F.col("l_quantity").cast("double").alias("v"), order.alias("file_order"))


RASTER = "raster as (select l_suppkey as raster, (l_partkey % 50)::int as r, (l_orderkey % 50)::int as c, l_quantity::double as v, {'a': l_suppkey, 'b': l_orderkey, 'c': l_partkey, 'd': l_linenumber, 'e': l_extendedprice} as file_order from lineitem)"


def areas(spark, sf_dir) -> DataFrame:
    """A right triangle per supplier, with its right angle at the top left."""
    s = table(spark, sf_dir, "supplier")
    x, y = (F.col("s_suppkey") % 100 * 10).cast("double"), (F.floor(F.col("s_suppkey") / 100) * 10).cast("double")
    side = F.col("s_nationkey") + 3.25
    point = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
    ring = F.array(point(x, y), point(x, y - side), point(x + side, y), point(x, y))
    return s.select(F.col("s_suppkey").alias("item"), (F.col("s_nationkey") % 5).cast("int").alias("value"), F.lit("2024-01-01").cast("date").alias("date"), F.array(ring).alias("rings"))


AREA = (
    "area as (select s_suppkey as item, (s_nationkey % 5)::int as value, (s_suppkey % 100 * 10)::double as x, (s_suppkey // 100 * 10)::double as y, s_nationkey + 3.25::double as side,"
    " s_nationkey::int + 4 as n from supplier), spot as (select item, value, side, n, r, c from area, (select i::int as r from range(28) t(i)), (select i::int as c from range(28) t(i)) where r < n and c < n)"
)


def probabilities(spark, sf_dir) -> DataFrame:
    """Ten probabilities per vector, not yet rescaled, and a class."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform(F.slice("embedding", 1, 10), lambda x: F.abs(x.cast("double"))).alias("probs"), (F.col("vec_id") % 10).cast("int").alias("class"))


PROB = "prob as (select vec_id, list_transform(embedding[1:10], lambda x: abs(x::double)) as probs, (vec_id % 10)::int as class from embeddings)"


#: Rasters of 12 x 10 cells of 100 m in UTM zones 29 and 30, in chunks of 5 x 5, and areas of 6 x 8 cells of 120 in EPSG 3857.
ROWS, COLS, CHUNK = 12, 10, 5


def _tile_corner():
    return -668000.0 + F.col("tile_id") % 12 * 1000.0, 4680000.0 - F.floor(F.col("tile_id") / 12) * 1000.0


def warp_areas(spark, sf_dir) -> DataFrame:
    """A rectangle for each tile."""
    x, y = _tile_corner()
    point = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    ring = F.array(point(x, y), point(x, y - 720), point(x + 960, y - 720), point(x + 960, y))
    return scenes(spark, sf_dir).select("tile_id").distinct().select("tile_id", F.lit(3857).alias("epsg"), F.array(ring).alias("rings"))


def warp_scenes(spark, sf_dir) -> DataFrame:
    """Scenes with a raster of their own, in either zone by their number and shifted by up to six cells, and a box in degrees."""
    x, y = _tile_corner()
    s = scenes(spark, sf_dir).select("scene_id", "tile_id", "sensing_time", "cloud_cover", (32629 + F.col("scene_id") % 2).cast("int").alias("sepsg"))
    (xmin, ymin), (xmax, ymax) = mercator_to_wgs84(F, x - 300, y - 1200), mercator_to_wgs84(F, x + 1300, y + 300)
    east, north = wgs84_to_utm(F, *mercator_to_wgs84(F, x, y), F.col("sepsg") % 100, 0.0)
    return s.withColumns({"xmin": xmin, "xmax": xmax, "ymin": ymin, "ymax": ymax, "sx0": F.floor(east / 100) * 100.0 - 200 + F.col("scene_id") % 7 * 100, "sy0": F.ceil(north / 100) * 100.0 + 200, "sscale": F.lit(100.0)})


def warp_values(scene, r, c):
    """b0, b02 and scl of a cell."""
    return {"b0": F.when((scene * 7 + r * 3 + c * 5) % 4 == 0, 0).otherwise(1 + (scene * 37 + r * 101 + c * 59) % 9999).cast("int"), "b02": ((scene * 41 + r * 7 + c * 11) % 10000).cast("int"), "scl": ((scene * 11 + r * 5 + c * 3) % 12).cast("int")}


def _chunk_values(scene: np.ndarray, r: np.ndarray, c: np.ndarray) -> dict[str, np.ndarray]:
    """warp_values() of many cells; every eleventh scene has nothing in b02."""
    b0 = np.where((scene * 7 + r * 3 + c * 5) % 4 == 0, 0, 1 + (scene * 37 + r * 101 + c * 59) % 9999)
    return {"b0": b0, "b02": np.where(scene % 11 == 0, 0, (scene * 41 + r * 7 + c * 11) % 10000), "scl": (scene * 11 + r * 5 + c * 3) % 12}


def warp_chunks(spark, sf_dir, bands: tuple = ("b0", "b02", "scl")) -> DataFrame:
    """The rasters as chunks with an array for each band; every eleventh scene has nothing in b02."""
    places = [(cr, cc, min(CHUNK, ROWS - cr * CHUNK), min(CHUNK, COLS - cc * CHUNK)) for cr in range((ROWS - 1) // CHUNK + 1) for cc in range((COLS - 1) // CHUNK + 1)]
    at = [(cr * CHUNK + i, cc * CHUNK + j) for cr, cc, h, w in places for i in range(h) for j in range(w)]
    r, c = (np.array(x, dtype=np.int64)[None, :] for x in zip(*at, strict=True))
    sizes = np.array([h * w for _, _, h, w in places])

    def run(batches):
        for b in batches:
            scene = b.column("scene_id").to_numpy()
            values = _chunk_values(scene[:, None], r, c)
            place = [pa.array(np.tile(np.array(x, dtype=np.int32), len(scene))) for x in zip(*places, strict=True)]
            ends = pa.array(np.concatenate([[0], np.cumsum(np.tile(sizes, len(scene)))]).astype(np.int32))
            arrays = [pa.ListArray.from_arrays(ends, pa.array(values[k].ravel().astype(np.int32))) for k in bands]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(scene, len(places))), *place, *arrays], ["scene_id", "chunk_row", "chunk_col", "h", "w", *bands])

    s = dealt(spark, sf_dir, ROWS * COLS).select("scene_id")
    return s.mapInArrow(run, "scene_id bigint, chunk_row int, chunk_col int, h int, w int, " + ", ".join(f"{b} array<int>" for b in bands))


def _warp_sql() -> str:
    """Up to warped(tile_id, step_no, idx, scene_id, r, c, b0, b02, scl), by the closed forms cell by cell; values come from
    their formulas, which stand for the source rasters."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    a = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996
    e = 2 * n**0.5 / (1 + n)
    alpha = [n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3, 13 / 48 * n**2 - 3 / 5 * n**3, 61 / 240 * n**3]
    d = lambda v: f"{v!r}::double"
    lonlat = lambda x, y: (f"degrees(({x}) / 6378137.0::double)", f"degrees(2 * atan(exp(({y}) / 6378137.0::double)) - pi() / 2)")

    def utm(source: str, out: str, x: str, y: str) -> str:
        lon, lat = lonlat(x, y)
        series = lambda f, g: " + ".join(f"{d(v)} * {f}({2 * j} * xi) * {g}({2 * j} * eta)" for j, v in enumerate(alpha, 1))
        return (
            f"{out}_1 as (select *, sin(radians({lat})) as si, radians({lon} - ((sepsg % 100) * 6 - 183)) as la from {source}), {out}_2 as (select *, sinh(atanh(si) - {d(e)} * atanh({d(e)} * si)) as tt from {out}_1), "
            f"{out}_3 as (select *, atan2(tt, cos(la)) as xi, atanh(sin(la) / sqrt(1 + tt * tt)) as eta from {out}_2), "
            f"{out} as (select * exclude (si, la, tt, xi, eta), 500000 + {d(a)} * (eta + {series('cos', 'sinh')}) as ee, {d(a)} * (xi + {series('sin', 'cosh')}) as nn from {out}_3)"
        )

    b0, b02, scl = "case when (scene_id * 7 + {r} * 3 + {c} * 5) % 4 = 0 then 0 else 1 + (scene_id * 37 + {r} * 101 + {c} * 59) % 9999 end", "case when scene_id % 11 = 0 then 0 else (scene_id * 41 + {r} * 7 + {c} * 11) % 10000 end", "(scene_id * 11 + {r} * 5 + {c} * 3) % 12"
    at = lambda v: v.format(r="r", c="c")
    (w, s), (east, north) = lonlat("x", "y - 720"), lonlat("x + 960", "y")
    (xmin, ymin), (xmax, ymax) = lonlat("x - 300", "y - 1200"), lonlat("x + 1300", "y + 300")
    mean = lambda b: f"coalesce(round(sum(k * {b}) filter (where {b} <> 0) / sum(k) filter (where {b} <> 0))::int, 0)"
    return f"""{SCENE}, {STEP}, wt as (select *, (32629 + scene_id % 2)::int as sepsg, -668000 + (tile_id % 12) * 1000.0::double as x, 4680000 - (tile_id // 12) * 1000.0::double as y from scene),
 {utm("wt", "wo", "x", "y")},
 ws as (select scene_id, sensing_time, sepsg, floor(ee / 100) * 100 - 200 + scene_id % 7 * 100 as sx0, ceil(nn / 100) * 100 + 200 as sy0, {xmin} as bx0, {ymin} as by0, {xmax} as bx1, {ymax} as by1 from wo),
 wa as (select distinct tile_id, x, y, {w} as west, {s} as south, {east} as east, {north} as north from wt),
 wm as (select tile_id, x, y, scene_id, sepsg, sx0, sy0, step_no, row_number() over (partition by tile_id, step_no order by sensing_time desc, scene_id)::int as idx from wa join ws on bx0 <= east and bx1 >= west and by0 <= north and by1 >= south join step on sensing_time >= step_start and sensing_time <= step_end),
 wc as (select tile_id, scene_id, sepsg, sx0, sy0, step_no, idx, i::int as r, j::int as c, x + (j + 0.5::double) * 120 as x, y - (i + 0.5::double) * 120 as y from wm, range(6) t(i), range(8) u(j) where idx <= 3),
 {utm("wc", "wp", "x", "y")},
 wr as (select tile_id, step_no, idx, scene_id, r as tr, c as tc, (sy0 - nn) / 100 as row, (ee - sx0) / 100 as col from wp),
 wk as (select *, ceil(row - 1.5::double)::bigint + i as r, ceil(col - 1.5::double)::bigint + j as c from wr, range(3) t(i), range(3) u(j)),
 wv as (select *, greatest(1 - abs(r + 0.5::double - row), 0) * greatest(1 - abs(c + 0.5::double - col), 0) as k, {at(b0)} as b0, {at(b02)} as b02 from wk where r between 0 and 11 and c between 0 and 9),
 wb as (select tile_id, step_no, idx, scene_id, tr, tc, {mean("b0")} as b0, {mean("b02")} as b02 from wv where k > 0 group by all),
 wn as (select *, floor(row)::bigint as r, floor(col)::bigint as c from wr),
 warped as (select wn.tile_id, wn.step_no, wn.idx, wn.scene_id, wn.tr as r, wn.tc as c, inside, case when inside then coalesce(b0, 0) else 0 end as b0, case when inside then coalesce(b02, 0) else 0 end as b02, case when inside then {scl.format(r="wn.r", c="wn.c").replace("scene_id", "wn.scene_id")} else 0 end::int as scl
  from (select *, r between 0 and 11 and c between 0 and 9 as inside from wn) wn left join wb on wb.tile_id = wn.tile_id and wb.step_no = wn.step_no and wb.scene_id = wn.scene_id and wb.tr = wn.tr and wb.tc = wn.tc)"""


WARP = _warp_sql()
