"""Queries over the driver's tables, each with DuckDB SQL written from the sequential definition where that is short."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from eocube.functions import cells as fc
from eocube.functions import clouds, dates, links, lookups
from eocube.operators import boxes, collect, grid, intervals, mosaic, regions, samples, search, stats, training, warp, windows
from eocube.sources import fixtures as fx
from eocube.sources import rasters
from eocube.sources import scenes as scene_source

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
B = ["b0", "b02", "b04", "b08"]
BL = ", ".join(B)


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def steps(spark):
    items = spark.sql("select date'2024-01-01' as start, date'2024-01-30' as `end`")
    return dates.time_steps(items, "weeks", 1).drop("start", "end")


def stepped(spark, d):
    """Scenes of each step, dealt out by tile and step for 16 cells each."""
    return search.assign_steps(fx.scenes(spark, d), steps(spark)).repartition(fx.tasks(spark, d), "tile_id", "step_no")


def ranked(spark, d):
    return search.rank_scenes(search.rank_scenes(stepped(spark, d)), "cloud_cover", "idc")


def by_scene(spark, d):
    """Cells without ranks, those of a scene in one task."""
    return fx.cells(search.assign_steps(fx.scenes(spark, d), steps(spark)).repartition(fx.tasks(spark, d), "scene_id"))


def cells(spark, d):
    return fx.cells(ranked(spark, d))


_scene = f"with {fx.SCENE} "
_ranked = f"with {fx.RANKED} "
_cell = f"with {fx.CELL} "
_plain = "scene_id, id, collection_id, tile_id, sensing_time, platform, cloud_cover"
_cols = [x.strip() for x in _plain.split(",")]

query("s1_scene_columns", _scene + "select id, collection_id, sensing_time, platform, cloud_cover, (32600 + tile_id % 60 + 1)::int as epsg from scene")(
    lambda s, d: scene_source.scene_columns(
        fx.scenes(s, d).select("id", "collection_id", F.col("sensing_time").alias("datetime"), F.to_json(F.struct("platform", F.col("cloud_cover").alias("eo:cloud_cover"), (32601 + F.col("tile_id") % 60).cast("int").alias("proj:epsg"))).alias("properties"))
    )
)
query("f1_bbox", _scene + f"select {_plain} from scene where xmin <= 5000 and xmax >= 2000 and ymin <= 4000 and ymax >= 1000")(lambda s, d: search.intersects_bbox(fx.scenes(s, d), 2000, 1000, 5000, 4000).select(*_cols))
query("f2_platform", _scene + f"select {_plain} from scene where platform in ('sentinel-2a','sentinel-2b','sentinel-2c','sentinel-2d')")(lambda s, d: search.filter_platform(fx.scenes(s, d), "SENTINEL_2").select(*_cols))
query("f3_collection", _scene + f"select {_plain} from scene where collection_id in ('sentinel-s2-l2a','sentinel-s2-l2a-cogs')")(lambda s, d: search.filter_collection(fx.scenes(s, d), "SENTINEL_2", "L2A").select(*_cols))
query("f4_dates", _scene + f"select {_plain} from scene where sensing_time >= timestamp '2024-01-05' and sensing_time <= timestamp '2024-01-09'")(lambda s, d: search.filter_dates(fx.scenes(s, d), "2024-01-05", "2024-01-09").select(*_cols))
query("f5_cloud", _scene + f"select {_plain} from scene where cloud_cover < 20")(lambda s, d: search.filter_cloud(fx.scenes(s, d), 20).select(*_cols))
_dedup = "(select * from (select *, row_number() over (partition by id order by collection_id desc, scene_id) as n from {}) where n = 1)"
query("f6_search_l2a", _scene + f", hit as (select * from scene where xmin <= 9000 and xmax >= 0 and ymin <= 9000 and ymax >= 0 and platform in ('sentinel-2a','sentinel-2b') and sensing_time >= timestamp '2024-01-02' and sensing_time <= timestamp '2024-01-20' and cloud_cover < 60) select {_plain} from {_dedup.format('hit')} order by sensing_time desc, scene_id limit 100")(
    lambda s, d: search.search(fx.scenes(s, d), "SENTINEL_2", "L2A", "2024-01-02", "2024-01-20", 60, (0, 0, 9000, 9000), 100).select(*_cols)
)


def catalogue(spark, d):
    """The scenes with collections of all platforms, as a catalogue of more than one kind has them."""
    landsat = F.col("platform").like("LANDSAT%")
    return fx.scenes(spark, d).withColumn("collection_id", F.when(landsat, "landsat-c2l2-sr").when(F.col("scene_id") % 5 == 0, "sentinel-s2-l1c").otherwise(F.col("collection_id")))


_catalogue = _scene + ", catalogue as (select * replace (case when platform like 'LANDSAT%' then 'landsat-c2l2-sr' when scene_id % 5 = 0 then 'sentinel-s2-l1c' else collection_id end as collection_id) from scene)"
query("f3_collection_mixed", _catalogue + f" select {_plain} from catalogue where collection_id in ('landsat-c2l2-sr', 'sentinel-s2-l1c')")(lambda s, d: search.filter_collection(catalogue(s, d), ["LANDSAT_8", "SENTINEL_2"]).select(*_cols))
query("f6_search_landsat", _catalogue + f" select {_plain} from catalogue where platform in ('LANDSAT_7', 'LANDSAT_8') and collection_id = 'landsat-c2l2-sr' and sensing_time >= timestamp '2024-01-02' and cloud_cover < 50 order by cloud_cover, scene_id limit 200")(
    lambda s, d: search.search(catalogue(s, d), ["LANDSAT_7", "LANDSAT_8"], start="2024-01-02", most_cloud=50, limit=200, sort="cloud_cover").select(*_cols)
)
query("f6_search_l1c", _catalogue + f" select {_plain} from catalogue where platform in ('sentinel-2a','sentinel-2b') and collection_id = 'sentinel-s2-l1c' and sensing_time <= timestamp '2024-01-25'")(lambda s, d: search.search(catalogue(s, d), "SENTINEL_2", "L1C", end="2024-01-25").select(*_cols))
query("w1_dedup_scenes", _scene + f"select {_plain} from {_dedup.format('scene')}")(lambda s, d: search.dedup_scenes(fx.scenes(s, d)).select(*_cols))
query("w2_rank_scenes", _ranked + "select scene_id, step_no, idx, idc from ranked")(lambda s, d: ranked(s, d).select("scene_id", "step_no", "idx", "idc"))
query("j2_assign_steps", _ranked + "select scene_id, step_no, step_start, step_end from ranked join step using (step_no)")(lambda s, d: search.assign_steps(fx.scenes(s, d), steps(s)).select("scene_id", "step_no", "step_start", "step_end"))
query("k2_limit_scenes", _ranked + "select scene_id, step_no, idx from ranked where idx <= 3")(lambda s, d: search.limit_scenes(ranked(s, d), 3).select("scene_id", "step_no", "idx"))
query("j1_match_scenes", f"with {fx.SCENE}, {fx.RECT} select r.id as area_id, scene_id from rect r join scene s on s.xmin <= r.xmax * 10 and s.xmax >= r.xmin * 10 and s.ymin <= r.ymax * 10 and s.ymax >= r.ymin * 10")(
    lambda s, d: search.match_scenes(fx.rectangles(s, d).select(F.col("id").alias("area_id"), *[(F.col(k) * 10).alias(f"a_{k}") for k in ("xmin", "ymin", "xmax", "ymax")]), fx.scenes(s, d)).select("area_id", "scene_id")
)
query("f10_drop_empty_scenes", _cell + ", e as (select tile_id, step_no, scene_id from cell group by all having max(abs(b0)) > 0 and max(abs(b02)) > 0) select tile_id, step_no, scene_id, count(*) as n from cell join e using (tile_id, step_no, scene_id) group by all")(
    lambda s, d: search.drop_empty_scenes(cells(s, d), ["b0", "b02"]).groupBy("tile_id", "step_no", "scene_id").agg(F.count("*").alias("n"))
)

# Mosaics
_first = _cell + ", x as (select *, row_number() over (partition by tile_id, step_no, r, c order by (b0 = 0), case when b0 = 0 then -{i} else {i} end) as k from cell) select tile_id, step_no, r, c, " + BL + " from x where k = 1"


def mosaic_latest_weekly(spark, d):
    return mosaic.drop_empty_steps(mosaic.first_valid(cells(spark, d), B), "b0")


query("mosaic_latest_weekly", _first.format(i="idx") + " qualify max(abs(b0)) over (partition by tile_id, step_no) > 0")(mosaic_latest_weekly)
query("m1_first_valid", _first.format(i="idx"))(lambda s, d: mosaic.first_valid(cells(s, d), B))
query("m2_cloud_sorted", _first.format(i="idc"))(lambda s, d: mosaic.first_valid(cells(s, d), B, "idc"))
query("m3_all_scenes", _cell + f"select scene_id, tile_id, step_no, r, c, {BL} from cell")(lambda s, d: mosaic.all_scenes(cells(s, d), B))
_SCL = "{scl} in (0,1,3,7,8,9,10)"


def _sieve_sql(source: str, item: str) -> str:
    """Common table expressions up to sieved(item, r, c, m): neighbours by windows along rows and columns of full grids."""
    down, right = "over (partition by item, c order by r)", "over (partition by item, r order by c)"
    return (
        f"sv_m as (select {item} as item, r, c, m from {source}), "
        f"sv_n as (select *, coalesce((lag(m) {down} = m)::int, 0) as up, coalesce((lead(m) {down} = m)::int, 0) as dn, coalesce((lag(m) {right} = m)::int, 0) as lf, coalesce((lead(m) {right} = m)::int, 0) as rt from sv_m), "
        "sv_d as (select *, up + dn + lf + rt as n from sv_n), "
        f"sv_p as (select *, case when up = 1 then lag(n) {down} when dn = 1 then lead(n) {down} when lf = 1 then lag(n) {right} else lead(n) {right} end as other from sv_d), "
        "sieved as (select item, r, c, case when n = 0 or (n = 1 and other = 1) then 1 - m else m end as m from sv_p)"
    )


def _residual_sql(cloud: str, more: str = "", source: str = "cell") -> str:
    return _composite_sql(cloud, more, source).rsplit(", s as", 1)[0] + " select tile_id, step_no, idx, round(avg(mask::int), 6)::double as share, count(*) filter (where b0 = 0) as empty from v group by all"


def _composite_sql(cloud: str, more: str = "", source: str = "cell") -> str:
    """Fill, mask and stop, told by the index of the scene that last filled a cell."""
    return (
        f"with {fx.CELL}{more}, o as (select tile_id, step_no, r, c, idx, {BL}, ({cloud}) as cloud from {source}), "
        "p as (select *, coalesce(bool_and(cloud) over (partition by tile_id, step_no, r, c order by idx rows between unbounded preceding and 1 preceding), true) as open, bool_and(cloud) over (partition by tile_id, step_no, r, c order by idx) as mask from o), "
        f"q as (select *, max(case when idx = 1 or (open and b0 <> 0) then idx end) over (partition by tile_id, step_no, r, c order by idx) as src from p), "
        "v as (select q.tile_id, q.step_no, q.r, q.c, q.idx, q.mask, " + ", ".join(f"o.{b}" for b in B) + " from q join o on o.tile_id = q.tile_id and o.step_no = q.step_no and o.r = q.r and o.c = q.c and o.idx = q.src), "
        "s as (select tile_id, step_no, idx from v group by all having count(*) filter (where b0 = 0) = 0 and avg(mask::int) <= 0.05), "
        "e as (select tile_id, step_no, coalesce(min(s.idx), max(v.idx)) as stop from v left join s using (tile_id, step_no) group by all) "
        f"select tile_id, step_no, r, c, {BL} from v join e using (tile_id, step_no) where idx = stop"
    )


query("m4_composite_scl", _composite_sql(_SCL.format(scl="scl")))(lambda s, d: mosaic.composite(cells(s, d), B, fc.scl_cloud("scl")))
query("m4_composite_scl_early", _composite_sql(_SCL.format(scl="scl_clear")))(lambda s, d: mosaic.composite(cells(s, d), B, fc.scl_cloud("scl_clear")))
_QA = ", flag as (select scene_id, r, c, ((qa & 27) <> 0)::int as m from cell), " + _sieve_sql("flag", "scene_id") + ", qcell as (select cell.*, sieved.m from cell join sieved on scene_id = item and sieved.r = cell.r and sieved.c = cell.c)"
query("m5_composite_qa", _composite_sql("m = 1", _QA, "qcell"))(lambda s, d: mosaic.composite_qa(cells(s, d), B, "qa"))
query("a11_residual_by_scene", _residual_sql(_SCL.format(scl="scl")))(lambda s, d: mosaic.residual_by_scene(cells(s, d), B, fc.scl_cloud("scl")).withColumn("share", F.round("share", 6)))


def without_added_band(s, d):
    """Composites of bands that leave the mask band to the method, which is read with them and taken out again."""
    asked = mosaic.with_mask_band(B, "scl")
    read = cells(s, d).select("idx", *mosaic.CELL, *asked)  # only what is asked for is read
    return mosaic.without_mask_band(mosaic.composite(read, asked, fc.scl_cloud("scl")), B, "scl")


query("u5_mask_band", _composite_sql(_SCL.format(scl="scl")))(without_added_band)
_RANK = "list_value(" + ", ".join(str(mosaic.SCL_RANK.index(i)) for i in range(12)) + ")[scl + 1]"
query("m6_composite_full", _cell + f", x as (select *, row_number() over (partition by tile_id, step_no, r, c order by {_RANK} + (1 - case when b08 + b04 = 0 then 1.0 else (b08 - b04)::double / (b08 + b04) end) / 100, idx) as k from cell) select tile_id, step_no, r, c, {BL} from x where k = 1")(
    lambda s, d: mosaic.composite_full(cells(s, d), B, mosaic.full_score("scl", "b04", "b08"))
)
query("g10_sieve", _cell + ", flag as (select scene_id, r, c, (scl in (0,1,3,7,8,9,10))::int as m from cell), " + _sieve_sql("flag", "scene_id") + " select item, r, c, m from sieved")(
    lambda s, d: mosaic.sieve(by_scene(s, d).select(F.col("scene_id").alias("item"), "r", "c", fc.scl_cloud("scl").cast("int").alias("m")))
)


def speckled(s, d):
    """A mask of 12 x 10 cells for each scene, of 7 densities, with single cells, pairs and larger regions."""
    m = "cast(scene_id % 7 + 2 > pmod(scene_id * 31 + r * r * 7 + c * c * 5 + r * c * (scene_id % 11 + 3), 11) as int)"
    return fx.dealt(s, d, 120).select(F.col("scene_id").alias("item"), "scene_id", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("r")).select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("c")).selectExpr("item", "r", "c", f"{m} as m")


#: Regions by reaching every cell from every other, then sizes, the neighbour that is largest and met first, and chains.
_REGIONS = (
    f"with recursive {fx.SCENE}, mk as (select scene_id as item, r, c, (scene_id % 7 + 2 > (scene_id * 31 + r * r * 7 + c * c * 5 + r * c * (scene_id % 11 + 3)) % 11)::int as m from scene, (select i::int as r from range(12) t(i)), (select i::int as c from range(10) t(i))), "
    "nb as (select a.item, a.r * 10 + a.c as p, b.r * 10 + b.c as q, a.m = b.m as same, a.r * 20 + a.c * 2 + (a.r = b.r)::int as at from mk a join mk b on a.item = b.item and ((b.r = a.r - 1 and b.c = a.c) or (b.r = a.r and b.c = a.c - 1))), "
    "ln as (select item, p, q from nb where same union all select item, q, p from nb where same), "
    "rc as (select item, r * 10 + c as p, r * 10 + c as f from mk union select ln.item, ln.q, rc.f from rc join ln on ln.item = rc.item and ln.p = rc.p where ln.q > rc.f), "
    "lb as (select item, p, min(f) as region from rc group by all), sz as (select lb.item, region, count(*) as n, any_value(m) as m from lb join mk on mk.item = lb.item and r * 10 + c = p group by all) "
)
query("g10_label_regions", _REGIONS + "select mk.item, r, c, mk.m, n as region_cells, lb.region // 10 as first_r, lb.region % 10 as first_c from mk join lb on lb.item = mk.item and r * 10 + c = p join sz on sz.item = lb.item and sz.region = lb.region")(
    lambda s, d: first_cells(regions.label_regions(speckled(s, d), size=5))
)


def first_cells(labelled):
    """Regions told by their first cell in the order of reading, which is their label."""
    return labelled.select("item", "r", "c", "m", "region_cells", F.shiftright("region", 32).alias("first_r"), F.col("region").bitwiseAND(0xFFFFFFFF).alias("first_c"))


_MERGED = _REGIONS + (
    ", bd as (select nb.item, x.region as a, y.region as b, nb.at as \"at\" from nb join lb x on x.item = nb.item and x.p = nb.p join lb y on y.item = nb.item and y.p = nb.q where not same), "
    "be as (select item, a, b, min(\"at\") as \"at\" from (select item, a, b, \"at\" from bd union all select item, b as a, a as b, \"at\" from bd) group by all), "
    "nx as (select be.item, a, b, row_number() over (partition by be.item, a order by n desc, \"at\") as k from be join sz on sz.item = be.item and region = b), "
    "ch as (select item, region as a, region as cur, 0 as step from sz where n < {threshold} union all select ch.item, ch.a, nx.b, step + 1 from ch join nx on nx.item = ch.item and nx.a = ch.cur and k = 1 join sz on sz.item = ch.item and sz.region = ch.cur where sz.n < {threshold} and step < 60), "
    "ed as (select ch.item, ch.a, sz.m from ch join sz on sz.item = ch.item and sz.region = ch.cur where sz.n >= {threshold}) "
    "select mk.item, r, c, coalesce(ed.m, mk.m) as m from mk join lb on lb.item = mk.item and r * 10 + c = p left join ed on ed.item = lb.item and ed.a = lb.region"
)
query("g10_sieve_merge", _MERGED.format(threshold=3))(lambda s, d: regions.sieve_regions(speckled(s, d), 3, size=5))
query("g10_sieve_merge_wide", _MERGED.format(threshold=12))(lambda s, d: regions.sieve_regions(speckled(s, d), 12, size=5))

# Statistics
query("a1_a3_value_counts", f"with {fx.LABEL} select item_id, value, count(*) as n from label group by grouping sets ((item_id, value), (value))")(lambda s, d: stats.value_counts(fx.labels(s, d)))
query("a2_histogram", _scene + "select least(floor(cloud_cover / 10), 9)::int as bin, count(*) as n from scene where cloud_cover between 0 and 100 group by all")(lambda s, d: stats.histogram(fx.scenes(s, d), "cloud_cover"))
query("a4_nodata_count", f"with {fx.LABEL} select item_id, count(*) filter (where value = 0) as nodata, count(*) filter (where value <> 0) as valid from label group by all")(lambda s, d: stats.nodata_counts(fx.labels(s, d), ["item_id"], "value", 0))
query("a5_class_weights", f"with {fx.LABEL}, n as (select value, count(*) as n from label where value <> 0 group by all) select value, n, round(sum(n) over () / (count(*) over () * n), 6)::double as weight from n")(
    lambda s, d: stats.class_weights(fx.labels(s, d).groupBy("value").agg(F.count("*").alias("n")), 0).withColumn("weight", F.round("weight", 6))
)
query("a6_extent", _scene + "select min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax, min(sensing_time) as first, max(sensing_time) as last from scene")(lambda s, d: stats.extent(fx.scenes(s, d), "sensing_time"))
query("a9_a10_per_image", _cell + "select tile_id, step_no, scene_id, sum((b0 = 0)::int + (b02 = 0)::int)::bigint as nodata, sum((scl in (0,1,3,7,8,9,10))::int)::bigint as clouds from cell group by all")(
    lambda s, d: stats.image_quality(cells(s, d), ["tile_id", "step_no", "scene_id"], ["b0", "b02"], fc.scl_cloud("scl"))
)
query("a12_temporal_stats", _cell + ", v as (select * from cell where b0 <> 0) select tile_id, step_no, r, c, round(avg(b02), 6) as mean, min(b02) as low, max(b02) as high, arg_min(idx, (b02, idx)) as at_low, arg_min(idx, (-b02, idx)) as at_high from v group by all union all select tile_id, step_no, r, c, null, null, null, null, null from cell group by all having count(*) filter (where b0 <> 0) = 0")(
    lambda s, d: stats.temporal_stats(cells(s, d), "b02", F.col("b0") == 0).withColumn("mean", F.round("mean", 6))
)
for _how, _sql in {"sum": "sum(v)", "count": "count(v)", "mean": "round(avg(v), 6)", "first": "arg_min(v, file_order)"}.items():
    query(f"a13_merge_{_how}", f"with {fx.RASTER} select r, c, {_sql} as v from raster where v <> 1 group by all")(lambda s, d, how=_how: stats.merge_rasters(fx.rasters(s, d), how, 1).withColumn("v", F.round("v", 6) if how == "mean" else F.col("v")))
query("a18_pyramid", f"with {fx.RASTER}, m as (select r, c, sum(v) as v from raster where v <> 1 group by all) select f::int as factor, (r // f)::int as r, (c // f)::int as c, round(avg(v), 6) as v from m, (select unnest([2, 4, 8, 16, 32]) as f) group by all")(
    lambda s, d: stats.pyramid(stats.merge_rasters(fx.rasters(s, d), "sum", 1), stats.overview_factors(50, 50)).withColumn("v", F.round("v", 6))
)
query("a18_pyramid_nearest", f"with {fx.RASTER}, m as (select r, c, count(v) as v from raster where v <> 1 group by all) select f::int as factor, (r // f)::int as r, (c // f)::int as c, v from m, (select unnest([2, 4, 8, 16, 32]) as f) where r = r // f * f and c = c // f * f")(
    lambda s, d: stats.pyramid(stats.merge_rasters(fx.rasters(s, d), "count", 1), stats.overview_factors(50, 50), nearest=True)
)
query("j4_overlapping_pairs", f"with {fx.RECT} select a.id as a_id, b.id as b_id from rect a join rect b on a.id < b.id and a.xmin < b.xmax and b.xmin < a.xmax and a.ymin < b.ymax and b.ymin < a.ymax and not (a.xmin <= b.xmin and a.ymin <= b.ymin and a.xmax >= b.xmax and a.ymax >= b.ymax) and not (b.xmin <= a.xmin and b.ymin <= a.ymin and b.xmax >= a.xmax and b.ymax >= a.ymax)")(lambda s, d: stats.overlapping_pairs(fx.rectangles(s, d)))

# Dates and incremental collection
_MONTHS = "with recursive it as (select distinct o_custkey as item, date '1995-01-31' + ((o_custkey % 50) * 7)::int as start, date '1996-06-30' as fin from orders), st as (select item, fin, 0 as step_no, start as a, (start + interval 1 month)::date as b from it union all select item, fin, step_no + 1, (a + interval 1 month)::date, (b + interval 1 month)::date from st where b - 1 <= fin), step as (select item, step_no, a as step_start, b - 1 as step_end from st where b - 1 <= fin)"


def monthly(spark, d):
    orders = fx.table(spark, d, "orders")  # an item's few bytes become many steps, so tasks are told
    o = orders.select(F.col("o_custkey").alias("item")).repartition(max(spark.sparkContext.defaultParallelism, orders.count() >> 17), "item").distinct()
    items = o.select("item", F.date_add(F.lit("1995-01-31").cast("date"), (F.col("item") % 50 * 7).cast("int")).alias("start"), F.lit("1996-06-30").cast("date").alias("end"))
    return dates.time_steps(items, "months", 1).drop("start", "end")


def missing(spark, d):
    have = fx.table(spark, d, "orders").select(F.col("o_custkey").alias("item"), F.col("o_orderdate").cast("date").alias("date"))
    return stats.missing_steps(monthly(spark, d), have)


_MISSING = _MONTHS + ", miss as (select * from step s where not exists (select 1 from orders o where o.o_custkey = s.item and o.o_orderdate::date between s.step_start and s.step_end))"
query("x1_time_steps", _MONTHS + " select * from step")(monthly)
query("j6_missing_steps", _MISSING + " select * from miss")(missing)
query("w6_time_bubbles", _MISSING + ", k as (select *, step_no - row_number() over (partition by item order by step_no) as k from miss) select item, min(step_start) as start, max(step_end) as \"end\" from k group by item, k")(lambda s, d: stats.time_bubbles(missing(s, d)))
query("x1_daily_steps", "with it as (select n_nationkey as item, date '1972-07-23' + n_nationkey::int as start, date '2026-01-01' as fin from nation), s as (select item, start, fin, unnest(range(0, datediff('day', start, fin) + 1)) as step_no from it) select item, step_no::int as step_no, start + step_no::int as step_start, start + step_no::int as step_end from s")(
    lambda s, d: dates.time_steps(fx.table(s, d, "nation").select(F.col("n_nationkey").alias("item"), F.date_add(F.lit("1972-07-23").cast("date"), F.col("n_nationkey").cast("int")).alias("start"), F.lit("2026-01-01").cast("date").alias("end")), "days", 1).drop("start", "end")
)


def mixed_steps(s, d):
    """Daily, monthly and one step of all time, over the same 53 years."""
    it = s.sql("select date'1972-07-23' as start, date'2026-01-01' as `end`")
    daily, monthly_, whole = (dates.time_steps(it, k, 1).drop("start", "end").withColumn("kind", F.lit(k)) for k in ("days", "months", "all"))
    return daily.unionByName(monthly_).unionByName(whole)


query("j2_mixed_steps", "with s as (select 'days' as kind, i::int as step_no, date '1972-07-23' + i::int as a, date '1972-07-23' + i::int as b from range(date '2026-01-01' - date '1972-07-23' + 1) t(i) union all select 'months', i::int, (date '1972-07-23' + to_months(i::int))::date, (date '1972-07-23' + to_months((i + 1)::int))::date - 1 from range(700) t(i) where (date '1972-07-23' + to_months((i + 1)::int))::date - 1 <= date '2026-01-01' union all select 'all', 0, date '1972-07-23', date '2026-01-01') select kind, step_no, count(*) as n, min(o_orderkey) as least from s join orders on o_orderdate::date between a and b group by all")(
    lambda s, d: intervals.days_in_intervals(fx.table(s, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date")), F.col("date"), mixed_steps(s, d)).groupBy("kind", "step_no").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least"))
)
_SIZES = "select {k} as id, ({k} * 7919 % 100003 * 10)::double as x, ({k} * 104729 % 99991 * 10)::double as y, pow(10, {k} % 7)::double as side from {t}"


def sized_boxes(s, d, table, key, prefix=""):
    """Boxes with sides from 1 to a million."""
    k = F.col(key)
    x, y, side = (k * 7919 % 100003 * 10).cast("double"), (k * 104729 % 99991 * 10).cast("double"), F.pow(F.lit(10.0), k % 7)
    return fx.table(s, d, table).select(k.alias(f"{prefix}id"), *[v.alias(prefix + n) for n, v in zip(boxes.SIDES, (x, y, x + side, y + side), strict=True)])


query("j1_many_sizes", f"with a as ({_SIZES.format(k='c_custkey', t='customer')}), b as ({_SIZES.format(k='s_suppkey', t='supplier')}) select a.id as a_id, b.id as id from a join b on a.x <= b.x + b.side and b.x <= a.x + a.side and a.y <= b.y + b.side and b.y <= a.y + a.side")(
    lambda s, d: boxes.meeting(sized_boxes(s, d, "customer", "c_custkey", "a_"), sized_boxes(s, d, "supplier", "s_suppkey")).select("a_id", "id")
)
query("x2_default_start", "select o_orderkey, coalesce(o_orderdate::date - 31, date '1972-07-23') as start from orders")(lambda s, d: fx.table(s, d, "orders").select("o_orderkey", dates.default_start(F.col("o_orderdate").cast("date")).alias("start")))

# Links
_URL = "https://sentinel-cogs.s3.us-west-2.amazonaws.com/sentinel-s2-l2a-cogs/29/S/ND/{y}/{m}/S2B_29SND_{d}_0_L2A/B06.tif"


def urls(spark, d):
    t = F.col("o_orderdate").cast("date")
    head, tail = _URL.split("{y}")[0], "_0_L2A/B06.tif"
    return fx.table(spark, d, "orders").select("o_orderkey", F.concat(F.lit(head), F.year(t), F.lit("/"), F.month(t), F.lit("/S2B_29SND_"), F.date_format(t, "yyyyMMdd"), F.lit(tail)).alias("url"))


_URLS = "with u as (select o_orderkey, o_orderdate::date as t from orders)"
query("x7_cog_to_jp2", _URLS + " select o_orderkey, 's3://sentinel-s2-l2a/tiles/29/S/ND/' || year(t) || '/' || month(t) || '/' || day(t) || '/0/R20m/B06.jp2' as url from u")(lambda s, d: urls(s, d).select("o_orderkey", links.cog_to_jp2(F.col("url")).alias("url")))



def mixed_urls(s, d):
    """COG links, JP2 links and links of neither store, by the key."""
    u, k = F.col("url"), F.col("o_orderkey") % 3
    return urls(s, d).withColumn("url", F.when(k == 1, links.cog_to_jp2(u)).when(k == 2, F.replace(u, F.lit("sentinel"), F.lit("other"))).otherwise(u))


query("x6_url_kind", _URLS + " select o_orderkey, o_orderkey % 3 = 0 as cog, o_orderkey % 3 = 1 as jp2 from u")(lambda s, d: mixed_urls(s, d).select("o_orderkey", links.is_cog_url(F.col("url")).alias("cog"), links.is_jp2_url(F.col("url")).alias("jp2")))
query("s14_s15_paths", _URLS + " select o_orderkey, 'zip' as scheme, 'a/b.zip' as archive, t as date, strftime(t, '%Y_%m_%d') as item from u")(
    lambda s, d: fx.table(s, d, "orders").select("o_orderkey", F.concat(F.lit("zip://a/b.zip!/"), F.date_format("o_orderdate", "yyyy_MM_dd"), F.lit(".tif")).alias("p"))
    .select("o_orderkey", links.parse_path(F.col("p"))["scheme"].alias("scheme"), links.parse_path(F.col("p"))["archive"].alias("archive"), dates.date_from_path(F.col("p")).alias("date"), links.item_id_from_path(F.col("p")).alias("item"))
)

# Cells
_N = {
    "ndvi": ("b08-b04", "b08+b04"), "ndmi": ("b08-b11", "b08+b11"), "ndwi1": ("b03-b11", "b03+b11"), "ndwi2": ("b03-b08", "b03+b08"), "nhi": ("b11-b03", "b11+b03"),
    "nbr": ("b08-b12", "b08+b12"), "bai": ("b02-b08", "b08+b02"), "chlorogreen": ("b08", "b03+b05"),
}
_PICTURES = {"infrared": ("b08", "b04", "b03"), "rgb": ("b04", "b03", "b02"), "swi": ("b12", "b08", "b04"), "agriculture": ("b11", "b08", "b02"), "geology": ("b12", "b11", "b02"), "bathymetric": ("b04", "b03", "b01")}
query("x20_indices", _cell + "select scene_id, r, c, " + ", ".join(f"({a})::double / nullif({b}, 0) as {k}" for k, (a, b) in _N.items()) + ", (b08-b04)::double / (b08+b04+0.5::double) * 1.5::double as savi, (b08 - b03)::double as gdvi, round(2.5::double * (b08-b04) / nullif(b08 + 6*b04 - 7.5::double*b02, 0) + 1, 6) as evi, " + ", ".join(f"{a}::bigint * 49 + {b} * 7 + {c} as {k}" for k, (a, b, c) in _PICTURES.items()) + " from cell")(
    lambda s, d: cells(s, d).select("scene_id", "r", "c", *[lookups.spectral_index(k).alias(k) for k in (*_N, "savi", "gdvi")], F.round(lookups.spectral_index("evi"), 6).alias("evi"), *[lookups.spectral_index(k).alias(k) for k in _PICTURES])
    .withColumns({k: sum((F.col(f"{k}.{n}").cast("bigint") * 7 ** (2 - i) for i, n in enumerate(lookups.INDICES[k].split(","))), F.lit(0)).cast("bigint") for k in _PICTURES})
)
query("x21_x23_x24_clouds", _cell + "select scene_id, r, c, greatest(b02, b03, b04) > 10000 as landsat, scl in (0,1,3,7,8,9,10) as scl_cloud, (qa & 27) <> 0 as qa_cloud from cell")(lambda s, d: cells(s, d).select("scene_id", "r", "c", fc.landsat_cloud("b02", "b03", "b04").alias("landsat"), fc.scl_cloud("scl").alias("scl_cloud"), fc.qa_cloud("qa").alias("qa_cloud")))
query("x26_multiclass", f"with {fx.LABEL} select item_id, position, case when y = 900 then 5 else floor(least(y / (2500.0 / 5), 5.0))::int end as k, case when y = 900 then 4 when y <= 1000 then 0 when y <= 1300 then 1 when y <= 1600 then 2 else 3 end as bin, case when value = 9 then 4 else value end as last from label")(
    lambda s, d: fx.labels(s, d).select("item_id", "position", fc.multiclass_int(F.col("y"), 5, 2500.0, 900.0).alias("k"), fc.multiclass_bins(F.col("y"), [1000, 1300, 1600], 900.0).alias("bin"), fc.nan_to_last_class(F.col("value"), 5, 9).alias("last"))
)
query("x28_one_hot", f"with {fx.LABEL} select item_id, position, i::int as i, (i = value)::int as hot from label, range(5) t(i)")(lambda s, d: fx.labels(s, d).select("item_id", "position", F.posexplode(fc.one_hot(F.col("value"), 5)).alias("i", "hot")))
query("x18_x19_ranges", f"with {fx.LABEL} select item_id, position, trunc((least(greatest(y, 950.0), 1500.0) - 950.0) * (255 / 1500.0::double))::int as clipped, round(least(greatest(y, 0), 1500.0) / 1500.0, 6)::double as normal from label")(
    lambda s, d: fx.labels(s, d).select("item_id", "position", fc.clip_range(F.col("y"), 950.0, 1500.0).alias("clipped"), F.round(fc.normalize(F.col("y"), 1500.0), 6).alias("normal"))
)
query("x16_argmax", "select vec_id, list_position(e, list_max(e)) - 1 as class from (select vec_id, list_transform(embedding[1:10], lambda x: abs(x::double)) as e from embeddings)")(lambda s, d: fx.table(s, d, "embeddings").select("vec_id", fc.argmax(F.transform(F.slice("embedding", 1, 10), lambda x: F.abs(x.cast("double")))).alias("class")))
query("x33_calculator", _cell + "select scene_id, r, c, b02 + b03 as add, b02 - b03 as subtract, b02 * b03 as multiply, b02::double / nullif(b03, 0) as divide, least(b02, b03) as minimum, greatest(b02, b03) as maximum, (b02 + b03) / 2.0::double as mean, b02 + b03 as sum, (b03 > b02)::int as argmax, (b03 < b02)::int as argmin, abs(b02 - 5000) as abs, round(sqrt(b02), 6)::double as sqrt from cell")(
    lambda s, d: cells(s, d).select(
        "scene_id", "r", "c", *[fc.calculate(k, F.col("b02"), F.col("b03")).alias(k) for k in ("add", "subtract", "multiply", "divide", "minimum", "maximum", "mean", "sum", "argmax", "argmin")],
        fc.calculate("abs", F.col("b02") - 5000).alias("abs"), F.round(fc.calculate("sqrt", F.col("b02")), 6).alias("sqrt"),
    )
)

# Samples
query("g8_upsample", _cell + ", f as (select i::int as i from range(2) t(i)) select scene_id, r * 2 + a.i as r, c * 2 + b.i as c, b02 from cell, f a, f b")(lambda s, d: samples.upsample(cells(s, d).select("scene_id", "r", "c", "b02"), 2))
query("g9_pad", _cell + "select scene_id, (i + 1)::int as r, (j + 1)::int as c, b02 from cell, range(-1, 5) t(i), range(-1, 5) u(j) where r = least(greatest(i, 0), 3) and c = least(greatest(j, 0), 3)")(lambda s, d: samples.pad(cells(s, d).select("scene_id", "r", "c", "b02"), 4, 4, 1))
query("g13_flip", _cell + "select scene_id, 3 - r as r, 3 - c as c, b02 from cell")(lambda s, d: samples.flip(cells(s, d).select("scene_id", "r", "c", "b02"), "both", 4, 4))
query("g12_fill_shape", _cell + ", k as (select distinct scene_id from cell), g as (select scene_id, i::int as r, j::int as c from k, range(5) t(i), range(5) u(j)) select scene_id, r, c, coalesce(b02, 0) as b02 from g left join cell using (scene_id, r, c)")(lambda s, d: samples.fill_shape(by_scene(s, d), ["scene_id"], 5, 5, ["b02"]).select("scene_id", "r", "c", "b02"))
query("k3_latest_images", _ranked + ", i as (select distinct tile_id, step_no from ranked) select tile_id, step_no from i qualify row_number() over (partition by tile_id order by step_no desc) <= 2")(lambda s, d: samples.latest_images(ranked(s, d).select("tile_id", "step_no").distinct(), 2))
query("k4_least_nodata", _first.format(i="idx").replace("select tile_id, step_no, r, c, " + BL + " from x where k = 1", ", n as (select tile_id, step_no, count(*) filter (where b02 % 7 = 0) as n from x where k = 1 group by all) select * from n qualify row_number() over (partition by tile_id order by n, step_no) <= 2"))(
    lambda s, d: samples.least_by(mosaic.first_valid(cells(s, d), B).groupBy("tile_id", "step_no").agg(F.count_if(F.col("b02") % 7 == 0).alias("n")), "n", 2)
)
query("p1_samples_cell", _first.format(i="idx").replace("select tile_id, step_no, r, c, " + BL + " from x where k = 1", ", m as (select * from x where k = 1), t as (select *, row_number() over (partition by tile_id, r, c order by step_no) - 1 as t from m), ok as (select tile_id, r, c from m group by all having bool_or(b0 <> 0 or b02 <> 0)) select tile_id, r, c, t::int as t, b0, b02 from t join ok using (tile_id, r, c)"))(
    lambda s, d: samples.samples_cell(mosaic.first_valid(cells(s, d), B), ["b0", "b02"], 0).select("tile_id", "r", "c", F.posexplode("features").alias("t", "f")).select("tile_id", "r", "c", "t", F.col("f")[0].alias("b0"), F.col("f")[1].alias("b02"))
)
query("u1_split_sizes", f"with {fx.LABEL}, n as (select count(*) as n from label) select true as training, ceil(n * 0.7)::bigint as n from n union all select false, n - ceil(n * 0.7)::bigint from n")(lambda s, d: samples.split_samples(fx.labels(s, d), "position", 0.7, 1).groupBy("training").agg(F.count("*").alias("n")))
query("u1_split")(lambda s, d: samples.split_samples(fx.labels(s, d), "position", 0.7, 1))
query("g15_windows", f"with {fx.RECT}, g as (select id as item, xmax - xmin + 20 as h, ymax - ymin + 25 as w from rect) select distinct item, greatest(0, least(i, h - 8))::bigint as row, greatest(0, least(j, w - 8))::bigint as col from g, (select unnest(range(0, 80, 4)) as i), (select unnest(range(0, 80, 4)) as j) where i <= h - 1 and j <= w - 1")(
    lambda s, d: samples.windows(fx.rectangles(s, d).select(F.col("id").alias("item"), (F.col("xmax") - F.col("xmin") + 20).alias("height"), (F.col("ymax") - F.col("ymin") + 25).alias("width")), 8, 0.5)
)
_E = {"mse": "avg((y_pred - y_true) * (y_pred - y_true)) filter (where y_true <> 1)", "rmse": "sqrt(avg((y_pred - y_true) * (y_pred - y_true)) filter (where y_true <> 1))", "rmse_less": "sqrt(avg((y_pred - y_true) * (y_pred - y_true)) filter (where y_true <> 1 and y_true <= 20))", "rmse_more": "sqrt(avg((y_pred - y_true) * (y_pred - y_true)) filter (where y_true <> 1 and y_true >= 20))", "stretching": "avg(abs(y_pred - y_true) * (y_true + 1)) filter (where y_true <> 1)", "square_stretching": "avg(abs(y_pred - y_true) * (y_true + 1) * (y_true + 1)) filter (where y_true <> 1)"}
query("e1_e8_metrics", f"with {fx.PRED} select " + ", ".join(f"round({v}, 4) as {k}" for k, v in _E.items()) + " from pred")(lambda s, d: fx.predictions(s, d).agg(*[F.round(samples.metric(k, 1.0, 20.0), 4).alias(k) for k in _E]))
query("w9_time_index", _ranked + ", i as (select distinct tile_id, step_no from ranked) select tile_id, step_no, row_number() over (partition by tile_id order by step_no) - 1 as t_idx from i")(lambda s, d: samples.time_index(ranked(s, d).select("tile_id", "step_no").distinct()))
query("w8_batch_ids", f"with {fx.LABEL} select item_id, position, (row_number() over (partition by item_id order by position) - 1) % ceil(count(*) over (partition by item_id) / 8)::bigint as batch from label")(lambda s, d: samples.batch_ids(fx.labels(s, d).select("item_id", "position"), "item_id", "position", 8))
query("j7_sample_weights", f"with {fx.LABEL}, w as (select value, count(*) as weight from label where value <> 0 group by all) select item_id, position, label.value, round(coalesce(weight / (select sum(weight) from w), 0), 6)::double as weight from label left join w using (value)")(
    lambda s, d: samples.sample_weights(fx.labels(s, d).select("item_id", "position", "value"), fx.labels(s, d).where("value <> 0").groupBy("value").agg(F.count("*").cast("double").alias("weight"))).withColumn("weight", F.round("weight", 6))
)

# Grids
_mask = f"with {fx.AREA} "


def grids(s, d, scale=1.0):
    return grid.grid(fx.areas(s, d), scale)


query("g2_grid", _mask + "select item, x as x0, y as y0, n as width, n as height from area")(lambda s, d: grids(s, d).select("item", "x0", "y0", "width", "height"))
query("g4_rasterize", _mask + "select item, r, c from spot where r + c + 1 < side")(lambda s, d: grid.rasterize(grids(s, d)))
query("g4_all_touched", _mask + "select item, r, c from spot where r + c < side")(lambda s, d: grid.rasterize(grids(s, d), all_touched=True))
query("g4b_rasterize_samples", _mask + "select item, date '2024-01-01' as date, r, c, case when r + c + 1 < side then value else 255 end as v from spot")(lambda s, d: grid.rasterize_samples(fx.areas(s, d), "value", 1.0))
query("g3_wgs84_bbox", _mask + "select item, round(degrees(x / 6378137.0::double), 9) as west, round(degrees(2 * atan(exp((y - side) / 6378137.0::double)) - pi() / 2), 9) as south, round(degrees((x + side) / 6378137.0::double), 9) as east, round(degrees(2 * atan(exp(y / 6378137.0::double)) - pi() / 2), 9) as north from area")(
    lambda s, d: grid.wgs84_bbox(fx.areas(s, d).withColumn("epsg", F.lit(3857))).select("item", *[F.round(k, 9).alias(k) for k in ("west", "south", "east", "north")])
)


def _regrid(s, d):
    """Scenes' cells as sources, and grids of half their resolution that start one cell off."""
    src = cells(s, d).select(F.col("scene_id").alias("item"), "r", "c", "b0", "b02")
    target = ranked(s, d).select(F.col("scene_id").alias("item"), F.lit(1.0).alias("x0"), F.lit(3.0).alias("y0"), F.lit(2).alias("width"), F.lit(2).alias("height"), F.lit(2.0).alias("scale"), F.lit(0.0).alias("sx0"), F.lit(4.0).alias("sy0"), F.lit(1.0).alias("sscale"))
    return src, target


_TARGET = _cell + ", g as (select scene_id as item, i::int as r, j::int as c, 1 + 2 * i + 1.0::double as u, 1 + 2 * j + 1.0::double as w from (select distinct scene_id from cell), range(2) t(i), range(2) v(j))"
query("g5_resample_nearest", _TARGET + " select g.item, g.r, g.c, b0, b02 from g join cell on scene_id = item and cell.r = floor(u) and cell.c = floor(w)")(lambda s, d: grid.resample_nearest(*_regrid(s, d)))
query("g6_resample_bilinear", _TARGET + ", k as (select item, g.r, g.c, b0, b02, (1 - abs(cell.r + 0.5::double - u) / 2) * (1 - abs(cell.c + 0.5::double - w) / 2) as k from g join cell on scene_id = item and abs(cell.r + 0.5::double - u) < 2 and abs(cell.c + 0.5::double - w) < 2) select item, r, c, coalesce(round(sum(k * b0) filter (where b0 <> 0) / sum(k) filter (where b0 <> 0))::int, 0) as b0, coalesce(round(sum(k * b02) filter (where b02 <> 0) / sum(k) filter (where b02 <> 0))::int, 0) as b02 from k group by all")(
    lambda s, d: grid.resample_bilinear(*_regrid(s, d), ["b0", "b02"])
)


def tile_mask(s, d):
    return fx.scenes(s, d).select("tile_id").distinct().withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(3)))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(3)))).where("(r + c + tile_id) % 3 <> 0")


query("f12_clip", _cell + "select scene_id, r, c, case when (r + c + tile_id) % 3 <> 0 then b0 else 0 end as b0 from cell")(lambda s, d: grid.clip(by_scene(s, d).select("scene_id", "tile_id", "r", "c", "b0"), tile_mask(s, d), ["b0"], ["tile_id"]).drop("tile_id"))

# Clouds of Sentinel-2 and the best observation
_f = {k: f"least(greatest({k}, 0), 10000)::double / 10000" for k in clouds.S2_BANDS}
_MEASURES = (
    _cell + ", m0 as (select scene_id, tile_id, step_no, r, c, idx, " + ", ".join(f"{v} as {k}" for k, v in _f.items()) + " from cell), m1 as (select *, case when b11 > 0 then b03 / b11 when b03 > 0 then 'inf'::double end as gs, case when b03 > 0 then b11 / b03 when b11 > 0 then 'inf'::double end as sg, (b02 + b03 + b04) / 3 as rgb,"
    " -0.8239::double * b02 + 0.0849::double * b03 + 0.4396::double * b04 + -0.058::double * b8a + 0.2013::double * b11 + -0.2773::double * b12 as haze, (b08 - b11) / nullif(b08 + b11, 0) as ns,"
    " 0.3029::double * b02 + 0.2786::double * b03 + 0.4733::double * b04 + 0.5599::double * b8a + 0.508::double * b11 + 0.1872::double * b12 as tcb, (b03 - b11) / nullif(b03 + b11, 0) as ndwi, (b08 - b04) / nullif(b08 + b04, 0) as ndvi from m0),"
    " m2 as (select *, (coalesce(gs > 1, false) and rgb > 0.3 and (haze < -0.1 or (haze > -0.08 and coalesce(ns < 0.4, false)))) or haze < -0.2 or (coalesce(gs > 1, false) and rgb < 0.3 and haze < -0.055 and rgb > 0.12) or (not (coalesce(gs > 1, false) and rgb < 0.3) and haze < -0.09 and rgb > 0.12) as dense,"
    " coalesce(ndwi > 0.7, false) and not (coalesce(gs > 1, false) and tcb < 0.36) as snow, (coalesce(sg > 1, false) and rgb < 0.2 and (haze < -0.1 or (haze < -0.08 and coalesce(ns < 0.4, false)))) or haze < -0.2 or (coalesce(gs > 1, false) and rgb < 0.2 and haze < -0.055 and rgb > 0.12) or (not (coalesce(gs > 1, false) and rgb < 0.2) and haze < -0.02 and rgb > 0.12) as light from m1)"
)
query("x22_s2_cloud", _MEASURES + " select scene_id, r, c, dense or snow or b02 = 0 or b02 + b03 + b04 + b08 < 0.2 as cloud, dense or light or b02 = 0 as light from m2")(
    lambda s, d: clouds.s2_cloud(clouds.s2_cloud(by_scene(s, d).select("scene_id", "r", "c", *clouds.S2_BANDS), light=True, snow=False, shadow=0).withColumnRenamed("cloud", "light")).select("scene_id", "r", "c", "cloud", "light")
)
query("m7_best_observation", _MEASURES + """, o as (select *, dense or snow or b02 = 0 or b02 + b03 + b04 + b08 < 0.5 as cloud from m2), v as (select tile_id, step_no, r, c, idx, dense, snow, case when not cloud then ndvi end as ndvi, case when not cloud then ndwi end as ndwi, case when not cloud then tcb end as tcb from o),
 a as (select tile_id, step_no, r, c, avg(ndvi) as vm, max(ndvi) as vx, avg(ndwi) as wm, min(ndwi) as wn, avg(tcb) as tm from v group by all),
 p as (select *, first_value(idx) over (w order by ndwi desc nulls last, idx) as wi, first_value(idx) over (w order by ndvi nulls last, idx) as vl, first_value(idx) over (w order by ndvi desc nulls last, idx) as vi, first_value(idx) over (w order by tcb nulls last, idx) as ti from v window w as (partition by tile_id, step_no, r, c))
 select tile_id, step_no, r, c, case when wm < -0.55 and vx - vm < 0.05 then vi when vm < -0.3 and wm - wn < 0.05 then wi when vm > 0.6 and tm < 0.45 then vi when not dense then ti when not snow and tcb < 1 then ti when vm < -0.2 then wi when tm > 0.45 then vl else vi end as idx from p join a using (tile_id, step_no, r, c) where idx = ti""")(
    lambda s, d: clouds.best_observation(cells(s, d), mosaic.CELL, "idx")
)

# Sources and sinks
def images(s, d):
    """Mosaics as images of an item and step."""
    return mosaic.first_valid(cells(s, d), B).select(F.col("tile_id").alias("item"), F.col("step_no").alias("t"), "r", "c", *B)


_images = _first.format(i="idx").replace("select tile_id, step_no, r, c, " + BL + " from x where k = 1", f", image as (select tile_id as item, step_no as t, r, c, {BL} from x where k = 1) ")
query("s4_s5_chunks", _images + "select item, t, r, c, b0, b02 from image")(lambda s, d: rasters.explode_chunks(rasters.assemble_chunks(images(s, d), 3, ["b0", "b02", "b04"]), 3, ["b0", "b02"]))
query("s5_assemble_chunks", _images + "select item, t, 'b02' as band, r // 3 as chunk_row, c // 3 as chunk_col, (max(r % 3) + 1)::int as h, (max(c % 3) + 1)::int as w, string_agg(b02::varchar, ',' order by r, c) as data from image group by all")(
    lambda s, d: rasters.assemble_chunks(images(s, d), 3, ["b02"]).withColumn("data", F.concat_ws(",", F.col("data").cast("array<string>")))
)
query("s6_raster_meta", _images + "select item, t, max(r) + 1 as height, max(c) + 1 as width from image group by all")(lambda s, d: rasters.raster_meta(images(s, d)))
query("s8_cast_for_sink", _images + "select item, t, r, c, case when b0 = 0 then 255 else b0 end as b0, case when b0 = 0 then -9999 else b0::double end as f from image")(
    lambda s, d: rasters.cast_for_sink(rasters.cast_for_sink(images(s, d).select("item", "t", "r", "c", F.expr("nullif(b0, 0)").alias("b0"), F.expr("nullif(b0, 0)").alias("f")), "b0", "int"), "f", "double")
)
query("s11_catalog", _scene + "select 'scenes' as catalog_id, count(*) as items, min(xmin) as xmin, min(ymin) as ymin, max(xmax) as xmax, max(ymax) as ymax from scene")(lambda s, d: rasters.catalog_from_items(fx.scenes(s, d), "scenes"))
query("s13_classify_source", "select p_partkey, case p_partkey % 3 when 0 then 'vector' else 'raster' end as kind from part")(
    lambda s, d: fx.table(s, d, "part").select("p_partkey", links.classify_source(F.concat(F.lit("a/"), F.element_at(F.array(F.lit("b.gpkg"), F.lit("b.zip"), F.lit("b/")), (F.col("p_partkey") % 3 + 1).cast("int")))).alias("kind"))
)
query("a7_footprint", _mask + "select item, x as xmin, y - n as ymin, x + n as xmax, y as ymax from area")(
    lambda s, d: grids(s, d).select("item", rasters.footprint(F.col("x0"), F.col("y0"), F.col("scale"), -F.col("scale"), F.col("width"), F.col("height")).alias("f")).select("item", "f.*")
)

# Items and collections
query("x15_vector_items", _mask + "select item, x as xmin, y - side as ymin, x + side as xmax, y as ymax, date '2024-01-01' as date, value as class from area")(lambda s, d: collect.vector_items(fx.areas(s, d), "value", True).drop("footprint"))
query("x15b_raster_items", f"with {fx.LABEL}, n as (select item_id as item, value, count(*) as n from label group by all) select r.s_suppkey as item, n.value, n.n from supplier r join n on n.item = s_suppkey")(
    lambda s, d: collect.raster_items(fx.table(s, d, "supplier").select(F.col("s_suppkey").alias("item")), fx.labels(s, d).select(F.col("item_id").alias("item"), "value")).select("item", F.explode("stats").alias("value", "n"))
)
query("x11_item_aoi", _mask + "select item, 4 as corners, x as west, y as north, 'EPSG:3857' as crs from area")(
    lambda s, d: collect.item_aoi(fx.areas(s, d).select("item", grid.bbox(F.col("rings")).alias("b"), F.lit(3857).alias("epsg")).select("item", "b.*", "epsg")).select(
        "item", F.lit(4).alias("corners"), F.get_json_object("geojson", "$.features[0].geometry.coordinates[0][1][0]").cast("double").alias("west"),
        F.get_json_object("geojson", "$.features[0].geometry.coordinates[0][1][1]").cast("double").alias("north"), F.get_json_object("geojson", "$.crs.properties.name").alias("crs"),
    )
)
query("u2_merge_collections", "select o_custkey, min(o_orderkey) as o_orderkey from orders where o_orderkey % 2 = 0 group by all union all select o_custkey, min(o_orderkey) from orders where o_orderkey % 2 = 1 and o_custkey not in (select o_custkey from orders where o_orderkey % 2 = 0) group by all")(
    lambda s, d: collect.merge_collections(*[fx.table(s, d, "orders").where(F.col("o_orderkey") % 2 == k).groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey")) for k in (0, 1)], "o_custkey")
)
query("w7_item_slice", "select o_orderkey from orders order by o_orderkey limit 500 offset 1000")(lambda s, d: collect.item_slice(fx.table(s, d, "orders").select("o_orderkey"), "o_orderkey", 2, 500))
query("w5_first_date", _ranked + "select tile_id, step_no, sensing_time::date as date from ranked where idx = 1")(lambda s, d: collect.first_date(ranked(s, d)))
query("a17_merge_predictions", f"with {fx.RASTER} select r, c, round(avg(v), 6) as v from raster where v <> 1 group by all")(lambda s, d: collect.merge_predictions(fx.rasters(s, d), fx.rectangles(s, d), False, 1).withColumn("v", F.round("v", 6)))
query("m8_pixel_stack", _cell + f", x as (select *, row_number() over (partition by tile_id, step_no, r, c order by (b0 = 0), case when b0 = 0 then -idc else idc end) as k from cell where idc <= 5), y as (select * from x where k = 1 qualify max(abs(b0)) over (partition by tile_id, step_no) > 0) select tile_id, step_no, r, c, case when (r + c + tile_id) % 3 <> 0 then b0 else 0 end as b0, case when (r + c + tile_id) % 3 <> 0 then b02 else 0 end as b02 from y")(
    lambda s, d: collect.pixel_stack(stepped(s, d), fx.cells, ["b0", "b02"], "cloud_sorted_pixel", 5, mask=tile_mask(s, d))
)


def warped_stack(s, d):
    """Weekly mosaics of areas in EPSG 3857 from rasters in two UTM zones: classes by nearest cells, bands from the four
    nearest, also where a cell of the area spans more than one of the source's, as south of 33 degrees."""
    return collect.area_stack(fx.warp_areas(s, d), fx.warp_scenes(s, d), steps(s), fx.warp_chunks(s, d), ["b0", "b02", "scl"], 120.0, fx.CHUNK, ["scl"], tolerance=0, reach=1.0, limit=3)


query("m8_area_stack", f"with {fx.WARP}, e as (select tile_id, step_no, scene_id from warped group by all having max(b0) > 0 and max(b02) > 0 and max(scl) > 0), x as (select *, row_number() over (partition by tile_id, step_no, r, c order by (b0 = 0), case when b0 = 0 then -idx else idx end) as k from warped join e using (tile_id, step_no, scene_id)) select tile_id, step_no, r, c, b0, b02, scl from x where k = 1")(warped_stack)
query("g5_g6_warp", f"with {fx.WARP} select tile_id, step_no, scene_id, r, c, b0, b02, scl from warped where idx = 1")(
    lambda s, d: warp.warp(
        search.limit_scenes(search.rank_scenes(search.assign_steps(search.match_scenes(grid.wgs84_bbox(fx.warp_areas(s, d)).select(F.col("tile_id").alias("area_id"), F.col("west").alias("a_xmin"), F.col("south").alias("a_ymin"), F.col("east").alias("a_xmax"), F.col("north").alias("a_ymax")), fx.warp_scenes(s, d)).drop("tile_id").withColumnRenamed("area_id", "tile_id"), steps(s))), 1)
        .join(grid.grid(fx.warp_areas(s, d), 120.0).select("tile_id", *warp.GRID), "tile_id"),
        fx.warp_chunks(s, d), ["tile_id", "step_no", "scene_id"], ["b0", "b02", "scl"], ["scl"], fx.CHUNK, tolerance=0, reach=1.0,
    )
)


def holey(scenes):
    """Cells of which every sixth scene has an empty band, so it must be passed over."""
    return fx.cells(scenes).withColumn("b02", F.when(F.col("scene_id") % 6 == 0, 0).otherwise(F.col("b02")))


query("m8_empty_scenes", _cell + ", x as (select *, row_number() over (partition by tile_id, step_no, r, c order by (b0 = 0), case when b0 = 0 then -idx else idx end) as k from cell where idx <= 4 and scene_id % 6 <> 0) select tile_id, step_no, r, c, b0, b02 from x where k = 1 qualify max(abs(b0)) over (partition by tile_id, step_no) > 0")(
    lambda s, d: collect.pixel_stack(stepped(s, d), holey, ["b0", "b02"], "latest_pixel", 4)
)


def scene_stats(s, d):
    """Zone maps of the holey scenes, each one chunk of 4 x 4, from arrays without a look at cells."""
    at = F.sequence(F.lit(0), F.lit(15))
    values = lambda band: F.transform(at, lambda p: fx.warp_values(F.col("scene_id"), F.floor(p / 4), p % 4)[band])
    b0, b02 = values("b0"), values("b02")
    chunks = fx.scenes(s, d).select("scene_id", F.lit(4).alias("h"), F.lit(4).alias("w"), b0.alias("b0"), F.when(F.col("scene_id") % 6 == 0, F.transform(at, lambda p: F.lit(0))).otherwise(b02).alias("b02"))
    return rasters.chunk_stats(chunks, ["b0", "b02"])


query("m8_zone_maps", _cell + ", x as (select *, row_number() over (partition by tile_id, step_no, r, c order by (b0 = 0), case when b0 = 0 then -idx else idx end) as k from cell where idx <= 4 and scene_id % 6 <> 0) select tile_id, step_no, r, c, b0, b02 from x where k = 1 qualify max(abs(b0)) over (partition by tile_id, step_no) > 0")(
    lambda s, d: collect.pixel_stack(stepped(s, d), holey, ["b0", "b02"], "latest_pixel", 4, stats=rasters.image_stats(scene_stats(s, d), ["scene_id"], ["b0", "b02"]))
)
query("a4_zone_maps", _scene + ", v as (select scene_id, case when (scene_id * 7 + i // 4 * 3 + i % 4 * 5) % 4 = 0 then 0 else 1 + (scene_id * 37 + i // 4 * 101 + i % 4 * 59) % 9999 end as b0 from scene, range(16) t(i)) select scene_id, min(b0) filter (where b0 <> 0)::int as least, max(b0) filter (where b0 <> 0)::int as most, count(*) filter (where b0 = 0) as nodata, count(*) filter (where b0 <> 0) as valid from v group by all")(
    lambda s, d: rasters.image_stats(scene_stats(s, d), ["scene_id"], ["b0"]).select("scene_id", "b0.*")
)
_RASTERS = _scene + ", src as (select scene_id as item, i::int as r, j::int as c, (case when (scene_id * 7 + i * 3 + j * 5) % 4 = 0 then 0 else 1 + (scene_id * 37 + i * 101 + j * 59) % 9999 end)::int as b0, (case when scene_id % 11 = 0 then 0 else (scene_id * 41 + i * 7 + j * 11) % 10000 end)::int as b02 from scene, range(12) t(i), range(10) u(j))"


def stored_chunks(s, d, bands=("b0", "b02")):
    return fx.warp_chunks(s, d, bands).withColumnRenamed("scene_id", "item").withColumn("t", F.lit(0))


query("s4_explode_windows", _RASTERS + " select item, 0 as t, r, c, b0, b02 from src where r between item % 8 and item % 8 + 5 and c between item % 7 and item % 7 + 3")(
    lambda s, d: rasters.explode_windows(stored_chunks(s, d), fx.scenes(s, d).select(F.col("scene_id").alias("item"), (F.col("scene_id") % 8).alias("row0"), (F.col("scene_id") % 8 + 5).alias("row1"), (F.col("scene_id") % 7).alias("col0"), (F.col("scene_id") % 7 + 3).alias("col1")).hint("merge"), fx.CHUNK, ["b0", "b02"])
)


def window_peaks(s, d):
    """A model of which each window's greatest value is known, over windows of 5 x 5 on images of 12 x 10 in chunks of 5."""

    def model(x):
        v = x[:, 0, :, :, 0]
        top = v.max(axis=(1, 2), keepdims=True)
        return np.stack([np.broadcast_to(top, v.shape), v - top], axis=-1)

    meta = fx.scenes(s, d).select(F.col("scene_id").alias("item"), F.lit(fx.ROWS).alias("height"), F.lit(fx.COLS).alias("width"))
    return windows.predict_windows(stored_chunks(s, d, ("b0",)), meta, ["b0"], model, 2, fx.CHUNK, 5, 0.5)


query("p11_window_peaks", _RASTERS + ", win as (select distinct greatest(0, least(i, 7)) as row, greatest(0, least(j, 5)) as col from (select unnest(range(0, 12, 2)) as i), (select unnest(range(0, 10, 2)) as j)), near as (select * from src join win on r between row and row + 4 and c between col and col + 4), m as (select *, max(b0) over (partition by item, row, col) as top from near) select item, r, c, round(avg(top), 6) as peak, round(avg(b0 - top), 6) as below from m group by all")(
    lambda s, d: window_peaks(s, d).select("item", "r", "c", F.round(F.col("probs")[0], 6).alias("peak"), F.round(F.col("probs")[1], 6).alias("below"))
)
query("m8_all_mode",_cell + "select scene_id, tile_id, step_no, r, c, b0, b02 from cell where idx <= 4 and scene_id % 6 <> 0")(
    lambda s, d: collect.pixel_stack(stepped(s, d), holey, ["b0", "b02"], "all", 4)
)
query("m8_composite_qa", _composite_sql("m = 1", _QA, "(select * from qcell where idx <= 10)"))(
    lambda s, d: collect.pixel_stack(stepped(s, d), fx.cells, B, "composite_qa", 10, qa="qa")
)


def _collected(s, d):
    """Steps of all tiles but those that have an image: every third event of even tiles is one."""
    tiles = fx.scenes(s, d).select(F.col("tile_id").alias("item")).distinct()
    have = fx.scenes(s, d).where("tile_id % 2 = 0 and scene_id % 29 = 0").select(F.col("tile_id").alias("item"), F.to_date("sensing_time").alias("date"))
    return tiles.join(F.broadcast(steps(s))), have  # four steps


query("m9_collect", _cell + ", have as (select distinct tile_id, step_no from scene join step on sensing_time::date between step_start and step_end where tile_id % 2 = 0 and scene_id % 29 = 0), x as (select *, row_number() over (partition by tile_id, step_no, r, c order by (b0 = 0), case when b0 = 0 then -idx else idx end) as k from cell anti join have using (tile_id, step_no) where idx <= 10), y as (select * from x where k = 1 qualify max(abs(b0)) over (partition by tile_id, step_no) > 0) select tile_id, step_no, r, c, b0, b02 from y")(
    lambda s, d: collect.collect(*_collected(s, d), fx.scenes(s, d), fx.cells, ["b0", "b02"])
)
query("a19_stack_index", "select o_custkey as item, count(distinct o_orderdate)::int as n, min(o_orderdate)::date as first, max(o_orderdate)::date as last from orders group by all")(
    lambda s, d: collect.stack_index(fx.table(s, d, "orders").select(F.col("o_custkey").alias("item"), F.to_date("o_orderdate").alias("date"), F.date_format("o_orderdate", "yyyy_MM_dd").alias("path"))).select("item", F.size("x_paths").alias("n"), "first", "last")
)

# Links to the archive
def _products(s, d):
    """A product per day of the orders with an even key."""
    t = F.to_date("o_orderdate")
    day = F.date_format(t, "yyyyMMdd")
    path = F.concat(F.lit("tiles/29/S/ND/"), F.year(t), F.lit("/"), F.month(t), F.lit("/"), F.dayofmonth(t), F.lit("/0"))
    o = fx.table(s, d, "orders").where("o_orderkey % 2 = 0").select(path.alias("path"), day.alias("day")).distinct()
    name = F.concat(F.lit("S2B_MSIL2A_"), F.col("day"), F.lit("T112509"))
    return o.select("path", name.alias("name"), F.concat(F.lit("GS2B_"), F.col("day"), F.lit("T112509_024940_N02.11")).alias("datatake"), F.lit(29).alias("zone"), F.lit("S").alias("band"), F.lit("ND").alias("square"), F.concat(F.lit("S2B_OPER_MSI_L2A_DS_MTI__x_S"), F.col("day"), F.lit("T112510_N02.11")).alias("datastrip"))


_LINKS = "with u as (select o_orderkey, o_orderdate::date as t, '29/S/ND/' || year(o_orderdate) || '/' || month(o_orderdate) as p, strftime(o_orderdate, '%Y%m%d') as day from orders), v as (select *, 'https://sentinel-cogs.s3.us-west-2.amazonaws.com/sentinel-s2-l2a-cogs/' || p || '/S2B_29SND_' || day || '_0_L2A/B06.tif' as url, 's3://sentinel-s2-l2a/tiles/' || p || '/' || day(t) || '/0/R20m/B06.jp2' as jp2, case when t in (select o_orderdate::date from orders where o_orderkey % 2 = 0) then 'https://storage.googleapis.com/gcp-public-data-sentinel-2/L2/tiles/29/S/ND/S2B_MSIL2A_' || day || 'T112509.SAFE/GRANULE/L2A_T29SND_A024940_' || day || 'T112510/IMG_DATA/R20m/L2A_T29SND_' || day || 'T112509_B06_20m.jp2' end as archive from u)"
query("x8_jp2_to_archive", _LINKS + " select o_orderkey, archive from v")(lambda s, d: links.jp2_to_archive(urls(s, d).withColumn("url", links.cog_to_jp2(F.col("url"))), "url", _products(s, d)).select("o_orderkey", "archive"))
query("x9_resolve_source", _LINKS + ", h as (select url as h from v where o_orderkey % 7 = 0 union select jp2 from v where o_orderkey % 5 = 0) select o_orderkey, case when url in (select h from h) then url when jp2 in (select h from h) then jp2 else archive end as source from v")(
    lambda s, d: links.resolve_source(urls(s, d), "url", urls(s, d).where("o_orderkey % 7 = 0").select("url").union(urls(s, d).where("o_orderkey % 5 = 0").select(links.cog_to_jp2(F.col("url")))), _products(s, d)).select("o_orderkey", "source")
)

# Training sets and predictions
def image_labels(s, d):
    return images(s, d).select("item", "r", "c", ((F.col("item") + F.col("r") * 3 + F.col("c")) % 4).cast("int").alias("label")).distinct()


_label = "((item + r * 3 + c) % 4)::int"
query("j3_pair_xy", _images + f"select item, t, r, c, b02, {_label} as label from image")(lambda s, d: training.pair_xy(images(s, d).select("item", "t", "r", "c", "b02"), image_labels(s, d)))
query("p2_samples_3d", _images + ", k as (select item, t, dense_rank() over (partition by item order by t desc) as k, dense_rank() over (partition by item order by t) as u, r, c, b0, b02 from image), n as (select * from k where k <= 3) select item, (u - min(u) over (partition by item))::int as t, r, c, b0, b02 from n")(
    lambda s, d: training.samples_3d(images(s, d), ["b0", "b02"], 3).select("item", F.posexplode("images").alias("t", "m")).select("item", "t", F.posexplode("m").alias("r", "row")).select("item", "t", "r", F.posexplode("row").alias("c", "v"))
    .select("item", "t", "r", "c", F.col("v")[0].alias("b0"), F.col("v")[1].alias("b02"))
)
query("p3_samples_2d", _images + "select item, t, string_agg(b0::varchar, ',' order by r, c) as v from image group by all")(
    lambda s, d: training.samples_2d(images(s, d), ["b0"]).select("item", "t", F.concat_ws(",", F.transform(F.flatten(F.flatten("image")), lambda v: v.cast("string"))).alias("v"))
)
query("g11_frames", _images + f", f as (select a.item, a.r, a.c, t, y, x, b.b02, {_label.replace('item', 'a.item').replace(' r ', ' a.r ').replace(' c)', ' a.c)')} as label from (select distinct item, r, c from image where r between 1 and 2 and c between 1 and 2) a, range(3) t1(y), range(3) t2(x), image b where b.item = a.item and b.r = a.r + y - 1 and b.c = a.c + x - 1), g as (select item, r, c, label, string_agg(b02::varchar, ',' order by t, y, x) as v from f where label <> 3 group by all) select * from g qualify row_number() over (partition by item, v order by r, c) = 1")(
    lambda s, d: training.frames(images(s, d), ["b02"], 3, 4, 4, image_labels(s, d), 3).select("item", "r", "c", "label", F.concat_ws(",", F.transform(F.flatten("features"), lambda v: v.cast("string"))).alias("v"))
)
query("g11_frames_edge", _images + "select item, i::int as r, j::int as c, string_agg(b02::varchar, ',' order by t, y, x) as v from image, range(4) t1(i), range(4) t2(j), range(3) t3(y), range(3) t4(x) where r = least(3, greatest(0, i + y - 1)) and c = least(3, greatest(0, j + x - 1)) group by all")(
    lambda s, d: training.frames(images(s, d), ["b02"], 3, 4, 4).select("item", "r", "c", F.concat_ws(",", F.transform(F.flatten("features"), lambda v: v.cast("string"))).alias("v"))
)
query("g14_augment", _images + "select item, t, case when k in (1, 2) then 3 - r else r end as r, case when k in (1, 3) then 3 - c else c end as c, k as aug_id, b02 * case when k = 5 then 10.0 else 1.0 end::double as b02 from image, (select unnest([0, 1, 2, 3, 5]) as k)")(
    lambda s, d: training.augment(images(s, d).select("item", "t", "r", "c", "b02"), ["b02"], [1, 2, 3, 5], 4, 4)
)
query("g14_augment_noise")(lambda s, d: training.augment(images(s, d).select("item", "t", "r", "c", "b02"), ["b02"], [1, 4], 4, 4, 7))
query("f16_limit_shape", _images + "select item, t, r, c, b04 from image where t < 2 and r < 3 and c < 2")(lambda s, d: training.limit_shape(images(s, d), 2, 3, 2, ["b04"]))
query("g16_trim_windows", _images + ", w as (select unnest([0, 1, 2]) as row), v as (select unnest([0, 2]) as col) select item, t, row, col, r, c from image, w, v where r between row and row + 1 and c between col and col + 1 and (r - row >= 1 or row = 0) and (r - row < 1 or row = 2) and (c - col >= 1 or col = 0) and (c - col < 1 or col = 2)")(
    lambda s, d: training.trim_windows(images(s, d).select("item", "t", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("row"), "r", "c").select("*", F.explode(F.array(F.lit(0), F.lit(2))).alias("col")).where("r between row and row + 1 and c between col and col + 1"), 2, 1, 4, 4)
)
query("g17_stitch", f"with {fx.RASTER} select raster % 5 as item, r, c, (raster % 3)::int as class, round(avg(v), 6) as p from raster group by all")(
    lambda s, d: samples.stitch(fx.rasters(s, d).select((F.col("raster") % 5).alias("item"), "r", "c", (F.col("raster") % 3).cast("int").alias("class"), F.col("v").alias("p")), -9999.0).withColumn("p", F.round("p", 6))
)
query("e4_e5_cross_entropy", f"with {fx.PROB}, p as (select *, list_sum(probs) as s, list_sum(probs[1:2]) as s2 from prob) select round(avg(-ln(greatest(least(probs[class + 1] / s, 1 - 1e-7), 1e-7))) filter (where class <> 3), 6) as e4, round(avg(case when class < 2 then 0 else -ln(greatest(least(probs[class + 1] / (s - s2), 1 - 1e-7), 1e-7)) end), 6) as e5 from p")(
    lambda s, d: fx.probabilities(s, d).agg(F.round(training.cross_entropy(F.col("class"), F.col("probs"), 3), 6).alias("e4"), F.round(training.cross_entropy_dropped(F.col("class"), F.col("probs"), [0, 1]), 6).alias("e5"))
)


def fitted(s, d):
    """A tree that learns each cell's label from its times; nodata labels are left out of fitting, all cells predicted."""
    from pyspark.ml.classification import DecisionTreeClassifier

    x, y = images(s, d), image_labels(s, d)
    times = steps(s).count()
    weights = stats.class_weights(y.groupBy(F.col("label").alias("value")).agg(F.count("*").alias("n")), 3).select("value", "weight")
    model = training.fit_cells(training.training_set(x, y, ["b02", "b04"], 10000.0, 0, 3, weights, times=times), DecisionTreeClassifier(maxDepth=5, seed=1))
    return training.predict(training.training_set(x, y, ["b02", "b04"], 10000.0, usage="prediction", times=times), model)


query("p10_p11_predict")(fitted)

# Bands and paths of scenes


def assets(s, d):
    """Even scenes name assets by band, odd ones by colour with the band inside and another link; every fifth lacks one."""
    asset = lambda key, band: F.struct(F.lit(key).alias("key"), F.struct(F.concat(F.lit("s3://"), F.col("scene_id"), F.lit("/" + key)).alias("href"), F.when(F.col("scene_id") % 4 == 1, F.concat(F.lit("alt://"), F.col("scene_id"), F.lit("/" + key))).alias("s3_href"), F.array(F.struct(F.lit(band).alias("name"), F.lit("x").alias("common_name"))).alias("eo_bands")).alias("value"))
    by_band, by_colour = F.array(asset("B04", "red"), asset("B08", "nir")), F.array(asset("red", "B04"), asset("nir", "B08"))
    e = F.when(F.col("scene_id") % 2 == 0, by_band).otherwise(by_colour)
    return fx.scenes(s, d).select("scene_id", F.map_from_entries(F.when(F.col("scene_id") % 5 == 0, F.slice(e, 1, 1)).otherwise(e)).alias("assets"))


query("f7_f8_bands", _scene + "select scene_id, case when scene_id % 4 = 1 then 'alt://' || scene_id || '/red' when scene_id % 2 = 1 then 's3://' || scene_id || '/red' else 's3://' || scene_id || '/B04' end as red, case when scene_id % 5 = 0 then 'B08' else '' end as missing from scene")(
    lambda s, d: assets(s, d).select("scene_id", search.resolve_bands(F.col("assets"), ["B04", "B08"]).alias("b")).select("scene_id", F.col("b")["B04"].alias("red"), F.array_join(search.missing_bands(F.col("b"), ["B04", "B08"]), ",").alias("missing"))
)


def required_bands(s, d):
    """Scenes with all bands through the operator, which is an error for the others; those are counted beside it."""
    found = search.resolve_bands(F.col("assets"), ["B04", "B08"])
    lacking = F.size(search.missing_bands(found, ["B04", "B08"])) > 0
    whole = search.require_bands(assets(s, d).where(~lacking), found, ["B04", "B08"])
    return whole.select("scene_id", F.size("bands").alias("n")).unionByName(assets(s, d).where(lacking).select("scene_id", F.size(found).alias("n")))


query("f9_require_bands", _scene + "select scene_id, case when scene_id % 5 = 0 then 1 else 2 end as n from scene")(required_bands)
query("f11_drop_empty_steps", _first.format(i="idx").replace("from x where k = 1", "from (select * replace (case when tile_id % 3 = 0 and step_no = 1 then 0 else b0 end as b0) from x where k = 1) qualify max(abs(b0)) over (partition by tile_id, step_no) > 0"))(
    lambda s, d: mosaic.drop_empty_steps(mosaic.first_valid(cells(s, d), B).withColumn("b0", F.when(F.expr("tile_id % 3 = 0 and step_no = 1"), 0).otherwise(F.col("b0"))), "b0")
)
query("f13_value_mask", _cell + "select scene_id, r, c, b0 = 0 as m from cell")(lambda s, d: cells(s, d).select("scene_id", "r", "c", fc.value_mask(F.col("b0"), 0).alias("m")))
query("x3_dynamic_range", "select o_orderkey, (o_orderdate::date - interval 3 month)::date as start, o_orderdate::date as \"end\" from orders")(
    lambda s, d: fx.table(s, d, "orders").select("o_orderkey", dates.dynamic_range(F.to_date("o_orderdate"), "months", 3).alias("x")).select("o_orderkey", "x.*")
)
query("x4_item_date", "select o_orderkey, case when o_orderkey % 3 = 0 then o_orderdate::date when o_orderkey % 3 = 1 then o_orderdate::date + 1 else date '2020-01-01' end as date from orders")(
    lambda s, d: fx.table(s, d, "orders").select("o_orderkey", collect.item_date(F.when(F.col("o_orderkey") % 3 == 0, F.to_date("o_orderdate")), F.when(F.col("o_orderkey") % 3 == 1, F.date_add(F.to_date("o_orderdate"), 1)), F.lit("2020-01-01").cast("date")).alias("date"))
)
query("x12_x13_x14_paths", "select p_partkey, p_partkey::int as id, '/data/' || p_partkey || '.tif' as absolute, '/tmp/in/a.zip/' || p_partkey || '.tif' as local from part")(
    lambda s, d: fx.table(s, d, "part").select(
        "p_partkey", links.id_number(F.concat(F.lit("item_id_"), F.col("p_partkey"), F.lit("_2020"))).alias("id"), links.absolute_paths(F.array(F.concat(F.col("p_partkey").cast("string"), F.lit(".tif"))), "/data/")[0].alias("absolute"),
        links.rewrite_paths(F.array(F.concat(F.lit("zip://s3://b/in/a.zip!/"), F.col("p_partkey"), F.lit(".tif"))), "s3://b/", "/tmp/")[0].alias("local"),
    )
)
query("x17_rescale_probs", f"with {fx.PROB}, p as (select vec_id, unnest(list_transform(probs, lambda x: x * 255)) as p, unnest(range(10)) as k from prob) select vec_id, k::int as k, (case when p - floor(p) = 0.5 then floor(p / 2 + 0.5) * 2 else round(p) end)::int as p from p")(
    lambda s, d: fx.probabilities(s, d).select("vec_id", F.posexplode(fc.rescale_probs(F.col("probs"))).alias("k", "p"))
)
query("x32_rescale_transform", _mask + "select item, 0.5::double as scale_x, -0.5::double as scale_y, x as x0 from area")(
    lambda s, d: grids(s, d).select("item", fc.rescale_transform(F.struct(F.col("scale").alias("scale_x"), "x0", (-F.col("scale")).alias("scale_y"), "y0"), 2).alias("g")).select("item", "g.scale_x", "g.scale_y", "g.x0")
)
query("k5_least_cloudy", _first.format(i="idx").replace("select tile_id, step_no, r, c, " + BL + " from x where k = 1", ", n as (select tile_id, step_no, count(*) filter (where greatest(b02, b04, b08) > 9000) as n from x where k = 1 group by all) select * from n qualify row_number() over (partition by tile_id order by n, step_no) <= 2"))(
    lambda s, d: samples.least_by(mosaic.first_valid(cells(s, d), B).groupBy("tile_id", "step_no").agg(F.count_if(F.greatest("b02", "b04", "b08") > 9000).alias("n")), "n", 2)
)
query("k6_shuffle")(lambda s, d: samples.shuffle(fx.labels(s, d).select("item_id", "position"), "position", 3))
query("a20_catalog_length", "with l as (select o_custkey as catalog_id, case when o_orderkey % 3 = 0 then 'child' when o_orderkey % 3 = 1 then 'item' else 'self' end as rel from orders) select c_custkey as catalog_id, c_custkey % 2 = 0 as is_collection, (select count(*) from l where l.catalog_id = c_custkey and rel = case when c_custkey % 2 = 0 then 'child' else 'item' end) as n from customer")(
    lambda s, d: stats.catalog_length(
        fx.table(s, d, "customer").select(F.col("c_custkey").alias("catalog_id"), (F.col("c_custkey") % 2 == 0).alias("is_collection")),
        fx.table(s, d, "orders").select(F.col("o_custkey").alias("catalog_id"), F.element_at(F.array(F.lit("child"), F.lit("item"), F.lit("self")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("rel")),
    )
)
query("a21_merge_index", "select o_custkey as item, coalesce(max(case when o_orderkey % 2 = 1 then o_orderkey end), max(o_orderkey)) as path from orders group by all")(
    lambda s, d: stats.merge_index(*[fx.table(s, d, "orders").where(F.col("o_orderkey") % 2 == k).groupBy(F.col("o_custkey").alias("item")).agg(F.max("o_orderkey").alias("path")) for k in (0, 1)])
)
query("p5_samples_scalar", _images + "select item, t, r, c, b02, (item % 4)::int as label from image")(
    lambda s, d: training.pair_xy(images(s, d).select("item", "t", "r", "c", "b02"), fx.scenes(s, d).select(F.col("tile_id").alias("item"), (F.col("tile_id") % 4).cast("int").alias("label")).distinct())
)
query("p6_training_set", _images + f", f as (select item, r, c, {_label} as label, round(sum(least(greatest(b02, 0), 5000) / 5000.0::double), 6) as total, count(*)::int as n from image group by all) select * from f where label <> 3 and total > 0")(
    lambda s, d: training.training_set(images(s, d), image_labels(s, d), ["b02"], 5000.0, 0, 3).select("item", "r", "c", "label", vector_to_array("features").alias("v")).select("item", "r", "c", "label", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.size("v").alias("n"))
)


def _tensor_labels(s, d):
    """Labels of the images' cells, twice as many along each side as the upsampled features have not padded."""
    two = F.explode(F.array(F.lit(0), F.lit(1)))
    y = image_labels(s, d).withColumn("_i", two).withColumn("_j", two)
    return y.select("item", (F.col("r") * 2 + F.col("_i")).alias("r"), (F.col("c") * 2 + F.col("_j")).alias("c"), "label")


query(
    "p6_image_tensors",
    _images + ", q as (select item, t, count(*) filter (where b0 = 0) + count(*) filter (where b02 = 0) as n from image group by all), k as (select * from q qualify row_number() over (partition by item order by n, t) <= 3), u as (select item, t, row_number() over (partition by item order by t) - 1 as tt from k),"
    " s as (select image.item, tt as t, r, c, b0, b02 from image join u on u.item = image.item and u.t = image.t where r < 3 and c < 3), g as (select item, t::int as t, i::int as i, j::int as j from (select distinct item from s), range(3) a(t), range(-1, 7) b(i), range(-1, 7) c(j)),"
    " f as (select g.item, g.t, i + 1 as y, j + 1 as x, coalesce(b0, 0) as b0, coalesce(b02, 0) as b02 from g left join s on s.item = g.item and s.t = g.t and s.r = least(greatest(i, 0), 5) // 2 and s.c = least(greatest(j, 0), 5) // 2)"
    " select item, t, case when k in (1, 2) then 7 - y else y end as r, case when k in (1, 3) then 7 - x else x end as c, k as aug_id, least(b0 * m, 5000) / 5000.0::double as b0, least(b02 * m, 5000) / 5000.0::double as b02 from f, (select unnest([0, 1, 2, 3, 5]) as k, unnest([1, 1, 1, 1, 10]) as m)",
)(lambda s, d: training.image_tensors(images(s, d), ["b0", "b02"], 3, 3, 3, 0, 2, 1, (1, 2, 3, 5), 5000.0).select("item", "t", "r", "c", "aug_id", "b0", "b02"))
query(
    "p6_label_tensors",
    _images + f", l as (select distinct item, r * 2 + i as r, c * 2 + j as c, {_label} as label from image, range(2) a(i), range(2) b(j)), n as (select label, count(*) as n from l where label <> 0 group by all), w as (select label, (sum(n) over () / (count(*) over () * n))::double as w from n), v as (select label, w / sum(w) over () as weight from w),"
    " g0 as (select item, y::int as y, x::int as x from (select distinct item from l), range(6) a(y), range(6) b(x)), g as (select g0.*, coalesce(label, 0) as label from g0 left join l on l.item = g0.item and l.r = y and l.c = x)"
    " select item, case when k in (1, 2) then 5 - y else y end as r, case when k in (1, 3) then 5 - x else x end as c, k as aug_id, g.label, (g.label = 2)::int as hot_2, round(coalesce(weight, 0), 6)::double as weight from g left join v using (label), (select unnest([0, 1, 2, 3, 5]) as k)",
)(
    lambda s, d: training.label_tensors(_tensor_labels(s, d), 6, 6, (1, 2, 3, 5), 4, True, stats.class_weights(_tensor_labels(s, d).groupBy(F.col("label").alias("value")).agg(F.count("*").alias("n")), 0).select("value", "weight"))
    .select("item", "r", "c", "aug_id", "label", F.col("hot")[2].alias("hot_2"), F.round("weight", 6).alias("weight"))
)
query("p6_item_batches", _images + ", i as (select count(distinct item) as n from image), b as (select unnest(range(ceil(n / 7)::int)) as batch, n, ceil(n / 7)::int as m from i) select batch::bigint as batch, n // m + (batch < n % m)::int as n from b")(lambda s, d: training.item_batches(images(s, d), 7, 1).groupBy("batch").agg(F.count("*").alias("n")))
query("p7_valid_samples", _images + ", k as (select item, count(distinct t) as n from image group by all) select item from k where n = 4")(
    lambda s, d: training.valid_samples(training.samples_3d(images(s, d).where("t < 3 or item % 2 = 0"), ["b0"], 4).where(F.forall("images", lambda m: F.size(m) == 4)).select("item", F.filter("images", lambda m: F.exists(F.flatten(F.flatten(m)), lambda v: v.isNotNull())).alias("images")), 4, 4, 4).select("item")
)
query("p8_cap_rows", f"with {fx.LABEL} select count(*) as n, count(*) as apart, true as inside from label")(
    lambda s, d: training.cap_rows(fx.labels(s, d), keys=("item_id", "position")).join(fx.labels(s, d).select("item_id", "position", F.lit(True).alias("known")), ["item_id", "position"], "left").agg(F.count("*").alias("n"), F.count_distinct("item_id", "position").alias("apart"), F.every(F.coalesce("known", F.lit(False))).alias("inside"))
)
query("f15_assert_square", _mask + "select item, 2.5::double as scale_x, -2.5::double as scale_y from area")(lambda s, d: rasters.assert_square(grids(s, d, 2.5).select("item", F.col("scale").alias("scale_x"), (-F.col("scale")).alias("scale_y"))))
query("g7_target_scale", _mask + "select item, case when value = 0 then 5 else 20 end::double as scale from area")(
    lambda s, d: fx.areas(s, d).select("item", grid.target_scale(F.when(F.col("value") == 0, 5.0), F.lit(3857), F.lit(3857), F.lit(-20.0)).alias("scale"))
)
query("j5_index_bands", _scene + "select scene_id, case when platform like 'sentinel%' then 'B08,B04' when platform = 'LANDSAT_8' then 'B5,B4' when platform = 'LANDSAT_7' then 'B4,B3' end as bands from scene")(
    lambda s, d: fx.scenes(s, d).select("scene_id", F.when(F.col("platform").like("sentinel%"), ",".join(lookups.index_bands("ndvi", "SENTINEL_2").values())).when(F.col("platform") == "LANDSAT_8", ",".join(lookups.index_bands("ndvi", "LANDSAT_8").values())).when(F.col("platform") == "LANDSAT_7", ",".join(lookups.index_bands("ndvi", "LANDSAT_7").values())).alias("bands"))
)
query("p9_fit_weights", f"with {fx.LABEL}, n as (select value, count(*) as n from label where value <> 0 group by all) select value, round(sum(n) over () / (count(*) over () * n), 6)::double as weight from n")(
    lambda s, d: training.fit_weights(fx.labels(s, d).groupBy("value").agg(F.count("*").alias("n")), 0).withColumn("weight", F.round("weight", 6))
)
query("e10_evaluate", f"with {fx.PRED} select round(avg((y_pred - y_true) * (y_pred - y_true)), 4) as mse, round(sqrt(avg((y_pred - y_true) * (y_pred - y_true))), 4) as rmse from pred")(
    lambda s, d: training.evaluate(fx.predictions(s, d), ["mse", "rmse"]).select(F.round("mse", 4).alias("mse"), F.round("rmse", 4).alias("rmse"))
)
