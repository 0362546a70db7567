"""What large tables need: joins that don't send cells to the driver, tasks of bounded size, work that follows the input."""

import datetime as dt

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from eocube.operators import boxes, grid, intervals, mosaic, regions, warp
from eocube.plans import queries
from eocube.sources import fixtures as fx

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rasterised_samples_are_not_broadcast(spark):
    ring = F.expr("array(array(struct(0D as x, 0D as y), struct(0D as x, -3.25D as y), struct(3.25D as x, 0D as y), struct(0D as x, 0D as y)))")
    areas = spark.range(3).select(F.col("id").alias("item"), F.lit(7).alias("value"), F.lit("2024-01-01").cast("date").alias("date"), ring.alias("rings"))
    made = grid.rasterize_samples(areas, "value", 1.0)
    assert made.count() == 3 * 16 and made.where("v = 7").count() == 3 * 6
    assert "Broadcast" not in plan(made)


def test_regions_are_not_broadcast(spark):
    mask = spark.range(6).select("id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("r")).select("id", "r", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("c")).withColumn("m", ((F.col("r") + F.col("c")) % 3 > 0).cast("int"))
    for made in (regions.label_regions(mask, ["id"], 3), regions.sieve_regions(mask, 3, ["id"], 3), queries.first_cells(regions.label_regions(mask.withColumnRenamed("id", "item"), size=3))):
        assert "Broadcast" not in plan(made)


def test_cap_query_takes_all_labels(spark):
    made = queries.QUERIES["p8_cap_rows"](spark, "/root/testdata/sf0.01").first()
    assert (made.n, made.apart, made.inside) == (2000, 2000, True)


def test_first_valid_and_composites_are_hashed(spark):
    cells = queries.cells(spark, SMALL)
    text = plan(mosaic.first_valid(cells, queries.B))
    assert "HashAggregate" in text and "SortAggregate" not in text
    for made in (mosaic.composite(cells, queries.B, F.col("scl") == 3), mosaic.composite_qa(cells, queries.B, "qa")):
        assert "collect_list" not in plan(made)


def test_scenes_are_dealt_out_before_they_become_cells(spark):
    for made in (queries.cells(spark, SMALL), queries.by_scene(spark, SMALL), queries.speckled(spark, SMALL), fx.warp_chunks(spark, SMALL)):
        assert "REPARTITION_BY_NUM" in plan(made)
    assert fx.tasks(spark, SMALL, 1 << 20) == 1000


def test_cover_looks_at_no_level_that_cannot_occur(spark):
    days = spark.range(-70, 70, 7).select(F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("a"))
    for n in (0, 1, 2, 3, 4, 7, 8, 31, 64):
        made = days.select("a", F.date_add("a", n - 1).alias("b")).select("a", intervals.cover(F.col("a"), F.col("b")).alias("x")).collect()
        for row in made:
            got = sorted(day for x in row.x for day in range(x.block << x.level, (x.block + 1) << x.level))
            first = (row.a - dt.date(1970, 1, 1)).days
            assert got == list(range(first, first + n))
    assert "sequence(0, 24" not in plan(days.select(intervals.cover(F.col("a"), F.col("a"))))


def test_composite_of_many_scenes_keeps_no_arrays(spark):
    """Cells that some scenes lack, 300 scenes of a step, against the definition."""
    rows = [(1, 0, 0, c, i, (i * 7 + c) % 3, int((i * 5 + c) % 11 < 9)) for c in range(3) for i in range(1, 301) if (i + c) % 4]
    cells = spark.createDataFrame(rows, "tile_id int, step_no int, r int, c int, idx int, b0 int, m int")
    want, states = {}, {}
    for c in range(3):
        pick, masked = None, 1
        for _, _, _, _, i, b, m in sorted(x for x in rows if x[3] == c):
            pick = b if pick is None or masked and b else pick
            masked &= m
            states[c, i] = pick, masked
    ends = [i for i in range(1, 301) if (at := [states[c, i] for c in range(3) if (c, i) in states]) and all(p for p, _ in at) and sum(m for _, m in at) / len(at) <= 0.05]
    stop = min(ends, default=300)
    want = {c: states[c, stop][0] for c in range(3) if (c, stop) in states}
    assert {x.c: x.b0 for x in mosaic.composite(cells, ["b0"], F.col("m") == 1).collect()} == want


def test_warp_takes_many_blocks_at_once(spark):
    """Not a group and an Arrow stream for each block; blocks that lie across batches are whole."""
    made = queries.QUERIES["g5_g6_warp"](spark, SMALL)
    assert "FlatMapGroupsInArrow" not in plan(made) and plan(made).count("REPARTITION_BY_NUM") == 2  # chunks' scenes and pairs
    want = sorted(made.collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert len(want) > 1000 and sorted(queries.QUERIES["g5_g6_warp"](spark, SMALL).collect()) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_blocks_are_cut_where_a_key_changes():
    keys = [(1, 0), (1, 0), (1, None), (1, None), (2, None), (2, 0), (2, 0), (2, 0)]
    for size in (1, 2, 3, 5, 8):
        batches = [pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in keys[i : i + size]], pa.schema({"a": pa.int64(), "b": pa.int64()})) for i in range(0, len(keys), size)]
        got = [list(zip(*b.to_pydict().values(), strict=True))[lo:hi] for b, at in warp.whole_blocks(batches, ["a", "b"]) for lo, hi in zip(at, [*at[1:], b.num_rows], strict=True)]
        assert got == [keys[:2], keys[2:4], keys[4:5], keys[5:]]
    assert list(warp.whole_blocks([], ["a"])) == []


def test_crowded_cells_are_dealt_to_pieces(spark):
    """Boxes as large as their domain meet in a few cells; each piece of one side meets each of the other in a group."""
    side = lambda df, p: df.select("id", (F.col("id") * 7919 % 1003).cast("double").alias("x"), (F.col("id") * 104729 % 997).cast("double").alias("y"), F.pow(F.lit(10.0), F.col("id") % 4).alias("s")).selectExpr(f"id as {p}id", f"x as {p}xmin", f"y as {p}ymin", f"x + s as {p}xmax", f"y + s as {p}ymax")
    a, b = side(spark.range(700), "a_"), side(spark.range(300), "")
    want = a.crossJoin(b).where("a_xmin <= xmax and xmin <= a_xmax and a_ymin <= ymax and ymin <= a_ymax").count()
    at = boxes.in_cells(a, "a_", boxes.levels_of(b), False), boxes.in_cells(b, "", [], True)
    hot = boxes.crowded(*at, 16).persist()
    assert hot.where("_lefts > 1 and _rights > 1").count() > 0
    left, right = boxes.dealt(at[0], hot, "_left", "_right"), boxes.dealt(at[1], hot, "_right", "_left")
    most = [df.groupBy(*boxes.CELL, "_left", "_right").count().agg(F.max("count")).first()[0] for df in (left, right)]
    assert max(most) < 48  # of 500 and 75 in one cell
    for piece in (16, 50, boxes.PIECE):
        got = boxes.meeting(a, b, piece=piece)
        assert got.count() == want == got.select("a_id", "id").distinct().count() > 20_000
        assert ("_left" in plan(got)) == (piece < boxes.PIECE)


def test_area_stack_equals_its_sql_where_cells_span_more_than_one(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"copy (select * replace (user_id + 30000 as user_id) from '{SMALL}/events.parquet' where user_id < 3) to '{tmp_path}/events.parquet' (format parquet)")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    made = queries.QUERIES["m8_area_stack"](spark, str(tmp_path))
    want = con.execute(f"with o as ({queries.ORACLES['m8_area_stack']}) select {', '.join(made.columns)} from o").fetchall()
    assert len(want) > 500 and sorted(map(tuple, made.collect())) == sorted(want)


def test_regions_send_few_bytes_for_a_cell(spark):
    mask = queries.speckled(spark, SMALL).localCheckpoint()
    store = spark.sparkContext._jsc.sc().statusStore()

    def sent():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        seen = store.executorList(False)
        return sum(seen.apply(i).totalShuffleWrite() for i in range(seen.size()))

    for made in (lambda: queries.first_cells(regions.label_regions(mask, size=5)), lambda: regions.sieve_regions(mask, 3, size=5)):
        before = sent()
        assert made().count() == 120 * 1000
        assert sent() - before < 5 * 120 * 1000


def test_tiles_of_one_mask_and_many_agree(spark):
    m = "case when id < 3 then (r * 7 + c * c * id) % 3 when id = 3 then -40000000000 * ((r * c) % 2) else pmod(r * 31 + c * 17, 5) * 300 - 600 end"
    mask = spark.range(6).select("id", F.explode(F.sequence(F.lit(0), F.lit(13))).alias("r")).select("id", "r", F.explode(F.sequence(F.lit(0), F.lit(10))).alias("c")).where("(r * 11 + c) % 13 > 0").withColumn("m", F.expr(m)).orderBy(F.xxhash64("id", "r", "c"))
    for of in (lambda size: regions.label_regions(mask, ["id"], size), lambda size: regions.sieve_regions(mask, 4, ["id"], size)):
        want = sorted(map(tuple, of(64).collect()))
        assert len(want) == mask.count() and want == sorted(map(tuple, of(1).collect()))


def test_crowded_cells_copy_a_row_to_few_pieces(spark):
    cell = [F.lit(0).alias(k) for k in boxes.CELL]
    left, right = (spark.range(n).select("id", *cell) for n in (30_000, 2_000))
    made = boxes.crowded(left, right, 10)
    lefts, rights = made.select("_lefts", "_rights").first()
    assert 1 < rights < lefts <= 256 and lefts * rights < 300
    assert boxes.dealt(left, made, "_left", "_right").count() + boxes.dealt(right, made, "_right", "_left").count() < 10 * 32_000
    one = boxes.crowded(left, spark.range(1).select("id", *cell), 10).select("_lefts", "_rights").first()
    assert tuple(one) == (256, 1)
