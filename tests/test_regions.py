import random

import pytest
from pyspark.sql import functions as F

from eocube.functions.cells import qa_cloud
from eocube.operators import mosaic, regions

SCHEMA = "item int, r int, c int, m int"


def flood(m):
    """Cell -> region number, and each region's cells, in the order of reading."""
    of, groups = {}, []
    for start in sorted(m):
        if start not in of:
            group, todo = [], [start]
            of[start] = len(groups)
            while todo:
                r, c = todo.pop()
                group.append((r, c))
                for x in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                    if x not in of and m.get(x) == m[start]:
                        of[x] = len(groups)
                        todo.append(x)
            groups.append(sorted(group))
    return of, groups


def merged(m, threshold):
    of, groups = flood(m)
    best = {}
    for r, c in sorted(m):
        for x in ((r - 1, c), (r, c - 1)):
            if x in m and of[x] != of[r, c]:
                for a, b in ((of[r, c], of[x]), (of[x], of[r, c])):
                    if a not in best or len(groups[best[a]]) < len(groups[b]):
                        best[a] = b
    out = dict(m)
    for a, cells in enumerate(groups):
        if len(cells) < threshold:
            at, seen = a, set()
            while at is not None and at not in seen and len(groups[at]) < threshold:
                seen.add(at)
                at = best.get(at)
            if at is not None and at not in seen:
                out.update(dict.fromkeys(cells, m[groups[at][0]]))
    return out


def masks():
    """Random masks of several densities and shapes, with holes, a checkerboard, a spiral and a single row."""
    out = []
    for k, share in enumerate((0.1, 0.3, 0.5, 0.7, 0.95)):
        rnd = random.Random(k)
        h, w = ((16, 16), (9, 23), (31, 7), (17, 13), (5, 5))[k]
        out.append({(r, c): int(rnd.random() < share) for r in range(h) for c in range(w)})
    rnd = random.Random(9)
    out.append({(r, c): rnd.randrange(4) for r in range(15) for c in range(15)})
    out.append({(r, c): int(rnd.random() < 0.5) for r in range(14) for c in range(14) if rnd.random() < 0.8})
    out.append({(r, c): (r + c) % 2 for r in range(6) for c in range(7)})
    out.append({(r, c): 0 for r in range(12) for c in range(1)})
    out.append({(r, c): int(r % 2 == 0 or c == (11 if r % 4 == 1 else 0)) for r in range(13) for c in range(12)})
    return out


@pytest.fixture(scope="module")
def given(spark):
    rows = [(i, r, c, x) for i, m in enumerate(masks()) for (r, c), x in m.items()]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def test_regions_equal_the_flood_fill(given):
    got = {}
    for x in regions.label_regions(given, size=4).collect():
        got.setdefault(x.item, {})[x.r, x.c] = (x.region, x.region_cells, x.m)
    for i, m in enumerate(masks()):
        of, groups = flood(m)
        assert {k: v[1:] for k, v in got[i].items()} == {k: (len(groups[of[k]]), x) for k, x in m.items()}
        assert len({v[0] for v in got[i].values()}) == len(groups) == len({(of[k], v[0]) for k, v in got[i].items()})


@pytest.mark.parametrize(("threshold", "size"), [(3, 4), (6, 5), (40, 64)])
def test_sieve_equals_the_merge(given, threshold, size):
    got = {}
    for x in regions.sieve_regions(given, threshold, size=size).collect():
        got.setdefault(x.item, {})[x.r, x.c] = x.m
    for i, m in enumerate(masks()):
        assert got[i] == merged(m, threshold)
    assert any(m != merged(m, threshold) for m in masks())


def test_small_regions_go_to_the_largest_neighbour_not_the_other_value(spark):
    grid = ["0100", "1000", "0000"]  # the 0 in the corner has single neighbours, whose own largest neighbour is 0
    m = {(r, c): int(x) for r, row in enumerate(grid) for c, x in enumerate(row)}
    got = {(x.r, x.c): x.m for x in regions.sieve_regions(spark.createDataFrame([(1, r, c, x) for (r, c), x in m.items()], SCHEMA), 3, size=2).collect()}
    flip = {(x.r, x.c): x.m for x in mosaic.sieve(spark.createDataFrame([(1, r, c, x) for (r, c), x in m.items()], SCHEMA)).collect()}
    assert got == merged(m, 3) and got != flip


def test_keys_types_nulls_and_empty_masks(spark):
    rows = [("a", 1, r, c, None if (r, c) == (0, 1) else c == 2) for r in range(2) for c in range(3)] + [("b", 1, 0, 0, True)]
    mask = spark.createDataFrame(rows, "name string, t int, r int, c int, m boolean").withColumn("label", F.lit("x"))
    got = {(x.name, x.t, x.r, x.c): x.m for x in regions.sieve_regions(mask, 3, ["name", "t"], 2).collect()}
    assert got == {("a", 1, 0, 0): False, ("a", 1, 1, 0): False, ("a", 1, 1, 1): False, ("a", 1, 0, 2): False, ("a", 1, 1, 2): False, ("b", 1, 0, 0): True}
    none = spark.createDataFrame([], SCHEMA)
    assert regions.sieve_regions(none).count() == 0 and regions.label_regions(none).count() == 0


def test_composite_with_the_merging_sieve(spark):
    rows = [(1, 1, i, r, c, (r * 5 + c * 3 + i) % 7 + 1, 2 if (r * r + c * i) % 5 == 0 else 64) for i in (1, 2, 3) for r in range(6) for c in range(5)]
    cells = spark.createDataFrame(rows, "tile_id int, step_no int, idx int, r int, c int, b0 int, qa int")
    scene = ["tile_id", "step_no", "idx"]
    flags = regions.sieve_regions(cells.select(*scene, "r", "c", qa_cloud("qa").cast("int").alias("m")), 3, scene)
    want = mosaic.composite(cells.join(flags, [*scene, "r", "c"]), ["b0"], F.col("m") == 1)
    got = mosaic.composite_qa(cells, ["b0"], "qa", sieved=lambda mask, keys: regions.sieve_regions(mask, 3, keys))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
