"""Joins of boxes that meet, over grids of several levels.

A box belongs to the level whose cells, of side 2^level, are at least as large as it is, where it touches four cells at
most. Boxes of one level meet in a cell of theirs; of two levels, in a cell of the coarser one, to which the smaller box
is put as well. So a box is written four times at most for each level that the other side has above its own, however
large boxes are, and small ones share cells with boxes of their own size alone. A pair is reported in one cell, that of
the lower corner of what the boxes have in common. Where a cell holds more boxes than a piece, as the coarsest ones do, both
sides are dealt to pieces, and each piece of one side meets each of the other in a group of its own. A cell has GROUPS such
groups at most, the larger side having more pieces, so what is copied grows with the boxes, not with their square; a group
streams one side and holds, or spills, its part of the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDES = ("xmin", "ymin", "xmax", "ymax")
#: Smaller boxes, and points, count as of this level.
FINEST = -20
CELL = ["_level", "_x", "_y"]
#: Boxes, about, of each side that one group of a crowded cell compares.
PIECE = 4096
#: Groups, about, of a crowded cell at most: enough for the cores of a cluster.
GROUPS = 256


def box_level(prefix: str = "") -> Column:
    xmin, ymin, xmax, ymax = (F.col(prefix + k) for k in SIDES)
    side = F.greatest(xmax - xmin, ymax - ymin).cast("double")
    return F.greatest(F.lit(FINEST), F.when(side > 0, F.ceil(F.log2(side))).otherwise(FINEST)).cast("int")


def levels_of(boxes: DataFrame, prefix: str = "") -> list[int]:
    """The levels that occur: as many as there are powers of two between the smallest and the largest box."""
    return sorted(r[0] for r in boxes.select(box_level(prefix).alias("k")).distinct().collect())


def in_cells(boxes: DataFrame, prefix: str, levels: list[int], own: bool) -> DataFrame:
    """A row for each cell (_level, _x, _y) that a box touches: at its own level, or at those of `levels` above it."""
    level = box_level(prefix)
    at = F.array(level) if own else F.filter(F.array(*[F.lit(k) for k in levels]).cast("array<int>"), lambda k: k > level)
    span = lambda lo, hi: F.explode(F.sequence(*[F.floor(F.col(prefix + k) / F.pow(F.lit(2.0), F.col("_level"))) for k in (lo, hi)]))
    return boxes.withColumn("_level", F.explode(at)).withColumn("_x", span("xmin", "xmax")).withColumn("_y", span("ymin", "ymax"))


def crowded(left: DataFrame, right: DataFrame, piece: int) -> DataFrame:
    """Cells of both sides in which one has more than `piece` boxes, with each side's number of pieces, _lefts and _rights. By
    their size these are fewer than 1 in `piece` rows. Where pieces of `piece` boxes would make more than GROUPS groups,
    both sides have fewer, in the ratio of their boxes, by which the fewest are copied."""
    of = lambda df, n: df.groupBy(*CELL).agg(F.count("*").alias(n))
    cells = of(left, "_l").join(of(right, "_r"), CELL).where(F.greatest("_l", "_r") > piece)
    part = lambda n, o: F.least(F.ceil(F.col(n) / piece), F.greatest(F.lit(1), F.least(F.lit(GROUPS), F.round(F.sqrt(F.col(n) / F.col(o) * GROUPS)))).cast("long"))
    return cells.select(*CELL, part("_l", "_r").alias("_lefts"), part("_r", "_l").alias("_rights"))


def dealt(side: DataFrame, cells: DataFrame, own: str, other: str) -> DataFrame:
    """A row of a crowded cell goes to the piece that its hash says, once for each of the other side's pieces. Rows
    equal in all columns share a piece."""
    n = lambda k: F.coalesce(F.col(k + "s"), F.lit(1))
    out = side.withColumn("_hash", F.xxhash64(*side.columns)).join(cells, CELL, "left")
    return out.withColumn(own, F.pmod(F.col("_hash"), n(own))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), n(other) - 1))).drop("_hash", "_lefts", "_rights")


def meeting(a: DataFrame, b: DataFrame, a_prefix: str = "a_", b_prefix: str = "", piece: int = PIECE) -> DataFrame:
    """Rows of a and b whose boxes (prefix + xmin, ymin, xmax, ymax) have a point in common, each pair once. Boxes with a
    null or not-a-number side, or whose sides are swapped, meet nothing. Other column names must differ."""
    sound = lambda df, p: df.where(" and ".join([f"{p}xmin <= {p}xmax and {p}ymin <= {p}ymax", *[f"not isnan({p}{k})" for k in SIDES]]))
    a, b = sound(a, a_prefix), sound(b, b_prefix)
    a_levels, b_levels = levels_of(a, a_prefix), levels_of(b, b_prefix)
    meet = " and ".join(f"{a_prefix}{k}min <= {b_prefix}{k}max and {a_prefix}{k}max >= {b_prefix}{k}min" for k in "xy")
    # what two boxes have in common begins in a cell that is the first of one of them, along rows and columns
    first = lambda df, p, to: df.withColumns({f"{to}_{k}": F.col(f"_{k}") == F.floor(F.col(f"{p}{k}min") / F.pow(F.lit(2.0), F.col("_level"))) for k in "xy"})

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        cells, on = crowded(left, right, piece), CELL
        left, right = first(left, a_prefix, "_a"), first(right, b_prefix, "_b")
        if not cells.isEmpty():
            on = [*CELL, "_left", "_right"]
            left, right = dealt(left, cells, "_left", "_right"), dealt(right, cells, "_right", "_left").hint("merge")
        return left.join(right, on).where(meet).where("(_a_x or _b_x) and (_a_y or _b_y)").select(*a.columns, *b.columns)

    coarse = joined(in_cells(a, a_prefix, [], True), in_cells(b, b_prefix, [], True).unionByName(in_cells(b, b_prefix, a_levels, False)))
    return coarse.unionByName(joined(in_cells(a, a_prefix, b_levels, False), in_cells(b, b_prefix, [], True)))
