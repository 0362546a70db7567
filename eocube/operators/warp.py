"""Scenes of any supported reference system and resolution on an area's grid, read by chunks.

Sources are chunk rows (scene_id, chunk_row, chunk_col, h, w and one array per band, in row order). The target grid is
cut into blocks; each block meets the few chunks that its cells lie in by an equi-join on the chunk's place, so what is
outside an area's window is never read into cells, and no single cell is shuffled. Where chunks are stored by chunk_row,
folders that no block needs aren't read. A task gets
its blocks sorted, each with its chunks in a row, many small blocks to an Arrow batch; it holds a batch and a block, whose
size is bounded, as blocks shrink when the target's cells are larger than the source's.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.functions.projections import arrays_between

#: Points along each side of a block whose source positions bound its window.
SIDE = 8
#: Cells, about, that leave a task at once.
OUT = 1 << 17
GRID = ["x0", "y0", "width", "height", "scale", "epsg"]
SOURCE = ["sx0", "sy0", "sscale", "sepsg"]


def source_place(grid: dict, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column, in source cells and their parts, of positions of the target grid."""
    px, py = arrays_between(x, y, grid["epsg"], grid["sepsg"])
    return (grid["sy0"] - py) / grid["sscale"], (px - grid["sx0"]) / grid["sscale"]


def cell_ratio(grid: dict) -> float:
    """Source cells along the side of the target's middle cell."""
    s = grid["scale"]
    x, y = grid["x0"] + grid["width"] * s / 2, grid["y0"] - grid["height"] * s / 2
    row, col = source_place(grid, np.array([x - s / 2, x + s / 2]), np.array([y, y]))
    return float(np.hypot(row[1] - row[0], col[1] - col[0]))


def source_window(grid: dict, x: tuple[float, float], y: tuple[float, float], pad: float) -> tuple[int, int, int, int]:
    """First and last row, first and last column of the source cells that a box of the target can need, by its outline."""
    at = np.linspace(0, 1, SIDE + 1)
    ax, ay = x[0] + at * (x[1] - x[0]), y[0] + at * (y[1] - y[0])
    row, col = source_place(grid, np.concatenate([ax, ax, np.full(SIDE + 1, x[0]), np.full(SIDE + 1, x[1])]), np.concatenate([np.full(SIDE + 1, y[0]), np.full(SIDE + 1, y[1]), ay, ay]))
    return max(0, math.floor(row.min() - pad)), math.floor(row.max() + pad), max(0, math.floor(col.min() - pad)), math.floor(col.max() + pad)


def block_windows(pairs: DataFrame, keys: list[str], size: int, block: int, kernel: float | None = None) -> DataFrame:
    """A row for each block (_br, _bc) of a pair's target grid and each place of a chunk that it can need, null if that is
    outside; _block is the block's side, _reach how many source cells the kernel takes to each side: `kernel`, or as many
    as a target cell spans, one at least."""
    plan = ["_block", "_br", "_bc", "_reach", "chunk_row", "chunk_col"]

    def run(batches):
        for b in batches:
            of, out = [], [[] for _ in plan]
            for k, grid in enumerate(b.select([*GRID, *SOURCE]).to_pylist()):
                ratio = cell_ratio(grid)
                reach, n, s = max(1.0, ratio) if kernel is None else kernel, max(1, min(block, int(block / ratio))), grid["scale"]
                for br in range(-(-grid["height"] // n)):
                    for bc in range(-(-grid["width"] // n)):
                        x = tuple(grid["x0"] + min(c * n, grid["width"]) * s for c in (bc, bc + 1))
                        y = tuple(grid["y0"] - min(r * n, grid["height"]) * s for r in (br, br + 1))
                        r0, r1, c0, c1 = source_window(grid, x, y, reach + 1)
                        places = [(cr, cc) for cr in range(r0 // size, r1 // size + 1) for cc in range(c0 // size, c1 // size + 1)] if r0 <= r1 and c0 <= c1 else []
                        for place in places or [(None, None)]:
                            of.append(k)
                            for column, v in zip(out, (n, br, bc, reach, *place), strict=True):
                                column.append(v)
            same = b.take(pa.array(of, pa.int64()))
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([*same.columns, *[pa.array(c, t) for c, t in zip(out, kinds, strict=True)]], [*same.schema.names, *plan])

    p = pairs.select(*keys, *[F.col(c).cast("int" if c in ("width", "height", "epsg", "sepsg") else "double").alias(c) for c in (*GRID, *SOURCE)])
    schema = ", ".join(f"{c} {t}" for c, t in p.dtypes)
    # pairs are a few bytes each, of which Spark would make one task
    return p.repartition(pairs.sparkSession.sparkContext.defaultParallelism, *keys).mapInArrow(run, f"{schema}, _block int, _br int, _bc int, _reach double, chunk_row int, chunk_col int")


def block_places(x: np.ndarray, y: np.ndarray, epsg: int, sepsg: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Source positions of the block's cell centres at columns x and rows y. From the four corners, linearly, if that is
    off by at most `tolerance` (in source units) at the middles of sides and block; else each by itself."""
    grid_x, grid_y = np.meshgrid(x, y)
    if tolerance > 0 and epsg != sepsg and len(x) > 2 and len(y) > 2:
        u, v = np.array([0.0, 0.5, 1.0]), np.array([0.0, 0.5, 1.0])
        px, py = arrays_between(*np.meshgrid(x[0] + u * (x[-1] - x[0]), y[0] + v * (y[-1] - y[0])), epsg, sepsg)
        linear = lambda p, a, b: p[0, 0] * (1 - a) * (1 - b) + p[0, 2] * a * (1 - b) + p[2, 0] * (1 - a) * b + p[2, 2] * a * b
        if max(np.abs(linear(p, *np.meshgrid(u, v)) - p).max() for p in (px, py)) <= tolerance:
            a, b = (grid_x - x[0]) / (x[-1] - x[0]), (grid_y - y[0]) / (y[-1] - y[0])
            return linear(px, a, b), linear(py, a, b)
    return arrays_between(grid_x, grid_y, epsg, sepsg)


def nearest(source: np.ndarray, known: np.ndarray, row: np.ndarray, col: np.ndarray, nodata: float) -> np.ndarray:
    """The value of the source cell that holds each position; nodata outside."""
    r, c = np.floor(row).astype(np.int64), np.floor(col).astype(np.int64)
    inside = (r >= 0) & (r < source.shape[0]) & (c >= 0) & (c < source.shape[1])
    r, c = np.where(inside, r, 0), np.where(inside, c, 0)
    return np.where(inside & known[r, c], source[r, c], nodata)


def bilinear(sources: list[np.ndarray], known: np.ndarray, row: np.ndarray, col: np.ndarray, reach: float, nodata: float) -> list[np.ndarray]:
    """For each source of one shape, the mean of its cells within reach, weighted by a triangle kernel along rows and
    columns, nodata left out and rounded (half away from 0); nodata where a position is outside of the source."""
    h, w = known.shape
    by = np.arange(int(math.floor(2 * reach)) + 1)[:, None]
    r, c = (np.ceil(p.ravel() - 0.5 - reach).astype(np.int64) + by for p in (row, col))  # of each tap and position
    along = lambda at, p: np.maximum(1 - np.abs(at + 0.5 - p.ravel()) / reach, 0)
    k = np.where((r >= 0) & (r < h), along(r, row), 0)[:, None] * np.where((c >= 0) & (c < w), along(c, col), 0)[None]
    k = k.reshape(len(by) ** 2, -1)
    at = (np.clip(r, 0, h - 1)[:, None] * w + np.clip(c, 0, w - 1)[None]).reshape(k.shape)
    k = np.where(known.ravel()[at], k, 0)
    outside = nearest(np.ones(known.shape), known, row, col, 0) == 0

    def mean(source: np.ndarray) -> np.ndarray:
        v = source.ravel()[at]
        some = np.where(v != nodata, k, 0)
        weight = some.sum(axis=0)
        with np.errstate(invalid="ignore", divide="ignore"):
            of = (some * v).sum(axis=0) / weight
        return np.where(outside, nodata, np.where(weight > 0, np.sign(of) * np.floor(np.abs(of) + 0.5), nodata).reshape(row.shape))

    return [mean(s) for s in sources]


def block_starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """The rows at which any of the keys changes; the first is one."""
    change = np.zeros(batch.num_rows, dtype=bool)
    change[:1] = True
    for k in keys:
        code = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(change)


def whole_blocks(batches, keys: list[str]):
    """The batches cut anew, so that no block (rows in a row with equal keys) is in two of them, each with its starts."""
    rest = None
    for b in batches:
        if b.num_rows == 0:
            continue
        b = b if rest is None else pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0]
        starts = block_starts(b, keys)
        rest = b.slice(starts[-1])
        if len(starts) > 1:
            yield b.slice(0, starts[-1]), starts[:-1]
    if rest is not None:
        yield rest, np.zeros(1, dtype=np.int64)


def warp(pairs: DataFrame, chunks: DataFrame, keys: list[str], bands: list[str], discrete: list[str] = (), size: int = 256, nodata: int = 0, tolerance: float = 0.125, block: int = 256, reach: float | None = None) -> DataFrame:
    """Cells (keys, r, c, bands) of every pair of a target grid and a scene.

    pairs has keys, scene_id, the grid (x0, y0, width, height, scale, epsg) and the source's (sx0, sy0, sscale, sepsg), both
    with square cells and their origin at the top left; keys name a pair. Bands in `discrete` are resampled by the
    nearest source cell, the others bilinearly over as many cells as a target cell spans, or over `reach` cells to each
    side, 1 being the four nearest whatever the scales. Cells outside of the source or in chunks that aren't there are
    nodata. Positions may be off by `tolerance` source cells where that spares projections; with 0 they are exact.
    Systems other than EPSG 4326, 3857 and UTM are an error.
    """
    own = [*keys, *[c for c in ("scene_id",) if c not in keys]]
    rows = block_windows(pairs, own, size, block, reach).join(chunks.select("scene_id", "chunk_row", "chunk_col", "h", "w", *bands).hint("merge"), ["scene_id", "chunk_row", "chunk_col"], "left")
    of_block = [*own, "_br", "_bc"]
    fields = {f.name: f.dataType.simpleString() for f in pairs.select(*own).schema}

    def one(row: dict, parts: list[tuple], images_of: dict) -> tuple:
        """Rows, columns and bands of one block; parts are its chunks' rows, places and sizes."""
        r0, c0 = min((p[1] for p in parts), default=0) * size, min((p[2] for p in parts), default=0) * size
        shape = max((p[1] * size + p[3] for p in parts), default=1) - r0, max((p[2] * size + p[4] for p in parts), default=1) - c0
        known, images = np.zeros(shape, dtype=bool), {b: np.zeros(shape) for b in bands}
        for k, cr, cc, h, w in parts:
            place = slice(cr * size - r0, cr * size - r0 + h), slice(cc * size - c0, cc * size - c0 + w)
            known[place] = True
            for b, (values, at) in images_of.items():
                images[b][place] = values[at[k] : at[k + 1]].reshape(h, w)
        n, s = row["_block"], row["scale"]
        r = np.arange(row["_br"] * n, min((row["_br"] + 1) * n, row["height"]))
        c = np.arange(row["_bc"] * n, min((row["_bc"] + 1) * n, row["width"]))
        x, y = block_places(row["x0"] + (c + 0.5) * s, row["y0"] - (r + 0.5) * s, row["epsg"], row["sepsg"], tolerance * row["sscale"])
        at_row, at_col = (row["sy0"] - y) / row["sscale"] - r0, (x - row["sx0"]) / row["sscale"] - c0
        smooth = [b for b in bands if b not in discrete]
        out = dict(zip(smooth, bilinear([images[b] for b in smooth], known, at_row, at_col, row["_reach"], nodata) if smooth else [], strict=True))
        out.update({b: nearest(images[b], known, at_row, at_col, nodata) for b in bands if b in discrete})
        return np.repeat(r, len(c)), np.tile(c, len(r)), *(out[b].ravel() for b in bands)

    def run(batches):
        for b, starts in whole_blocks(batches, of_block):
            place = list(zip(*(b.column(k).to_pylist() for k in ("chunk_row", "chunk_col", "h", "w")), strict=True))
            images_of = {k: (b.column(k).values.to_numpy(zero_copy_only=False), b.column(k).offsets.to_numpy()) for k in bands}
            first = b.select([*GRID, *SOURCE, "_block", "_br", "_bc", "_reach"]).take(pa.array(starts)).to_pylist()
            held, n = [], 0
            for i, (row, lo, hi) in enumerate(zip(first, starts, [*starts[1:], b.num_rows], strict=True)):
                held.append((lo, *one(row, [(k, *place[k]) for k in range(lo, hi) if place[k][2] is not None], images_of)))
                n += len(held[-1][1])
                if n >= OUT or i + 1 == len(starts):
                    of, r, c, *values = ([h[k] for h in held] for k in range(len(held[0])))
                    same = b.select(own).take(pa.array(np.repeat(of, [len(a) for a in r])))
                    cells = [pa.array(np.concatenate(a).astype(np.int32)) for a in (r, c, *values)]
                    yield pa.RecordBatch.from_arrays([*same.columns, *cells], [*own, "r", "c", *bands])
                    held, n = [], 0

    schema = ", ".join([*(f"{k} {t}" for k, t in fields.items()), "r int", "c int", *(f"{b} int" for b in bands)])
    return rows.repartition(*of_block).sortWithinPartitions(*of_block).mapInArrow(run, schema)
