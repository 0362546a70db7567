"""Models over overlapping windows of images, by blocks of cells with a halo.

A window belongs to the block that holds its first cell. Each chunk goes to its own block and, cut to the strips that
windows reach into, to the blocks above and to the left; so a cell is sent as often as there are blocks that need it,
not once for each window. Predictions are summed on the block before they leave it, and the parts that reach into
neighbours are added up there. Blocks of one place are predicted together, up to MOST_CELLS cells, as a call for each of
many small ones would take longer than its work; images of any size are fine. Images of up to TILE x TILE chunks and
MOST_CELLS values are sent once, each to a task, in as few bytes as their values need, and are done there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.operators.regions import whole_groups

#: Values of the blocks that are predicted at once; one block at least.
MOST_CELLS = 1 << 22
#: Chunks along each side of an image that a task takes whole.
TILE = 4


def window_starts(n: int, window: int, ratio: float) -> np.ndarray:
    """First cells of the windows along a side of n cells; the last one is moved back to the edge."""
    step = max(1, int(window * ratio))
    return np.unique(np.maximum(0, np.minimum(np.arange(0, max(1, n), step), n - window)))


def halo_strips(chunks: DataFrame, bands: list[str], size: int, reach: int) -> DataFrame:
    """Chunk rows (item, t, chunk_row, chunk_col, h, w, bands, height, width) as rows for each block (br, bc) that needs
    cells of theirs, cut to at most `reach` cells behind the block: r0, c0, h, w and the bands as doubles."""
    spans = -(-reach // size)

    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(10 + len(bands))]
            item, t, cr, cc, h, w, height, width = (b.column(c).to_pylist() for c in ("item", "t", "chunk_row", "chunk_col", "h", "w", "height", "width"))
            for k in range(b.num_rows):
                images = [np.asarray(b.column(n)[k].values.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(h[k], w[k]) for n in bands]
                for dr in range(min(spans, cr[k]) + 1):
                    for dc in range(min(spans, cc[k]) + 1):
                        rows, cols = min(h[k], size + reach - dr * size), min(w[k], size + reach - dc * size)
                        row = [item[k], t[k], cr[k] - dr, cc[k] - dc, cr[k] * size, cc[k] * size, rows, cols, height[k], width[k], *(np.ascontiguousarray(m[:rows, :cols]).ravel() for m in images)]
                        for column, v in zip(out, row, strict=True):
                            column.append(v)
            if out[0]:
                kinds = [b.column("item").type, *[pa.int32()] * 9, *[pa.list_(pa.float64())] * len(bands)]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)], ["item", "t", "br", "bc", "r0", "c0", "h", "w", "height", "width", *bands])

    kind = dict(chunks.dtypes)["item"]
    asked = chunks.select("item", *[F.col(c).cast("int").alias(c) for c in ("t", "chunk_row", "chunk_col", "h", "w", "height", "width")], *bands)
    return asked.mapInArrow(run, f"item {kind}, t int, br int, bc int, r0 int, c0 int, h int, w int, height int, width int, " + ", ".join(f"{b} array<double>" for b in bands))


def narrowed(column: pa.ListArray) -> tuple[pa.Array, pa.Array]:
    """Bytes of each list and how many a value has: as few as the column's whole numbers need, or 0 for doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    whole = values.dtype.kind == "i"
    kind = np.min_scalar_type(min(int(values.min(initial=0)), -1 - int(values.max(initial=0)))) if whole else np.dtype(np.float64)
    ends = np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy() * kind.itemsize)).astype(np.int32)
    raw = pa.BinaryArray.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values.astype(kind)))])
    return raw, pa.array(np.full(len(column), kind.itemsize if whole else 0, dtype=np.int32))


def widened(raw: pa.BinaryArray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What narrowed() made as doubles, and where each list begins."""
    ends = np.frombuffer(raw.buffers()[1], dtype=np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2], dtype=np.uint8)
    each = np.where(width == 0, 8, width)
    n = np.diff(ends) // each
    start = np.append(0, np.cumsum(n))
    out = np.empty(start[-1])
    for w in np.unique(width).tolist():
        some = np.flatnonzero(np.repeat(width == w, n))
        row = np.repeat(np.arange(len(n)), n)[some]
        at = ends[row] + (some - start[row]) * each[row]
        out[some] = np.ascontiguousarray(data[at[:, None] + np.arange(w or 8)]).view(f"i{w}" if w else "f8").ravel()
    return out, start


def sent_whole(chunks: DataFrame, meta: DataFrame, bands: list[str], size: int) -> DataFrame:
    """Rows of images that a task takes whole, sorted by item: one of meta, with t = -1, height and width, and the chunks, of
    which there can be others as well."""
    kinds = dict(chunks.dtypes)
    ints = ["t", "chunk_row", "chunk_col", "h", "w"]

    def run(batches):
        for b in batches:
            if b.num_rows:
                t, cr, cc, h, w = (b.column(k) for k in ints)
                first = [pa.compute.multiply(v, pa.scalar(size, pa.int32())) for v in (cr, cc)]
                none = pa.array(np.zeros(b.num_rows, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([b.column("item"), t, *first, h, w, none, none, *(x for k in bands for x in narrowed(b.column(k)))], names)

    names = ["item", "t", "r0", "c0", "h", "w", "height", "width", *(x for k in bands for x in (k, f"_{k}"))]
    few = chunks.where((F.col("chunk_row") < TILE) & (F.col("chunk_col") < TILE) & F.col("item").isNotNull())
    few = few.select("item", *[F.col(c).cast("int").alias(c) for c in ints], *bands)
    rows = few.mapInArrow(run, f"item {kinds['item']}, " + ", ".join([*(f"{c} int" for c in names[1:8]), *(f"`{k}` binary, `_{k}` int" for k in bands)]))
    zero, none = F.lit(0), F.lit(b"")
    sides = meta.select("item", F.lit(-1).alias("t"), *[zero.alias(c) for c in ("r0", "c0", "h", "w")], *[F.col(c).cast("int").alias(c) for c in ("height", "width")], *(x for k in bands for x in (none.alias(k), zero.alias(f"_{k}"))))
    return rows.unionByName(sides.where(F.col("item").isNotNull())).repartition("item").sortWithinPartitions("item")


def predict_windows(chunks: DataFrame, meta: DataFrame, bands: list[str], model, classes: int, size: int, window: int, ratio: float = 0.5, times: int = 1, border: int = 0, nodata: float = -9999.0) -> DataFrame:
    """(item, r, c, probs): for each cell the mean of the predictions of all windows that hold it.

    chunks(item, t, chunk_row, chunk_col, h, w, an array per band) have sides of `size` cells, t counts from 0 to times - 1,
    meta(item, height, width). model takes windows as an array [window, time, row, column, band], missing cells and
    times 0, and returns [window, row, column, class] for `classes` classes. Windows lie `window` * ratio cells apart; images smaller
    than a window are one window of their own size. The outer `border` cells of a window don't count, but for those at
    the image's edge; cells that no window counts for are nodata.
    """
    reach, n = window - 1, len(bands)
    kind = dict(chunks.dtypes)["item"]
    whole = (F.col("height") <= size * TILE) & (F.col("width") <= size * TILE) & (F.col("height").cast("long") * F.col("width") <= MOST_CELLS // max(1, times * n))
    part = ["item", "br", "bc", "h", "w", "count", "total"]

    def predicted(table: pa.Table, images: dict, place: tuple, m: int, rows_of: np.ndarray, block_of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Sums and counts of m blocks of one place (br, bc, height, width); rows_of are all rows of theirs, images each
        band's values and where those of a row begin."""
        br, bc, height, width = place
        top, left = br * size, bc * size
        bottom, right = min(height, top + size + reach), min(width, left + size + reach)
        rows, cols = (s[s // size == at] - at * size for s, at in ((window_starts(height, window, ratio), br), (window_starts(width, window, ratio), bc)))
        if not len(rows) or not len(cols):
            return None
        hh, ww = min(window, height), min(window, width)
        x = np.zeros((m, times, bottom - top, right - left, n))
        spots, kind_of = np.unique(np.stack([table.column(c).to_numpy()[rows_of] for c in ("t", "r0", "c0", "h", "w")]), axis=1, return_inverse=True)
        for k, (t, r0, c0, h, w) in enumerate(spots.T.tolist()):
            some = np.flatnonzero(kind_of.ravel() == k)
            for i, b in enumerate(bands if 0 <= t < times else ()):
                values, begin = images[b]
                cells = np.nan_to_num(values[begin[rows_of[some]][:, None] + np.arange(h * w)]).reshape(len(some), h, w)
                x[block_of[some], t, r0 - top : r0 - top + h, c0 - left : c0 - left + w, i] = cells[:, : bottom - r0, : right - c0]
        views = np.lib.stride_tricks.sliding_window_view(x, (hh, ww), axis=(2, 3))[:, :, rows][:, :, :, cols]
        windows = views.transpose(0, 2, 3, 1, 5, 6, 4).reshape(m * len(rows) * len(cols), times, hh, ww, n)
        p = np.asarray(model(windows), dtype=np.float64).reshape(m, len(rows), len(cols), hh, ww, classes)
        total, count = np.zeros((m, *x.shape[2:4], classes)), np.zeros(x.shape[2:4], dtype=np.int64)
        for i, r in enumerate(rows.tolist()):
            a, b = (0 if top + r == 0 else border), (hh if top + r + hh >= height else hh - border)
            for j, c in enumerate(cols.tolist()):
                d, e = (0 if left + c == 0 else border), (ww if left + c + ww >= width else ww - border)
                total[:, r + a : r + b, c + d : c + e] += p[:, i, j, a:b, d:e]
                count[r + a : r + b, c + d : c + e] += 1
        return total, count

    def handed_on(table: pa.Table, images: dict, place: tuple, first: np.ndarray, rows_of: np.ndarray, block_of: np.ndarray) -> pa.RecordBatch | None:
        """What blocks of one place hand on to those whose cells they predict; first is a row of each."""
        (br, bc, *_), m, out = place, len(first), []
        total, count = predicted(table, images, place, m, rows_of, block_of, size) or (None, np.zeros((0, 0)))
        for i in range(0, count.shape[0], size):
            for j in range(0, count.shape[1], size):
                if (some := count[i : i + size, j : j + size]).any():
                    lists = lambda v, per: pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * per), pa.array(v.ravel()))
                    ints = [pa.array(np.full(m, v, dtype=np.int32)) for v in (br + i // size, bc + j // size, *some.shape)]
                    values = [lists(np.broadcast_to(some, (m, *some.shape)), some.size), lists(total[:, i : i + size, j : j + size], some.size * classes)]
                    out.append(pa.RecordBatch.from_arrays([table.column("item").combine_chunks().take(pa.array(first)), *ints, *values], part))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if out else None

    def at_once(table: pa.Table, start: np.ndarray, places: np.ndarray):
        """Blocks of one place, MOST_CELLS cells of them: the place, a row of each, all their rows and the block of each row."""
        places, place_of = np.unique(places, axis=1, return_inverse=True)
        ends = np.append(start, table.num_rows)
        for k, place in enumerate(places.T.tolist()):
            blocks = np.flatnonzero(place_of.ravel() == k)
            most = max(1, MOST_CELLS // max(1, times * min(place[2], size * TILE + reach) * min(place[3], size * TILE + reach) * n))
            for i in range(0, len(blocks), most):
                some = blocks[i : i + most]
                lengths = ends[some + 1] - ends[some]
                block_of = np.repeat(np.arange(len(some)), lengths)
                yield tuple(place), start[some], np.arange(len(block_of)) + np.repeat(ends[some] - np.cumsum(lengths) + lengths, lengths), block_of

    def predict(batches):
        for table, start in whole_groups(batches, ["item", "br", "bc"]):
            images = {b: (a.values.to_numpy(zero_copy_only=False), a.offsets.to_numpy()) for b in bands for a in (table.column(b).combine_chunks(),)}
            for asked in at_once(table, start, np.stack([table.column(c).to_numpy()[start] for c in ("br", "bc", "height", "width")])):
                if (made := handed_on(table, images, *asked)) is not None:
                    yield made

    def finish(batches):
        """Cells of images that are whole; of other images there are chunks without a row of meta."""
        for table, start in whole_groups(batches, ["item"]):
            t, h, w = (table.column(c).to_numpy() for c in ("t", "height", "width"))
            height, width = np.maximum.reduceat(h, start), np.maximum.reduceat(w, start)
            known = np.flatnonzero((np.maximum.reduceat(h, start) > 0) & (width > 0) & (np.add.reduceat((h == 0).astype(np.int64), start) > 0))
            if not len(known):
                continue
            ends = np.append(start, table.num_rows)
            table = table.take(pa.array(np.concatenate([np.arange(ends[k], ends[k + 1]) for k in known]))).combine_chunks()
            begin = np.append(0, np.cumsum(ends[known + 1] - ends[known]))[:-1]
            images = {b: widened(table.column(b).combine_chunks(), table.column(f"_{b}").to_numpy()) for b in bands}
            zero = np.zeros(len(known), dtype=np.int64)
            for place, first, rows_of, block_of in at_once(table, begin, np.stack([zero, zero, height[known], width[known]])):
                if (made := predicted(table, images, place, len(first), rows_of, block_of, size * TILE)) is not None:
                    total, count = made
                    mean = np.where(count[..., None] > 0, total / np.maximum(count, 1)[..., None], nodata)
                    r, c = (np.tile(v.ravel().astype(np.int32), len(first)) for v in np.indices(count.shape))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(r) + 1) * classes, classes, dtype=np.int32)), pa.array(mean.ravel()))
                    yield pa.RecordBatch.from_arrays([table.column("item").combine_chunks().take(pa.array(np.repeat(first, count.size))), pa.array(r), pa.array(c), lists], ["item", "r", "c", "probs"])

    def add(batches):
        for table, start in whole_groups(batches, ["item", "br", "bc"]):
            h, w = (table.column(c).to_numpy().astype(np.int64) for c in ("h", "w"))
            block = np.repeat(np.arange(len(start)), np.diff(np.append(start, table.num_rows)))
            high, wide = np.maximum.reduceat(h, start), np.maximum.reduceat(w, start)
            base = np.append(0, np.cumsum(high * wide))
            row = np.repeat(np.arange(table.num_rows), h * w)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(h * w) - h * w, h * w)
            to = base[block[row]] + pos // w[row] * wide[block[row]] + pos % w[row]
            flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            count, sums = np.bincount(to, flat("count"), base[-1]), flat("total").reshape(-1, classes)
            total = np.stack([np.bincount(to, sums[:, i], base[-1]) for i in range(classes)], axis=1)
            mean = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], nodata)
            of = np.repeat(np.arange(len(start)), high * wide)
            cell = np.arange(base[-1]) - base[of]
            r, c = (table.column(k).to_numpy()[start][of].astype(np.int64) * size + v for k, v in (("br", cell // wide[of]), ("bc", cell % wide[of])))
            ends = np.arange(0, (base[-1] + 1) * classes, classes, dtype=np.int32)
            item = table.column("item").combine_chunks().take(pa.array(start[of]))
            yield pa.RecordBatch.from_arrays([item, pa.array(r.astype(np.int32)), pa.array(c.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(mean.ravel()))], ["item", "r", "c", "probs"])

    def by_block(df: DataFrame) -> DataFrame:
        return df.repartition("item", "br", "bc").sortWithinPartitions("item", "br", "bc")

    cells = f"item {kind}, r int, c int, probs array<double>"
    some, others = meta.agg(F.max(whole), F.max(~whole)).first()
    done = []
    if some or not others:
        done.append(sent_whole(chunks, meta.where(whole), bands, size).mapInArrow(finish, cells))
    if others:
        strips = halo_strips(chunks.join(meta.where(~whole).select("item", "height", "width").hint("merge"), "item"), bands, size, reach)
        parts = by_block(strips).mapInArrow(predict, f"item {kind}, br int, bc int, h int, w int, count array<long>, total array<double>")
        done.append(by_block(parts).mapInArrow(add, cells))
    return done[0] if len(done) == 1 else done[0].unionByName(done[1])
