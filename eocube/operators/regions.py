"""Regions of equal cells that touch along their sides, and the sieve that merges small ones into their neighbours.

Masks are cut into blocks of cells, of which TILE x TILE are a tile. Cells are packed by tile before they are dealt out, and
each tile is labelled in one task; of a tile without a cell at an inner border, that is of every mask that fits in one, all is
known there and then. Of other tiles only cells along their edges are compared with the next tile's, so what is joined
afterwards are labels of regions, not cells. A region's label is its first cell, in the order of reading; what a tile's
regions belong to is found by star contraction of the pairs that meet across edges. What is kept in between is compressed,
rounds replace each other, and no task holds more than a tile and a run of cells. Joins are merges by hint: what Spark
estimates of exploded tiles is the size of what they were made of, and it would send them to the driver.
"""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Blocks along each side of a tile, and cells, about, that are labelled at once; one tile at least.
TILE, RUN = 4, 1 << 19
_LISTS = {"r": "int", "c": "int", "m": "long", "label": "long", "done": "long", "own": "long", "own_m": "long", "own_n": "long", "er": "int", "ec": "int", "em": "long", "el": "long", "pa": "long", "pb": "long", "pat": "long"}


def _written(df: DataFrame) -> DataFrame:
    """A compressed table in spark.checkpoint.dir; where that is unset and all runs on this machine, in a temporary folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="eocube-"))
    path = f"{sc.getCheckpointDir()}/regions-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def _forget(df: DataFrame) -> None:
    """Deletes a table that _written() made, once another has replaced it."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def whole_groups(batches, names: list[str]):
    """Tables of whole groups, such as blocks, out of a partition sorted by names, with where each group starts."""
    held: list[pa.RecordBatch] = []

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[0] = True
        for k in names:
            code = table.column(k).combine_chunks().dictionary_encode().indices.to_numpy()
            new[1:] |= code[1:] != code[:-1]
        return np.flatnonzero(new)

    for b in batches:
        if b.num_rows:
            held.append(b)
            table = pa.Table.from_batches(held).combine_chunks()
            start = starts(table)
            if end := int(start[-1]):
                yield table.slice(0, end), start[:-1]
                held = table.slice(end).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, starts(table)


def _roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For each of n cells the first cell of its region, given the pairs that touch: roots hook to the least beside them."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
    return root


def _packed(b: pa.RecordBatch, keys: list[str], side: int) -> pa.RecordBatch:
    """A row for each tile that a batch has cells of: their places in it, each as its distance from the one before, and
    their values in `w` bytes each."""
    r, c, m = (b.column(k).to_numpy().astype(np.int64) for k in ("r", "c", "m"))
    by = [r // side, c // side, *(b.column(k).dictionary_encode().indices.to_numpy() for k in keys)]
    order = np.lexsort((c, r, *by))
    by, r, c, m = [x[order] for x in by], r[order], c[order], m[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in by], axis=0)
    start = np.flatnonzero(new)
    place = (r - by[0] * side) * side + c - by[1] * side
    step = np.diff(place, prepend=0)
    step[start] = place[start]
    kind = np.result_type(*(np.min_scalar_type(x) for x in (-1, m.min(), m.max())))
    n = np.diff(np.append(start, len(r)))

    def binary(values: np.ndarray) -> pa.Array:
        ends = np.append(0, np.cumsum(n * values.dtype.itemsize)).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(values)])

    columns = [b.column(k).take(pa.array(order[start])) for k in keys]
    columns += [pa.array(x[start].astype(np.int32)) for x in by[:2]]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(n), kind.itemsize, dtype=np.int32)), binary(step.astype(np.int32)), binary(m.astype(kind))], [*keys, "br", "bc", "w", "step", "m"])


def _unpacked(table: pa.Table, start: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tile (its number in the table), row, column and value of all cells, in the order of reading in each tile."""

    def bytes_of(name: str) -> tuple[np.ndarray, np.ndarray]:
        a = table.column(name).combine_chunks()
        ends = np.frombuffer(a.buffers()[1], dtype=np.int32)[a.offset : a.offset + len(a) + 1].astype(np.int64)
        return np.frombuffer(a.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]

    raw, ends = bytes_of("step")
    n = np.diff(ends) // 4
    first = np.cumsum(n) - n
    step = np.frombuffer(raw.tobytes(), dtype=np.int32).astype(np.int64)
    place = np.cumsum(step)
    place -= np.repeat(place[first] - step[first], n)
    raw, ends = bytes_of("m")
    width = np.repeat(table.column("w").to_numpy(), n)
    at = np.repeat(ends[:-1], n) + (np.arange(len(place)) - np.repeat(first, n)) * width
    m = np.empty(len(place), dtype=np.int64)
    for w in np.unique(width).tolist():
        some = np.flatnonzero(width == w)
        m[some] = np.ascontiguousarray(raw[at[some][:, None] + np.arange(w)]).view(f"i{w}").ravel()
    tile = np.repeat(np.repeat(np.arange(len(start)), np.diff(np.append(start, table.num_rows))), n)
    r, c = (np.repeat(table.column(k).to_numpy().astype(np.int64), n) * side + x for k, x in (("br", place // side), ("bc", place % side)))
    key = tile * side * side + place
    if (np.diff(key) <= 0).any():
        order = np.argsort(key, kind="stable")
        tile, r, c, m = tile[order], r[order], c[order], m[order]
    return tile, r, c, m


def _merged(a: np.ndarray, b: np.ndarray, at: np.ndarray, m: np.ndarray, n: np.ndarray, threshold: int) -> np.ndarray:
    """The value of each of the regions (m, n cells) after a sieve, where all pairs of neighbours a, b that meet at `at` are
    given, both ways; see sieve_regions()."""
    order = np.lexsort((at, -n[b], a))
    order = order[n[a[order]] < threshold]
    a, b = a[order], b[order]
    one = np.flatnonzero(np.append(True, a[1:] != a[:-1])[: len(a)])
    following, done, to = np.arange(len(n)), n >= threshold, m.copy()
    following[a[one]], left = b[one], -1
    to[a[one]] = m[b[one]]
    done[a[one]] = n[b[one]] >= threshold
    while (now := int((~done).sum())) and now != left:
        left = now
        go = np.flatnonzero(~done)
        ahead = following[go]
        following[go], to[go], done[go] = following[ahead], to[ahead], done[ahead]
    return np.where(done, to, m)


def _labelled(table: pa.Table, start: np.ndarray, keys: list[str], side: int, threshold: int | None) -> pa.RecordBatch:
    """A row for each tile of a table sorted by tile, with the lists of _LISTS. Tiles without a cell at an inner border are
    done: they have r, c, m, the label and in `done` each cell's region's cells or, if there is a threshold, r, c and in
    `done` the value after the sieve."""
    tile, r, c, m = _unpacked(table, start, side)
    y, x = r % side, c % side
    place = (tile * side + y) * side + x
    right = np.flatnonzero((place[1:] == place[:-1] + 1) & (x[:-1] < side - 1))
    below = np.searchsorted(place, place + side)
    down = np.flatnonzero((y < side - 1) & (np.append(place, -1)[below] == place + side))
    u, v, k = np.concatenate([right + 1, below[down]]), np.concatenate([right, down]), np.repeat([1, 0], [len(right), len(down)])
    same = m[u] == m[v]
    root = _roots(u[same], v[same], len(r))
    label = r[root] << 32 | c[root]
    own, of, count = np.unique(root, return_inverse=True, return_counts=True)
    edge = ((y == 0) & (r != 0)) | (y == side - 1) | ((x == 0) & (c != 0)) | (x == side - 1)
    is_open = np.zeros(len(start), dtype=bool)
    is_open[tile[edge]] = True
    u, v, k = u[~same], v[~same], k[~same]
    at = r[u] << 33 | c[u] << 1 | k
    if threshold is None:
        done = count[of]
    else:
        near = ~is_open[tile[u]]
        a, b = of[u[near]], of[v[near]]
        done = _merged(np.concatenate([a, b]), np.concatenate([b, a]), np.tile(at[near], 2), m[own], count, threshold)[of]
    u, v, at = (z[is_open[tile[u]]] for z in (u, v, at))
    met = np.stack([tile[u], np.minimum(label[u], label[v]), np.maximum(label[u], label[v]), at])
    met = met[:, np.lexsort(met[::-1])]
    new = np.ones(met.shape[1], dtype=bool)
    new[1:] = (met[:3, 1:] != met[:3, :-1]).any(axis=0)
    met = met[:, new]

    def lists(values: np.ndarray, of: np.ndarray, kind: str) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(start) + 1)), pa.int32()), pa.array(values, pa.int32() if kind == "int" else pa.int64()))

    every, open_cells, inner = slice(None), np.flatnonzero(is_open[tile]), np.flatnonzero(~is_open[tile])
    raw = every if threshold is None else open_cells
    own = own[is_open[tile[own]]]
    edge = np.flatnonzero(edge)
    values = [*((z[some], tile[some]) for z, some in ((r, every), (c, every), (m, raw), (label, raw), (done, inner)))]
    values += [*((z, tile[own]) for z in (label[own], m[own], count[of[own]])), *((z[edge], tile[edge]) for z in (r, c, m, label)), *((z, met[0]) for z in met[1:])]
    firsts = table.select([*keys, "br", "bc"]).take(pa.array(start)).combine_chunks()
    columns = [*(firsts.column(k).combine_chunks() for k in firsts.column_names), pa.array(is_open)]
    return pa.RecordBatch.from_arrays([*columns, *(lists(z, of, kind) for (z, of), kind in zip(values, _LISTS.values(), strict=True))], [*keys, "br", "bc", "open", *_LISTS])


def _tiles(mask: DataFrame, keys: list[str], side: int, threshold: int | None = None) -> DataFrame:
    kinds, names = dict(mask.dtypes), [*keys, "br", "bc"]
    cells = mask.where("m is not null").select(*keys, *[F.col(k).cast("int").alias(k) for k in ("r", "c")], F.col("m").cast("long").alias("m"))
    key = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + ["br int, bc int"])

    def pack(batches):
        for b in batches:
            if b.num_rows:
                yield _packed(b, keys, side)

    def run(batches):
        for table, start in whole_groups(batches, names):
            cells = np.append(0, np.cumsum(pa.compute.binary_length(table.column("step")).to_numpy() // 4))
            ends = np.append(start, table.num_rows)
            cuts = np.unique(cells[ends[:-1]] // RUN, return_index=True)[1]
            for lo, hi in zip(cuts, [*cuts[1:], len(start)], strict=True):
                yield _labelled(table.slice(ends[lo], ends[hi] - ends[lo]), start[lo:hi] - start[lo], keys, side, threshold)

    packed = cells.mapInArrow(pack, f"{key}, w int, step binary, m binary")
    return _written(packed.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, f"{key}, open boolean, " + ", ".join(f"{k} array<{kind}>" for k, kind in _LISTS.items())))


def _done(tiles: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    """Cells (keys, r, c, names) of the tiles that are done, names being lists and what they are called."""
    kinds, lists = dict(tiles.dtypes), {"r": "r", "c": "c", **names}

    def run(batches):
        for b in batches:
            if b.num_rows:
                row = pa.array(np.repeat(np.arange(b.num_rows), b.column("r").value_lengths().to_numpy()))
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(row) for k in keys), *(b.column(k).flatten() for k in lists)], [*keys, *lists.values()])

    schema = [f"`{k}` {kinds[k]}" for k in keys] + [f"{to} {_LISTS[k]}" for k, to in lists.items()]
    return tiles.where("not open").select(*keys, *lists).mapInArrow(run, ", ".join(schema))


def _rows(blocks: DataFrame, keys: list[str], **lists: str) -> DataFrame:
    """Parallel lists of the blocks as rows."""
    zipped = F.arrays_zip(*[F.col(x).alias(k) for k, x in lists.items()])
    return blocks.select(*keys, F.explode(zipped).alias("x")).select(*keys, *[F.col("x")[k].alias(k) for k in lists])


def _across(blocks: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Cells that meet over an edge of two blocks: labels a and b with values ma and mb, and where they meet."""
    edge = _rows(blocks, keys, r="er", c="ec", m="em", label="el")
    after = edge.select(*keys, "r", "c", F.col("m").alias("mb"), F.col("label").alias("b"))
    both = []
    for k, (along, off) in enumerate((("r", "c"), ("c", "r"))):
        last = edge.where(F.pmod(F.col(along), F.lit(size)) == size - 1).select(*keys, (F.col(along) + 1).alias(along), off, F.col("m").alias("ma"), F.col("label").alias("a"))
        met = after.where(F.pmod(F.col(along), F.lit(size)) == 0).join(last.hint("merge"), [*keys, "r", "c"])
        both.append(met.select(*keys, "a", "b", "ma", "mb", F.expr(f"shiftleft(cast(r as bigint), 33) | shiftleft(cast(c as bigint), 1) | {k}L").alias("at")))
    return both[0].unionByName(both[1])


def connected(links: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, root) of every label that links(keys, u, v) name, root being the least label reachable within the
    same keys. Large-star and small-star steps until a round changes nothing."""
    e = _written(links.select(*keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = e.unionByName(e.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*keys, "u").agg(F.min("v").alias("_m"))
        large = both.join(least.hint("merge"), [*keys, "u"]).where("v > u").select(*keys, F.col("v").alias("u"), F.least("u", "_m").alias("v"))
        least = large.groupBy(*keys, "u").agg(F.min("v").alias("_m"))
        ends = F.array(F.struct(F.col("v").alias("u"), F.col("_m").alias("v")), F.struct("u", F.col("_m").alias("v")))
        after = _written(large.join(least.hint("merge"), [*keys, "u"]).select(*keys, F.explode(ends).alias("x")).select(*keys, "x.u", "x.v").where("u <> v").distinct())
        _forget(e)
        e = after
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    roots = e.select(*keys, F.col("u").alias("label"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(*keys, F.col("root").alias("label"), "root").distinct())


def _named(blocks: DataFrame, across: DataFrame, keys: list[str]) -> DataFrame:
    """Each block's labels with root, value m and n, the cells of the whole region."""
    roots = connected(across.where("ma = mb").select(*keys, F.col("a").alias("u"), F.col("b").alias("v")), keys)
    own = _rows(blocks, keys, label="own", m="own_m", n="own_n").join(roots.hint("merge"), [*keys, "label"], "left")
    own = own.withColumn("root", F.coalesce("root", "label"))
    sizes = own.groupBy(*keys, "root").agg(F.sum("n").alias("n"))
    return _written(own.drop("n").join(sizes.hint("merge"), [*keys, "root"]))


def _handed(blocks: DataFrame, values: DataFrame, keys: list[str], size: int, columns: dict[str, str]) -> DataFrame:
    """Cells (keys, r, c, m) with `columns` of values(keys, label), null where a label has none: handed to the blocks,
    so cells aren't shuffled again."""
    place = {"br": F.floor(F.shiftright("label", 32) / size).cast("int"), "bc": F.floor(F.col("label").bitwiseAND(0xFFFFFFFF) / size).cast("int")}
    lists = values.withColumns(place).groupBy(*keys, "br", "bc").agg(F.sort_array(F.collect_list(F.struct("label", *columns))).alias("x"))
    lists = lists.select(*keys, "br", "bc", F.col("x.label").alias("_l"), *[F.col("x")[k].alias(f"_{k}") for k in columns])
    kinds = dict(blocks.dtypes)

    def run(batches):
        for b in batches:
            if b.num_rows:
                row = np.repeat(np.arange(b.num_rows), b.column("label").value_lengths().to_numpy())
                known = np.repeat(np.arange(b.num_rows), b.column("_l").value_lengths().fill_null(0).to_numpy())
                code = np.unique(np.concatenate([b.column("label").flatten().to_numpy(), b.column("_l").flatten().to_numpy()]), return_inverse=True)[1]
                wanted, given = row * (len(code) + 1) + code[: len(row)], known * (len(code) + 1) + code[len(row) :]
                at = np.searchsorted(given, wanted)
                take = pa.array(at, mask=np.append(given, -1)[at] != wanted)
                arrays = [*(b.column(k).take(pa.array(row)) for k in keys), *(b.column(k).flatten() for k in ("r", "c", "m")), *(b.column(f"_{k}").flatten().take(take) for k in columns)]
                yield pa.RecordBatch.from_arrays(arrays, [*keys, "r", "c", "m", *columns])

    joined = blocks.select(*keys, "br", "bc", "r", "c", "m", "label").join(lists.hint("merge"), [*keys, "br", "bc"], "left")
    return joined.mapInArrow(run, ", ".join([f"`{k}` {kinds[k]}" for k in keys] + ["r int, c int, m long"] + [f"{k} {kind}" for k, kind in columns.items()]))


def label_regions(mask: DataFrame, keys: list[str] | None = None, size: int = 64) -> DataFrame:
    """mask(keys, r, c, m) with `region`, row * 2^32 + column of the region's first cell in the order of reading, and
    `region_cells`, how many cells it has. Regions are equal cells that touch along sides, whatever their values.

    A mask has one row a cell with r and c from 0; cells may be absent and break regions. Cells whose m is null are in no region
    and not returned, nor are other columns. Keys (`item` if none are named) must not be null. No cells give no rows. A
    task takes TILE x TILE blocks of `size` x `size` cells at once.
    """
    keys, side = keys or ["item"], size * TILE
    kind = dict(mask.dtypes)["m"]
    tiles = _tiles(mask, keys, side)
    done = _done(tiles, keys, {"m": "m", "label": "region", "done": "region_cells"})
    if not (some := tiles.where("open")).isEmpty():
        named = _named(some, _across(some, keys, side), keys).select(*keys, "label", F.col("root").alias("region"), F.col("n").alias("region_cells"))
        done = done.unionByName(_handed(some, named, keys, side, {"region": "long", "region_cells": "long"}))
    return done.withColumn("m", F.col("m").cast(kind))


def sieve_regions(mask: DataFrame, threshold: int = 3, keys: list[str] | None = None, size: int = 64) -> DataFrame:
    """mask(keys, r, c, m) whose regions of fewer than `threshold` cells take the value of their largest neighbour; of
    neighbours alike in size, the one whose border is met first in the order of reading, above before left. Is that
    neighbour small as well, its own largest neighbour follows, and so on; a chain that comes round without a region of
    `threshold` cells leaves its regions as they are, as does a region without neighbours. Sizes are those of the mask
    as given. For rows, nulls, keys and size see label_regions.

    Neighbours are pairs of labels, gathered by tile; chains are followed by doubling.
    """
    keys, side = keys or ["item"], size * TILE
    kind = dict(mask.dtypes)["m"]
    tiles = _tiles(mask, keys, side, threshold)
    done = _done(tiles, keys, {"done": "m"})
    if not (some := tiles.where("open")).isEmpty():
        done = done.unionByName(_sieved(some, threshold, keys, side))
    return done.withColumn("m", F.col("m").cast(kind))


def _sieved(blocks: DataFrame, threshold: int, keys: list[str], size: int) -> DataFrame:
    """Cells (keys, r, c, m) of tiles that aren't done, after the sieve."""
    across = _across(blocks, keys, size)
    named = _named(blocks, across, keys)
    met = _rows(blocks, keys, a="pa", b="pb", at="pat").unionByName(across.where("ma <> mb").select(*keys, "a", "b", "at"))
    sides = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    met = met.select(*keys, "at", F.explode(sides).alias("x")).select(*keys, "at", "x.a", "x.b")
    of = lambda side, **names: named.select(*keys, F.col("label").alias(side), *[F.col(k).alias(v) for k, v in names.items()])
    small = of("a", root="root", n="n").where(F.col("n") < threshold).drop("n")
    pairs = met.join(small.hint("merge"), [*keys, "a"]).join(of("b", root="next", n="n", m="to").hint("merge"), [*keys, "b"])
    pairs = pairs.groupBy(*keys, "root", "next", "n", "to").agg(F.min("at").alias("at"))
    step = pairs.groupBy(*keys, "root").agg(F.max_by(F.struct("next", "to", (F.col("n") >= threshold).alias("done")), F.struct("n", -F.col("at"))).alias("x"))
    step, left = _written(step.select(*keys, "root", "x.*")), None
    while (now := step.where("not done").count()) and now != left:
        left = now
        ahead = step.select(*keys, F.col("root").alias("next"), F.struct("next", "to", "done").alias("y"))
        after = _written(step.join(ahead.hint("merge"), [*keys, "next"], "left").select(*keys, "root", F.when(F.col("done"), F.struct("next", "to", "done")).otherwise(F.col("y")).alias("z")).select(*keys, "root", "z.*"))
        _forget(step)
        step = after
    changed = named.select(*keys, "root", "label").join(step.where("done").select(*keys, "root", "to").hint("merge"), [*keys, "root"]).select(*keys, "label", "to")
    cells = _handed(blocks, changed, keys, size, {"to": "long"})
    return cells.select(*keys, "r", "c", F.coalesce("to", "m").alias("m"))
