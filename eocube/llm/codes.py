"""Vector compression by product codes: k-means codebooks for each part of the vectors, in exact integers.

Every task sorts its vectors' parts along a Hilbert curve, part by part, and cuts them into flat blocks. A block keeps
the smallest box around its vectors and their sum. In each round the distances from a box to the codebook's entries give
the block's shortlist: an entry that is farther from all points of the box than another is nearest to none of the
block's vectors. A block with one entry left adds its sum without a look at its vectors;
the other blocks are compared with their shortlists only, by integer kernels. Blocks are written once, no vector is
shuffled, and a round sends no more than the entries' sums.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eocube.llm.common import pack, table, unpack, written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors of one block, and components that a task sorts at once.
BLOCK, SLICE = 8, 1 << 20
#: Sums leave a task in digits of so many bits, so that they may add up over any number of tasks.
LIMB = 40


def whole_numbers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles, as int64 where it fits, else as Python's integers."""
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
    if np.abs(v).max(initial=0) < 2**53:
        return v.astype(np.int64)
    exact = [int(c) * scale if abs(c) >= 2**53 else math.floor(c * scale) for c in x.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(x.shape)


def hilbert_order(x: np.ndarray) -> np.ndarray:
    """Rows of x in the order of a Hilbert curve through their box, by Skilling's transform of axes."""
    n, dims = x.shape
    if not dims or n < 2:
        return np.arange(n)
    f = x.astype(np.float64) * 0.25
    lo = f.min(axis=0)
    f = (f - lo) / np.maximum(f.max(axis=0) - lo, 1e-300)
    dims = min(dims, 63)
    bits = min(16, 63 // dims)
    a = (np.clip(f[:, :dims], 0, 1) * ((1 << bits) - 1)).astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(dims):
            up = (a[i] & q) != 0
            swap = np.where(up, 0, (a[0] ^ a[i]) & (q - 1))
            a[0] ^= np.where(up, q - 1, swap)
            a[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        a[i] ^= a[i - 1]
    flip, q = np.zeros(n, dtype=np.int64), 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(a[-1] & q, q - 1, 0)
        q >>= 1
    a ^= flip
    index = np.zeros(n, dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = index << 1 | a[i] >> bit & 1
    return np.argsort(index, kind="stable")


def kernel(width: int, *values: np.ndarray):
    """The narrowest kind of integer in which squared distances between such values are exact."""
    most = max(int(np.abs(v).max(initial=0)) for v in values)
    far = max(1, width) * (2 * most) ** 2
    return np.int32 if far < 2**31 else np.int64 if far < 2**63 else object


class Blocks:
    """One part of some vectors, sorted, in flat blocks; the last block is filled up with its last vector."""

    def __init__(self, x: np.ndarray, order: np.ndarray, block: int = BLOCK):
        self.n, self.width = x.shape
        self.order, self.block = order, block
        count = -(-self.n // block)
        x = x[order]
        self.x = np.concatenate([x, np.repeat(x[-1:], count * block - self.n, axis=0)]).T.reshape(self.width, count, block)
        self.lo, self.hi = self.x.min(axis=2), self.x.max(axis=2)
        self.size = np.full(count, block)
        self.size[-1] = self.n - (count - 1) * block
        wide = self.x.dtype if self.x.dtype == object else np.int64
        self.sum = self.x.sum(axis=2, dtype=wide) - self.x[:, :, -1].astype(wide) * (block - self.size)

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """[entry, block]: whether the entry can be nearest to a vector of the block. It can't if the box is nearer to
        another with all its points than to it with any, nor if every point of the box is nearer to the entry that is
        nearest to the box's middle: how much nearer is linear, so the box's corners tell."""
        kind = object if kernel(16 * max(1, self.width), self.lo, self.hi, entries) is object else np.int64
        lo, hi, e = self.lo.astype(kind), self.hi.astype(kind), entries.astype(kind)
        near = np.zeros((len(e), len(self.size)), dtype=kind)
        far, middle = near.copy(), near.copy()
        for k in range(self.width):
            c = e[:, k, None]
            gap = np.maximum(np.maximum(lo[k] - c, c - hi[k]), 0)
            reach = np.maximum(hi[k] - c, c - lo[k])
            near += gap * gap
            far += reach * reach
            middle += (lo[k] + hi[k] - 2 * c) * (lo[k] + hi[k] - 2 * c)
        first = middle.argmin(axis=0)
        square = (e * e).sum(axis=1)
        lead = square[first] - square[:, None]  # by how much an entry is nearer than the first at most, in the box
        for k in range(self.width):
            d = e[first, k] - e[:, k, None]
            lead = lead + np.maximum(-2 * lo[k] * d, -2 * hi[k] * d)
        return ((near <= far.min(axis=0)) & (lead >= 0)).astype(bool)

    def nearest(self, entries: np.ndarray, every: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest entry of each vector in sorted order (ties to the lower index) and its squared distance, and the
        blocks all of whose vectors have it as the only one on their shortlist; these have distances only if asked for."""
        short = self.shortlists(entries)
        alone = short.sum(axis=0) == 1
        kind = kernel(self.width, self.lo, self.hi, entries)
        x, e = self.x.astype(kind), entries.astype(kind)
        found = np.repeat(short.argmax(axis=0)[:, None], self.block, axis=1)
        best, seen = np.zeros(found.shape, dtype=kind), np.zeros(len(alone), dtype=bool)
        for i in range(len(e)):
            at = np.flatnonzero(short[i] if every else short[i] & ~alone)
            if not len(at):
                continue
            d = np.zeros((len(at), self.block), dtype=kind)
            for k in range(self.width):
                step = x[k, at] - e[i, k]
                d += step * step
            less = ~seen[at][:, None] | (d < best[at])
            found[at] = np.where(less, i, found[at])
            best[at] = np.where(less, d, best[at])
            seen[at] = True
        return found, best, alone

    def sums(self, entries: np.ndarray) -> np.ndarray:
        """[entry, component]: the sum of the vectors nearest to each entry; their number comes last."""
        found, _, alone = self.nearest(entries)
        out = np.zeros((len(entries), self.width + 1), dtype=object)
        within = np.arange(self.block) < self.size[:, None]
        wide = self.x.dtype if self.x.dtype == object else np.int64
        for i in range(len(entries)):
            some = alone & (found[:, 0] == i)
            each = within & ~alone[:, None] & (found == i)
            for k in range(self.width):
                out[i, k] = int(self.sum[k, some].sum()) + int(self.x[k][each].sum(dtype=wide))
            out[i, -1] = int(self.size[some].sum()) + int(each.sum())
        return out


def cut_points(length: int, parts: int) -> list[int]:
    """Where vectors of this length are cut; lengths that the parts don't divide give parts that differ by one."""
    return [length * i // parts for i in range(parts + 1)]


def digits(value: int) -> list[int]:
    """The value in digits of LIMB bits, the last of them signed."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def blocks_table(vectors: DataFrame, scale: int, parts: int, slice_: int) -> DataFrame:
    """Rows (dim, vec_ids, labels, data) of up to `slice_` components: vectors, and the Hilbert order of each part."""

    def row(dim, ids, labels, x):
        cuts, v = cut_points(dim, parts), whole_numbers(x, scale)
        order = np.concatenate([hilbert_order(v[:, a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]).astype(np.uint32)
        most = np.abs(v).max(initial=0)
        size, kept = (2, v.astype(np.int16)) if most < 2**15 else (4, v.astype(np.int32)) if most < 2**31 else (8, x)
        data = pack(np.array([size], dtype=np.uint8), order, kept.view(np.uint8))
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())), pa.array([data], pa.binary())], ["dim", "vec_ids", "labels", "data"])

    def run(batches):
        held: dict[int, list] = {}
        size = 0
        for b in batches:
            lists = b.column("e")
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy())
            for i, l, d, end in zip(b.column("vec_id").to_pylist(), b.column("label").to_pylist(), lists.value_lengths().to_pylist(), ends.tolist(), strict=True):
                held.setdefault(d, []).append((i, l, flat[end - d : end]))
                size += max(1, d)
                if size >= slice_:
                    for dim, rows in held.items():
                        yield row(dim, *map(list, zip(*((i, l) for i, l, _ in rows), strict=True)), np.stack([x for _, _, x in rows]))
                    held, size = {}, 0
        for dim, rows in held.items():
            yield row(dim, *map(list, zip(*((i, l) for i, l, _ in rows), strict=True)), np.stack([x for _, _, x in rows]))

    return vectors.mapInArrow(run, "dim int, vec_ids array<long>, labels array<string>, data binary")


def unblocked(dim: int, data: bytes, scale: int, parts: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The whole-number vectors of a row, and (part, order) of each part."""
    size, order, raw = unpack(data, np.uint8, np.uint32, np.uint8)
    cuts, order = cut_points(dim, parts), order.reshape(parts, -1)
    v = raw.view({2: np.int16, 4: np.int32, 8: np.float64}[int(size[0])]).reshape(order.shape[1], dim)
    v = whole_numbers(v, scale) if size[0] == 8 else v
    return v, [(v[:, a:b], o.astype(np.int64)) for a, b, o in zip(cuts[:-1], cuts[1:], order, strict=True)]


def first_vectors(blocks: DataFrame, entries: int, scale: int, parts: int) -> dict[int, list[np.ndarray]]:
    """The codebooks to begin with, for each length of vectors: of each part, that of the vectors of the smallest vec_ids
    (null last; rows that repeat a vec_id in the order of their components as text)."""

    def run(batches):
        for b in batches:
            for dim, ids, data in zip(*(b.column(c).to_pylist() for c in ("dim", "vec_ids", "data")), strict=True):
                v, _ = unblocked(dim, data, scale, parts)
                least = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
                last = ids[least[min(entries, len(least)) - 1]]
                rows = [k for k in least if ids[k] is None or last is None or ids[k] <= last]
                some = sorted((ids[k] is None, ids[k] or 0, [str(c) for c in v[k].tolist()]) for k in rows)[:entries]
                none, ids, v = zip(*some, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([dim] * len(some), pa.int32()), pa.array(none), pa.array(ids, pa.int64()), pa.array(v, pa.list_(pa.string()))], ["dim", "none", "vec_id", "v"])

    rows = blocks.select("dim", "vec_ids", "data").mapInArrow(run, "dim int, none boolean, vec_id long, v array<string>")
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("dim").orderBy("none", "vec_id", "v"))).where(F.col("rank") <= entries)
    out: dict[int, list] = {}
    for r in sorted(first.collect(), key=lambda r: (r.dim, r.rank)):
        out.setdefault(r.dim, []).append([int(c) for c in r.v])
    return {d: [array_of([x[a:b] for x in rows]) for a, b in zip(cut_points(d, parts)[:-1], cut_points(d, parts)[1:], strict=True)] for d, rows in out.items()}


def array_of(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(c) < 2**62 for x in rows for c in x)
    return np.array(rows, dtype=np.int64 if small else object).reshape(len(rows), -1)


def next_codebooks(blocks: DataFrame, books: dict[int, list[np.ndarray]], scale: int, parts: int) -> dict[int, list[np.ndarray]]:
    """Every entry replaced by the floor of the mean of the parts nearest to it; entries without any stay. A task sends
    one number for each component of an entry, whatever the number of its vectors."""

    def run(batches):
        total: dict[tuple[int, int, int, int], int] = {}
        for b in batches:
            for dim, data in zip(b.column("dim").to_pylist(), b.column("data").to_pylist(), strict=True):
                _, split = unblocked(dim, data, scale, parts)
                for p, (x, order) in enumerate(split):
                    for i, values in enumerate(Blocks(x, order).sums(books[dim][p]).tolist()):
                        for k, value in enumerate(values):
                            total[dim, p, i, k] = total.get((dim, p, i, k), 0) + value
        rows = [(*key, n, digit) for key, value in total.items() if value for n, digit in enumerate(digits(value))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["dim", "part", "entry", "k", "digit", "value"])

    sums = blocks.select("dim", "data").mapInArrow(run, "dim long, part long, entry long, k long, digit long, value long")
    total: dict[tuple[int, int, int], dict[int, int]] = {}
    for r in sums.groupBy("dim", "part", "entry", "k", "digit").agg(F.sum("value").alias("value")).collect():
        of = total.setdefault((r.dim, r.part, r.entry), {})
        of[r.k] = of.get(r.k, 0) + (r.value << LIMB * r.digit)
    out = {}
    for dim, book in books.items():
        out[dim] = []
        for p, e in enumerate(book):
            rows, width = e.tolist(), e.shape[1]
            for i in range(len(rows)):
                of = total.get((dim, p, i), {})
                if of.get(width):
                    rows[i] = [of.get(k, 0) // of[width] for k in range(width)]
            out[dim].append(array_of(rows))
    return out


def digest(book: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(c) for e in book for c in e.ravel().tolist()).encode()).hexdigest()


def product_codes(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, slice_: int = SLICE) -> tuple[DataFrame, dict[int, list[np.ndarray]]]:
    """(codes, codebooks): vec_id, label (as text), dim, code and error of every kept row, and each part's entries by the
    length of the vectors. A code has two hex digits a part; error is the squared distance of the whole-number
    vector from its entries, at most 2^63-1.

    Rows whose vector is null or holds a null or non-finite component are left out. Rows that repeat a vec_id count and
    are returned one by one; a null vec_id or label stays. Fewer vectors than entries give fewer entries. Vectors of
    each length have codebooks of their own, which the driver holds: 16 vectors for each length there is; lengths that
    the parts don't divide are cut into parts that differ by one. An empty table gives no rows and no codebooks. Other
    columns are not read. Components of any size are exact; those from 2^31 on are summed as Python's integers.
    """
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("e")).where(
        "e is not null and not exists(e, c -> c is null or isnan(c) or abs(c) = double('infinity'))"
    )
    blocks = written(blocks_table(kept, scale, parts, slice_))
    books = first_vectors(blocks, entries, scale, parts)
    for _ in range(rounds):
        books = next_codebooks(blocks, books, scale, parts)

    def run(batches):
        for b in batches:
            for dim, ids, labels, data in zip(b.column("dim").to_pylist(), b.column("vec_ids"), b.column("labels"), b.column("data").to_pylist(), strict=True):
                code, error = np.zeros((len(ids), parts), dtype=np.uint8), np.zeros(len(ids), dtype=object)
                for p, (x, order) in enumerate(unblocked(dim, data, scale, parts)[1]):
                    found, best, _ = Blocks(x, order).nearest(books[dim][p], every=True)
                    code[order, p] = found.ravel()[: len(order)]
                    error[order] += best.ravel()[: len(order)].astype(object)
                hexes, n = code.tobytes().hex(), 2 * parts
                most = np.minimum(error, 2**63 - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array(np.full(len(ids), dim, dtype=np.int32)), pa.array([hexes[i : i + n] for i in range(0, len(hexes), n)]), pa.array(most)],
                    ["vec_id", "label", "dim", "code", "error"],
                )

    return blocks.mapInArrow(run, "vec_id long, label string, dim int, code string, error long"), books


def label_errors(codes: DataFrame) -> DataFrame:
    """codes with label_error, the sum of error over equal labels, nulls together; at most 2^63-1. Sums are made before
    the shuffle, and the join is a plain one, of which adaptive execution splits a label with many rows."""
    total = codes.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("_sum"))
    most = F.least("_sum", F.lit(2**63 - 1).cast("decimal(30,0)")).cast("long")
    return codes.join(total, F.col("label").eqNullSafe(F.col("_label"))).withColumn("label_error", most).drop("_label", "_sum")


def op12(spark, sf_dir) -> DataFrame:
    codes, books = product_codes(table(spark, sf_dir, "embeddings"))
    sha = F.lit(None).cast("string")
    for dim, book in books.items():
        sha = F.when(F.col("dim") == dim, digest(book)).otherwise(sha)
    return label_errors(written(codes)).select("vec_id", "code", "error", "label_error", sha.alias("codebooks_sha256"))


def _oracle() -> str:
    """DuckDB SQL: every distance of every round. Squared distances and sums are whole numbers below 2^53."""
    near = "min((list_inner_product(t.x, t.x) - 2 * list_inner_product(t.x, c.x) + list_inner_product(c.x, c.x)) * 16 + c.entry)::bigint"
    sql = """
with v as (select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)) as e from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
t as materialized (select r, vec_id, p, e[p * len(e) // 8 + 1 : (p + 1) * len(e) // 8] as x from v, range(8) as s(p)),
c0 as materialized (select p, entry, x from (select p, row_number() over (partition by p order by vec_id) - 1 as entry, x from t) where entry < 16)"""
    for n in range(ROUNDS):
        sql += f""",
a{n} as (select t.p, any_value(t.x) as x, {near} % 16 as entry from t join c{n} c using (p) group by t.r, t.p),
s{n} as (select p, entry, list(m order by i) as x from (select p, entry, i, floor(sum(x[i]) / count(*)) as m from (select p, entry, x, unnest(range(1, len(x) + 1)) as i from a{n}) group by p, entry, i) group by p, entry),
c{n + 1} as materialized (select c.p, c.entry, coalesce(s.x, c.x) as x from c{n} c left join s{n} s using (p, entry))"""
    return sql + f""",
f as (select r, string_agg(printf('%02x', m % 16), '' order by p) as code, sum(m // 16)::bigint as error from (select t.r, t.p, {near} as m from t join c{ROUNDS} c using (p) group by t.r, t.p) group by r),
h as (select sha256(string_agg(x[i]::bigint::varchar, ',' order by p, entry, i)) as s from (select p, entry, x, unnest(range(1, len(x) + 1)) as i from c{ROUNDS}))
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, h.s as codebooks_sha256 from v join f using (r), h
"""


ORACLE = _oracle()
