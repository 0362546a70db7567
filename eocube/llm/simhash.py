"""Near duplicates by SimHash fingerprints and BK-trees.

A BK-tree hangs every fingerprint below its parent on an edge that bears their Hamming distance, so a search
within radius r of a query at distance d from a node needs only the node's edges d-r to d+r. One tree over a
corpus fits no executor, so fingerprints are dealt to shards such that fingerprints that can match meet in some
shard; each shard has its own tree, which goes to where the shard's queries are (a shuffle by shard: the trees
together grow with the corpus, so none is broadcast to every executor).

Two routings are offered. By blocks: fingerprints within radius r agree on one of r+1 blocks of bits, so no
match is missed; a large shard is dealt out once more by classes of bits, of which the same holds. By min-hashes of the shingles: for wide radii, where blocks are too short to select anything;
documents of similarity 0.8 share none of 8 min-hashes with a probability of 0.2^8. Shards still above a bound are
cut into pieces, and each pair of pieces is searched in a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from eocube.llm.common import byte_texts, forget, fresh, keyed, mixed, whole_runs, written
from eocube.llm.components import connected

SEED = 42
#: Fingerprints in one tree; a larger shard is searched piece by piece.
SHARD = 20_000
#: Texts of up to so many shingles are compared whatever their fingerprints, and min-hashes of a run that all agree.
SHORT, RUN = 20, 4
#: Bytes of text in one piece of a group, and how many of a large group's texts go to all its pieces.
PIECE_BYTES, HUBS = 32_000_000, 16


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """XXH64 of every run of k words, repeats included; of the whole sequence if it is shorter."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    text = b" ".join(words)
    if len(words) <= k:
        return np.array([xxh64_intdigest(text, SEED)], dtype=np.uint64)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: len(words) - k + 1].tolist()
    return np.fromiter((xxh64_intdigest(text[a:b], SEED) for a, b in zip(start, end[k - 1 :].tolist(), strict=True)), dtype=np.uint64, count=len(start))


def simhash(h: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


class Forest:
    """BK-trees of many shards in arrays; each item is a node of its shard's tree."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        self.fp = fp
        _, first, self.tree = np.unique(shard, return_index=True, return_inverse=True)
        self.root = first
        self.size = np.bincount(self.tree)
        parent, edge = np.full(len(fp), -1, dtype=np.int64), np.zeros(len(fp), dtype=np.int64)
        at = first[self.tree]
        rest = np.setdiff1d(np.arange(len(fp)), first)
        while len(rest):
            d = np.bitwise_count(fp[rest] ^ fp[at[rest]]).astype(np.int64)
            _, new, branch = np.unique(at[rest] * 65 + d, return_index=True, return_inverse=True)
            child = rest[new]
            parent[child], edge[child] = at[child], d[new]
            stay = np.ones(len(rest), dtype=bool)
            stay[new] = False
            below = child[branch][stay]
            rest = rest[stay]
            at[rest] = below
        child = np.flatnonzero(parent >= 0)
        key = parent[child] * 65 + edge[child]
        order = np.argsort(key, kind="stable")
        self.child, self.key = child[order], key[order]

    def pairs(self, radius: int, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of items of one shard within the radius and their distances, each pair once, in runs of queries of
        bounded work."""
        ask = np.flatnonzero(self.size[self.tree] > 1)
        ask = ask[np.argsort(self.tree[ask], kind="stable")]
        work = np.cumsum(self.size[self.tree[ask]])
        for some in np.split(ask, np.searchsorted(work, np.arange(most, work[-1], most))) if len(ask) else []:
            q, node, a, b, far = some, self.root[self.tree[some]], [], [], []
            while len(q):
                d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype(np.int64)
                hit = (d <= radius) & (q < node)
                a.append(q[hit])
                b.append(node[hit])
                far.append(d[hit])
                lo = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0))
                n = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), side="right") - lo
                q = np.repeat(q, n)
                node = self.child[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(len(q))]
            yield np.concatenate(a), np.concatenate(b), np.concatenate(far)


class Union:
    """Disjoint sets of items, each named by its first one; arrays of pairs are joined at once or tested one by one."""

    def __init__(self, root: np.ndarray):
        self.root = root

    def flat(self) -> np.ndarray:
        while not np.array_equal(up := self.root[self.root], self.root):
            self.root[:] = up
        return self.root

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = int(root[x])
        return x

    def join(self, a: np.ndarray, b: np.ndarray, same=None, at_once: int = 1 << 13) -> None:
        """Joins the items of each pair that are the `same`, or all where that is not given. same(a, b) takes arrays and
        returns those that may be, and a test of single pairs."""
        for i in range(0, len(a), at_once):
            root = self.flat()
            x, y = a[i : i + at_once], b[i : i + at_once]
            apart = root[x] != root[y]
            x, y = x[apart], y[apart]
            if same is None and len(x):
                _, one = np.unique(np.stack([root[x], root[y]]), axis=1, return_index=True)
                x, y = x[one], y[one]
            elif len(x):
                likely = same.likely(x, y)
                x, y = x[likely], y[likely]
            for p, q in zip(x.tolist(), y.tolist(), strict=True):
                r, s = self.find(p), self.find(q)
                if r != s and (same is None or same(p, q)):
                    self.root[max(r, s)] = min(r, s)


class SameSets:
    """Whether two sets of hashes have a Jaccard similarity of `similarity` or more. `likely` sorts pairs out by an upper
    bound from bit sets of 1,024 buckets: what is in a bucket that the other lacks is not in common."""

    def __init__(self, sets: list[np.ndarray], similarity: float):
        self.sets, self.similarity = sets, similarity
        self.n = np.array([len(x) for x in sets], dtype=np.int64)
        self.bits = np.zeros((len(sets), 16), dtype=np.uint64)
        for i in range(0, len(sets), 4096):
            some = sets[i : i + 4096]
            bits = np.zeros((len(some), 1024), dtype=bool)
            bits[np.repeat(np.arange(len(some)), self.n[i : i + 4096]), (np.concatenate(some) >> np.uint64(54)).astype(np.int64)] = True
            self.bits[i : i + 4096] = np.packbits(bits, axis=1).view(np.uint64)
        self.spare = self.n - np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)

    def likely(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        most = np.bitwise_count(self.bits[a] & self.bits[b]).sum(axis=1, dtype=np.int64) + np.minimum(self.spare[a], self.spare[b])
        most = np.minimum(most, np.minimum(self.n[a], self.n[b]))
        return most >= self.similarity * (self.n[a] + self.n[b] - most) - 1e-9

    def __call__(self, x: int, y: int) -> bool:
        a, b = self.sets[x], self.sets[y]
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both >= self.similarity * (len(a) + len(b) - both) - 1e-9


#: Bins of a sketch, each of which has 4 bits.
BINS = 128


def sketch(h: np.ndarray) -> bytes:
    """For each bin of the leading bits 4 bits of the least of the sorted distinct hashes in it, from 1 to 15; 0 if it is empty."""
    bins = np.arange(BINS, dtype=np.uint64)
    at = np.searchsorted(h, bins << np.uint64(57))
    least = np.append(h, np.uint64(0))[at]
    value = np.where((at < len(h)) & (least >> np.uint64(57) == bins), np.uint64(1) + (least & np.uint64(0xFFFFFFFF)) % np.uint64(15), np.uint64(0)).astype(np.uint8)
    return (value[::2] << 4 | value[1::2]).tobytes()


class SameSketch:
    """Whether two sets can have a Jaccard similarity of `similarity` or more, by their sizes and sketches: at least 3 in 5
    of the bins that either has agree. Of 128 full bins of two sets of similarity 0.8, 104 agree on average with a deviation
    of 4.4, so 77 are missed less than once in 10^9; the bins of small sets are nearly the sets."""

    def __init__(self, n: np.ndarray, sketches: np.ndarray, similarity: float):
        self.n, self.similarity = n, similarity
        self.bins = np.stack([sketches >> 4, sketches & 15], axis=2).reshape(len(n), -1)

    def likely(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.minimum(self.n[a], self.n[b]) >= self.similarity * np.maximum(self.n[a], self.n[b]) - 1e-9
        some = np.flatnonzero(out)
        x, y = self.bins[a[some]], self.bins[b[some]]
        out[some] = 5 * ((x == y) & (x > 0)).sum(axis=1) >= 3 * ((x | y) > 0).sum(axis=1)
        return out

    def __call__(self, x: int, y: int) -> bool:
        return True


def sketches_of(column) -> np.ndarray:
    """Rows of BINS // 2 bytes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), BINS // 2)


def forest_links(forest: Forest, radius: int, same: SameSets | None = None, classes: np.ndarray | None = None, alike: Iterable[np.ndarray] = ()) -> np.ndarray:
    """Links (first item, item) of the sets that pairs within the radius (and the `same`, where given) form. Items of one
    class, where classes are given, are joined from the start: their links are known, in whatever shard, and a class
    gets one link. Two items of one array of `alike` are joined if they are the `same`, also outside the radius."""
    start = np.arange(len(forest.fp))
    if classes is not None:
        _, first, class_of = np.unique(classes, return_index=True, return_inverse=True)
        start = first[class_of]
    union = Union(start.copy())
    for a, b, d in forest.pairs(radius):
        order = np.argsort(d, kind="stable")  # nearest first, so most of the others are in one set by then
        union.join(a[order], b[order], same)
    for some in alike:
        for i, x in enumerate(some[:-1].tolist()):
            if (union.flat()[some[i:]] == union.root[x]).all():
                continue
            rest = some[i + 1 :]
            rest = rest[np.bitwise_count(forest.fp[rest] ^ forest.fp[x]) > radius]
            union.join(np.full(len(rest), x), rest, same)
    root = union.flat()
    item = np.flatnonzero((root != start) & (start == np.arange(len(start))))
    return np.stack([root[item], item], axis=1)


def in_cells(rows: DataFrame, key: str, spread: str, most: int) -> DataFrame:
    """Adds `cell`, within which rows of one key meet. A key with over `most` rows is cut into pieces of about that
    many, and every pair of pieces becomes a cell, so any two of its rows still meet and no cell is large."""
    hot = rows.groupBy(key).count().where(F.col("count") > most).select(F.col(key).alias("_hot"), F.ceil(F.col("count") / most).cast("int").alias("_n"))
    own = F.pmod(F.xxhash64(F.lit(7), spread), F.coalesce("_n", F.lit(1))).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1), lambda j: F.xxhash64(key, F.least("_own", j), F.greatest("_own", j)))
    return rows.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_own", own).withColumn("cell", F.explode(cells)).drop("_hot", "_n", "_own")


def _piece(pieces: str, by: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), by), F.col(pieces)).cast("int")


def joined_groups(rows: DataFrame, search, most: int, most_bytes: int = PIECE_BYTES, hubs: int = HUBS) -> DataFrame:
    """(node, root) of what `search` joins within the groups rows(root, node, size, ...). search takes rows with a class
    and an array of cells, and finds links within cells between classes.

    Groups are first cut into pieces of about `most` rows and `most_bytes`, and each piece also gets about `hubs` rows
    of the group that are the same for all. In a large group of copies nearly all are then in one class, and only the
    rest must still meet every piece: pairs within the class are not searched again.
    """
    per = rows.groupBy(F.col("root").alias("_r")).agg(F.count("*").alias("_c"), F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum("size") / most_bytes)).cast("int").alias("_n")).where("_n > 1")
    cutting = written(rows.join(per, F.col("root") == F.col("_r"), "left").drop("_r").withColumn("_n", F.coalesce("_n", F.lit(1))))
    hub = (F.col("_n") > 1) & (F.pmod(F.xxhash64(F.lit(3), "node"), F.col("_c")) < hubs)
    own = F.when(hub, F.sequence(F.lit(0), F.col("_n") - 1)).otherwise(F.array(_piece("_n", "node")))
    first = cutting.withColumn("cells", F.transform(own, lambda j: F.xxhash64("root", j))).withColumn("class", F.col("node"))
    classes = connected(search(first.drop("_n", "_c")))
    large = cutting.where("_n > 1")
    if large.isEmpty():
        forget(cutting)
        return classes

    named = classes.select(F.col("node").alias("_node"), F.col("root").alias("class"))
    large = written(large.join(named, F.col("node") == F.col("_node"), "left").drop("_node", "_c").withColumn("class", F.coalesce("class", "node")))
    forget(cutting)
    main = large.groupBy("root", "class").count().groupBy(F.col("root").alias("_r")).agg(F.max_by("class", F.struct("count", "class")).alias("_main"))
    large = large.join(main, F.col("root") == F.col("_r")).drop("_r").withColumn("_apart", F.col("class") != F.col("_main"))
    apart = large.where("_apart").groupBy(F.col("root").alias("_r")).agg(F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum("size") / most_bytes)).cast("int").alias("_m"))
    cells = lambda i, j: F.xxhash64("root", i, j)  # noqa: E731  the i-th piece of the rest with the j-th of all
    asked = F.transform(F.sequence(F.lit(0), F.col("_m") - 1), lambda i: cells(i, _piece("_n", "node")))
    asking = F.when(F.col("_apart"), F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda j: cells(_piece("_m", "node"), j))).otherwise(F.array().cast("array<bigint>"))
    again = large.join(apart, F.col("root") == F.col("_r")).withColumn("cells", F.array_union(asked, asking))
    links = search(again.drop("_r", "_n", "_m", "_main", "_apart"))
    return connected(classes.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(links))


def _numbers(column, kind=np.int64) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(kind)


def _links(node: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node[links[:, 0]]), pa.array(node[links[:, 1]])], ["u", "v"])


def finer(rows: DataFrame, key: str, keys: Column, most: int) -> DataFrame:
    """Rows of a key with over `most` rows go to each of the finer `keys` within it instead."""
    hot = rows.groupBy(key).count().where(F.col("count") > most).select(F.col(key).alias("_hot"))
    within = F.when(F.col("_hot").isNull(), F.array(key)).otherwise(F.transform(keys, lambda k: F.xxhash64(key, k)))
    return rows.join(hot, F.col(key) == F.col("_hot"), "left").withColumn(key, F.explode(within)).drop("_hot")


def links_within(nodes: DataFrame, shards: Column, radius: int, most: int = SHARD, second: Column | None = None, similarity: float | None = None) -> DataFrame:
    """links(u, v) that connect the nodes(node, fp) within the radius that share a shard and, in a shard of over `most`
    nodes, one of the `second` keys where those are given. With a similarity, only nodes(..., n, sketch) whose sketches can
    be of sets as similar are linked."""
    own = ["n", "sketch"] if similarity is not None else []

    def search(batches):
        for t in whole_runs(batches, "cell"):
            cell, fp, node = _numbers(t.column("cell")), _numbers(t.column("fp"), np.uint64), _numbers(t.column("node"))
            _, where, n = np.unique(cell, return_inverse=True, return_counts=True)
            meet = n[where] > 1
            same = None
            cell, fp, node = cell[meet], fp[meet], node[meet]
            order = np.lexsort((node, cell))
            if own:
                some = np.flatnonzero(meet)[order]
                same = SameSketch(_numbers(t.column("n"))[some], sketches_of(t.column("sketch").combine_chunks().take(pa.array(some))), similarity)
            yield _links(node[order], forest_links(Forest(cell[order], fp[order]), radius, same))

    rows = nodes.where("node is not null").select("node", "fp", *own, F.explode(F.array_distinct(shards)).alias("shard"))
    if second is not None:
        rows = finer(rows, "shard", second, most)
    return in_cells(rows, "shard", "node", most).select("cell", "fp", "node", *own).repartition("cell").sortWithinPartitions("cell").mapInArrow(search, "u long, v long")


def block_shards(radius: int) -> Column:
    """One shard for each of radius+1 blocks of the fingerprint's bits."""
    n = radius + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return F.array(*[F.xxhash64(F.lit(i), F.shiftrightunsigned("fp", a).bitwiseAND((1 << (b - a)) - 1)) if b - a < 64 else F.lit(0) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))])


def bit_shards(radius: int) -> Column:
    """One shard for each of radius+1 classes of bits, by their place modulo radius+1. Like the blocks they lose no
    match, and most of a class's bits are outside any one block."""
    masks = [sum(1 << p for p in range(64) if p % (radius + 1) == i) for i in range(radius + 1)]
    return F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(m - (m >> 63 << 64))) for i, m in enumerate(masks)])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, th, fp for every row of docs. Null and empty texts: 0."""

    def run(batches):
        for b in batches:
            fp = [simhash(shingle_hashes(t.lower().split(), words)) for t in byte_texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(np.array(fp, dtype=np.uint64).view(np.int64))], ["doc_id", "th", "fp"])

    return keyed(docs).mapInArrow(run, "doc_id long, th long, fp long")


def fingerprint_components(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable by links of `radius` or fewer differing bits.

    Lower-cases A-Z; words are runs of bytes other than ASCII white space. Null and empty texts have fingerprint 0
    and are linked like any other. Rows of one fingerprint are one node, so copies never make pairs. A null doc_id
    gets the component of its fingerprint and is no end of it; repeated rows are returned repeatedly. An empty table
    gives no rows. Other columns of docs are not read.
    """
    rows = written(fingerprints(docs, words).select("doc_id", "fp"))
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("node"))
    roots = connected(links_within(nodes, block_shards(radius), radius, second=bit_shards(radius)))
    named = nodes.join(roots, "node", "left").select(F.col("fp").alias("_fp"), F.coalesce("root", "node").alias("component_id"))
    return rows.join(named, rows.fp == F.col("_fp"), "left").select("doc_id", "fp", "component_id")


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 20, hashes: int = 8, most: int = 4_000) -> DataFrame:
    """doc_id, th and component_id of documents linked by a Jaccard similarity of shingle sets of `similarity` or more.

    SimHash candidates within a radius that holds such pairs (about 10 bits differ at 0.8, with a deviation of 2.7)
    are found in the BK-trees of shards keyed by min-hashes; the shingle sets of candidates are then compared. Both
    are of shingle sets, so repeats count once. Texts that agree in a run of min-hashes, and short texts that share a
    min-hash, are candidates whatever their fingerprints. Candidates become links only if their sketches allow the
    similarity: else chance meetings, which grow with the square of the corpus, would join unrelated texts to groups.
    Groups of over `most` candidates, or of over PIECE_BYTES of text, are compared in pieces.
    Equal texts are one node. Null and empty texts are similar to each other. A null doc_id takes no part. Rows that
    repeat a doc_id with different texts are one node of several texts. An empty table gives no rows; other columns
    are not read.
    """
    salts = np.random.RandomState(SEED).randint(1, 2**63, size=hashes, dtype=np.int64).astype(np.uint64)

    def sets_of(texts: list[bytes]) -> list[np.ndarray]:
        return [np.unique(shingle_hashes(t.lower().split(), words)) for t in texts]

    def sign(batches):
        for b in batches:
            fp, keys, alike, sizes, sketches = [], [], [], [], []
            for h in sets_of(byte_texts(b.column(1))):
                fp.append(simhash(h))
                sizes.append(len(h))
                sketches.append(sketch(h))
                least = np.array([mixed(h ^ s).min() if len(h) else s for s in salts], dtype=np.uint64).view(np.int64)
                keys.append(least.tolist())
                of = [(i, 0, least[i : i + RUN].tobytes()) for i in range(0, hashes - RUN + 1, RUN)]
                if len(h) <= SHORT / similarity:  # short texts, and those that can be similar to one
                    of += [(i, 1, least[i].tobytes()) for i in range(hashes)]
                alike.append(np.array([xxh64_intdigest(x, i << 1 | k) for i, k, x in of], dtype=np.uint64).view(np.int64).tolist())
            numbers = [pa.array(x, pa.list_(pa.int64())) for x in (keys, alike)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(np.array(fp, dtype=np.uint64).view(np.int64)), *numbers, pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())], ["doc_id", "th", "size", "fp", "keys", "alike", "n", "sketch"])

    def verify(batches):
        for t in whole_runs(batches, "cell"):
            t = t.combine_chunks()
            t = t.take(pa.array(np.lexsort((_numbers(t.column("node")), _numbers(t.column("cell"))))))
            cell, node, known = _numbers(t.column("cell")), _numbers(t.column("node")), _numbers(t.column("class"))
            lists = t.column("alike").combine_chunks()
            item, key = np.repeat(np.arange(t.num_rows), lists.value_lengths().to_numpy()), _numbers(lists.flatten())
            by = np.lexsort((item, key, cell[item]))
            item, key = item[by], key[by]
            alike = (x for x in np.split(item, np.flatnonzero((key[1:] != key[:-1]) | (cell[item][1:] != cell[item][:-1])) + 1) if len(x) > 1)
            same = SameSets(sets_of(byte_texts(t.column("text"))), similarity)
            yield _links(node, forest_links(Forest(cell, _numbers(t.column("fp"), np.uint64)), radius, same, known, alike))

    sized = keyed(docs).withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    rows = written(sized.mapInArrow(sign, "doc_id long, th long, size long, fp long, keys array<long>, alike array<long>, n long, sketch binary"))
    own = [F.min(F.when(F.col("doc_id").isNotNull(), F.col(c))).alias(c) for c in ("size", "keys", "alike", "n", "sketch")]
    nodes = written(rows.groupBy("th", "fp").agg(F.min("doc_id").alias("node"), *own))
    shards = F.transform("keys", lambda k, i: F.xxhash64(i, k))
    links = links_within(nodes, shards, radius, similarity=similarity).unionByName(links_within(nodes, F.col("alike"), 64, similarity=similarity))
    groups = connected(links).select(F.col("node").alias("_node"), "root")
    plan = nodes.drop("keys", "n", "sketch").join(groups, F.col("node") == F.col("_node")).select("root", "node", F.col("th").alias("_th"), "fp", "size", "alike")

    def search(asked: DataFrame) -> DataFrame:
        texts = keyed(docs).join(asked, (F.col("doc_id") == F.col("node")) & (F.col("th") == F.col("_th")))
        cells = texts.select(F.explode("cells").alias("cell"), "fp", "node", "class", "text", "alike")
        return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(verify, "u long, v long")

    roots = joined_groups(plan, search, most)
    named = nodes.join(roots, "node", "left").select(F.col("th").alias("_th"), F.col("fp").alias("_fp"), F.coalesce("root", "node").alias("component_id"))
    return rows.select("doc_id", "th", "fp").join(named, (F.col("th") == F.col("_th")) & (F.col("fp") == F.col("_fp")), "left").select("doc_id", "th", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents with the smallest doc_id of their group of near duplicates, as similar_groups() finds them, and
    those without a doc_id. Rows that repeat a doc_id stay or go together; an empty table stays empty; all columns are
    kept, whatever their names."""
    name = fresh(docs, "_kept_id")
    kept = similar_groups(docs, **options).where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, docs.doc_id == F.col(name), "left_semi").unionByName(docs.where("doc_id is null"))


def op2(spark, sf_dir) -> DataFrame:
    found = fingerprint_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
