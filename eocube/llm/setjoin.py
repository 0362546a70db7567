"""Set similarity join of word shingles by partitions of the universe.

Two sets of a Jaccard similarity of at least s differ by at most H = (1-s)/(1+s) * (sum of their sizes) elements. If a
hash deals all possible elements to H+1 segments, some segment of two such sets is equal, so the sets are found by the
hashes of their segments' subsets alone. A segment may count twice: if its subsets with any one element left out are
indexed too, it can only be missed by two differences. So segments that count once or twice, H+1 in all, lose nothing.

Empty subsets are what unrelated sets share, and such chance meetings grow with the square of the number of sets. So a
partition gets spare segments, and a set leaves out its empty subsets if they are no more than the spare tests: then
an equal segment that isn't empty is left for every similar set. Sets with more empty ones, which are next to none,
index them too. How many segments count twice, and how many are spare, is decided for each size band by the cost of
signatures and chance meetings. A set is compared within its band and with the band below.

Signatures that several sets share become links from the first of them, so a group of many near copies gives as many
links as it has sets. The groups that the links form are then verified on their shingle sets, each group in pieces. Groups
that are too large for one piece, as passages that many texts quote make them, are first cut to what their sets' sketches,
of 64 bytes each, allow to be similar.
"""

from __future__ import annotations

import math
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.llm.common import Hashes, byte_texts, keyed, mixed, pack, partitions, table, unpack, whole_runs, windows, written
from eocube.llm.components import connected
from eocube.llm.simhash import SHARD, SameSets, SameSketch, Union, joined_groups, sketch, sketches_of

WORDS, SIMILAR = 4, (85, 100)
#: Cost of a chance meeting of two sets, in signatures.
MEETING = 50
#: Bytes of text signed at once, and of signatures in one bucket.
BLOCK_BYTES, BUCKET_BYTES = 8_000_000, 24_000_000


def shingle_set(text: bytes, words: int, hashes: Hashes) -> np.ndarray:
    """Distinct hashes of the text's shingles; of the whole sequence, if it is shorter."""
    h = hashes.of(text.lower().split())
    return np.unique(windows(h, min(words, len(h)))) if len(h) else h


def set_hash(s: np.ndarray) -> int:
    """One hash for a set, whatever its order."""
    return int(mixed(mixed(s ^ np.uint64(0x5E7)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s)))[0])


def size_bands(most: int, similar: tuple[int, int] = SIMILAR) -> list[int]:
    """First sizes of the bands, and one behind the last. A similar set is in the same band or one next to it."""
    a, b = similar
    out = [1]
    while out[-1] <= most:
        out.append(out[-1] * b // a + 1)
    return out


def differences(size: int, similar: tuple[int, int] = SIMILAR) -> int:
    """By how many elements a set of up to `size` elements can differ from a similar one that is no smaller."""
    a, b = similar
    return (b - a) * (size + size * b // a) // (a + b)


def allocation(size: int, sets: float, mean: float, similar: tuple[int, int] = SIMILAR, meeting: float = MEETING) -> tuple[int, int, int]:
    """(segments, how many of them count twice, spare tests) for a band of sets of up to `size` elements, by the least cost
    of signatures and of chance meetings of sets that have to keep their empty subsets."""
    tests = differences(size, similar) + 1
    twice = np.unique(np.linspace(0, tests, min(tests + 1, 65)).astype(np.int64))[:, None]
    spare = np.arange(33 + int(math.sqrt(tests)))[None, :]
    segments = np.maximum(tests - twice + spare, np.maximum(twice, 1))
    spare = segments + twice - tests
    filled = mean / segments
    empty = np.exp(-filled)
    lost = (segments - twice) * empty + twice * empty * (2 + filled)
    keep = np.minimum(1, np.exp(np.minimum(0, spare + 1 - lost + (spare + 1) * np.log(np.maximum(lost, 1e-300) / (spare + 1)))))
    keep = np.where(lost >= spare + 1, 1.0, keep)
    cost = sets * (segments + twice * filled) + meeting * (sets * keep) ** 2 / 2 * empty**2 * segments
    best = np.unravel_index(int(np.argmin(cost)), cost.shape)
    return int(segments[best]), int(np.broadcast_to(twice, cost.shape)[best]), int(spare[best])


class Partition:
    """How the sets of each band are dealt to segments. counts: (size, sets of about this size)."""

    def __init__(self, counts: list[tuple[float, int]], similar: tuple[int, int] = SIMILAR):
        self.similar = similar
        most = max((int(np.ceil(size)) for size, _ in counts), default=1)
        self.first = np.array(size_bands(2 * most + 2, similar))
        sizes, sets = np.array([s for s, _ in counts] or [1.0]), np.array([n for _, n in counts] or [0])
        band = np.searchsorted(self.first, sizes, side="right") - 1
        held = np.bincount(band, weights=sets, minlength=len(self.first))
        mean = np.bincount(band, weights=sets * sizes, minlength=len(self.first)) / np.maximum(held, 1)
        plan = [allocation(int(b) - 1, held[k] + held[k + 1], mean[k] or float(a), similar) for k, (a, b) in enumerate(pairwise(self.first.tolist()))]
        self.segments, self.twice, self.spare = (np.array(x, dtype=np.int64) for x in zip(*plan, strict=True))

    def rate(self, size: float) -> float:
        """Signatures of one set in its own band."""
        k = min(int(np.searchsorted(self.first, size, side="right")) - 1, len(self.segments) - 1)
        return float(self.segments[k] + self.twice[k] * size / self.segments[k])

    def visits(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, band) of every band in which a set has to be compared: its own and, if a similar set can be there, the
        one below. Bands of one segment that counts once hold no similar sets that aren't equal."""
        a, b = self.similar
        own = np.minimum(np.searchsorted(self.first, sizes, side="right") - 1, len(self.segments) - 1)
        below = np.flatnonzero((own > 0) & (a * sizes < b * self.first[own]))
        item, band = np.concatenate([np.arange(len(sizes)), below]), np.concatenate([own, own[below] - 1])
        asked = self.segments[band] + self.twice[band] - self.spare[band] > 1
        return item[asked], band[asked]

    def signatures(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(signature, set, whether an element is left out)."""
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        item, band = self.visits(sizes)
        if not len(item):
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
        visit = np.repeat(np.arange(len(item)), sizes[item])
        element = np.concatenate([sets[i] for i in item.tolist()])
        base = np.cumsum(self.segments[band]) - self.segments[band]
        salt = mixed(band.astype(np.uint64) + np.uint64(1))
        segment = (mixed(element ^ salt[visit]) % self.segments[band][visit].astype(np.uint64)).astype(np.int64)
        total = np.zeros(int(self.segments[band].sum()), dtype=np.uint64)
        weight, place = mixed(element + np.uint64(0xD1FF)), base[visit] + segment
        np.add.at(total, place, weight)
        owner = np.repeat(np.arange(len(item)), self.segments[band])
        named = mixed(salt[owner] + (np.arange(len(total)) - base[owner]).astype(np.uint64))
        held, doubled = np.bincount(place, minlength=len(total)), np.arange(len(total)) - base[owner] < self.twice[band][owner]
        lost = np.where(doubled, np.maximum(2 - held, 0), held == 0)
        sparse = (np.bincount(owner, weights=lost, minlength=len(item)) <= self.spare[band])[owner]
        left = doubled[place] & ~(sparse[place] & (held[place] == 1))
        whole = np.flatnonzero(~(sparse & (held == 0)))
        place, weight, visit = place[left], weight[left], visit[left]
        key = mixed(np.concatenate([total[whole], total[place] - weight]) ^ np.concatenate([named[whole], named[place]]))
        return key, item[np.concatenate([owner[whole], visit])], np.arange(len(key)) >= len(whole)


def first_of(key: np.ndarray, node: np.ndarray, less: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by signature, whole subsets before those with an element left out, then by node, without equal
    rows; and where a new signature begins."""
    order = np.lexsort((node, less, key))
    k, n, l = key[order], node[order], less[order]
    new = np.append(True, k[1:] != k[:-1])[: len(k)]
    other = new | np.append(True, (n[1:] != n[:-1]) | (l[1:] != l[:-1]))[: len(k)]
    return order[other], new[other]


def distinct_pairs(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    apart = u != v
    u, v = u[apart], v[apart]
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    new = np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]))[: len(u)]
    return u[new], v[new]


def planes(x: np.ndarray, keep: int) -> bytes:
    """The first `keep` bytes of 64-bit numbers, place by place; the leading ones of sorted numbers compress well."""
    return x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :keep].T.tobytes()


def whole_numbers(raw: np.ndarray, keep: int) -> np.ndarray:
    """planes() back as numbers, whose other bytes are 0."""
    out = np.zeros((len(raw) // keep, 8), dtype=np.uint8)
    out[:, :keep] = raw.reshape(keep, -1).T
    return out.view(">u8").ravel().astype(np.uint64)


def candidate_links(docs: DataFrame, plan: Partition, words: int, buckets: int, key_bytes: int, node_bytes: int) -> DataFrame:
    """links(u, v) between hashes of sets, of `node_bytes` bytes, which connect all that share a signature of which one is
    of a whole subset. Hashes are cut so far that each comes to about one in a million by chance: that only links more.

    Signatures are dealt by hash, packed by block and bucket. Equal sets of a block are signed once, and of a block's
    equal signatures only the first is sent, with links to the others; so a signature that a third of all sets share
    comes to its bucket once for each block.
    """

    def block(texts: list[bytes], hashes: Hashes):
        sets: dict[int, np.ndarray] = {}
        for t in texts:
            s = shingle_set(t, words, hashes)
            if len(s):
                sets.setdefault(set_hash(s), s)
        key, item, less = plan.signatures(list(sets.values()))
        node = (np.fromiter(sets, dtype=np.uint64, count=len(sets)) >> np.uint64(64 - 8 * node_bytes)).view(np.int64)[item]
        order, new = first_of(key, node, less)
        key, node, less = key[order], node[order], less[order]
        kind = np.append(True, (key[1:] != key[:-1]) | (less[1:] != less[:-1]))[: len(key)]
        at = np.flatnonzero(kind)[np.cumsum(kind) - 1] if len(key) else np.zeros(0, dtype=np.int64)
        u, v = distinct_pairs(node[at], node)
        key, node, less = key[kind], node[kind], less[kind]
        bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = [(k, pack(planes(key[a:b], key_bytes), planes(node[a:b].view(np.uint64) << np.uint64(64 - 8 * node_bytes), node_bytes), less[a:b], u[:0], u[:0])) for k, (a, b) in enumerate(pairwise(cuts.tolist())) if b > a]
        if len(u):
            rows.append((int(rows[0][0]), pack(b"", b"", less[:0], u, v)))
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["bucket", "data"])

    def sign(batches):
        hashes, held, size = Hashes(), [], 0
        for b in batches:
            for t in byte_texts(b.column(1)):
                held.append(t)
                size += len(t)
                if size >= BLOCK_BYTES:
                    yield block(held, hashes)
                    held, size = [], 0
        if held:
            yield block(held, hashes)

    def match(batches):
        parts = [unpack(x, np.uint8, np.uint8, bool, np.int64, np.int64) for b in batches for x in b.column("data").to_pylist()]
        if not parts:
            return
        key = np.concatenate([whole_numbers(x[0], key_bytes) for x in parts])
        node = np.concatenate([whole_numbers(x[1], node_bytes) >> np.uint64(64 - 8 * node_bytes) for x in parts]).view(np.int64)
        less, u, v = (np.concatenate(x) for x in list(zip(*parts, strict=True))[2:])
        del parts
        order, new = first_of(key, node, less)
        node, less = node[order], less[order]
        at = np.flatnonzero(new)[np.cumsum(new) - 1] if len(node) else order
        whole = ~less[at]
        u, v = distinct_pairs(np.concatenate([u, node[at][whole]]), np.concatenate([v, node[whole]]))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return keyed(docs).mapInArrow(sign, "bucket int, data binary").repartition(buckets, "bucket").mapInArrow(match, "u long, v long")


def set_links(cell: np.ndarray, size: np.ndarray, same: SameSets, classes: np.ndarray, similar: tuple[int, int], most: int = 1 << 20) -> np.ndarray:
    """Links (first item, item) of similar sets within cells; items are sorted by cell and size, and those of one class
    are known to be linked."""
    _, first, of = np.unique(classes, return_index=True, return_inverse=True)
    start = first[of]
    union = Union(start.copy())
    for lo, hi in pairwise([0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]):
        n = np.searchsorted(size[lo:hi] * similar[0], size[lo:hi] * similar[1], side="right") - np.arange(1, hi - lo + 1)
        work = np.cumsum(n)
        for some in np.split(np.arange(hi - lo), np.searchsorted(work, np.arange(most, work[-1], most))):
            a = np.repeat(some, n[some])
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
            union.join(lo + a, lo + b, same)
    root = union.flat()
    item = np.flatnonzero((root != start) & (start == np.arange(len(start))))
    return np.stack([root[item], item], axis=1)


def sketched_groups(rows: DataFrame, most: int, similar: tuple[int, int]) -> DataFrame:
    """rows(root, node, n, sketch, ...) whose groups of over `most` rows are cut to the groups that pairs of similar sketches
    form; rows that are similar to none go. Sketches are compared like texts, in pieces, which are of SHARD rows."""
    hot = written(rows.groupBy("root").count().where(F.col("count") > most).select(F.col("root").alias("_hot")))
    if hot.isEmpty():
        return rows
    large = rows.join(hot, F.col("root") == F.col("_hot")).drop("_hot")

    def match(batches):
        for t in whole_runs(batches, "cell"):
            cell, node, known, n = (t.column(c).to_numpy() for c in ("cell", "node", "class", "n"))
            order = np.lexsort((node, n, cell))
            same = SameSketch(n[order], sketches_of(t.column("sketch"))[order], similar[0] / similar[1])
            links = set_links(cell[order], n[order], same, known[order], similar)
            yield pa.RecordBatch.from_arrays([pa.array(node[order][links[:, k]]) for k in (0, 1)], ["u", "v"])

    def search(part: DataFrame) -> DataFrame:
        cells = part.select(F.explode("cells").alias("cell"), "node", "class", "n", "sketch")
        return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(match, "u long, v long")

    roots = joined_groups(large.select("root", "node", F.lit(64).alias("size"), "n", "sketch"), search, SHARD).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    cut = large.join(roots, F.col("node") == F.col("_node")).withColumn("root", F.col("_root")).drop("_node", "_root")
    return rows.join(hot, F.col("root") == F.col("_hot"), "left_anti").unionByName(cut)


def similar_sets(docs: DataFrame, words: int = WORDS, similar: tuple[int, int] = SIMILAR, most: int = 4_000) -> DataFrame:
    """doc_id, n (distinct shingles) and component_id (the smallest doc_id reachable, itself included) for every row;
    links are of Jaccard similarities of similar[0]/similar[1] or more.

    Lower-cases A-Z; words are runs of bytes other than ASCII white space; a text of fewer words than a shingle is one
    shingle as a whole. Null texts and texts without words have an empty set, linked with nothing. Rows of equal sets
    are one node. A row without a doc_id links others, gets the component's id and is no end of it (null, if it is
    alone). Rows that repeat are returned repeatedly. Very long texts are sets like others, and one row is one task's
    work. An empty table gives no rows; other columns are not read. Shingles and sets are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession

    def measure(batches):
        hashes = Hashes()
        for b in batches:
            sets = [shingle_set(t, words, hashes) for t in byte_texts(b.column(1))]
            node = np.array([set_hash(s) for s in sets], dtype=np.uint64).view(np.int64)
            size = np.array([len(s) for s in sets], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(size), pa.array(node, mask=size == 0), pa.array([sketch(s) for s in sets], pa.binary())], ["doc_id", "th", "size", "n", "node", "sketch"])

    sized = keyed(docs).withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    rows = written(sized.mapInArrow(measure, "doc_id long, th long, size long, n long, node long, sketch binary"))
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "size", "n", "sketch")).alias("rep")
    nodes = written(rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"), rep))
    counts = nodes.groupBy(F.floor(F.log("rep.n") * 20).alias("k")).agg(F.avg("rep.n").alias("size"), F.count("*").alias("sets"), F.max("rep.n").alias("most")).collect()
    plan = Partition([(r.size, r.sets) for r in counts] + [(float(r.most), 0) for r in counts], similar)
    sets, signatures = sum(r.sets for r in counts), sum(2 * r.sets * plan.rate(r.size) for r in counts)
    key_bytes, node_bytes = (min(8, max(5, -(-(math.ceil(math.log2(x + 1)) + 20) // 8))) for x in (signatures, sets))
    buckets = max(partitions(spark), int(signatures * (key_bytes + node_bytes) // BUCKET_BYTES) + 1)
    short = F.shiftrightunsigned("node", 64 - 8 * node_bytes) if node_bytes < 8 else F.col("node")
    named = nodes.withColumn("short", short)
    groups = connected(candidate_links(docs, plan, words, buckets, key_bytes, node_bytes)).select(F.col("node").alias("_short"), "root")
    alike = named.groupBy(F.col("short").alias("_short")).count().where("count > 1").select("_short", F.col("_short").alias("root"))
    groups = groups.unionByName(alike.join(groups, "_short", "left_anti"))
    asked = written(named.join(groups, F.col("short") == F.col("_short")).select("root", "node", F.col("rep.doc_id").alias("_id"), F.col("rep.th").alias("_th"), "rep.size", "rep.n", "rep.sketch"))
    asked = written(sketched_groups(asked, most, similar).drop("n", "sketch"))

    def verify(batches):
        hashes = Hashes()
        for t in whole_runs(batches, "cell"):
            t = t.combine_chunks()
            sets = [shingle_set(x, words, hashes) for x in byte_texts(t.column("text").combine_chunks())]
            size = np.array([len(s) for s in sets], dtype=np.int64)
            cell, node, known = (t.column(c).to_numpy() for c in ("cell", "node", "class"))
            order = np.lexsort((node, size, cell))
            links = set_links(cell[order], size[order], SameSets([sets[i] for i in order.tolist()], similar[0] / similar[1]), known[order], similar)
            yield pa.RecordBatch.from_arrays([pa.array(node[order][links[:, k]]) for k in (0, 1)], ["u", "v"])

    # candidates' texts, once: all texts are dealt out by plain shuffles, of which a hot key is split; repeated rows go
    found = keyed(docs).join(asked.select(F.col("node").alias("_of"), "_id", "_th").hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
    texts = written(found.groupBy("_of").agg(F.any_value("text").alias("text")))

    def search(part: DataFrame) -> DataFrame:
        cells = texts.join(part, F.col("_of") == F.col("node")).select(F.explode("cells").alias("cell"), "node", "class", "text")
        return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(verify, "u long, v long")

    roots = joined_groups(asked.select("root", "node", "size"), search, most).select(F.col("node").alias("_node"), "root")
    named = nodes.join(roots, F.col("node") == F.col("_node"), "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root")).select(F.col("node").alias("_node"), "component_id")
    return rows.join(named, F.col("node") == F.col("_node"), "left").select("doc_id", "n", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op11(spark, sf_dir) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
