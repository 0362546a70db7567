"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

A run is a stretch with a smallest period q that no neighbouring word extends. Each run ends in exactly one square of
its period that can't be shifted right: a branching tandem repeat. In the suffix array, the two halves of such a square
of period d are suffixes i and i+d in one LCP interval of depth d, in different children. So of each interval only the
suffixes outside its largest child are looked at, and ISA[i+d] and ISA[i-d] tell whether the other half is in the same
interval. A square found is rotated left as far as its words allow, which gives the run; squares of multiples of q
give the same stretch and are merged.

All is done on arrays, for many documents at once: words are numbered by document, so nothing is in common between
documents, and intervals come from the LCP array's next smaller values, without a tree.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.llm.common import byte_texts, keyed, table

LEAST, TIMES = 24, 3
#: Words of one suffix array, if not of a single document.
WORDS = 300_000


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, from 0 by first use."""
    number = dict.fromkeys(words)
    number.update(zip(number, range(len(number)), strict=True))
    return np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))


def repeats_within(t: np.ndarray, length: int) -> np.ndarray:
    """Positions of t, whose documents have no number in common, that start one of several equal windows of `length` (a
    power of two) numbers."""
    n = len(t)
    at = np.flatnonzero(np.bincount(t)[t] > 1) if n else np.zeros(0, dtype=np.int64)
    rank, step = t, 1
    while step < length and len(at):
        known = np.zeros(n + step, dtype=bool)
        known[at] = True
        at = at[known[at + step]]
        _, inverse, count = np.unique(rank[at] * np.int64(n + 1) + rank[at + step], return_inverse=True, return_counts=True)
        several = count[inverse] > 1
        new = np.full(n, -1, dtype=np.int64)
        new[at] = inverse
        rank, at, step = new, at[several], step * 2
    return at


class SuffixArray:
    """Suffixes of t in order, with the ranks of all windows of 1, 2, 4, ... numbers (4 bytes each), from which common
    extensions of two positions to the right and to the left are read."""

    def __init__(self, t: np.ndarray):
        n = len(t)
        self.ranks = [t.astype(np.int32)]
        step = 1
        while True:
            key = (self.ranks[-1].astype(np.int64) + 1) * (n + 1)
            key[: n - step] += self.ranks[-1][step:] + 1
            order = np.argsort(key, kind="stable")
            new = np.zeros(n, dtype=np.int32)
            new[order[1:]] = np.cumsum(key[order][1:] != key[order][:-1])
            self.ranks.append(new)
            step *= 2
            if n == 0 or new[order[-1]] == n - 1:
                break
        self.sa, self.isa = order, new
        self.lcp = np.zeros(n + 1, dtype=np.int64)
        self.lcp[1:n] = self.right(order[:-1], order[1:])
        self.lcp[0] = self.lcp[n] = -1

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers from a and b on are equal."""
        n, out = len(self.ranks[0]), np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            x, y = a + out, b + out
            inside = (x < n) & (y < n)
            same = inside & (self.ranks[k][np.where(inside, x, 0)] == self.ranks[k][np.where(inside, y, 0)])
            out[same] += 1 << k
        return out

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers before a and b are equal."""
        out = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            x, y = a - out - (1 << k), b - out - (1 << k)
            inside = (x >= 0) & (y >= 0)
            same = inside & (self.ranks[k][np.where(inside, x, 0)] == self.ranks[k][np.where(inside, y, 0)])
            out[same] += 1 << k
        return out

    def intervals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place k of the LCP array with a common prefix: k, and the ends (first, behind last) of the interval in
        which no common prefix is shorter than at k."""
        lcp = self.lcp
        at = np.flatnonzero(lcp > 0)
        least = [lcp]
        while 2 << (len(least) - 1) <= len(lcp):
            half = 1 << (len(least) - 1)
            least.append(np.minimum(least[-1][:-half], least[-1][half:]))
        lo, hi = at.copy(), at + 1
        for k in range(len(least) - 1, -1, -1):
            wide = 1 << k
            back = lo >= wide
            back &= least[k][np.where(back, lo - wide, 0)] >= lcp[at]
            lo[back] -= wide
            on = hi + wide <= len(lcp)
            on &= least[k][np.where(on, hi, 0)] >= lcp[at]
            hi[on] += wide
        return at, lo - 1, hi

    def branching_squares(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and periods of the squares that can't be shifted to the right."""
        at, lo, hi = self.intervals()
        n = len(self.sa)
        none = np.zeros(0, dtype=np.int64)
        if not len(at):
            return none, none
        _, first, of = np.unique(lo * (n + 1) + hi, return_index=True, return_inverse=True)
        start = np.concatenate([lo[first], at])  # of the intervals' children
        of = np.concatenate([np.arange(len(first)), of])
        order = np.lexsort((start, of))
        start, of = start[order], of[order]
        last = np.append(of[1:] != of[:-1], True)
        size = np.where(last, hi[first][of], np.append(start[1:], 0)) - start
        heads = np.flatnonzero(np.append(True, last[:-1]))
        widest = np.maximum.reduceat(size, heads)[of]
        largest = np.flatnonzero(size == widest)
        keep = np.ones(len(size), dtype=bool)
        keep[largest[np.append(True, of[largest][1:] != of[largest][:-1])]] = False
        start, size, of = start[keep], size[keep], of[keep]
        place = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        of = np.repeat(of, size)
        i, d, lo, hi = self.sa[place], self.lcp[at[first]][of], lo[first][of], hi[first][of]
        t = np.append(self.ranks[0], -1)
        starts, periods = [], []
        for a, b in ((i, i + d), (i - d, i)):  # the square's halves
            other = b if a is i else a
            inside = (other >= 0) & (other < n)
            where = self.isa[np.where(inside, other, 0)]
            inside &= (where >= lo) & (where < hi)
            a, p = a[inside], d[inside]
            branching = t[np.minimum(a + p, n)] != t[np.minimum(a + 2 * p, n)]
            starts.append(a[branching])
            periods.append(p[branching])
        return np.concatenate(starts), np.concatenate(periods)


def runs_of(t: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of every run of t with length >= max(least, times * period), by start, then period; times is 2 or
    more."""
    if not len(t):
        return np.zeros((0, 3), dtype=np.int64)
    array = SuffixArray(t)
    start, period = array.branching_squares()
    end = start + 2 * period
    start = start - array.left(start, start + period)
    long = end - start >= np.maximum(least, times * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)  # of one stretch, the smallest period counts
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return np.stack([start, end - start, period], axis=1)[order]


def runs_by_document(texts: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """runs_of() each document's numbers. Two equal windows of w words lie within any run, w being at least what a run
    of the least length has besides one period; documents without such windows are done with."""
    size = np.array([len(x) for x in texts], dtype=np.int64)
    top = np.array([int(x.max()) + 1 if len(x) else 0 for x in texts], dtype=np.int64)
    base, offset = np.cumsum(top) - top, np.cumsum(size) - size
    whole = np.concatenate([x + b for x, b in zip(texts, base.tolist(), strict=True)]) if texts else np.zeros(0, dtype=np.int64)
    window = 1 << (max(1, least - least // times).bit_length() - 1)
    asked = np.unique(np.searchsorted(offset + size, repeats_within(whole, window), side="right"))
    none = np.zeros((0, 3), dtype=np.int64)
    out = [none] * len(texts)
    if len(asked):
        parts, begin = [whole[offset[k] : offset[k] + size[k]] for k in asked.tolist()], np.cumsum(size[asked]) - size[asked]
        _, dense = np.unique(np.concatenate(parts), return_inverse=True)
        found = runs_of(dense.astype(np.int64), least, times)
        cuts = np.searchsorted(found[:, 0], np.append(begin, begin[-1] + size[asked[-1]]))
        for k, b, x, y in zip(asked.tolist(), begin.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            out[k] = found[x:y] - np.array([b, 0, 0])
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay if each run keeps its first period only."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, th, n_words, runs and collapsed for every row of docs: runs has (start, length, period) of each run of
    words with length >= max(least, times * period), by start, then period; collapsed has the words that are left if
    each run keeps its first period, joined by one space.

    Words are runs of bytes other than ASCII white space. Null and empty texts have no words and no runs. A null doc_id
    is kept; repeated rows are returned repeatedly. An empty table gives no rows. Other columns are not read. One row
    is one task's work: a document of n words that has long repeats takes about 4 * log2(n) bytes a word for its
    suffix array and some hundred more for its intervals, and time of n * log2(n)^2.
    """

    def run(batches):
        for b in batches:
            at, total = 0, 0
            words: list[list[bytes]] = []
            texts = byte_texts(b.column(1))
            for k, text in enumerate(texts):
                words.append(text.split())
                total += len(words[-1])
                if total >= WORDS or k == len(texts) - 1:
                    found = runs_by_document([numbered(w) for w in words], least, times)
                    kept = [b" ".join(w if not len(r) else [x for x, k in zip(w, kept_words(len(w), r).tolist(), strict=True) if k]) for w, r in zip(words, found, strict=True)]
                    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                    flat = np.concatenate(found)
                    structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
                    n = len(words)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(at, n), b.column(2).slice(at, n), pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), structs), pa.array(kept, pa.binary()).cast(pa.string())],
                        ["doc_id", "th", "n_words", "runs", "collapsed"],
                    )
                    at, total, words = at + n, 0, []

    return keyed(docs).mapInArrow(run, "doc_id long, th long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def made_periodic(docs: DataFrame) -> DataFrame:
    """doc_id and text, the words joined by one space; of every document whose h = crc32 of its doc_id as text ends in 0,
    the words from number a on repeat with period p, where g = h div 10, a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    A null doc_id counts as the empty text; without words nothing repeats."""

    def run(batches):
        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), byte_texts(b.column(1)), strict=True):
                words, h = text.split(), zlib.crc32(b"" if doc is None else str(doc).encode())
                if h % 10 == 0 and words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    words[a:] = (words[a : a + p] * ((n - a) // p + 1))[: n - a]
                out.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return keyed(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, text string")


def op13(spark, sf_dir) -> DataFrame:
    found = periodic_runs(made_periodic(table(spark, sf_dir, "documents")))
    # by cross multiplication the quotients compare exactly; of equal ones the first by start and period stays
    stronger = F.expr("aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (x, y) -> if(x is null or y.length * x.period > x.length * y.period, y, x))")
    text = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.withColumn("best", stronger).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
