"""Substring dedup by level-wise doubling.

Whether a run of `length` words occurs elsewhere is asked level by level: runs of length/2 words first (or
length/4, ... from `start`), then only what repeats there is extended to twice the length. At the levels below
the last one, each window of `length` words stands for its run with the smallest hash, which equal windows choose
alike, so about 2/(length - start + 2) of the runs are shuffled and none that could repeat is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.llm.common import Hashes, byte_texts, joined, keyed, marked_only, mixed, windows, with_marks, written

_OTHER = np.uint64(0x5851F42D4C957F2D)


def _rolling(best, x: np.ndarray, span: int) -> np.ndarray:
    """best (np.minimum or np.maximum) over every `span` consecutive entries."""
    size = 1
    while size * 2 <= span:
        x, size = best(x[:-size], x[size:]), size * 2
    return best(x[: len(x) - (span - size)], x[span - size :]) if size < span else x


def _member(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, x)
    return ordered[np.minimum(at, len(ordered) - 1)] == x if len(ordered) else np.zeros(len(x), dtype=bool)


def one_number(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """One number for the two hashes of a window, to tell it from the others of its document."""
    return a ^ (c << np.uint64(32))


class Run:
    """The words of several documents in one array, so that hashing costs a few array operations for all of them."""

    def __init__(self, batch: pa.RecordBatch, hashes: Hashes, length: int):
        self.batch = batch
        self.words = [t.split() for t in byte_texts(batch.column("text"))]
        self.n = np.array([len(w) for w in self.words], dtype=np.int64)
        known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self.first = np.cumsum(self.n) - self.n
        self.h = hashes.of(list(chain.from_iterable(self.words)))
        self.length = length
        m = max(0, len(self.h) - length + 1)
        #: Starts of windows that lie in one document.
        self.whole = (self.doc[:m] == self.doc[length - 1 :]) & known[self.doc[:m]] if m else np.zeros(0, dtype=bool)

    def least(self, run: int) -> np.ndarray:
        """For every window, the hash of the run it chooses."""
        return _rolling(np.minimum, windows(self.h, run), self.length - run + 1)

    def surviving(self, run: int) -> np.ndarray:
        """Which windows have a chosen run that is marked. A run marked for one document is so for any."""
        marks = np.unique(self.batch.column("marks").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        return self.whole & _member(self.least(run), marks) if self.whole.any() and len(marks) else np.zeros(len(self.whole), dtype=bool)

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows at these starts, of 64 and of 31 bits."""
        return windows(self.h, self.length)[at], windows(mixed(self.h ^ _OTHER), self.length)[at] >> np.uint64(33)

    def column(self, name: str, rows: np.ndarray):
        return self.batch.column(name).take(pa.array(rows))


def _runs(batches, length: int, most: int = 4 << 20) -> Iterator[Run]:
    """Documents in runs of about `most` bytes of text."""
    hashes = Hashes(1)
    for b in batches:
        size = np.cumsum(np.array(pc.fill_null(pc.binary_length(b.column("text").cast(pa.binary())), 0).to_pylist(), dtype=np.int64) + 100) // most
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), b.num_rows]
        for x, y in zip(cuts, cuts[1:], strict=False):
            if y > x:
                yield Run(b.slice(x, y - x), hashes, length)


def repeated_spans(docs: DataFrame, length: int = 20, start: int = 10) -> DataFrame:
    """doc_id, th, n_words, n_removed and `kept`, the text without words covered by a window of `length` words that
    also starts earlier: in a document with a smaller doc_id, or earlier in the same one.

    Words are runs of bytes other than ASCII white space, unchanged; kept words are joined by one space. Windows are
    judged on the input, by two hashes of 64 and 31 bits, put together from 64-bit hashes of the words. Null and empty texts have no words, texts of fewer than `length` words
    no window. Rows that repeat a doc_id count as one document and get one result each; a null doc_id neither removes
    nor loses words. Empty tables give no rows. Other columns are not read.
    """
    runs = [start]
    while runs[-1] * 2 < length:
        runs.append(runs[-1] * 2)
    if start < 1 or runs[-1] * 2 != length:
        raise ValueError("length must be start doubled once or more")
    marks = None
    for k, run in enumerate(runs):
        marks = written(_repeated(docs, length, run, marks, runs[k - 1] if k else 0))
        if marks.isEmpty():
            break
    with_runs = with_marks(docs, marks, "marks")
    last = runs[-1]

    def full(batches):
        for r in _runs(batches, length):
            at = np.flatnonzero(r.surviving(last))
            if not len(at):
                continue
            a, c = r.windows(at)
            _, first = np.unique(joined(r.doc[at].astype(np.uint64), one_number(a, c)), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(a[first].view(np.int64)), pa.array(c[first].astype(np.int32)), r.column("doc_id", r.doc[at[first]])], ["a", "c", "doc_id"])

    seen = marked_only(with_runs, "marks").mapInArrow(full, "a long, c int, doc_id long")
    one = F.col("a").bitwiseXOR(F.shiftleft(F.col("c").cast("long"), 32))  # as one_number() has it: tells the windows of one document apart
    firsts = seen.groupBy("a", "c").agg(F.min("doc_id").alias("_d")).groupBy("_d").agg(F.collect_list(one).alias("firsts"))

    def cover(batches):
        for r in _runs(batches, length):
            at = np.flatnonzero(r.surviving(last))
            kept = [b" ".join(w) for w in r.words] if not len(at) else None
            n_removed = np.zeros(len(r.n), dtype=np.int64)
            if kept is None:
                mine = joined(r.doc[at].astype(np.uint64), one_number(*r.windows(at)))
                _, first = np.unique(mine, return_index=True)
                f = r.batch.column("firsts")
                own = joined(pc.list_parent_indices(f).to_numpy(zero_copy_only=False).astype(np.uint64), f.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                stays = first[_member(mine[first], np.sort(own))]
                gone = np.delete(at, stays)
                steps = np.zeros(len(r.h) + 1, dtype=np.int64)
                np.add.at(steps, gone, 1)
                np.add.at(steps, gone + length, -1)
                out = np.cumsum(steps[:-1]) > 0
                n_removed = np.bincount(r.doc, weights=out, minlength=len(r.n)).astype(np.int64)
                kept = [b" ".join(w if not k else [x for x, o in zip(w, out[i : i + len(w)].tolist(), strict=True) if not o]) for w, k, i in zip(r.words, n_removed.tolist(), r.first.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [r.batch.column("doc_id"), r.batch.column("th"), pa.array(r.n), pa.array(n_removed), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "th", "n_words", "n_removed", "kept"]
            )

    both = with_runs.join(firsts, F.col("doc_id") == F.col("_d"), "left").select("doc_id", "text", "th", "marks", "firsts")
    return both.mapInArrow(cover, "doc_id long, th long, n_words long, n_removed long, kept string")


def _repeated(docs: DataFrame, length: int, run: int, marks: DataFrame | None, before: int) -> DataFrame:
    """For each document, the hashes of its chosen runs of `run` words that occur more than once anywhere."""
    source = keyed(docs) if marks is None else marked_only(with_marks(docs, marks, "marks"), "marks")
    span = length - run + 1

    def choose(batches):
        for r in _runs(batches, length):
            live = r.surviving(before) if before else r.whole
            if not live.any():
                continue
            # A run is chosen if it is the least of some live window: if the greatest of the windows' least is it.
            g, least = windows(r.h, run), np.where(live, r.least(run), np.uint64(0))
            at = np.flatnonzero(_rolling(np.maximum, np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)]), span) == g)
            doc, g = r.doc[at], g[at]
            order = np.lexsort((g, doc))
            doc, g = doc[order], g[order]
            new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (g[1:] != g[:-1])]))
            n = np.diff(np.append(new, len(g)))
            yield pa.RecordBatch.from_arrays([pa.array(g[new].view(np.int64)), pa.array(n), r.column("doc_id", doc[new])], ["g", "n", "doc_id"])

    rows = written(source.mapInArrow(choose, "g long, n long, doc_id long"))
    # Written, so that both sides of the join are plain and adaptive execution can split a hot run.
    again = written(rows.groupBy("g").agg(F.sum("n").alias("_n")).where("_n > 1").select(F.col("g").alias("_g")))
    return rows.join(again, F.col("g") == F.col("_g"), "left_semi").groupBy("doc_id").agg(F.collect_set("g").alias("marks"))


def op3(spark, sf_dir) -> DataFrame:
    found = repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
