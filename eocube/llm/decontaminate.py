"""Benchmark decontamination: Wu-Manber search for many patterns at once, with words as the characters.

Patterns of one length share a shift table over blocks of two words: a block that ends no pattern says how far the
search may jump; one that does leads to the bucket of the patterns with that suffix, in which a second table is asked
for those with the prefix that the text has there. They are compared word by word.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.llm.common import byte_texts, fresh, keyed, written

#: Separators become spaces, A-Z become a-z: the bytes 0-9, a-z and from 0x80 on make words.
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

#: Bytes of benchmark text in one set of tables that goes to every executor, where it takes about 18 times as much; a
#: larger benchmark is searched set by set.
SHARD_BYTES = 2_000_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


class Tables:
    """Shift tables and suffix buckets with prefix tables, by pattern length."""

    def __init__(self, items: list[tuple[int, bytes]], length: int):
        patterns: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = words_of(text)
            m = min(length, len(words))
            for i in range(len(words) - m + 1 if m else 0):
                patterns[m][tuple(words[i : i + m])].add(item)
        self.single = patterns.pop(1, {})
        self.groups = []
        for m, found in sorted(patterns.items()):
            shift: dict[tuple, int] = {}
            bucket: dict[tuple, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
            for p, owners in found.items():
                for j in range(1, m):
                    block = p[j - 1 : j + 1]
                    shift[block] = min(shift.get(block, m - 1), m - 1 - j)
                bucket[p[-2:]][p[:2]].append((p, owners))
            self.groups.append((m, shift, {k: dict(v) for k, v in bucket.items()}))

    def search(self, words: list[bytes]) -> tuple[list[int], set]:
        """Flat starts and ends of the occurrences, and the items they belong to."""
        spans: list[int] = []
        items: set = set()
        n = len(words)
        for m, shift, bucket in self.groups:
            jump, i, far = shift.get, m - 1, m - 1
            while i < n:
                block = (words[i - 1], words[i])
                if step := jump(block, far):
                    i += step
                    continue
                for p, owners in bucket[block].get((words[i - m + 1], words[i - m + 2]), ()):
                    if tuple(words[i - m + 1 : i + 1]) == p:
                        spans += (i - m + 1, i + 1)
                        items |= owners
                i += 1
        if self.single:
            for i, w in enumerate(words):
                if (w,) in self.single:
                    spans += (i, i + 1)
                    items |= self.single[(w,)]
        return spans, items


def pieces(benchmark: DataFrame, length: int, most: int) -> DataFrame:
    """item and text of the benchmark, items of more than `most` bytes in pieces of about `most` that overlap by
    length - 1 words, so every window stands whole in a piece. Words are lower-case and joined by spaces in pieces."""

    def cut(batches):
        for b in batches:
            ids, texts = [], []
            for item, t in zip(b.column("item").to_pylist(), byte_texts(b.column("text")), strict=True):
                if len(t) <= most:
                    ids.append(item)
                    texts.append(t)
                    continue
                words = words_of(t)
                size = np.cumsum([len(w) + 1 for w in words])
                start = 0
                while start < len(words):
                    before = int(size[start - 1]) if start else 0
                    end = max(start + length, int(np.searchsorted(size, before + most, side="right")))
                    ids.append(item)
                    texts.append(b" ".join(words[start:end]))
                    start = len(words) if end >= len(words) else end - length + 1
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column("item").type), pa.array(texts, pa.binary())], ["item", "text"])

    items = benchmark.select(F.col("item_id").alias("item"), "text").where("item is not null and text is not null")
    return items.mapInArrow(cut, f"item {dict(items.dtypes)['item']}, text binary")


def occurrences(docs: DataFrame, benchmark: DataFrame, length: int = 10, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, th, n_words, n_hit and `items`, the ids of the items with a window in the document, for every row.

    Lower-cases A-Z; words are runs of 0-9, a-z and bytes from 0x80 on. An item of fewer than `length` words is one
    window, one of none has no window. Null texts have no words; rows without an item_id are passed over; items that
    repeat count once. Repeated documents are returned repeatedly; a null doc_id is kept. An empty benchmark hits
    nothing. The tables are broadcast in sets of at most about `shard_bytes` of text, by measured size: a larger
    benchmark means more passes over the documents, one after the other, not larger tables. Items of over half
    a set are cut into pieces first; one window is never cut, however long its words. The passes after the first
    keep what they hit alone, and are put together by doc_id and th. Very long texts are searched like any other.
    """
    spark = docs.sparkSession
    items = written(pieces(benchmark, length, max(1, shard_bytes // 2)))
    total = items.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    n = max(1, -(-total // shard_bytes))
    rows = keyed(docs).select("doc_id", "th", "text")
    more = []
    for k in range(n):
        some = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()
        tables = spark.sparkContext.broadcast(Tables([(r.item, bytes(r.text)) for r in some], length))
        found = rows.mapInArrow(_pass(tables, k == 0), "doc_id long, th long, n_words long, spans array<int>, items array<long>")
        if k:
            more.append(written(found))
            tables.unpersist()
        else:
            first = found
    if more:
        rest = reduce(DataFrame.unionByName, more).groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).agg(*[F.flatten(F.collect_list(c)).alias(f"_{c}") for c in ("spans", "items")])
        first = first.join(rest, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left")
        first = first.select("doc_id", "th", "n_words", *[F.concat(c, F.coalesce(f"_{c}", F.array().cast(t))).alias(c) for c, t in (("spans", "array<int>"), ("items", "array<long>"))])
    return first.mapInArrow(_counted, "doc_id long, th long, n_words long, n_hit long, items array<long>")


def _pass(tables, every: bool):
    """A search of one set of tables: the flat starts and ends of what it hits, of all documents or of those with hits."""

    def run(batches):
        found = tables.value
        for b in batches:
            rows, n_words, spans, items = [], [], [], []
            for i, t in enumerate(byte_texts(b.column("text"))):
                words = words_of(t)
                at, of = found.search(words)
                if every or at:
                    rows.append(i)
                    n_words.append(len(words))
                    spans.append(at)
                    items.append(sorted(of))
            some = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(some), b.column("th").take(some), pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.int64()))], ["doc_id", "th", "n_words", "spans", "items"])

    return run


def _counted(batches):
    """The words covered by the spans, and the distinct items."""
    for b in batches:
        n_hit, items = [], []
        for n, spans, of in zip(b.column("n_words").to_pylist(), b.column("spans").to_pylist(), b.column("items").to_pylist(), strict=True):
            steps = np.zeros(n + 1 if spans else 1, dtype=np.int64)
            np.add.at(steps, spans[::2], 1)
            np.add.at(steps, spans[1::2], -1)
            n_hit.append(int((np.cumsum(steps[:-1]) > 0).sum()))
            items.append(sorted(set(of)))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), b.column("n_words"), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.int64()))], ["doc_id", "th", "n_words", "n_hit", "items"])


def clean(docs: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """The documents that hold no window of any benchmark item; those without a doc_id stay unless hit. Null and empty
    texts stay; rows that repeat stay or go together; all columns are kept, whatever their names."""
    d, t = fresh(docs, "_d"), fresh(docs, "_t")
    bad = occurrences(docs, benchmark, length).where("n_hit > 0").select(F.col("doc_id").alias(d), F.col("th").alias(t)).distinct()
    return docs.join(bad, docs.doc_id.eqNullSafe(F.col(d)) & (F.xxhash64(docs.text) == F.col(t)), "left_anti")


def op5(spark, sf_dir) -> DataFrame:
    found = occurrences(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
