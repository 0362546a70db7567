"""Token counts by pre-token: what a tokenizer makes of a pre-token is counted once, and documents sum the counts.

For a sentencepiece BPE model whose pieces hold white-space marks only at their start, no merge crosses from a
character to a following mark, so a text's pieces are those of its pre-tokens: runs of marks with the characters up
to the next mark. Models with other pieces are refused.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from eocube.llm.common import keyed, pack, unpack

_HEAD = np.dtype([("doc_id", "<i8"), ("known", "<i1"), ("n_bytes", "<i8")])
_PRE = re.compile("[ ▁]*[^ ▁]+|[ ▁]+")
_BLOCK_CHARS, _BLOCK_DOCS = 12_000_000, 16_384
#: Bytes of text for each bucket of pre-tokens, so what a task remembers doesn't grow with the corpus.
BUCKET_BYTES = 16_000_000


@functools.cache
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def check(path: str) -> None:
    """Raises unless counting by pre-token is exact for the model."""
    p = processor(path)
    if any(re.search("[^▁]▁", p.id_to_piece(i)) for i in range(p.get_piece_size())) or p.normalize("a  b") != "▁a▁▁b":
        raise ValueError("the model's pieces cross pre-tokens, or it changes white space")


def pre_tokens(text: str) -> list[str]:
    """The text is given the leading mark that the model puts before it; empty texts get none."""
    return _PRE.findall(" " + text) if text else []


def piece_counts(path: str, found: list[str]) -> list[int]:
    """Pieces of each pre-token. encode() puts the first mark back; a mark alone is what it adds behind a word."""
    p = processor(path)
    got = [len(x) for x in p.encode([x[1:] for x in found], num_threads=1)] if found else []
    alone = len(p.encode("a ")) - len(p.encode("a"))
    return [n if len(x) > 1 else alone for x, n in zip(found, got, strict=True)]


class _Block:
    """Documents that a task has read in turn: their distinct pre-tokens, each with the documents that use it and how
    often. It leaves the task in one row per bucket of pre-tokens, packed, and a row that names the documents."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.heads: list[tuple] = []
        self.flat: list[str] = []
        self.counts: list[int] = []

    def add(self, head: tuple, text: str) -> bool:
        found = pre_tokens(text)
        self.heads.append(head)
        self.flat += found
        self.counts.append(len(found))
        self.size += len(text)
        return self.size >= _BLOCK_CHARS or len(self.heads) >= _BLOCK_DOCS

    def rows(self, buckets: int) -> pa.RecordBatch:
        coded = pa.array(self.flat, pa.large_string()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        bucket = np.fromiter((xxh64_intdigest(w) % buckets for w in words), dtype=np.int64, count=len(words))
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        n_docs = max(1, len(self.counts))
        key, n = np.unique(rank[coded.indices.to_numpy()] * n_docs + np.repeat(np.arange(len(self.counts)), self.counts), return_counts=True)
        word, doc = key // n_docs, key % n_docs
        named = [words[i].encode() for i in order.tolist()]
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        posts = np.searchsorted(word, cuts)
        out = [(self.number % buckets, self.number, True, pack(np.array(self.heads, dtype=_HEAD)))]
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            some, (a, b) = named[cuts[k] : cuts[k + 1]], posts[k : k + 2]
            uses = np.bincount(word[a:b] - cuts[k], minlength=len(some))
            out.append((k, self.number, False, pack(b"".join(some), np.array([len(x) for x in some], dtype=np.uint32), uses.astype(np.uint32), doc[a:b].astype(np.uint16), n[a:b].astype(np.uint32))))
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.bool_(), pa.binary()), strict=True)], ["bucket", "block", "header", "data"])


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens for every row: the tokens the model gives the whole text, none added.

    Each task counts its documents' pre-tokens by blocks of some MB. Pre-tokens are dealt by hash, so the uses of one
    meet where its pieces are counted, once; what a block's documents gain from each bucket goes back to the block.
    Null and empty texts have 0 bytes and tokens; repeated rows are returned repeatedly, a null doc_id is kept. An
    empty table gives no rows. Other columns are not read. model_path must be readable on every executor, and docs a
    table as read, which a rerun deals out alike: blocks are named by partition and order.
    """
    check(model_path)
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // BUCKET_BYTES))

    def split(batches):
        part = TaskContext.get().partitionId() << 32
        block = _Block(part)
        for b in batches:
            for d, t, n in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("n_bytes").to_pylist(), strict=True):
                if block.add((d or 0, d is not None, n or 0), t or ""):
                    yield block.rows(buckets)
                    block = _Block(block.number + 1)
        if block.heads:
            yield block.rows(buckets)

    def count(batches):
        counts: dict[bytes, int] = {}  # of this bucket's pre-tokens, each of which is in no other one
        for b in batches:
            out = []
            for header, data in zip(b.column("header").to_pylist(), b.column("data").to_pylist(), strict=True):
                if header:
                    out.append(data)
                    continue
                text, size, uses, doc, n = unpack(data, np.uint8, np.uint32, np.uint32, np.uint16, np.uint32)
                raw, end = text.tobytes(), np.cumsum(size.astype(np.int64))
                words = [raw[i:j] for i, j in zip((end - size).tolist(), end.tolist(), strict=True)]
                new = [w for w in words if w not in counts]
                counts.update(zip(new, piece_counts(model_path, [w.decode() for w in new]), strict=True))
                pieces = np.fromiter(map(counts.__getitem__, words), dtype=np.int64, count=len(words))
                gain = np.bincount(doc, weights=np.repeat(pieces, uses) * n)
                some = np.flatnonzero(gain)
                out.append(pack(some.astype(np.uint16), gain[some].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("header"), pa.array(out, pa.binary())], ["block", "header", "data"])

    def add(batches):
        heads: dict[int, np.ndarray] = {}
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for block, header, data in zip(*(b.column(c).to_pylist() for c in ("block", "header", "data")), strict=True):
                if header:
                    heads[block] = unpack(data, _HEAD)[0]
                else:
                    doc, gain = unpack(data, np.uint16, np.int64)
                    np.add.at(totals.setdefault(block, np.zeros(_BLOCK_DOCS, dtype=np.int64)), doc, gain)
        for block, head in heads.items():
            total = totals.get(block, np.zeros(_BLOCK_DOCS, dtype=np.int64))[: len(head)]
            yield pa.RecordBatch.from_arrays([pa.array(head["doc_id"].astype(np.int64), mask=head["known"] == 0), pa.array(head["n_bytes"].astype(np.int64)), pa.array(total)], ["doc_id", "n_bytes", "n_tokens"])

    kind = "block long, header boolean, data binary"
    rows = keyed(docs).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes")).mapInArrow(split, f"bucket int, {kind}")
    counted = rows.repartition(buckets, "bucket").mapInArrow(count, kind)
    return counted.repartition(buckets, "block").mapInArrow(add, "doc_id long, n_bytes long, n_tokens long")


def op4(spark, sf_dir, model_path: str | None = None, limit: int = 4096) -> DataFrame:
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    found = token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), str(model_path))
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
