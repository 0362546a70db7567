"""What several operators of this subpackage share.

Rows of `documents` are recognised by their doc_id together with a hash of
their text, so rows that repeat a doc_id with another text stay apart, and
rows that repeat both get the same result.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary folder if all
    run on this machine, else an error: executors elsewhere would not see it."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="eocube-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: lineage ends in the shared folder, and a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The same as a compressed Parquet table in the shared folder, for larger intermediate tables."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/eocube-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(df: DataFrame) -> None:
    """Deletes a table that written() made, once another written table has replaced it."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str, most: int = 32_000_000) -> Iterator[pa.Table]:
    """Tables of about `most` bytes out of a partition sorted by `key`, none of which cuts the rows of one key apart."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        if size >= most:
            last, values = held[-1].column(key)[-1].as_py(), b.column(key).to_numpy(zero_copy_only=False)
            end = int(np.searchsorted(values, last, side="right"))
            if end < b.num_rows:
                yield pa.Table.from_batches([*held, b.slice(0, end)])
                held, size, b = [], 0, b.slice(end)
        held.append(b)
        size += b.nbytes
    if held:
        yield pa.Table.from_batches(held)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def remainder(column: str, n: int) -> Column:
    """crc32 of a number written as text, modulo n; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


class Hashes(dict):
    """xxh64 of words, remembered for up to `most` of them."""

    def __init__(self, seed: int = 0, most: int = 1 << 19):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, seed=self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def byte_texts(column) -> list[bytes]:
    """UTF-8 texts of an Arrow string column; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def packed(values: np.ndarray, counts: np.ndarray) -> pa.BinaryArray:
    """One binary value for each entry of counts, cut in order out of the fixed-width array values."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts * values.dtype.itemsize, out=offsets[1:])
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of a packed column in one array, and how many each row has."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.LargeBinaryArray):
        column = column.cast(pa.binary())
    if not len(column):
        return np.zeros(0, dtype=dtype), np.zeros(0, dtype=np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = memoryview(data)[offsets[0] : offsets[-1]] if data is not None else b""
    return np.frombuffer(bytes(raw), dtype=dtype), np.diff(offsets) // np.dtype(dtype).itemsize


def pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays in one compressed value; their lengths in bytes come first."""
    raw = [x if isinstance(x, bytes) else x.tobytes() for x in arrays]
    whole = np.array([len(x) for x in raw], dtype=np.int64).tobytes() + b"".join(raw)
    return len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def unpack(value: bytes, *kinds) -> list[np.ndarray]:
    whole = pa.decompress(value[8:], decompressed_size=int.from_bytes(value[:8], "little"), codec="zstd", asbytes=True)
    at, out = 8 * len(kinds), []
    for n, kind in zip(np.frombuffer(whole[:at], dtype=np.int64).tolist(), kinds, strict=True):
        out.append(np.frombuffer(whole, dtype=kind, count=n // np.dtype(kind).itemsize, offset=at))
        at += n
    return out


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # fixed values: murmur3's 64-bit finaliser


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a sequence from those of its two parts; not symmetric."""
    return mixed(mixed(left) * np.uint64(0x9E3779B97F4A7C15) + right)


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of `length` consecutive items, put together by doubling."""
    if len(h) < length:
        return h[:0]
    out, have, power, done = None, 0, h, 1
    left = length
    while left:
        if left & 1:
            n = len(h) - (have + done) + 1
            out = power[:n] if out is None else joined(out[:n], power[have : have + n])
            have += done
        left >>= 1
        if left:
            power = joined(power[:-done], power[done:])
            done *= 2
    return out


def fresh(df: DataFrame, name: str) -> str:
    """A name like `name` that no column of df has, in either case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and th, the text's hash (null texts hash as the seed)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("th"))


def with_marks(docs: DataFrame, marks: DataFrame, column: str) -> DataFrame:
    """keyed() documents, each with the array that `marks` holds for its doc_id, or null. Both sides are plain
    shuffles, so adaptive execution may split a hot key."""
    d = keyed(docs)
    return d.join(marks.select(F.col("doc_id").alias("_id"), F.col(column)), d.doc_id == F.col("_id"), "left").select("doc_id", "text", "th", column)


def marked_only(joined: DataFrame, column: str) -> DataFrame:
    """The rows of with_marks() that have marks. The condition looks at both sides of the join, which keeps it an outer
    join: a plan that also needs the other rows can then use the same shuffle of the texts."""
    return joined.where(F.coalesce(F.size(column), F.lit(0)) > F.when(F.col("doc_id").isNull(), 1).otherwise(0))
