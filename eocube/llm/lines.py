"""Line dedup by content-defined chunks of lines, pairs of lines and long lines.

A chunk ends after a line if a rolling hash over the hashes of the last `window` lines is 0 modulo `divisor`, so
boundaries move with the content and a passage that is shifted elsewhere is cut alike. What the chunks leave over is
compared as well: every pair of successive lines that are not blank, which covers repeated passages of two or more
lines to their edges wherever chunks begin, and every line of over `words` words by itself. What occurs more than once
anywhere stays at its first place only. Hashes find the candidates; their bytes are what is compared, by grouping on
them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.llm.common import Hashes, byte_texts, fresh, joined, keyed, marked_only, windows, with_marks, written


def units(texts: list[bytes], hashes: Hashes, window: int, divisor: int, words: int) -> list[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """For each text its lines, and from, to and hash of what is compared in it, in order: chunks with two lines or
    more that are not blank, pairs of successive lines that are not blank with what is between, and long lines."""
    split = [t.split(b"\n") for t in texts]
    lines = [x for some in split for x in some]
    start = np.concatenate([[0], np.cumsum([len(some) for some in split])]).astype(np.int64)
    text = np.repeat(np.arange(len(split)), np.diff(start))
    h = hashes.of(lines)
    full = np.fromiter((bool(x.strip()) for x in lines), dtype=bool, count=len(lines))
    end = np.flatnonzero(windows(h, window) % np.uint64(divisor) == 0) + window
    bound = np.union1d(end[text[end - window] == text[end - 1]], start)
    n = np.concatenate([[0], np.cumsum(full)])
    chunk = np.flatnonzero(n[bound[1:]] - n[bound[:-1]] > 1)
    solid = np.flatnonzero(full)
    pair = np.flatnonzero(text[solid[1:]] == text[solid[:-1]])
    long = np.array([i for i, x in enumerate(lines) if len(x) > 2 * words and len(x.split()) > words], dtype=np.int64)
    a = np.concatenate([bound[chunk], solid[pair], long])
    b = np.concatenate([bound[chunk + 1], solid[pair + 1] + 1, long + 1])
    at = np.unique(np.stack([a, b]), axis=1)
    a, b = at[0], at[1]
    value, go, step = h[a], np.arange(len(a)), 1
    while len(go := go[a[go] + step < b[go]]):
        value[go] = joined(value[go], h[a[go] + step])
        step += 1
    cuts = np.searchsorted(a, start)
    return [(some, a[i:j] - o, b[i:j] - o, value[i:j].view(np.int64)) for some, o, i, j in zip(split, start.tolist(), cuts.tolist(), cuts[1:].tolist(), strict=False)]


def without_repeated_chunks(docs: DataFrame, window: int = 2, divisor: int = 4, words: int = 50) -> DataFrame:
    """doc_id, th, n_lines, n_removed and `kept`, the text without the lines of chunks, pairs of lines and lines of
    over `words` words that stand earlier: in a document with a smaller doc_id, or further up in the same one.

    Lines end at newlines. Null texts count as empty, one empty line. Single lines of up to `words` words stay, and
    so does what overlaps its own first place. Every line removed has a copy that is kept. Rows that repeat a doc_id
    count as one document; a null doc_id neither removes nor loses lines. Empty tables give no rows. Other columns are
    not read.
    """

    def hashed(batches):
        hashes = Hashes(3)
        for b in batches:
            some = [(t, d) for t, d in zip(byte_texts(b.column("text")), b.column("doc_id").to_pylist(), strict=True) if d is not None]
            rows = [np.unique(u[3], return_counts=True) for u in units([t for t, _ in some], hashes, window, divisor, words)]
            if rows:
                ids = np.repeat(np.array([d for _, d in some], dtype=np.int64), [len(v) for v, _ in rows])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([v for v, _ in rows])), pa.array(np.concatenate([k for _, k in rows])), pa.array(ids)], ["g", "n", "doc_id"])

    rows = written(keyed(docs).mapInArrow(hashed, "g long, n long, doc_id long"))
    # Written, so that both sides of the join are plain and adaptive execution can split a hot line.
    again = written(rows.groupBy("g").agg(F.sum("n").alias("_n")).where("_n > 1").select(F.col("g").alias("_g")))
    marks = written(rows.join(again, F.col("g") == F.col("_g"), "left_semi").groupBy("doc_id").agg(F.collect_set("g").alias("marks")))
    marked = with_marks(docs, marks, "marks")

    def candidates(batches):
        hashes = Hashes(3)
        for b in batches:
            rows = []
            found = units(byte_texts(b.column("text")), hashes, window, divisor, words)
            for (lines, x, y, v), d, m in zip(found, b.column("doc_id").to_pylist(), b.column("marks").to_pylist(), strict=True):
                seen = set()
                for i in np.flatnonzero(np.isin(v, m)).tolist():
                    if (chunk := b"\n".join(lines[x[i] : y[i]])) not in seen:
                        seen.add(chunk)
                        rows.append((chunk, d, int(x[i]) << 32 | int(y[i])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.binary(), pa.int64(), pa.int64()), strict=True)], ["chunk", "doc_id", "at"])

    firsts = marked_only(marked, "marks").mapInArrow(candidates, "chunk binary, doc_id long, at long")
    firsts = firsts.groupBy("chunk").agg(F.min("doc_id").alias("doc_id"), F.min_by("at", "doc_id").alias("at"))
    side = firsts.groupBy(F.col("doc_id").alias("_d")).agg(F.collect_list("at").alias("firsts"))

    def keep(batches):
        hashes = Hashes(3)
        for b in batches:
            kept, marks = byte_texts(b.column("text")), b.column("marks").to_pylist()
            n_lines, n_removed = [t.count(b"\n") + 1 for t in kept], [0] * len(kept)
            some, firsts = [k for k, m in enumerate(marks) if m], b.column("firsts").to_pylist()
            for k, (lines, x, y, v) in zip(some, units([kept[k] for k in some], hashes, window, divisor, words), strict=True):
                first, own, gone = set(firsts[k] or ()), {}, set()
                for i in np.flatnonzero(np.isin(v, marks[k])).tolist():
                    p, q, g = int(x[i]), int(y[i]), int(v[i])
                    if p << 32 | q in first:
                        own[g] = q
                    elif p >= own.get(g, 0):
                        gone.update(range(p, q))
                n_removed[k] = len(gone)
                kept[k] = b"\n".join(z for j, z in enumerate(lines) if j not in gone)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "th", "n_lines", "n_removed", "kept"]
            )

    both = marked.join(side, F.col("doc_id") == F.col("_d"), "left").select("doc_id", "text", "th", "marks", "firsts")
    return both.mapInArrow(keep, "doc_id long, th long, n_lines long, n_removed long, kept string")


def rewritten(docs: DataFrame) -> DataFrame:
    """docs with the shortened texts; documents of which nothing is left go. Untouched texts stay as they are, null
    included, and so do rows without a doc_id. Rows that repeat a doc_id and text get the same new text. A column n_chars
    follows the new text. An empty table stays empty; all columns are kept, whatever their names."""
    d, t, kept = (fresh(docs, c) for c in ("_d", "_t", "_kept"))
    found = without_repeated_chunks(docs).where("n_removed > 0").select(F.col("doc_id").alias(d), F.col("th").alias(t), F.col("kept").alias(kept)).distinct()
    out = docs.join(found, (docs.doc_id == F.col(d)) & (F.xxhash64(docs.text) == F.col(t)), "left")
    new = F.when(F.col(d).isNotNull(), F.col(kept)).otherwise(docs.text)
    columns = [new.alias("text") if c == "text" else F.when(F.col(d).isNotNull(), F.length(kept).cast(dict(docs.dtypes)[c])).otherwise(docs[c]).alias(c) if c == "n_chars" else docs[c] for c in docs.columns]
    return out.where(F.col(kept).isNull() | F.col(kept).rlike(r"\S")).select(*columns)


def op6(spark, sf_dir) -> DataFrame:
    found = without_repeated_chunks(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
