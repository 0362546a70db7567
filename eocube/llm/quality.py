"""Quality classifier: a linear-chain conditional random field over a document's lines.

Each line is good or bad. A line's features are statistics of its characters and words, put into bins, and those of
the lines before and after it; adjacent labels are coupled by transition weights. Training takes a document's label
for each of its lines and maximises the likelihood of the label sequences; each gradient is summed by a Spark job.
A document's score is the length-weighted mean of its lines' forward-backward marginals, calibrated by a logistic
curve on the same sample.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eocube.llm.common import byte_texts, cut, fresh, keyed, remainder

#: Bin edges of each feature; every feature has len(edges) + 1 bins.
_SHARE = [0.001, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.8]
_EDGES = {
    "symbols": _SHARE, "punctuation": _SHARE, "capitals": _SHARE, "digits": _SHARE, "high_bytes": _SHARE, "repeats": _SHARE,
    "commonest": _SHARE, "one_letter": _SHARE, "words": [0.5, 1.5, 3.5, 7.5, 15.5, 31.5, 63.5, 255.5], "word_length": [1.5, 2.5, 3.5, 4.5, 5.5, 7.5, 10.5, 15.5],
    "seen": [0.5], "no_end": [0.5],
}
_BINS = max(len(x) for x in _EDGES.values()) + 1
_PER_LINE = len(_EDGES)
#: Weights: bins of a line, of the one before, of the one after, then bias, transitions stay-good and stay-bad, start.
N_WEIGHTS = 3 * _PER_LINE * _BINS + 4
_LETTERS = bytes(range(0x61, 0x7B)) + bytes(range(0x41, 0x5B))
_UPPER, _DIGITS, _HIGH = bytes(range(0x41, 0x5B)), b"0123456789", bytes(range(0x80, 0x100))
_PUNCT = b".,;:!?'\"()-"
_KNOWN = _LETTERS + _DIGITS + _HIGH + _PUNCT + b" \t\r\n\v\f"


def line_bins(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bins (lines x features) and weights (bytes + 1) of a text's lines."""
    lines = text.split(b"\n")
    rows, seen = [], set()
    for line in lines:
        words = line.split()
        n, w = max(1, len(line)), max(1, len(words))
        most = Counter(words).most_common(1)[0][1] if len(words) > 1 else 0
        rows.append((
            len(line.translate(None, _KNOWN)) / n, (len(line) - len(line.translate(None, _PUNCT))) / n, (len(line) - len(line.translate(None, _UPPER))) / n,
            (len(line) - len(line.translate(None, _DIGITS))) / n, (len(line) - len(line.translate(None, _HIGH))) / n, 1 - len(set(words)) / w if words else 0,
            most / w, sum(1 for x in words if len(x) == 1) / w, len(words), len(line) / w, line in seen, not line.rstrip().endswith((b".", b"!", b"?")),
        ))
        seen.add(line)
    values = np.array(rows, dtype=np.float64)
    bins = np.stack([np.searchsorted(e, values[:, i], side="right") for i, e in enumerate(_EDGES.values())], axis=1)
    return bins.astype(np.uint8), np.array([len(x) + 1 for x in lines], dtype=np.int64)


def active(bins: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Indices of each line's weights: own bins, and those of its neighbours; -1 where it has none."""
    own = bins + np.arange(_PER_LINE) * _BINS
    before, after = np.roll(own, 1, axis=0) + _PER_LINE * _BINS, np.roll(own, -1, axis=0) + 2 * _PER_LINE * _BINS
    before[first], after[last] = -1, -1
    return np.concatenate([own, before, after], axis=1)


def marginals(weights: np.ndarray, bins: np.ndarray, lengths: np.ndarray):
    """Of all lines of some documents: P(good), P(both good), P(both bad) with the line before, and the indices.
    Forward-backward in log-odds form over all documents at once, line by line."""
    ends = np.cumsum(lengths)
    first, last = ends - lengths, ends - 1
    idx = active(bins.astype(np.int64), first, last)
    emit = np.append(weights[:-4], 0.0)[idx].sum(axis=1) + weights[-4]
    emit[first] += weights[-1]
    good, bad = weights[-3], weights[-2]  # scores of good-good and bad-bad; changes score 0
    fw, bw = np.empty(len(emit)), np.zeros(len(emit))
    order = np.argsort(-lengths, kind="stable")
    most = int(lengths.max(initial=0))
    alive = np.searchsorted(-lengths[order], -np.arange(1, most + 1), side="right")
    fw[first] = emit[first]
    step = lambda x: np.logaddexp(x + good, 0) - np.logaddexp(x, bad)  # noqa: E731  log-odds passed along one transition
    for t in range(1, most):
        at = first[order[: alive[t]]] + t
        fw[at] = emit[at] + step(fw[at - 1])
    for t in range(1, most):
        at = last[order[: alive[t]]] - t
        bw[at] = step(emit[at + 1] + bw[at + 1])
    p = 1 / (1 + np.exp(-(fw + bw)))
    inner = np.ones(len(emit), dtype=bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    a, b = fw[at - 1], emit[at] + bw[at]
    z = np.logaddexp(np.logaddexp(a + b + good, bad), np.logaddexp(a, b))
    return p, np.exp(a + b + good - z), np.exp(bad - z), idx, first, at


def mean_marginal(weights, bins, sizes, lengths) -> np.ndarray:
    p = marginals(weights, bins, lengths)[0]
    starts = np.cumsum(lengths) - lengths
    return np.add.reduceat(p * sizes, starts) / np.add.reduceat(sizes.astype(np.float64), starts)


def _odds(m: np.ndarray) -> np.ndarray:
    m = np.clip(m, 1e-4, 1 - 1e-4)
    return np.log(m / (1 - m))


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 8_192, steps: int = 40, rate: float = 0.3) -> tuple[np.ndarray, float, float]:
    """Weights, slope and offset, from at most most_rows labelled rows: those first in the order of a hash of doc_id,
    so a rerun takes the same. Labels other than 0 and 1, and null ids, are passed over; a document that is labelled both
    0 and 1 counts as 0. Without labels: all zero."""
    some = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality")).where("_id is not null and quality in (0, 1)").groupBy("_id").agg(F.min("quality").alias("quality"))
    some = some.orderBy(F.xxhash64("_id"), "_id").limit(most_rows)

    def prepare(batches):
        for b in batches:
            got = [line_bins(t) for t in byte_texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("quality"), pa.array([x.tobytes() for x, _ in got]), pa.array([x.tobytes() for _, x in got])], ["quality", "bins", "sizes"])

    # At most most_rows rows of two numbers: broadcasting them is bounded whatever the tables' sizes.
    sample = cut(keyed(docs).join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("text", "quality").mapInArrow(prepare, "quality int, bins binary, sizes binary").repartition(8))

    def load(batches):
        rows = [(q, np.frombuffer(x, dtype=np.uint8).reshape(-1, _PER_LINE), np.frombuffer(s, dtype=np.int64)) for b in batches for q, x, s in zip(*(b.column(c).to_pylist() for c in ("quality", "bins", "sizes")), strict=True)]
        if not rows:
            return None
        n = np.array([len(r[2]) for r in rows])
        return np.array([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows]), n

    def summed(f) -> np.ndarray | None:
        def run(batches):
            if (data := load(batches)) is not None:
                yield pa.RecordBatch.from_arrays([pa.array([f(*data).astype(np.float64).tobytes()])], ["part"])

        parts = sorted(bytes(r.part) for r in sample.mapInArrow(run, "part binary").collect())
        return np.sum([np.frombuffer(x) for x in parts], axis=0) if parts else None

    weights = np.zeros(N_WEIGHTS)
    mean, square = np.zeros(N_WEIGHTS), np.zeros(N_WEIGHTS)
    for k in range(1, steps + 1):
        now = weights.copy()

        def gradient(q, bins, sizes, n, now=now):
            p, gg, bb, idx, first, inner = marginals(now, bins, n)
            y = np.repeat(q, n)
            # Each document counts alike, however many lines it has.
            share = np.repeat(1 / n, n)
            err = (y - p) * share
            out = np.zeros(N_WEIGHTS + 1)
            out[:-5] = np.bincount(np.where(idx < 0, N_WEIGHTS - 4, idx).ravel(), weights=np.repeat(err, idx.shape[1]), minlength=N_WEIGHTS - 3)[: N_WEIGHTS - 4]
            out[-5] = err.sum()
            out[-4] = ((y[inner] - gg) * share[inner])[y[inner] == 1].sum() - (gg * share[inner])[y[inner] == 0].sum()
            out[-3] = (((1 - y[inner]) - bb) * share[inner])[y[inner] == 0].sum() - (bb * share[inner])[y[inner] == 1].sum()
            out[-2] = err[first].sum()
            out[-1] = len(n)
            return out

        got = summed(gradient)
        if got is None:
            return weights, 1.0, 0.0
        g = got[:-1] / got[-1] - 1e-4 * weights
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        weights = weights + rate * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)

    final = weights.copy()
    slope, offset = 1.0, 0.0
    for _ in range(8):  # Newton steps of the calibrating curve, with a little weight on the slope 1 and offset 0

        def curve(q, bins, sizes, n, slope=slope, offset=offset):
            x = _odds(mean_marginal(final, bins, sizes, n))
            p = 1 / (1 + np.exp(-(slope * x + offset)))
            w = p * (1 - p)
            return np.array([((q - p) * x).sum(), (q - p).sum(), (w * x * x).sum(), (w * x).sum(), w.sum()])

        gx, g1, hxx, hx, h1 = summed(curve) + np.array([1.0 - slope, -offset, 1.0, 0.0, 1.0])
        det = hxx * h1 - hx * hx
        slope, offset = slope + (h1 * gx - hx * g1) / det, offset + (hxx * g1 - hx * gx) / det
    return weights, float(slope), float(offset)


def score(docs: DataFrame, model: tuple[np.ndarray, float, float]) -> DataFrame:
    """doc_id, th and score, from 0 to 1, for every row. Null and empty texts are one empty line. Repeated rows get the
    same score each; a null doc_id is kept; an empty table gives no rows. Only the text is looked at."""
    weights, slope, offset = model

    def run(batches):
        for b in batches:
            texts, out, k = byte_texts(b.column("text")), [], 0
            while k < len(texts):  # runs of about 4 MB
                some, size = [], 0
                while k < len(texts) and (size < 1 << 22 or not some):
                    some.append(line_bins(texts[k]))
                    size += len(texts[k]) + 100
                    k += 1
                m = mean_marginal(weights, np.concatenate([x for x, _ in some]), np.concatenate([x for _, x in some]), np.array([len(x) for _, x in some]))
                out.append(1 / (1 + np.exp(-(slope * _odds(m) + offset))))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(np.concatenate(out) if out else np.zeros(0))], ["doc_id", "th", "score"])

    return keyed(docs).mapInArrow(run, "doc_id long, th long, score double")


def held_out() -> Column:
    return remainder("doc_id", 5) == 0


def model_for(docs: DataFrame, labels: DataFrame):
    return fit(docs, labels.where(~held_out()))


def good(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents that score at least `least`, all columns kept whatever their names. Rows that repeat a doc_id and text
    stay or go together; rows without a doc_id are scored as well; an empty table stays empty."""
    d, t = fresh(docs, "_d"), fresh(docs, "_t")
    bad = score(docs, model_for(docs, labels)).where(F.col("score") < least).select(F.col("doc_id").alias(d), F.col("th").alias(t)).distinct()
    return docs.join(bad, docs.doc_id.eqNullSafe(F.col(d)) & (F.xxhash64(docs.text) == F.col(t)), "left_anti")


def op9(spark, sf_dir) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = score(docs, model_for(docs, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
