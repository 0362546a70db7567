"""LM scoring with a Brown class-based bigram model.

Words are put into classes by exchange: a word moves to the class that gives the training text the highest likelihood
under class bigrams. The CORE most frequent words exchange in turn on the driver, over their bigrams, until a round gains
next to nothing; these tables have the size of the core squared, however large the corpus. Every other word that occurs
LEAST times or more makes the same choice against the classes of the core, in Spark, from all its neighbours in all
training texts; rarer words, and words never seen, have a class by their form. With p the add-one probabilities of
words, summed to p(C) for classes,

    P(word | previous) = p(word) * (a * T(class | previous class) / p(class) + 1 - a),

the class transition times the emission p(word) / p(class), mixed with the unigram: a distribution over the words.

Texts are split once, into blocks: a block is what one task has read in turn, up to some MB, as its distinct words and
the texts as numbers of these. What a word counts and its class come back to the blocks that use it by a shuffle on the
word and one on the block, so no table of all words is ever sent to all tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eocube.llm.common import keyed, pack, packed, partitions, remainder, unpack, unpacked, whole_runs, written

#: Words of the exchange on the driver, classes, and how often a word must occur to get one of these by its neighbours.
CORE, CLASSES, LEAST = 2_000, 56, 3
_FORMS = 4
_END = CLASSES + _FORMS
#: Classes, classes by form and the end; as a neighbour, a word outside the core is a state of its own.
N_STATES = _END + 1
_OTHER = N_STATES
#: The weight a of the class model, and the share of the log-likelihood that a round of exchange must gain to go on.
WEIGHT, TOLERANCE = 0.95, 1e-4
#: Bytes of text in a block.
BLOCK_CHARS = 6_000_000

_HEAD = np.dtype([("doc_id", "<i8"), ("known", "<i1"), ("held", "<i1"), ("n", "<i8")])
_NEIGHBOUR = np.dtype([("k", "<u1"), ("n", "<u4")])
_DIGIT = re.compile(rb"[0-9]")


def form(word: bytes) -> int:
    """The class of a rare word, from 0: with a digit, without a-z at its end, long, or other."""
    return 0 if _DIGIT.search(word) else 1 if not 97 <= word[-1] <= 122 else 2 if len(word) >= 12 else 3


def forms(words: pa.Array) -> np.ndarray:
    """form() of each."""
    b = words.cast(pa.binary())
    digit, letter = (pc.match_substring_regex(words, x).to_numpy(zero_copy_only=False) for x in ("[0-9]", r"[a-z]\z"))
    return np.where(digit, 0, np.where(~letter, 1, np.where(pc.binary_length(b).to_numpy() >= 12, 2, 3)))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts with A-Z in lower case, in one array, and how many each text has. Words are runs other than
    ASCII white space; null texts have none."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat, text = words.flatten(), np.repeat(np.arange(len(texts)), words.value_lengths().to_numpy())
    some = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(some), np.bincount(text[some.to_numpy(zero_copy_only=False)], minlength=len(texts))


def held_out() -> Column:
    return remainder("doc_id", 7) == 2


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    """Blocks of texts: their headers and words as numbers, packed, and the distinct words."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64) + 100) // BLOCK_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if j == i:
                continue
            b = batch.slice(i, j - i)
            flat, n = split_words(b.column("text"))
            heads = np.zeros(len(n), dtype=_HEAD)
            heads["doc_id"], heads["n"] = b.column("doc_id").fill_null(0).to_numpy(), n
            heads["known"], heads["held"] = (x.to_numpy(zero_copy_only=False) for x in (b.column("doc_id").is_valid(), b.column("held")))
            coded = flat.dictionary_encode()
            data = pack(heads, coded.indices.to_numpy().astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([data]), pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)], ["block", "data", "words"])
            number += 1


def _each(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """block, headers, numbers and words of every block."""
    for b in batches:
        for i in range(b.num_rows):
            heads, seq = unpack(b.column("data")[i].as_py(), _HEAD, np.int32)
            yield b.column("block")[i].as_py(), heads, seq, b.column("words")[i].values


def _word_counts(coded: DataFrame) -> DataFrame:
    """word and c, its count in the training texts."""

    def count(batches):
        for _, heads, seq, words in _each(batches):
            n = np.bincount(seq[np.repeat(heads["held"] == 0, heads["n"])], minlength=len(words))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([words.take(pa.array(some)), pa.array(n[some])], ["word", "n"])

    return coded.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _with_ends(heads: np.ndarray, values: np.ndarray, end: int) -> np.ndarray:
    """The values of each text, an end before the first and after each."""
    return np.concatenate([[end], np.insert(values, np.cumsum(heads["n"]), end)])


def _core_bigrams(coded: DataFrame, core: list[str]) -> np.ndarray:
    """How often the training texts have core word i, or an end (CORE), or another word (CORE + 1) before j. Tasks add
    up their texts, slices of the tables are then added up by slice; the sums have (CORE + 2) ** 2 entries."""
    given = coded.sparkSession.sparkContext.broadcast(core)
    size, step, groups = len(core) + 2, 128, max(1, isqrt(partitions(coded.sparkSession)))
    kind = "slice int, group int, part binary"

    def count(batches):
        known, total = pa.array(given.value, pa.string()), np.zeros(size * size, dtype=np.int64)
        for _, heads, seq, words in _each(batches):
            row = pc.index_in(words, known).fill_null(size - 1).to_numpy().astype(np.int64)
            keep = heads["held"] == 0
            w = _with_ends(heads[keep], row[seq[np.repeat(keep, heads["n"])]], size - 2)
            total += np.bincount(w[:-1] * size + w[1:], minlength=len(total))
        yield from parts(total.reshape(size, size), TaskContext.get().partitionId() % groups)

    def parts(total, group):
        for i in range(0, size, step):
            flat = total[i : i + step].ravel()
            some = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array([i // step], pa.int32()), pa.array([group], pa.int32()), pa.array([pack(some.astype(np.int32), flat[some])])], ["slice", "group", "part"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column("slice").to_pylist(), b.column("part").to_pylist(), strict=True):
                some, n = unpack(x, np.int32, np.int64)
                total.setdefault(i, np.zeros(step * size, dtype=np.int64))[some] += n
        for i, x in total.items():
            some = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([0], pa.int32()), pa.array([pack(some.astype(np.int32), x[some])])], ["slice", "group", "part"])

    n = -(-size // step)
    some = coded.mapInArrow(count, kind).repartition(n * groups, "slice", "group").mapInArrow(add, kind)  # two steps, so no task adds up what all tasks send
    out = np.zeros(n * step * size)
    for r in some.repartition(n, "slice").mapInArrow(add, kind).collect():
        at, x = unpack(bytes(r.part), np.int32, np.int64)
        out[r.slice * step * size + at] = x
    return out[: size * size].reshape(size, size)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def class_bigrams(bigrams: np.ndarray, classes: np.ndarray, states: int) -> np.ndarray:
    rows = np.zeros((states, len(classes)))
    np.add.at(rows, classes, bigrams)
    out = np.zeros((states, states))
    np.add.at(out.T, classes, rows.T)
    return out


def likelihood(n: np.ndarray) -> float:
    """The part of the class bigrams' log-likelihood that depends on the classes."""
    return float(_f(n).sum() - _f(n.sum(axis=1)).sum() - _f(n.sum(axis=0)).sum())


def exchange(bigrams: np.ndarray, classes: np.ndarray, movable: int, choices: int, states: int) -> tuple[np.ndarray, np.ndarray]:
    """One round over the first `movable` words: each is taken out of its class and put where the log-likelihood is
    highest, among the first `choices` classes; counts follow every move, so the likelihood never falls. The classes
    and their bigrams."""
    classes, n = classes.copy(), class_bigrams(bigrams, classes, states)
    left, right = n.sum(axis=1), n.sum(axis=0)
    diagonal = np.arange(choices)
    for w in range(movable):
        a, itself = classes[w], bigrams[w, w]
        out, came = (np.bincount(classes, weights=x, minlength=states) for x in (bigrams[w], bigrams[:, w]))
        n_out, n_in = out.sum(), came.sum()
        out[a] -= itself
        came[a] -= itself
        n[a] -= out
        n[:, a] -= came
        n[a, a] -= itself
        left[a] -= n_out
        right[a] -= n_in
        rows, columns = n[:choices], n[:, :choices].T
        gain = (_f(rows + out) - _f(rows)).sum(axis=1) + (_f(columns + came) - _f(columns)).sum(axis=1)
        own, o, c = n[diagonal, diagonal], out[:choices], came[:choices]
        gain += _f(own + o + c + itself) + _f(own) - _f(own + o) - _f(own + c)  # one entry is in both the row and the column
        gain -= _f(left[:choices] + n_out) - _f(left[:choices]) + _f(right[:choices] + n_in) - _f(right[:choices])
        b = int(np.argmax(gain)) if gain.max() > gain[a] + 1e-9 * abs(gain[a]) else a
        classes[w] = b
        n[b] += out
        n[:, b] += came
        n[b, b] += itself
        left[b] += n_out
        right[b] += n_in
    return classes, n


def core_classes(bigrams: np.ndarray, words: int, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the core's words, and how often a class is before another; ends and other words keep their own."""
    classes = np.concatenate([np.arange(words) % CLASSES, [_END, _OTHER]])
    n = class_bigrams(bigrams, classes, N_STATES + 1)
    while True:
        before = likelihood(n)
        classes, n = exchange(bigrams, classes, words, CLASSES, N_STATES + 1)
        if likelihood(n) - before <= tolerance * abs(before):
            return classes, n


def choices(word: np.ndarray, k: np.ndarray, count: np.ndarray, words: int, n: np.ndarray, at_once: int = 1 << 13) -> np.ndarray:
    """The class that each of `words` words would be put into, given the class bigrams n of the core. A word's neighbours
    are entries (word, k, count): k below 64 is the state after it, from 64 on the state before it, plus 64."""
    left, right = n.sum(axis=1)[:CLASSES], n.sum(axis=0)[:CLASSES]
    key, where = np.unique(word * 128 + k, return_inverse=True)
    count = np.bincount(where, weights=count, minlength=len(key))
    word, k = key // 128, key % 128
    table = np.concatenate([n[:CLASSES].T, np.zeros((64 - len(n), CLASSES)), n[:, :CLASSES], np.zeros((64 - len(n), CLASSES))])
    out = np.zeros(words, dtype=np.int64)
    for lo in range(0, words, at_once):
        a, b = np.searchsorted(word, (lo, lo + at_once))
        gain = np.zeros((min(at_once, words - lo), CLASSES))
        if b > a:
            which, times = np.unique(np.stack([k[a:b], count[a:b]]), axis=1, return_inverse=True)
            row = table[which[0].astype(np.int64)]
            effect = (_f(row + which[1][:, None]) - _f(row))[times.ravel()]
            first = np.flatnonzero(np.diff(word[a:b], prepend=-1))
            gain[word[a:b][first] - lo] = np.add.reduceat(effect, first, axis=0)
        for side, margin in ((k[a:b] < 64, left), (k[a:b] >= 64, right)):
            sums = np.bincount(word[a:b][side] - lo, weights=count[a:b][side], minlength=len(gain))
            some, of = np.unique(sums, return_inverse=True)
            gain -= (_f(margin + some[:, None]) - _f(margin))[of]
        out[lo : lo + at_once] = np.argmax(gain, axis=1)
    return out


def _other_words(coded: DataFrame, given) -> DataFrame:
    """For the words outside the core: `data`, their numbers, counts and classes for each block that uses them, packed;
    with block -1, what each class has of their add-one mass."""

    def uses(batches):
        core, classes, _ = given.value
        known = pa.array(core, pa.string())
        for block, heads, seq, words in _each(batches):
            row = pc.index_in(words, known).fill_null(len(core) + 1).to_numpy()
            keep = heads["held"] == 0
            w = _with_ends(heads[keep], seq[np.repeat(keep, heads["n"])], -1)
            state = np.append(classes[row], _END)[w]  # of -1, an end: the last
            at = np.flatnonzero(state == _OTHER)
            key, n = np.unique(np.concatenate([w[at] * 128 + state[at + 1], w[at] * 128 + 64 + state[at - 1]]).astype(np.int64), return_counts=True)
            entries = np.empty(len(key), dtype=_NEIGHBOUR)
            entries["k"], entries["n"] = key % 128, n
            per = np.bincount(key // 128, minlength=len(words))
            some = np.flatnonzero(row == len(core) + 1)
            yield pa.RecordBatch.from_arrays([words.take(pa.array(some)), pa.array(np.full(len(some), block)), pa.array(some.astype(np.int32)), pa.array(np.bincount(w[at], minlength=len(words))[some]), packed(entries, per[some])], ["word", "block", "id", "n", "near"])

    def choose(batches):
        n = given.value[2]
        for t in whole_runs(batches, "word"):
            t = t.combine_chunks()
            name = t.column("word").combine_chunks()
            new = np.append(True, pc.not_equal(name[1:], name[:-1]).to_numpy(zero_copy_only=False)) if len(name) > 1 else np.ones(1, dtype=bool)
            run, first = np.cumsum(new) - 1, np.flatnonzero(new)
            c = np.add.reduceat(t.column("n").to_numpy(), first)
            near, per = unpacked(t.column("near"), _NEIGHBOUR)
            often = c >= LEAST
            entry = np.repeat(run, per)
            near, entry = near[often[entry]], entry[often[entry]]
            place = np.cumsum(often) - 1
            cls = CLASSES + forms(name.take(pa.array(first)))
            cls[often] = choices(place[entry], near["k"].astype(np.int64), near["n"], int(often.sum()), n)
            mass = np.bincount(cls, weights=np.where(c > 0, c + 1, 0), minlength=N_STATES).astype(np.int64)
            order = np.argsort(t.column("block").to_numpy(), kind="stable")
            block, at = t.column("block").to_numpy()[order], run[order]
            ids, cuts = t.column("id").to_numpy()[order], np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(order))
            data = [pack(ids[i:j], c[at[i:j]], cls[at[i:j]].astype(np.uint8)) for i, j in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array([*block[cuts[:-1]].tolist(), -1]), pa.array([*data, mass.tobytes()], pa.binary())], ["block", "data"])

    rows = coded.mapInArrow(uses, "word string, block long, id int, n long, near binary")
    return written(rows.repartition("word").sortWithinPartitions("word").mapInArrow(choose, "block long, data binary"))


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row.

    Tokens are lower-cased words and one end per text; null and empty texts have the end alone. The model learns
    from the texts that are not held out, all of them. base_score is add-one unigram, score the class model's log10
    probability. Repeated rows count and are scored repeatedly; a null doc_id counts as the empty text for the
    split and is kept. With no training text all counts are 0. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = keyed(docs).select("doc_id", "text", held_out().alias("held"))
    ends = rows.agg(F.count_if(~F.col("held"))).first()[0]
    coded = written(rows.mapInArrow(_blocks, "block long, data binary, words array<string>"))
    counts = written(_word_counts(coded))
    types, total = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    total, types = total + ends, types + (ends > 0)
    top = counts.orderBy(F.desc("c"), "word").limit(CORE).collect()  # a bounded number of words
    core = [r.word for r in top]
    classes, n = core_classes(_core_bigrams(coded, core), len(core))
    given = spark.sparkContext.broadcast((core, classes, n))
    others = _other_words(coded, given)

    # p(C) from the words' add-one probabilities; the mass of words never seen is shared by the forms.
    whole = total + types + 1
    mass = np.zeros(N_STATES)
    np.add.at(mass, classes[: len(top)], [r.c + 1 for r in top])
    sums = others.where("block = -1").mapInArrow(_masses, "state int, mass long").groupBy("state").agg(F.sum("mass").alias("mass"))
    for r in sums.collect():
        mass[r.state] += r.mass
    mass[CLASSES : CLASSES + _FORMS] += 1 / _FORMS
    mass[_END] = ends + 1 if ends else 1e-9
    p = np.maximum(mass, 1e-9) / mass.sum()
    core_counts = np.array([r.c for r in top] + [ends, 0], dtype=np.int64)

    def settle(batches):
        core, classes, _ = given.value
        known = pa.array(core, pa.string())
        for t in whole_runs(batches, "block"):
            blocks = t.column("block").to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(blocks, prepend=-1)), len(blocks))
            for i, j in zip(cuts, cuts[1:], strict=False):
                part = t.slice(i, j - i)
                texts = part.column("words").is_valid().to_numpy()
                of = int(np.flatnonzero(texts)[0])
                heads, seq = unpack(part.column("data")[of].as_py(), _HEAD, np.int32)
                words = part.column("words")[of].values
                row = pc.index_in(words, known).fill_null(len(core) + 1).to_numpy()
                c, cls = core_counts[row], classes[row].astype(np.uint8)
                for x in np.flatnonzero(~texts).tolist():
                    ids, n, k = unpack(part.column("data")[x].as_py(), np.int32, np.int64, np.uint8)
                    c[ids], cls[ids] = n, k
                w = np.insert(seq, np.cumsum(heads["n"]), len(words))
                c, cls = np.append(c, ends), np.append(cls, np.uint8(_END))
                start = np.cumsum(heads["n"] + 1) - heads["n"] - 1
                base = np.add.reduceat(np.log10((c[w] + 1) / whole), start)
                known_words = np.add.reduceat((c[w] > 0).astype(np.int64), start)
                yield pa.RecordBatch.from_arrays([pa.array([pack(heads, base, known_words, cls[w])])], ["data"])

    texts = coded.select("block", "data", "words").unionByName(others.where("block >= 0").withColumn("words", F.lit(None).cast("array<string>")))
    settled = written(texts.repartition("block").sortWithinPartitions("block").mapInArrow(settle, "data binary"))

    def step(batches):
        n = np.zeros(N_STATES * N_STATES, dtype=np.int64)
        for heads, _, _, state in _settled(batches):
            keep = np.repeat(heads["held"] == 0, heads["n"] + 1)
            c = np.append(_END, state[keep]).astype(np.int64)
            n += np.bincount(c[:-1] * N_STATES + c[1:], minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["k", "n"])

    steps = np.zeros(N_STATES * N_STATES)
    for r in settled.mapInArrow(step, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        steps[r.k] = r.n
    steps = steps.reshape(N_STATES, N_STATES)
    transition = (steps + 5 * p) / (steps.sum(axis=1, keepdims=True) + 5)
    gains = np.log10(WEIGHT * transition / p + 1 - WEIGHT)

    def out(batches):
        for heads, base, known, state in _settled(batches):
            start = np.cumsum(heads["n"] + 1) - heads["n"] - 1
            c = np.append(_END, state).astype(np.int64)
            gain = np.add.reduceat(gains[c[:-1], c[1:]], start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(heads["doc_id"].astype(np.int64), mask=heads["known"] == 0), pa.array(heads["held"] != 0), pa.array(heads["n"] + 1), pa.array(known), pa.array(np.full(len(heads), total)), pa.array(base), pa.array(base + gain)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return settled.mapInArrow(out, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _masses(batches) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = np.frombuffer(b"".join(b.column("data").to_pylist()), dtype=np.int64).reshape(-1, N_STATES).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(N_STATES), pa.int32()), pa.array(x)], ["state", "mass"])


def _settled(batches) -> Iterator[list[np.ndarray]]:
    for b in batches:
        for x in b.column("data").to_pylist():
            yield unpack(x, _HEAD, np.float64, np.int64, np.uint8)


def op8(spark, sf_dir) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
