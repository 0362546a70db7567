"""The set join, vector codes and periodic runs, against brute force."""

import hashlib
import math
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.llm import codes, runs, setjoin
from eocube.llm.common import Hashes, table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, th string, node string, n long, size string, runs int, collapsed int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 7, "z", 1, 2) for i, t in rows], SCHEMA)


# Sets


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)) and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[find(i)] += [doc] if doc is not None else []
    return sorted(((doc, len(s), min(least[find(i)], default=None) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found_components(df):
    return sorted(((r.doc_id, r.n, r.component_id) for r in df.collect()), key=repr)


BASE = [f"word{i}" for i in range(60)]
TEXTS = [
    (5, " ".join(BASE)), (9, " ".join(BASE).upper()), (3, " ".join([*BASE, "more"])), (None, " ".join([*BASE, "more", "words"])), (20, " ".join(BASE[::-1])),
    (1, None), (2, ""), (4, " \t\n"), (6, "one two"), (7, "One  two"), (8, "one two three four"), (8, "one two three four"), (11, "one two three four five"),
    (12, " ".join(f"w{i % 997}x{i}" for i in range(30_000))), (13, " ".join(f"w{i % 997}x{i}" for i in range(29_000))), (None, "alone on its own here"), (14, "é 日本 x y z " * 3),
]


def test_set_join_of_odd_rows(spark):
    assert found_components(setjoin.similar_sets(documents(spark, TEXTS))) == brute_components(TEXTS)
    assert setjoin.similar_sets(documents(spark, [])).collect() == []
    assert setjoin.similar_sets(documents(spark, [(1, None)])).collect() == [(1, 0, 1)]


def test_set_join_of_large_groups_in_pieces(spark):
    """A chain of near copies, a group around one text, and texts that share half of their words with the group."""
    rng = np.random.RandomState(1)
    words = [f"v{i}" for i in range(5_000)]
    chain = [str(x) for x in rng.choice(words, 400)]
    rows = [(1000 + k, " ".join(chain[3 * k : 3 * k + 80])) for k in range(60)]
    hub = [str(x) for x in rng.choice(words, 80)]
    for k in range(120):
        some = list(hub)
        for i in rng.randint(0, 80, rng.randint(0, 5)):
            some[i] = str(rng.choice(words))
        rows.append((2000 + k, " ".join(some)))
    rows += [(3000 + k, " ".join(hub[:50] + [str(x) for x in rng.choice(words, 30)])) for k in range(60)]
    want = brute_components(rows)
    assert len({c for _, _, c in want}) > 60
    assert found_components(setjoin.similar_sets(documents(spark, rows), most=16)) == want


def test_set_join_on_a_whole_table(spark):
    docs = table(spark, SF, "documents")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in setjoin.op11(spark, SF).collect()), key=repr)
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert any(a != c for a, _, c in got)


@pytest.mark.parametrize("held", [10, 10**9])
def test_signatures_meet_for_every_similar_pair(held):
    """With many sets segments count twice and partitions have spare segments, also for sets with many empty subsets."""
    rng = np.random.RandomState(0)
    sets = []
    for n in [*range(1, 60), 100, 300, 1000]:
        base = rng.randint(0, 2**62, n, dtype=np.int64).astype(np.uint64)
        sets.append(np.unique(base))
        for _ in range(6):
            gone, new = rng.randint(0, max(1, n // 10) + 1, 2)
            sets.append(np.unique(np.concatenate([rng.permutation(base)[gone:], rng.randint(0, 2**62, new, dtype=np.int64).astype(np.uint64)])))
    sets = [s for s in sets if len(s)]
    plan = setjoin.Partition([(float(len(s)), held) for s in sets])
    assert (plan.spare > 0).any() and (held == 10 or (plan.twice > 0).any())
    by = defaultdict(lambda: (set(), set()))
    for key, i, less in zip(*(x.tolist() for x in plan.signatures(sets)), strict=True):
        by[key][less].add(i)
    met = {(min(a, b), max(a, b)) for whole, less in by.values() for a in whole for b in whole | less if a != b}
    both = lambda a, b: len(np.intersect1d(a, b))
    want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and not np.array_equal(a, b) and 100 * both(a, b) >= 85 * (len(a) + len(b) - both(a, b))}
    assert len(want) > 300 and not want - met


def test_bands_hold_all_similar_sizes():
    first = np.array(setjoin.size_bands(5_000))
    band = lambda n: int(np.searchsorted(first, n, side="right")) - 1
    assert all(band(n) - band(-(-85 * n // 100)) in (0, 1) for n in range(1, 5_000))


def test_set_hash_tells_sets_apart():
    h = Hashes()
    a, b = (setjoin.shingle_set(t, 4, h) for t in (b"a b c d e", b"A B c D e"))
    assert setjoin.set_hash(a) == setjoin.set_hash(b) != setjoin.set_hash(a[:1])


# Codes


def brute_codes(rows):
    """rows (vec_id, label, vector) to (vec_id, code, error, label_error, sha), one length."""
    kept = [(i, l, [math.floor(Fraction(x) * 4096) for x in v]) for i, l, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [str(c) for c in r[2]]))
    width = len(kept[0][2]) // 8
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(v, p) for _, _, v in kept[:16]] for p in range(8)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, book: min((far(x, e), k) for k, e in enumerate(book))
    for _ in range(6):
        for p in range(8):
            of = defaultdict(list)
            for _, _, v in kept:
                of[nearest(part(v, p), books[p])[1]].append(part(v, p))
            books[p] = [[sum(c) // len(of[k]) for c in zip(*of[k], strict=True)] if of[k] else e for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = []
    for i, l, v in kept:
        best = [nearest(part(v, p), books[p]) for p in range(8)]
        out.append((i, l, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    total = defaultdict(int)
    for _, l, _, e in out:
        total[l] += e
    most = 2**63 - 1
    return sorted(((i, c, min(e, most), min(total[l], most), sha) for i, l, c, e in out), key=repr)


def coded(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([(i, v, l, 1) for i, l, v in rows], "vec_id long, embedding array<double>, label int, code int").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.op12(spark, path).collect()), key=repr)


def test_codes_of_odd_rows(spark, tmp_path):
    rng = np.random.RandomState(2)
    rows = [(int(i), int(i % 3) if i % 4 else None, (rng.randint(-3, 3, 16) / 4).tolist()) for i in rng.permutation(60)]
    rows += [(7, 1, rows[0][2]), (7, 1, rows[0][2]), (8, None, rows[1][2]), (None, 2, rows[2][2]), (100, 1, None), (101, 1, [0.5] * 15 + [None]), (102, 1, [math.nan] * 16), (103, 1, [math.inf] + [0.0] * 15)]
    assert coded(spark, rows, tmp_path) == brute_codes(rows)


def test_codes_of_huge_and_few_vectors(spark, tmp_path):
    rng = np.random.RandomState(3)
    rows = [(i, 0, (rng.randn(8) * 10.0 ** rng.randint(-2, 18)).tolist()) for i in range(40)] + [(50, 0, [1e300, -1e300, 0.0, 1.0, 2.0, 3.0, 4.0, 5.5])]
    assert coded(spark, rows, tmp_path / "a") == brute_codes(rows)
    assert coded(spark, rows[:5], tmp_path / "b") == brute_codes(rows[:5])
    assert coded(spark, [], tmp_path / "c") == coded(spark, [(1, 1, None)], tmp_path / "d") == []


def test_codes_of_several_lengths(spark):
    rows = [(i, [float(i % 5 + k) for k in range(n)], "a") for i in range(20) for n in (0, 3, 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    found, books = codes.product_codes(df)
    assert sorted(books) == [0, 3, 16] and found.count() == 60 and found.agg(F.sum("error")).first()[0] == 0
    assert [e.shape[1] for e in books[3]] == [0, 0, 1, 0, 0, 1, 0, 1]


def test_codes_on_a_whole_table(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    assert sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.op12(spark, SF).collect()), key=repr) == brute_codes(rows)


def test_shortlists_hold_the_nearest_entry():
    rng = np.random.RandomState(4)
    x = np.concatenate([rng.randint(-50, 50, (300, 4)), rng.randint(900, 910, (100, 4))])
    entries = np.concatenate([rng.randint(-50, 50, (6, 4)), rng.randint(900, 910, (1, 4)), np.full((1, 4), 905)])
    blocks = codes.Blocks(x, codes.hilbert_order(x))
    found, best, alone = blocks.nearest(entries, every=True)
    d = ((x[blocks.order][:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (found.ravel()[: len(x)] == d.argmin(axis=1)).all() and (best.ravel()[: len(x)] == d.min(axis=1)).all()
    assert blocks.shortlists(entries).sum() < len(entries) * len(alone)
    sums = blocks.sums(entries)
    assert [int(c) for c in sums[:, -1]] == [int((d.argmin(axis=1) == k).sum()) for k in range(len(entries))]


def test_hilbert_order_goes_to_neighbours():
    grid = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    walk = grid[codes.hilbert_order(grid)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_digits_add_up():
    for v in (0, 1, -1, 2**39, -(2**40), 2**41 + 5, -(2**200) + 17, 10**80):
        assert sum(d << codes.LIMB * n for n, d in enumerate(codes.digits(v))) == v


# Runs


def brute_runs(words, least=24, times=3):
    n, found = len(words), {}
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    t = np.array([number[w] for w in words], dtype=np.int64)
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[0], (t[:-q] == t[q:]).astype(int), [0]])
        step = np.diff(same)
        for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True):
            if b - a + q >= 2 * q:
                found.setdefault((a, b + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, times * q))


def brute_op13(doc, text):
    w, h = (text or "").encode().split(), zlib.crc32(b"" if doc is None else str(doc).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_on_a_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = sorted((tuple(r) for r in runs.op13(spark, SF).collect()), key=repr)
    assert got == sorted((brute_op13(*r) for r in rows), key=repr) and any(r[1] for r in got)


def test_runs_of_odd_rows(spark, tmp_path):
    long = " ".join(["a b c"] * 5_000 + [f"u{i}" for i in range(20_000)] + ["x"] * 24)
    two = " ".join(["p q"] * 20 + ["r"] * 30 + ["p q"] * 20)
    rows = [(1, None), (2, ""), (3, "la " * 23), (4, "la " * 24), (5, long), (6, two), (6, two), (None, "one two " * 30), (None, None), (7, " ".join(f"w{i % 20}" for i in range(59))), (8, " ".join(f"w{i % 20}" for i in range(60))), (9, "é\x0b日本 " * 40)]
    rows += [(i, " ".join(f"w{k}" for k in range(50))) for i in range(10, 60)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in runs.op13(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((brute_op13(*r) for r in rows), key=repr)
    found = {r.doc_id: r for r in runs.periodic_runs(documents(spark, rows)).where("doc_id is not null").collect()}
    assert [tuple(x) for x in found[5].runs] == [(0, 15_000, 3), (35_000, 24, 1)] and found[4].collapsed == "la" and found[3].runs == [] and found[1].n_words == 0
    assert runs.periodic_runs(documents(spark, [])).collect() == []


def test_runs_of_random_words():
    rng = np.random.RandomState(0)
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(1, 8)):
            parts = [np.zeros(0, dtype=int)]
            for _ in range(rng.randint(0, 6)):
                parts += [np.tile(rng.randint(0, rng.randint(1, 6) + 1, rng.randint(1, 30)), rng.randint(1, 6))[: rng.randint(1, 120)], rng.randint(0, rng.randint(2, 50), rng.randint(0, 20))]
            texts.append([str(v).encode() for v in np.concatenate(parts)])
        for least, times in ((24, 3), (2, 2), (7, 2), (12, 4)):
            got = runs.runs_by_document([runs.numbered(t) for t in texts], least, times)
            assert [[tuple(r) for r in g.tolist()] for g in got] == [brute_runs(t, least, times) for t in texts]


def test_set_join_compares_no_texts_that_only_share_a_passage(spark, monkeypatch):
    rng = np.random.RandomState(5)
    passage = [f"p{i}" for i in range(45)]
    rows = [(k, " ".join(passage + [f"w{x}" for x in rng.randint(0, 10**6, 40)])) for k in range(200)]
    rows.append((100, rows[7][1] + " more"))
    seen, real = [], setjoin.joined_groups

    def spy(asked, *a, **k):
        seen.extend([] if "sketch" in asked.columns else [asked.count()])
        return real(asked, *a, **k)

    monkeypatch.setattr(setjoin, "joined_groups", spy)
    assert found_components(setjoin.similar_sets(documents(spark, rows), most=16)) == brute_components(rows)
    assert seen == [2]
