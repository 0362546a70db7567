"""Secret scans with DataFrame functions alone: fixed patterns, and a likelihood-ratio test of two character models.

Two first-order Markov models over characters are trained from labelled samples: random strings, which are made by hash
functions and so random by construction, with what the patterns found; and ordinary words and identifiers, the
different runs of characters that all documents repeat. A run's log-likelihood ratio is the sum over its transitions, so letters
alone are enough if they are many; a run above a bar that grows with its length is a span of kind `markov`.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.llm.common import written

# The kinds in order, and the patterns.
KINDS = ["assign", "access", "hex", "markov"]
ASSIGN_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_HEAD + "[A-Za-z0-9+/_.=-]+"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "(?<![0-9a-f])[0-9a-f]{16,}+"
RUN = "[A-Za-z0-9+/_.=-]"

_SPAN = "array<struct<a:int,kind:int,b:int,match:string>>"
#: Random strings that the models learn from; each is made in three alphabets.
RANDOM_STRINGS = 20_000
#: A run is random if its log-likelihood ratio is over BAR + SLOPE * its length.
BAR, SLOPE = math.log(10_000), 0.2


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value computed once."""
    return F.transform(F.array(value), f)[0]


def _running(x: Column) -> Column:
    """Sums of the array's first 1, 2, ... entries, in blocks of the root of their number: arrays grow by copying, so
    one pass over n entries would cost n squared."""
    add = lambda some: F.aggregate(some, F.array().cast("array<int>"), lambda acc, y: F.concat(acc, F.array(F.coalesce(F.element_at(F.concat(F.array(F.lit(0)), acc), -1), F.lit(0)) + y)))
    step = F.greatest(F.ceil(F.sqrt(F.size(x))), F.lit(1)).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), F.size(x), step), lambda i: add(F.slice(x, i, step)))
    whole = lambda blocks: add(F.transform(blocks, lambda b: F.element_at(b, -1)))
    shifted = lambda blocks: F.zip_with(blocks, F.concat(F.array(F.lit(0)), F.slice(whole(blocks), 1, F.size(blocks) - 1)), lambda b, by: F.transform(b, lambda y: y + by))
    return F.flatten(_let(blocks, shifted))


def _spans(text: Column, matches: Column, pattern: str, kind: int) -> Column:
    """The matches with their places, by code points, from the lengths of the matches and of what is between them."""
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    ends = _running(F.zip_with(gaps, matches, lambda g, m: F.length(g) + F.length(m)))
    found = F.zip_with(ends, matches, lambda e, m: F.struct((e - F.length(m)).alias("a"), F.lit(kind).alias("kind"), e.alias("b"), m.alias("match")))
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(_SPAN))


def _blanked(text: Column, matches: Column, pattern: str, keep: Callable[[Column], Column]) -> Column:
    """The text with the kept matches overwritten by as many zero characters."""
    gaps = F.split(text, pattern, -1)
    over = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.concat(g, F.when(keep(m), F.repeat(F.lit("\0"), F.length(m))).otherwise(m)))
    return F.when(F.size(matches) > 0, F.concat(F.array_join(over, ""), F.element_at(gaps, -1))).otherwise(text)


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _transitions(token: Column) -> Column:
    """Numbers of the adjacent pairs of characters, by their ASCII codes."""
    codes = F.transform(_characters(token), lambda c: F.ascii(c))
    return _let(codes, lambda x: F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: a * 128 + b))


def found_spans(docs: DataFrame, shortest: int = 16) -> DataFrame:
    """doc_id, base (the patterns' spans) and candidates (runs of `shortest` or more characters outside these spans, with
    their places)."""
    run = f"(?<!{RUN}){RUN}{{{shortest},}}+"
    text, c = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col
    long = lambda head, n: lambda m: F.length(F.regexp_replace(m, f"^{head}", "")) >= n
    kinds = {"assign": (ASSIGN, F.contains("text", F.lit(":")) | F.contains("text", F.lit("=")), long(ASSIGN_HEAD, 12)), "access": (ACCESS, F.contains("text", F.lit("AKIA")), lambda m: F.length(m) >= 18), "hex": (HEX, F.lit(True), lambda m: F.length(m) >= 16)}
    empty = F.array().cast("array<string>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumns({f"m_{k}": F.when(when, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(empty) for k, (p, when, _) in kinds.items()})
    kept = lambda spans, keep: F.filter(spans, lambda x: keep(x["match"]))
    rows = rows.withColumn("base", F.concat(*[kept(_spans(c("text"), c(f"m_{k}"), p, i), keep) for i, (k, (p, _, keep)) in enumerate(kinds.items())]))
    blanked = [_characters(_blanked(c("text"), c(f"m_{k}"), p, keep)) for k, (p, _, keep) in kinds.items()]
    both = lambda x, y: F.zip_with(x, y, lambda a, b: F.when(a == "\0", a).otherwise(b))
    rows = rows.select("doc_id", "base", F.when(F.size("base") > 0, F.array_join(both(both(blanked[0], blanked[1]), blanked[2]), "")).otherwise(c("text")).alias("rest"))
    rows = rows.withColumn("m_run", F.regexp_extract_all("rest", F.lit(run), F.lit(0)))
    return rows.select("doc_id", "base", _spans(c("rest"), c("m_run"), run, 3).alias("candidates"))


def random_strings(spark: SparkSession, n: int = RANDOM_STRINGS) -> DataFrame:
    """(token, random): strings that are random by construction, in base64, in letters and digits, and in capitals and
    digits. They are made from hashes of numbers, so every run has the same."""
    whole = F.base64(F.unhex(F.sha2(F.concat(F.lit("sample"), F.col("id")), 256)))
    plain = F.regexp_replace(whole, "[+/=]", "")
    return spark.range(n).select(F.explode(F.array(whole, plain, F.upper(plain))).alias("token"), F.lit(1).alias("random"))


def labelled_samples(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(token, random): random_strings() and what the patterns found are random (1); all runs of four or more characters
    in the documents that occur twice or more, as random strings seldom do, and hold no match of a pattern are ordinary
    (0), each once however often it occurs, as it is and in capitals, as names of constants are."""
    secret = F.transform("base", lambda s: F.when(s["kind"] == 0, F.regexp_replace(s["match"], f"^{ASSIGN_HEAD}", "")).otherwise(s["match"]))
    own = found.select(F.explode(secret).alias("token"), F.lit(1).alias("random"))
    runs = docs.select(F.explode(F.split(F.col("text").cast("string"), f"{RUN.replace('[', '[^')}+", -1)).alias("token")).where(F.length("token") >= 4)
    ordinary = runs.groupBy("token").count().where((F.col("count") > 1) & ~F.col("token").rlike(f"{ACCESS}|{HEX}|{ASSIGN_HEAD}"))
    return random_strings(docs.sparkSession).unionByName(own).unionByName(ordinary.select(F.explode(F.array("token", F.upper("token"))).alias("token"), F.lit(0).alias("random")))


def log_ratios(samples: DataFrame) -> list[float]:
    """log P(next | last) under the model of random strings less that under the one of identifiers, by
    128 * last + next. Counts cover all samples; the table has 128 * 128 entries however many there are."""
    pairs = samples.select("random", F.explode(_transitions(F.col("token"))).alias("pair")).groupBy("random", "pair").count()
    n = [[0.0] * 128 * 128, [0.0] * 128 * 128]
    for r in pairs.where("pair < 16384").collect():
        # Identifiers are scored by what others show, so a transition's own occurrence doesn't count for them.
        n[r["random"]][r["pair"]] += r["count"] - (r["random"] == 0)
    if not sum(n[0]) or not sum(n[1]):
        return [0.0] * 128 * 128
    logs = []
    for m in n:  # backed off to the characters' own shares
        share = [(sum(m[b::128]) + 0.5) / (sum(m) + 64) for b in range(128)]
        row = [sum(m[128 * a : 128 * a + 128]) for a in range(128)]
        logs.append([math.log((m[i] + 10 * share[i % 128]) / (row[i // 128] + 10)) for i in range(128 * 128)])
    return [y - x for x, y in zip(*logs, strict=True)]


def scan(docs: DataFrame, shortest: int = 16, bar: float = BAR, slope: float = SLOPE, samples: DataFrame | None = None) -> DataFrame:
    """doc_id, base and spans for every row; spans are structs (a, kind, b, match) by start, then kind.

    a and b are code points, b exclusive; kind counts KINDS from 0. spans are base and those of the models, which
    overlap no base span. samples(token, random) are labelled strings, those of labelled_samples() if not given.
    Null texts count as empty and have no spans; repeated rows are returned repeatedly, a null doc_id is kept, an empty
    table gives no rows. Without samples of one kind the models are equal and add nothing. Other columns are not read.
    """
    found = written(found_spans(docs, shortest))
    ratios = log_ratios(labelled_samples(docs, found) if samples is None else samples)
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in ratios)), ",").cast("array<double>")
    ratio = lambda c: F.aggregate(_transitions(c["match"]), F.lit(0.0), lambda acc, p: acc + F.element_at(table, p + 1))
    likely = F.filter("candidates", lambda c: ratio(c) > bar + slope * F.length(c["match"]))
    return found.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(F.concat(F.col("base"), likely)).alias("spans"))


def _listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["a"].cast("string"), s["b"].cast("string"))))


def op7(spark, sf_dir) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
