"""Mixing sources to target weights by min-cost flow.

Documents are first counted by membership pattern, the set of sources they belong to. Tokens then flow from
patterns to the quotas of their sources: a pattern's first pass is free, each repetition dearer than the one
before, so the flow repeats as little as it can. The patterns are a small aggregate; documents stay in Spark, which
takes from each pattern, in an order seeded by a hash, as many as its flow asks for.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.llm.common import written

#: First sight of the seeded order: its leading 12 bits.
_SLOTS = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """source, source_size and target for sizes(source, source_size). Sources by code point, null last, weigh 1, 2, 3,
    repeating, and share the sum of all sizes; none gets more than `most` times its size, what is above being shared
    again by weight until none is above. Of no sources nothing; if all are empty, targets are 0.

    Filling by weight to a common level: sources in the order of cap over weight, those below the level have their
    cap, the others their weight times the level. The windows run over one row per source.
    """
    by_name, by_cap = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8")), Window.orderBy("at", F.col("source").isNull(), F.encode("source", "utf-8"))
    w = sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn("cap", most * F.col("source_size"))
    w = w.withColumn("at", F.col("cap") / F.col("weight")).withColumn("_all", F.sum("source_size").over(Window.partitionBy()))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("_capped", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("_left", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    w = w.withColumn("_level", (F.col("_all") - F.col("_capped")) / F.col("_left"))
    level = F.first(F.when(F.col("at") > F.col("_level"), F.col("_level")), ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    w = w.withColumn("_fill", level)
    return w.select("source", "source_size", F.when(F.col("_fill").isNull() | (F.col("at") <= F.col("_fill")), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("_fill")).alias("target"))


def min_cost_flow(capacity: dict, quota: dict, passes: int) -> dict:
    """Tokens routed from each pattern (a tuple of sources) to each of its sources: a maximal flow of least cost. A
    pattern gives its capacity up to `passes` times, the i-th time at cost i per token. Successive shortest paths."""
    names = [("pattern", p) for p in capacity] + [("source", s) for s in quota]
    at = {x: i + 1 for i, x in enumerate(names)}
    end = len(names) + 1
    graph: list[list[list]] = [[] for _ in range(end + 1)]

    def edge(a, b, room, cost):
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p, size in capacity.items():
        for i in range(passes):
            edge(0, at["pattern", p], size, i)
        for s in p:
            if s in quota:
                edge(at["pattern", p], at["source", s], passes * size, 0)
    for s, q in quota.items():
        edge(at["source", s], end, q, 0)
    while True:
        cost: list = [None] * (end + 1)
        came: list = [None] * (end + 1)
        cost[0], todo, queued = 0, deque([0]), {0}
        while todo:
            a = todo.popleft()
            queued.discard(a)
            for i, (b, room, c, _) in enumerate(graph[a]):
                if room > 0 and (cost[b] is None or cost[a] + c < cost[b]):
                    cost[b], came[b] = cost[a] + c, (a, i)
                    if b not in queued:
                        queued.add(b)
                        todo.append(b)
        if cost[end] is None:
            break
        path, b = [], end
        while b:
            a, i = came[b]
            path.append((a, i))
            b = a
        room = min(graph[a][i][1] for a, i in path)
        for a, i in path:
            graph[a][i][1] -= room
            b = graph[a][i]
            graph[b[0]][b[3]][1] += room
    return {(p, s): graph[e[0]][e[3]][1] for p in capacity for e in graph[at["pattern", p]] if e[0] > len(capacity) and e[0] < end for s in [names[e[0] - 1][1]] if graph[e[0]][e[3]][1]}


def mix(sized: DataFrame, quotas: DataFrame, most: int = 3, seed: str = "1", max_patterns: int = 100_000) -> DataFrame:
    """sized(doc_id, sources, size, ...) with `taken`, the words the mix takes of each document.

    sources is an array of the sources a document belongs to; quotas(source, target) says what each shall give. Every
    document of a pattern is taken the same whole number of times, and those first in the seeded order (md5 of the
    seed, doc_id and size) once more, the last of these only in part, so quotas are met to the word. No document is
    taken more than `most` times. Rows that repeat each stand for themselves. The patterns and quotas (one row per
    distinct set of sources) go to the driver, at most max_patterns of each; more raise an error, for the flow is solved
    there: sources are then to be put together first.
    """
    rows = sized.withColumn("_order", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"))))
    rows = rows.withColumn("_pattern", F.array_sort("sources")).withColumn("_slot", F.conv(F.substring("_order", 1, 3), 16, 10).cast("int"))
    counts = written(rows.groupBy("_pattern", "_slot").agg(F.sum("size").alias("words")))
    patterns = counts.groupBy("_pattern").agg(F.sum("words").alias("words")).limit(max_patterns + 1).collect()
    if len(patterns) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    wanted = quotas.select("source", "target").limit(max_patterns + 1).collect()
    if len(wanted) > max_patterns:
        raise ValueError(f"more than {max_patterns} sources")
    flow = min_cost_flow({tuple(r._pattern): r.words for r in patterns}, {r.source: round(r.target) for r in wanted}, most)
    out: dict = {}
    for (p, _), n in flow.items():
        out[p] = out.get(p, 0) + n
    plan = [(list(r._pattern), *divmod(out.get(tuple(r._pattern), 0), r.words)) for r in patterns if r.words]
    plan = sized.sparkSession.createDataFrame(plan, "_p array<string>, _passes long, _rest long")
    # Where the rest ends: whole slots below the boundary, then single documents within it.
    running = F.sum("words").over(Window.partitionBy("_pattern").orderBy("_slot")) - F.col("words")
    edges = counts.withColumn("_before", running).join(plan, F.col("_pattern") == F.col("_p")).select("_p", F.col("_slot").alias("_s"), "_passes", "_rest", "_before", "words")
    marked = rows.join(edges, (F.col("_pattern") == F.col("_p")) & (F.col("_slot") == F.col("_s")), "left")
    room = F.col("_rest") - F.col("_before")
    whole = marked.withColumn("_more", F.when(room >= F.col("words"), F.col("size")).when(room <= 0, F.lit(0)).when(room.isNull(), F.lit(0)))
    split = whole.where("_more is null")
    w = Window.partitionBy("_p", "_s").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    split = split.withColumn("_more", F.greatest(F.lit(0), F.least(F.col("size"), room - F.coalesce(F.sum("size").over(w), F.lit(0)))))
    done = whole.where("_more is not null").unionByName(split)
    return done.select(*sized.columns, (F.coalesce("_passes", F.lit(0)) * F.col("size") + F.col("_more")).cast("long").alias("taken"))


def _mixed(sized: DataFrame, most: int, seed: str) -> DataFrame:
    """sized(doc_id, source, size, ...) with source_size, target and taken, each document having one source."""
    # An array element that no source name can clash with stands for null.
    label = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    goal = targets(written(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), most)
    out = mix(sized.withColumn("sources", F.array(label)), goal.select(label.alias("source"), "target"), most, seed)
    return out.drop("sources").join(goal.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def sampled(docs: DataFrame, most: int = 3, seed: str = "1") -> DataFrame:
    """doc_id, source, size, source_size, target and taken for every document, each of which has one source. Sizes
    count runs other than ASCII white space; null and empty texts have size 0 and are taken 0 times. A null source is
    a source, a null doc_id counts as the empty one in the seeded order. Rows that repeat each stand for themselves. Empty tables
    give no rows. Other columns are not read."""
    sized = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text").cast("string")).alias("size")))
    return _mixed(sized, most, seed).select("doc_id", "source", "size", "source_size", "target", "taken")


def with_shares(docs: DataFrame, most: int = 3, seed: str = "1") -> DataFrame:
    """All columns of every document, with size, source_size, target and taken as sampled() has them; columns of docs with
    these names are replaced. Every row has its own `taken`, also where ids are null or repeat."""
    columns = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    sized = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text").cast("string")).alias("size"))
    return _mixed(sized, most, seed).select("row.*", "size", "source_size", "target", "taken")


def op1(spark, sf_dir) -> DataFrame:
    return sampled(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
with sized as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
    md5('1:' || coalesce(doc_id::varchar, '') || ':' || coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::varchar) as o from documents),
sizes as (select source, sum(size)::bigint as source_size from sized group by source),
w as (select *, (row_number() over (order by source is null, source) - 1) % 3 + 1 as weight, 3 * source_size as cap, (sum(source_size) over ())::bigint as total from sizes),
a as (select *, cap / weight as ratio from w),
l as (select *, (total - coalesce(sum(cap) over (order by ratio, source is null, source rows between unbounded preceding and 1 preceding), 0)::bigint)
    / (sum(weight) over (order by ratio, source is null, source rows between current row and unbounded following))::bigint as level from a),
f as (select min(ratio) as first_at, arg_min(level, (ratio, source is null, source)) as fill from l where ratio > level),
goal as (select source, source_size, case when fill is null or ratio <= fill then cap::double else weight * fill end as target from l, f),
ranked as (select doc_id, size, s.source, g.source_size, target, round_even(target, 0)::bigint as quota,
    coalesce(sum(size) over (partition by s.source order by o, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from sized s join goal g on s.source is not distinct from g.source)
select doc_id, source, size, source_size, target, case when source_size = 0 then 0 else (quota // source_size) * size
    + greatest(0, least(size, quota % source_size - before)) end::bigint as taken from ranked
"""
