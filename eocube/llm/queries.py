"""The queries of this subpackage, by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from eocube.llm import codes, decontaminate, lines, lm, mixing, quality, runs, secrets, setjoin, simhash, substring, tokens, topk

QUERIES = {
    "op1_mix_sources": mixing.op1,
    "op2_simhash_near_dedup": simhash.op2,
    "op3_substring_dedup": substring.op3,
    "op4_token_counts": tokens.op4,
    "op5_decontaminate": decontaminate.op5,
    "op6_line_dedup": lines.op6,
    "op7_secret_scan": secrets.op7,
    "op8_lm_score": lm.op8,
    "op9_quality": quality.op9,
    "op10_topk": topk.op10,
    "op11_ngram_jaccard_join": setjoin.op11,
    "op12_vector_codes": codes.op12,
    "op13_periodic_runs": runs.op13,
}

_OP5 = """
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark where text is not null),
p as (select distinct item_id, len(x) as m, array_to_string(x, ' ') as k from (select item_id, w[i:i + 9] as x from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) as i from b where len(w) > 0))),
lengths as (select distinct m from p),
g as (select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as k from (select doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) as i from d, lengths where len(w) >= m)),
hits as (select g.doc_id, g.m, g.i, p.item_id from g join p on g.m = p.m and g.k = p.k),
n as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(generate_series(i, i + m - 1)) as j from hits) group by doc_id),
o as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids from (select distinct doc_id, item_id::varchar as s from hits) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join o using (doc_id)
"""

_OP3 = """
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
g as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as k from (select doc_id, w, unnest(generate_series(1, len(w) - 19)) as i from d where len(w) >= 20)),
r as (select doc_id, i from (select doc_id, i, row_number() over (partition by k order by doc_id, i) as n from g) where n > 1),
gone as (select distinct doc_id, unnest(generate_series(i, i + 19)) as j from r),
x as (select doc_id, list(j) as js from gone group by doc_id),
kept as (select d.doc_id, len(w) as n, list_filter(generate_series(1, len(w)), lambda j: x.js is null or not list_contains(x.js, j)) as ks, w from d left join x using (doc_id))
select doc_id, n::bigint as n_words, (n - len(ks))::bigint as n_removed, sha256(coalesce(array_to_string(list_select(w, ks), ' '), '')) as kept_sha256 from kept
"""

_OP10 = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, v.vec_id, list_inner_product(q.e, v.e)::bigint as score from v q join v on q.vec_id % 50 = 0 and q.vec_id <> v.vec_id),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
select * from r where rank <= 5
"""

ORACLES = {"op1_mix_sources": mixing.ORACLE, "op3_substring_dedup": _OP3, "op5_decontaminate": _OP5, "op10_topk": _OP10, "op12_vector_codes": codes.ORACLE}
