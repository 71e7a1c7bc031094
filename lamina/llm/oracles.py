"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DIVERGENCE = rf"""
with docs as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
occ as (select doc, lang, source, unnest(terms) as term from docs),
vocabulary as (select lang, term from occ group by all having count(distinct doc) >= 30),
counts as (select lang, source, term, count(*) as n from occ join vocabulary using (lang, term) group by all),
grps as (select distinct lang, source from docs),
sizes as (select g.lang, (select count(*) from vocabulary v where v.lang = g.lang) as v from (select distinct lang from docs) g),
totals as (
  select g.lang, g.source, any_value(s.v) as v, coalesce(sum(c.n), 0) + 5 * any_value(s.v) as share_of
  from grps g join sizes s using (lang) left join counts c using (lang, source) group by all),
whole as (
  select lang, sum(share_of - 5 * v) + 5 * any_value(v) as share_of from totals group by lang),
lang_counts as (select lang, term, sum(n) as n from counts group by all),
weights as (
  select t.lang, t.source, v.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)::hugeint) // t.share_of::hugeint as p
  from totals t join vocabulary v using (lang) left join counts c using (lang, source, term)),
lang_weights as (
  select lang, term, 1 + (1000000000::hugeint * (n + 5)::hugeint) // w.share_of::hugeint as q
  from lang_counts join whole w using (lang)),
sums as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from weights a join weights b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from grps a join grps b on a.lang = b.lang and a.source <> b.source
  left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (
  select w.lang, w.source, 'term' as part, w.term as item, (w.p - q.q)::bigint as value
  from weights w join lang_weights q using (lang, term) where w.n > 0 and w.p > q.q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
  from (select * from pairs union all select * from terms))
select * from ranked where part = 'pair' or rank <= 50
"""

DECONTAMINATE = rf"""
with docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
windows as (
  select distinct item_id, m, list_slice(w, i, i + m - 1) as gram
  from (select item_id, w, m, unnest(range(1, len(w) - m + 2)) as i
        from (select *, least(len(w), 10) as m from items where len(w) > 0))),
grams as (
  select doc_id, m, i, list_slice(w, i, i + m - 1) as gram
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i
        from docs, (select distinct m from windows) where len(w) >= m)),
met as (select doc_id, item_id, grams.m, i from grams join windows on grams.m = windows.m and grams.gram = windows.gram),
hit as (
  select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + m)) as place from met) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct doc_id, item_id from met where item_id is not null) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (doc_id) left join named using (doc_id)
"""

HARD_NEGATIVES = """
with points as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from points a join points b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id,
       row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 5
"""

EXACT = r"""
with n as (
  select doc_id, length(coalesce(text, '')) as points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as content
  from documents),
g as (
  select doc_id, points, content, first_value(doc_id) over (partition by content order by points desc, doc_id) as keep_id,
         count(*) over (partition by content) as group_size
  from n)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(content) as text_sha256, points as n_points from g
"""

SUBSTRINGS = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') as run
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from docs where len(w) >= 20)),
repeated as (select doc_id, i from windows qualify row_number() over (partition by run order by doc_id, i) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as place from repeated),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from docs),
kept as (
  select doc_id, string_agg(word, ' ' order by place) as text, count(*) as n from words anti join gone using (doc_id, place)
  group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256
from docs left join kept using (doc_id)
"""

SQL = {
    "op4_fm_substrings": SUBSTRINGS,
    "op9_grace_dedup": EXACT,
    "op11_divergence_audit": DIVERGENCE,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_decontaminate": DECONTAMINATE,
}
