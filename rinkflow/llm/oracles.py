"""The queries' results in DuckDB's SQL, where SQL can express them on whole tables."""

from __future__ import annotations

from .licenses import COVERAGE, DRIFT, PHRASES, TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = f"list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_ALNUM = f"regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
_SHINGLES = "case when len(ws) = 0 then []::varchar[] when len(ws) < 5 then [array_to_string(ws, ' ')] else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) end"

OP1 = """
with recursive v as (
  select vec_id, label, case when label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0 then embedding::double[] end as e from embeddings),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach as (select vec_id as id, vec_id as c from v union select r.id, l.b from reach r join links l on r.c = l.a),
component as (select id, min(c) as component_id from reach group by id)
select v.vec_id, coalesce(n.n, 0) as n_links, c.component_id, v.vec_id = c.component_id as kept
from v join component c on v.vec_id = c.id left join (select a, count(*) as n from links group by a) n on v.vec_id = n.a"""

OP3 = f"""
with recursive s as (select doc_id, {_SHINGLES} as sh from (select doc_id, {_SPACED} as ws from documents)),
u as (select doc_id, len(sh) as n, unnest(sh) as g from s),
links as (
  select a, b from (select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as k from u a join u b on a.g = b.g and a.doc_id <> b.doc_id group by all)
  where 100 * k >= 85 * (na + nb - k)),
reach as (select doc_id as id, doc_id as c from s union select r.id, l.b from reach r join links l on r.c = l.a),
component as (select id, min(c) as component_id from reach group by id)
select s.doc_id, cast(len(sh) as bigint) as n_shingles, c.component_id, s.doc_id = c.component_id as kept from s join component c on s.doc_id = c.id"""

OP4 = f"""
with d as (select doc_id, unnest({_SHINGLES}) as g from (select doc_id, {_ALNUM} as ws from documents)),
i as (select item_id, sh, unnest(sh) as g from (select item_id, {_SHINGLES} as sh from (select item_id, {_ALNUM} as ws from benchmark)))
select doc_id, item_id, cast(n as bigint) as n_item, k as n_shared, cast(k as double) / n as containment
from (select d.doc_id, i.item_id, len(i.sh) as n, count(*) as k from d join i using (g) group by all) where k >= 0.8 * n"""

_VALUES = ", ".join(f"({i}, '{label}', {str(base).lower()}, '{text}')" for i, (text, label, base) in enumerate([(*p, True) for p in PHRASES] + [(*t, False) for t in TEMPLATES]))
OP9 = f"""
with w as (select doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as ws from documents),
grams as (select doc_id, i - 1 as pos, ws[i] || ' ' || ws[i+1] as pair from (select doc_id, ws, unnest(range(1, len(ws))) as i from w)),
known as (select template, label, base, len(t) - 1 as pairs, i - 1 as place, t[i] || ' ' || t[i+1] as pair
  from (select *, unnest(range(1, len(t))) as i from (select template, label, base, string_split(phrase, ' ') as t from (values {_VALUES}) x(template, label, base, phrase)))),
votes as (select doc_id, template, label, base, pairs, pos - place as diagonal, bit_or(cast(1 as bigint) << cast(place as bigint)) as own, min(pos) as first, max(pos) as last from grams join known using (pair) group by all),
near as (select *, cast(bit_count(case when base then own else bit_or(own) over w end) as double) / pairs as coverage, case when base then diagonal else min(first) over w end as s
  from votes window w as (partition by doc_id, template order by diagonal range between {DRIFT} preceding and {DRIFT} following)),
spans as (select * from (select *, coalesce(max(coverage) over (partition by doc_id, template order by diagonal range between {2 * DRIFT} preceding and 1 preceding), 0) as before,
    coalesce(max(coverage) over (partition by doc_id, template order by diagonal range between 1 following and {2 * DRIFT} following), 0) as after from near)
  where case when base then coverage = 1 else coverage >= {COVERAGE} and coverage > before and coverage >= after end),
found as (select doc_id, count(*) filter (where base) as n_base, min(s) filter (where base) as first_word, max(s) filter (where base) as last_word,
  array_to_string(list_sort(list(distinct label) filter (where base)), ',') as base_labels, array_to_string(list_sort(list(distinct label)), ',') as labels, max(coverage) as score from spans group by doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_base, 0) as n_base, cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0::double) as score
from w left join found using (doc_id)"""
