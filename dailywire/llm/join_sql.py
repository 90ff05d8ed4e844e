"""DuckDB SQL of the n-gram join, by the definition: shared shingles counted per pair, links followed to their end."""

from __future__ import annotations


def similar_documents(shingle: int, percent: int) -> str:
    return rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), s as (
  select distinct doc_id, shingle from (
    select doc_id, unnest(case when len(w) >= {shingle} then list_transform(range(1, len(w) - {shingle - 2}), lambda i: array_to_string(w[i:i + {shingle - 1}], ' '))
      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingle from w)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), p as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
), l as (
  select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b where 100 * p.c >= {percent} * (x.n + y.n - p.c)
), r as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, l.b from r join l on l.a = r.other
)
select r.doc_id, cast(coalesce(any_value(n.n), 0) as bigint) as n_shingles, min(r.other) as component_id
from r left join n on n.doc_id = r.doc_id group by r.doc_id
"""
