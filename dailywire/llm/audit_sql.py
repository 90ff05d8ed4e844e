"""DuckDB SQL of the filter audit, by the definition: every order's steps judged on each document's failures."""

from __future__ import annotations

AUDIT = r"""
with recursive d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents
), w as (
  select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by t) as first from d
), l as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id
), f as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    case when len(words) < 50 then 'A' else '' end
    || case when 100 * len(list_distinct(words)) < 65 * len(words) then 'B' else '' end
    || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when w.doc_id > first then 'E' else '' end as fails
  from w left join l on w.doc_id = l.doc_id
), g as (
  select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, fails
), o as (
  select '' as filter_order union all
  select filter_order || x from o, (select unnest(['A', 'B', 'C', 'D', 'E']) as x) where not contains(filter_order, x)
), s as (
  select filter_order, cast(step as int) as step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as before
  from o, (select unnest([1, 2, 3, 4, 5]) as step) where length(filter_order) = 5
), r as (
  select part, filter_order, step, own,
    cast(sum(case when translate(fails, before || own, '') = fails then n else 0 end) as bigint) as kept,
    cast(sum(case when contains(fails, own) and translate(fails, before, '') = fails then n else 0 end) as bigint) as removed,
    cast(sum(case when contains(fails, own) and translate(fails, before, '') <> fails then n else 0 end) as bigint) as redundant,
    cast(sum(case when fails = own then n else 0 end) as bigint) as unique_fails,
    cast(sum(case when contains(fails, own) and translate(fails, before, '') = fails then good else 0 end) as bigint) as good_lost,
    cast(sum(case when contains(fails, own) and translate(fails, before, '') = fails then toxic else 0 end) as bigint) as toxic_lost
  from g, s group by part, filter_order, step, own
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  cast(sum(removed) over (partition by part, own) as bigint) as shapley
from r
"""
