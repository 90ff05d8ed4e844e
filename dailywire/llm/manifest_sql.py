"""DuckDB SQL of the Merkle manifest, by the definition: levels from row numbers, one fold step a level."""

from __future__ import annotations


def _leaf(text: str) -> str:
    fields = ["cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text]
    return "sha256(" + " || ".join(f"coalesce(cast(strlen({f}) as varchar) || ':' || {f}, '-')" for f in fields) + ")"


#: Bytes of the decimal doc_id, eight shift steps (-1) after each.
_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(cast(doc_id as varchar), ''),
  lambda c: list_concat([cast(ascii(c) as bigint)], [-1, -1, -1, -1, -1, -1, -1, -1])))),
  lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295)"""

MANIFEST = f"""
with recursive d as (
  select *, {_leaf("text")} as leaf,
    case when {_CRC} % 3 = 0 then {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as tampered
  from documents
), p as (
  select doc_id, lang, leaf, coalesce(tampered, leaf) as start, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx,
    dense_rank() over (order by lang nulls first) - 1 as g, count(*) over (partition by lang) as n from d
), up as (
  select g, 0 as lvl, idx, leaf as h, n from p
  union all
  select g, lvl + 1, idx // 8, sha256(string_agg(h, '' order by idx)), (any_value(n) + 7) // 8 from up where n > 1 group by g, lvl, idx // 8
), sub as (
  select g, h as subroot from up where n = 1
), top as (
  select 0 as lvl, g as idx, subroot as h, (select count(*) from sub) as n from sub
  union all
  select lvl + 1, idx // 8, sha256(string_agg(h, '' order by idx)), (any_value(n) + 7) // 8 from top where n > 1 group by lvl, idx // 8
), u as (
  select g, lvl, idx, coalesce(string_agg(h, '') over (partition by g, lvl, idx // 8 order by idx rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(h, '') over (partition by g, lvl, idx // 8 order by idx rows between 1 following and unbounded following), '') as after
  from up where n > 1
), t as (
  select lvl, idx, coalesce(string_agg(h, '') over (partition by lvl, idx // 8 order by idx rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(h, '') over (partition by lvl, idx // 8 order by idx rows between 1 following and unbounded following), '') as after
  from top where n > 1
), way as (
  select p.g, p.idx as own, p.start, l.lvl, u.before, u.after from p, (select distinct g, lvl from u) l, u
  where l.g = p.g and u.g = p.g and u.lvl = l.lvl and u.idx = p.idx // cast(pow(8, l.lvl) as bigint)
  union all
  select p.g, p.idx, p.start, (select count(distinct lvl) from u x where x.g = p.g) + l.lvl, t.before, t.after from p, (select distinct lvl from t) l, t
  where t.lvl = l.lvl and t.idx = p.g // cast(pow(8, l.lvl) as bigint)
), fold as (
  select g, idx as own, 0 as lvl, start as h, '' as proof from p
  union all
  select f.g, f.own, f.lvl + 1, sha256(w.before || f.h || w.after), f.proof || w.before || w.after
  from fold f join way w on w.g = f.g and w.own = f.own and w.lvl = f.lvl
), last as (
  select g, own, arg_max(h, lvl) as folded_root, sha256(arg_max(proof, lvl)) as proof_sha256 from fold group by g, own
)
select p.doc_id, p.leaf, sub.subroot, r.root, last.proof_sha256, last.folded_root, last.folded_root = r.root as verified
from p join sub on sub.g = p.g join last on last.g = p.g and last.own = p.idx, (select h as root from top where n = 1) r
"""
