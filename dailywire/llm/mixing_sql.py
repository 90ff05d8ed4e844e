"""DuckDB SQL of a mix: the same budgets, written level by level, and the same epoch prefixes."""

from __future__ import annotations

from . import mixing


def _share(parent: str, name: str, path: str, weights: str, level: str, above: str, out: str, epochs: int) -> str:
    """CTEs from the budgets of one level's nodes to those of their children."""
    need = f"partition by {parent} order by supply / weight::double, {name}"
    return f"""
c_{out} as (
  select {path}, sum(tokens)::bigint as tokens, sum(tokens)::bigint * {epochs} as supply from leaves group by {path}
), k_{out} as (
  select c.*, n.budget,
    case when coalesce(w.weight, 1) <= 0 then 1 else coalesce(w.weight, 1) * 1000000 end as weight
  from c_{out} c join {above} n using ({parent})
  left join ({weights}) w on w.level = '{level}' and w.path = concat_ws('/', {", ".join("c." + x for x in path.split(", ")[1:])})
), s_{out} as (
  select *, budget - coalesce(sum(supply) over ({need} rows between unbounded preceding and 1 preceding), 0) as rest_before,
    sum(weight) over ({need} rows between current row and unbounded following) as among
  from k_{out}
), f_{out} as (
  select *, min(supply::hugeint * among::hugeint <= greatest(rest_before, 0)::hugeint * weight::hugeint)
      over ({need} rows between unbounded preceding and current row) as is_full
  from s_{out}
), r_{out} as (
  select *, greatest(budget - coalesce(sum(case when is_full then supply end) over (partition by {parent}), 0), 0) as rest,
    coalesce(sum(case when not is_full then weight end) over (partition by {parent}), 0) as open
  from f_{out}
), p_{out} as (
  select *, case when is_full then supply else (rest::hugeint * weight::hugeint) // greatest(open, 1)::hugeint end as part from r_{out}
), e_{out} as (
  select *, rest - coalesce(sum(case when not is_full then part end) over (partition by {parent}), 0) as extra,
    row_number() over (partition by {parent}, is_full order by supply / weight::double desc, {name}) as turn
  from p_{out}
), {out} as (
  select {path}, tokens, least(case when is_full then part else part + case when turn <= extra then 1 else 0 end end, supply)::bigint as budget from e_{out}
)"""


def mix(weights: list[tuple[str, str, int]], epochs: int, part: str, seed: int = mixing.SEED) -> str:
    values = ", ".join(f"('{a}', '{b}', {c})" for a, b, c in weights)
    table = f"select * from (values {values}) as w(level, path, weight)"
    return f"""
with counted as (
  select doc_id, coalesce(case when regexp_extract(source, '([0-9]{{1,9}})$', 1) <> '' then 'domain' || (cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) as integer) % 4) else 'other' end, 'other') as domain,
    coalesce(lang, '') as lang, coalesce(source, '') as source,
    cast(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as bigint) as tokens
  from documents where text is not null
), leaves as (
  select 0 as root, domain, lang, source, sum(tokens)::bigint as tokens from counted where tokens > 0 group by domain, lang, source
), top as (
  select 0 as root, least(({part})::bigint, total * {epochs}) as budget from (select coalesce(sum(tokens), 0)::bigint as total from leaves)
), {_share("root", "domain", "root, domain", table, "domain", "top", "by_domain", epochs)},
{_share("root, domain", "lang", "root, domain, lang", table, "lang", "by_domain", "by_lang", epochs)},
{_share("root, domain, lang", "source", "root, domain, lang, source", table, "source", "by_lang", "by_source", epochs)},
budgets as (
  select domain, lang, source, budget // tokens as whole, budget % tokens as part from by_source where budget > 0
), ordered as (
  select c.*, b.whole, b.part, md5(concat_ws(':', '{seed}', cast(b.whole as varchar), coalesce(cast(c.doc_id as varchar), ''))) as key
  from counted c join budgets b using (domain, lang, source) where c.tokens > 0
), placed as (
  select *, coalesce(sum(tokens) over (partition by domain, lang, source order by key, doc_id nulls first, tokens rows between unbounded preceding and 1 preceding), 0) as start from ordered
)
select doc_id, domain, lang, source, cast(e as bigint) as epoch, tokens, tokens as take from ordered, unnest(range(whole)) as r(e)
union all
select doc_id, domain, lang, source, whole as epoch, tokens, cast(least(tokens, part - start) as bigint) as take from placed where start < part
"""
