"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from threadtables.llm.queries import BLOCKED_LABELS, RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def op1_bloom_cascade() -> str:
    rules = ", ".join(f"({_text(v)}, {_text(h)}, {_text(p)})" for v, h, p in RULES)
    labels = ", ".join(map(_text, BLOCKED_LABELS))
    return f"""
with rules(verdict, host, path) as (values {rules}),
rest as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rest),
keyed as (select *, row_number() over () as k from parts),
fits as (
  select k, r.host || r.path as rule, r.verdict,
         row_number() over (partition by k order by length(r.host || r.path) desc, length(r.host) desc) as place
  from keyed p join rules r
    on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path))
select page_id, host, path, f.rule,
       coalesce(f.verdict, case when list_has_any(string_split(host, '.'), [{labels}]) then 'block' else 'allow' end) as verdict
from keyed p left join fits f on f.k = p.k and f.place = 1
"""


_BLANKS = r"\x20\x09-\x0D"
_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def op11_source_divergence() -> str:
    share = "1 + 1000000000 * ({} + 5)::hugeint // ({} + 5 * v)"
    return f"""
with docs as (
  select row_number() over () as k, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (
  select k, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) as term from docs),
kept as (select lang, term from words group by 1, 2 having count(distinct k) >= 30),
counts as (select lang, source, term, count(*) as n from words join kept using (lang, term) group by 1, 2, 3),
sizes as (select lang, count(*) as v from kept group by 1),
groups as (
  select lang, source, coalesce(v, 0) as v, coalesce(total, 0) as total
  from (select distinct lang, source from docs) left join sizes using (lang)
  left join (select lang, source, sum(n) as total from counts group by 1, 2) using (lang, source)),
shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, {share.format('coalesce(c.n, 0)', 'g.total')} as p
  from groups g join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
langs as (select lang, term, {share.format('sum(n)', 'any_value(total)')} as q
  from (select lang, term, n from counts) join (select lang, sum(total) as total, any_value(v) as v from groups group by 1) using (lang)
  group by lang, term, v),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(d.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (
    select a.lang, a.source, b.source as other, sum(abs(a.p - b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3) d
  on d.lang = a.lang and d.source = a.source and d.other = b.source),
terms as (select lang, source, 'term' as part, term as item, p - q as value from shares join langs using (lang, term) where n > 0 and p > q)
select lang, source, part, item, value::bigint as value, rank::int as rank from (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from terms))
where part = 'pair' or rank <= 50
"""


def op12_fill_in_middle() -> str:
    dice = ", ".join(f"('0x' || substr(hex, {8 * k + 1}, 8))::bigint as h{k + 1}" for k in range(4))
    return f"""
with drawn as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as hex from documents),
units as (
  select *, regexp_extract_all(text, '[{_BLANKS}]*[^{_BLANKS}]+|[{_BLANKS}]+') as units, {dice} from drawn),
cuts as (
  select *, len(units) as n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
              when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from units),
parts as (
  select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle, array_to_string(units[b + 1:], '') as suffix from cuts)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              else '<P>' || prefix || '<S>' || suffix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""


def op13_circulant_minhash() -> str:
    """Every pair of documents that shares a shingle, then the least doc_id reached over the links."""
    return f"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^{_BLANKS}]+') as words from documents),
shingles as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) = 1 then [words[1]]
         else list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) end) as shingle from docs),
sizes as (select doc_id, count(*) as n from shingles group by 1),
numbered as (select doc_id, dense_rank() over (order by shingle) as s from shingles),
meets as (select a.doc_id as a, b.doc_id as b, count(*) as k from numbered a join numbered b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from meets join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
reached as (select doc_id, doc_id as other from docs union select r.doc_id, l.b from reached r join links l on l.a = r.other),
least as (select doc_id, min(other) as component_id from reached group by 1)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from docs d left join sizes s on s.doc_id = d.doc_id join least l on l.doc_id = d.doc_id
"""


def all_sql() -> dict[str, str]:
    return {f.__name__: f() for f in (op1_bloom_cascade, op11_source_divergence, op12_fill_in_middle, op13_circulant_minhash)}
