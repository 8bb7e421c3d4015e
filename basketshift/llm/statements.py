"""DuckDB SQL of operators whose whole results SQL can state."""

from __future__ import annotations

EXACT_DEDUP = r"""
with texts as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept, text_sha256
from texts window g as (partition by text_sha256)
"""

NEAR_GROUPS = r"""
with recursive
texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) < 2 then w else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s from texts),
sizes as materialized (select doc_id, cast(len(s) as bigint) as n from sets),
shingles as materialized (select doc_id, unnest(s) as x from sets),
links as materialized (
  select a.doc_id as a, b.doc_id as b
  from shingles a join shingles b on a.x = b.x and a.doc_id < b.doc_id join sizes m on m.doc_id = a.doc_id join sizes n on n.doc_id = b.doc_id
  where 100 * least(m.n, n.n) >= 80 * greatest(m.n, n.n)
  group by a.doc_id, b.doc_id, m.n, n.n having 100 * count(*) >= 80 * (m.n + n.n - count(*))),
ends_ as (select a, b from links union all select b, a from links),
reached as (select doc_id, doc_id as other from sizes union select r.doc_id, ends_.b from reached r join ends_ on ends_.a = r.other)
select s.doc_id, n as n_shingles, min(other) as component_id, s.doc_id = min(other) as kept from sizes s join reached r on r.doc_id = s.doc_id group by s.doc_id, n
"""
