"""DuckDB SQL for the operators that SQL can express, over the same whole tables."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from tidemark.llm.licenses import NOTICES, SHINGLE

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _bench_words(table: str, key: str) -> str:
    lowered = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
    return f"select {key}, regexp_extract_all({lowered}, '{_WORD}') w from {table}"


DECONTAMINATE = f"""
with d as ({_bench_words("documents", "doc_id")}),
b as ({_bench_words("benchmark", "item_id")}),
item_window as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') s
  from (select item_id, w, least(10, len(w)) n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from b where len(w) > 0)),
lengths as (select distinct n from item_window),
doc_window as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') s
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from d, lengths where len(w) >= n)),
hit as (select doc_id, i, n, item_id from doc_window join item_window using (s, n)),
place as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hit) group by doc_id),
item as (
  select doc_id, count(*) n_items, string_agg(item, ',' order by item) items
  from (select distinct doc_id, cast(item_id as varchar) item from hit) group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join place using (doc_id) left join item using (doc_id)
"""

_NOTICE_ROWS = ", ".join(f"('{name}', '{text}')" for name, text in NOTICES.items())


def _shingles(source: str, key: str) -> str:
    words = r"[x for x in regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') if x <> '']"
    return (
        f"select distinct {key}, array_to_string(w[i:i + {SHINGLE - 1}], ' ') s from "
        f"(select {key}, w, unnest(range(1, len(w) - {SHINGLE - 2})) i from (select {key}, {words} w from {source}))"
    )


LICENSES = f"""
with t as (select * from (values {_NOTICE_ROWS}) v(template, text)),
ts as ({_shingles("t", "template")}),
size as (select template, count(*) n from ts group by template),
ds as ({_shingles("documents", "doc_id")}),
found as (select doc_id, template from ds join ts using (s) join size using (template) group by doc_id, template, n having count(*) >= 0.8 * n)
select doc_id, count(template)::bigint n_templates, coalesce(string_agg(template, ',' order by template), '') templates
from documents left join found using (doc_id) group by doc_id
"""

FILTER_AUDIT = r"""
with d as (
  select doc_id, coalesce(text, '') body, coalesce(source, '') part, min(doc_id) over (partition by coalesce(text, '')) as first_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w
  from documents),
l as (select doc_id, max(quality = 1) good, max(toxic = 1) toxic from labels group by doc_id),
failed as (
  select part, coalesce(good, false) good, coalesce(toxic, false) toxic, [
    case when len(w) < 50 then 'A' end, case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' end,
    case when 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) then 'C' end,
    case when regexp_matches(body, '[#$%&*|]') then 'D' end, case when doc_id > first_id then 'E' end] f
  from d left join l using (doc_id)),
f as (
  select part, list_filter(f, lambda x: x is not null) f, count(*) n, count(*) filter (good) good, count(*) filter (toxic) toxic
  from failed group by all),
letter as (select unnest(['A', 'B', 'C', 'D', 'E']) x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from letter a, letter b, letter c, letter d, letter e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
place as (
  select part, filter_order, step, f, n, good, toxic, filter_order[step] own, list_contains(f, filter_order[step]) fails,
    len(list_filter(f, lambda x: instr(filter_order, x) < step)) > 0 gone
  from f, orders, range(1, 6) s(step)),
counted as (
  select part, filter_order, step, own, coalesce(sum(n) filter (not fails and not gone), 0)::bigint kept,
    coalesce(sum(n) filter (fails and not gone), 0)::bigint removed, coalesce(sum(n) filter (fails and gone), 0)::bigint redundant,
    coalesce(sum(n) filter (f = [own]), 0)::bigint unique_fails, coalesce(sum(good) filter (fails and not gone), 0)::bigint good_lost,
    coalesce(sum(toxic) filter (fails and not gone), 0)::bigint toxic_lost
  from place group by all)
select * exclude (own, step), step::int step, (sum(removed) over (partition by part, own))::bigint shapley from counted
"""

ORACLE = {"op1_decontaminate": DECONTAMINATE, "op2_license_scan": LICENSES, "op11_filter_audit": FILTER_AUDIT}
