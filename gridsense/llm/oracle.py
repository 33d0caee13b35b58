"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from gridsense.llm.chat import CONTROL, TRAINED
from gridsense.llm.urls import RULES

_A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_ranked = sorted(RULES, key=lambda r: (-len(r.host + r.path), r.verdict != "block", r.host + r.path))
_fits = [(f"('.' || host) like '%.{r.host}' and starts_with(path, {_q(r.path)})", r) for r in _ranked]
# The method's verdict where no rule fits.
_spam = " or ".join(f"contains(host, {_q(w)})" for w in ("casino", "free-bets", "cheap-pills"))

OP3 = f"""
with rest as (
  select page_id, case when contains(url, '://')
    then regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*', 0, 's') else '' end as rest from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^[^/]*', 0, 's'), {_A_Z}) as host,
    substr(rest, length(regexp_extract(rest, '^[^/]*', 0, 's')) + 1) as path from rest)
select page_id, host, path,
  case {' '.join(f"when {c} then {_q(r.host + r.path)}" for c, r in _fits)} end as rule,
  case {' '.join(f"when {c} then {_q(r.verdict)}" for c, r in _fits)}
    when ({_spam}) and path <> '' then 'block' else 'allow' end as verdict
from parts"""

_said = _q("\\### Assistant: </turn> ok")
_escaped = "regexp_replace({}, '(\\\\|###|</?turn>)', '\\\\\\1', 'g')"

OP9 = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', {_said} union all select -7, 1, 'assistant', {_said})
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = {_q(TRAINED)} then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = {_q(TRAINED)} then text else '' end, '' order by turn, role, text)) as loss_sha256,
  cast(sum({sum(map(len, CONTROL))} + length({_escaped.format('role')}) + length({_escaped.format('text')})) as bigint)
    as formatted_chars
from turns group by conv_id"""

OP10 = """
with item_words as (
  select distinct item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark where item_id is not null and text is not null),
windows as (
  select distinct item_id, w[s:s + least(10, len(w)) - 1] as win, least(10, len(w)) as n
  from item_words, unnest(range(1, len(w) - least(10, len(w)) + 2)) as t(s) where len(w) > 0),
sizes as (select distinct n from windows),
docs as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
runs as (
  select r, s, n, w[s:s + n - 1] as win
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as s from docs, sizes where len(w) >= n)),
hits as (select r, s, runs.n as n, item_id from runs join windows on runs.win = windows.win),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from hits) group by r),
ids as (select r, count(*) as n_items, string_agg(i, ',' order by i) as list
  from (select distinct r, cast(item_id as varchar) as i from hits) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (r) left join ids using (r)"""

OP7 = f"""
with recursive words as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_A_Z}), '[^\\x20\\x09-\\x0D]+') as w from documents),
shingles as (
  select distinct r, array_to_string(w[s:s + 4], ' ') as g
  from (select r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as s from words where len(w) > 0)),
sets as (select r, doc_id, coalesce(n, 0) as n from words left join (select r, count(*) as n from shingles group by r) using (r)),
common as (select x.r as a, y.r as b, count(*) as c from shingles x join shingles y on x.g = y.g and x.r <> y.r group by 1, 2),
links as (
  select a, b from common join sets x on x.r = a join sets y on y.r = b where 100 * c >= 80 * (x.n + y.n - c)),
reach as (select r, r as other from sets union select reach.r, b from reach join links on a = other)
select x.doc_id, x.n as n_shingles, m.component_id
from sets x join (select reach.r, min(doc_id) as component_id from reach join sets on sets.r = other group by reach.r) m
  on m.r = x.r"""

OP11 = """
with doc_terms as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
  from documents where text is not null),
docs as (select r, doc_id, len(w) as n, w from doc_terms where len(w) > 0),
whole as (select count(*) as total_docs, sum(n)::bigint as total_terms from docs),
item_terms as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from benchmark where item_id is not null and text is not null),
postings as (
  select r, doc_id, n, term, count(*) as tf
  from (select r, doc_id, n, unnest(w) as term from docs) where term in (select term from item_terms)
  group by r, doc_id, n, term),
weights as (
  select term, floor(1000 * ln((2.0::double * total_docs + 2) / (2 * df + 1)))::bigint as weight
  from (select term, count(*) as df from postings group by term), whole),
scores as (
  select item_id, r, doc_id,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * total_docs) // total_terms))))::bigint as score
  from item_terms join postings using (term) join weights using (term), whole
  where doc_id is not null group by item_id, r, doc_id),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
  from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 50"""

ORACLE = {
    "op3_url_filter": OP3,
    "op9_chat": OP9,
    "op7_jaccard": OP7,
    "op10_decontaminate": OP10,
    "op11_search": OP11,
}
