"""SQL for the registered queries that DuckDB can state."""

from __future__ import annotations

ESCAPED = r"regexp_replace(coalesce({}, ''), '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')"

CHAT = rf"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select * from (values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), ordered as (
  select *, role is distinct from lag(role) over (partition by conv_id order by turn nulls first, role, text) as opens,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as place
  from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length({ESCAPED.format("text")}) + case when opens then 13 + length({ESCAPED.format("role")}) else 7 end) as bigint) as formatted_chars
from ordered group by conv_id
"""

URLS = r"""
with parts as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), cut as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts
), ruled as (
  select *, case
    when ('.' || host) like '%.example.org' and starts_with(path, '/en/1') then 'example.org/en/1'
    when ('.' || host) like '%.example.org' and starts_with(path, '/es/') then 'example.org/es/'
    when ('.' || host) like '%.com' and starts_with(path, '/fr/') then 'com/fr/'
    when ('.' || host) like '%.com' and starts_with(path, '/de/') then 'com/de/'
    when ('.' || host) like '%.org' and starts_with(path, '/') then 'org/' end as rule
  from cut
)
select page_id, host, path, rule, case
    when rule in ('org/', 'com/fr/') then 'allow'
    when rule is not null then 'block'
    when regexp_matches(host || path, '/tag/[^/]+/?\z') then 'block'
    when regexp_matches(host || path, '/login(/|\.|\z)') then 'block'
    when regexp_matches(host || path, '^([^/]*\.)?blog\.[^/]*/[a-z]{2}/[0-9]*0\z') then 'block'
    when regexp_matches(host || path, '^m\.[^/]*/') then 'block'
    else 'allow' end as verdict
from ruled
"""

TOP = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as w from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as r from scored
)
select query_id, cast(r as integer) as rank, vec_id, score from ranked where r <= 10
"""

LEAKS = r"""
with d as (
  select row_number() over () as place, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents
), i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark
), w as (
  select distinct item_id, n, unnest(list_transform(generate_series(1, len(words) - n + 1), lambda k: list_slice(words, k, k + n - 1))) as cut
  from (select *, least(10, len(words)) as n from i where len(words) > 0)
), p as (
  select place, n, unnest(generate_series(1, len(words) - n + 1)) as pos, unnest(list_transform(generate_series(1, len(words) - n + 1), lambda k: list_slice(words, k, k + n - 1))) as cut
  from d join (select distinct n from w) on len(words) >= n
), h as (
  select place, pos, p.n, item_id from p join w on p.n = w.n and p.cut = w.cut
), covered as (
  select place, count(distinct word) as n_hit from (select place, unnest(generate_series(pos, pos + n - 1)) as word from h) group by place
), met as (
  select place, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct place, cast(item_id as varchar) as item from h where item_id is not null) group by place
)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (place) left join met using (place)
"""

MANIFEST = r"""
with recursive rows as (
  select row_number() over () as r, doc_id, coalesce('s' || source, '') as s, text, coalesce(octet_length(encode(doc_id::varchar)) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
      || coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars, '-') as fields,
    list_reduce([4294967295::bigint] || flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, (a & 1) * 3988292384) end) as state
  from documents
), leaves as (
  select r, doc_id, s, sha256(fields || coalesce(octet_length(encode(text)) || ':' || text, '-')) as leaf,
    sha256(fields || coalesce(octet_length(encode(text)) || ':' || case when xor(state, 4294967295) % 5 = 0
      then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end, '-')) as claimed
  from rows
), placed as (
  select *, row_number() over (partition by s order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by s) as n from leaves
), tree as (
  select s, 0 as level, place, leaf as node, n from placed
  union all
  select s, level + 1, place // 16, sha256(string_agg(node, '' order by place)), (n + 15) // 16 from tree where n > 1 group by s, level, place // 16, n
), subroots as (
  select s, node as subroot, row_number() over (order by encode(s)) - 1 as place, count(*) over () as n from tree where n = 1
), top as (
  select 0 as level, place, subroot as node, n from subroots
  union all
  select level + 1, place // 16, sha256(string_agg(node, '' order by place)), (n + 15) // 16 from top where n > 1 group by level, place // 16, n
), segments as (
  select p.r, t.level, coalesce(string_agg(t.node, '' order by t.place) filter (where t.place < p.place // (16 ** t.level)::bigint), '') as before,
    coalesce(string_agg(t.node, '' order by t.place) filter (where t.place > p.place // (16 ** t.level)::bigint), '') as behind
  from placed p join tree t on t.s = p.s and t.n > 1 and t.place // 16 = p.place // (16 ** (t.level + 1))::bigint group by p.r, t.level
  union all
  select p.r, 100 + t.level, coalesce(string_agg(t.node, '' order by t.place) filter (where t.place < b.place // (16 ** t.level)::bigint), ''),
    coalesce(string_agg(t.node, '' order by t.place) filter (where t.place > b.place // (16 ** t.level)::bigint), '')
  from placed p join subroots b on b.s = p.s join top t on t.n > 1 and t.place // 16 = b.place // (16 ** (t.level + 1))::bigint group by p.r, t.level
), steps as (
  select *, row_number() over (partition by r order by level) as step from segments
), folded as (
  select r, 0::bigint as step, claimed as node from leaves
  union all
  select f.r, t.step, sha256(t.before || f.node || t.behind) from folded f join steps t on t.r = f.r and t.step = f.step + 1
), ends as (
  select r, arg_max(node, step) as folded_root from folded group by r
), proofs as (
  select r, string_agg(before || behind, '' order by step) as proof from steps group by r
)
select doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) as proof_sha256, folded_root, folded_root = root as verified
from placed join (select s, subroot from subroots) using (s) join ends using (r) left join proofs using (r), (select node as root from top where n = 1)
"""

ORACLE_SQL: dict[str, str] = {"op4_maxscore": TOP, "op7_chat_format": CHAT, "op8_url_rules": URLS, "op12_merkle_manifest": MANIFEST, "op13_decontaminate": LEAKS}
