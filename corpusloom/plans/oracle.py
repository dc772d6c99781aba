"""SQL with the same results as the registered queries, written for DuckDB.

Plain statements of the rules: simple patterns, pair joins, recursion. They are for checking on
small tables only.
"""

from __future__ import annotations

from collections.abc import Callable

from corpusloom.operators.profile import HEADER_KEYS
from corpusloom.operators.sweep import THRESHOLDS
from corpusloom.plans.registered import EMBED_DIMENSION, GMM_ROUNDS, GRID, GRID_ROUNDS, LRU_ENTRIES, POST_TEXT, SLICE, SMALL_CACHE, SMOKE_QUERIES

NL = "chr(10)"
# The classes of blanks and of word characters, stated here on their own.
BLANKS_IN_LINE = r"\t\x0B\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BLANKS = r"\n" + BLANKS_IN_LINE
WORD = r"\p{L}\p{N}_"
ASCII_BLANK_CHARS = "||".join(f"chr({c})" for c in [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
ALL_BLANK_CHARS = "||".join(
    f"chr({c})"
    for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def body(t: str) -> str:
    return f"case when contains({t}, {NL}||{NL}) then substr({t}, instr({t}, {NL}||{NL}) + 2) else {t} end"


def header(t: str) -> str:
    return f"case when contains({t}, {NL}||{NL}) then split_part({t}, {NL}||{NL}, 1) else '' end"


def without_signature(t: str) -> str:
    return f"split_part(split_part({t}, {NL}||'-- '||{NL}, 1), {NL}||'--'||{NL}, 1)"


def without_quotes(t: str) -> str:
    lines = f"string_split({t}, {NL})"
    return f"array_to_string(list_filter({lines}, lambda l: not regexp_matches(l, '^[{BLANKS_IN_LINE}]*[>|]')), {NL})"


def without(pattern: str) -> Callable[[str], str]:
    return lambda t: f"regexp_replace({t}, '{pattern}', '', 'g')"


def tidy(t: str) -> str:
    lines = rf"string_split(regexp_replace({t}, '\n{{3,}}', {NL}||{NL}, 'g'), {NL})"
    stripped = f"array_to_string(list_transform({lines}, lambda l: rtrim(l, {ASCII_BLANK_CHARS})), {NL})"
    return f"trim({stripped}, {ASCII_BLANK_CHARS})"


RULES = {
    "strip_headers": body,
    "remove_signature": without_signature,
    "remove_quoted_lines": without_quotes,
    "remove_emails": without(rf"[{WORD}.\-+]+@[{WORD}.\-]+\.[{WORD}]+"),
    "remove_tags": without("<[^>]+>"),
    "remove_urls": without(rf"https?://[^{BLANKS}]+|ftp://[^{BLANKS}]+|www\.[^{BLANKS}]+"),
    "remove_non_ascii": without(r"[^\x00-\x7F]"),
    "normalize_whitespace": tidy,
}


def cleaned(t: str) -> str:
    for rule in RULES.values():
        t = rule(t)
    return t


PLAIN = "plain as (select doc_id, source category, doc_id::varchar filename, text from documents)"
POSTS = f"posts as (select doc_id, source category, doc_id::varchar filename, {POST_TEXT} as text from documents)"
MIXED = (
    f"{PLAIN}, {POSTS}, mixed as (select category, filename, text from plain "
    "union all select category, 'p'||filename, text from posts)"
)


def first_of(key: str, source: str, columns: str) -> str:
    return (
        f"select {columns} from (select *, row_number() over (partition by {key} order by category, filename) as place "
        f"from {source}) where place = 1"
    )


CLEANED_MIXED = f"{MIXED}, c as (select *, {cleaned('text')} as cleaned_text from mixed)"

# --- profile --------------------------------------------------------------------------------------

FEATURES = rf"""features as (select
  {', '.join(f"contains({header('text')}, '{k}') as has_{k.rstrip(':').lower().replace('-', '_')}" for k in HEADER_KEYS)},
  len(list_filter(string_split(text, {NL}), lambda l: regexp_matches(l, '^[{BLANKS_IN_LINE}]*>'))) as quoted_lines,
  contains(text, {NL}||'-- '||{NL}) or contains(text, {NL}||'--'||{NL}) as has_signature,
  length(text) as text_len,
  text as text_key,
  {body('text')} as body_key,
  len(regexp_extract_all(text, '[^\x00-\x7F]')) as non_ascii,
  case when regexp_extract({header('text')}, 'Newsgroups:[{BLANKS}]*([^\n]+)', 1) <> ''
    then len(string_split(regexp_extract({header('text')}, 'Newsgroups:[{BLANKS}]*([^\n]+)', 1), ',')) else 1 end as newsgroups,
  length(trim({body('text')}, {ALL_BLANK_CHARS})) as body_len,
  regexp_matches(text, '<[a-zA-Z][^>]*>') as has_html,
  contains(text, 'Content-Type:') or contains(text, 'MIME-Version:') as has_mime,
  contains(lower(text), 'base64') as has_base64,
  len(regexp_extract_all({body('text')}, '[{WORD}.\-]+@[{WORD}.\-]+')) as emails
  from %s)"""


def posts_if(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def share(condition: str) -> str:
    return f"({posts_if(condition)} / count(*)) * 100"


PROFILE = {
    "headers": {
        f"posts_has_{name}": posts_if(f"has_{name}")
        for name in (k.rstrip(":").lower().replace("-", "_") for k in HEADER_KEYS)
    },
    "quotes": {
        "posts_with_quotes": posts_if("quoted_lines > 0"),
        "share_with_quotes": share("quoted_lines > 0"),
        "mean_quoted_lines": "avg(quoted_lines)",
        "max_quoted_lines": "max(quoted_lines)",
        "posts_over_20_quoted_lines": posts_if("quoted_lines > 20"),
    },
    "signatures": {"posts_with_signature": posts_if("has_signature"), "share_with_signature": share("has_signature")},
    "lengths": {
        "min_length": "min(text_len)",
        "max_length": "max(text_len)",
        "mean_length": "avg(text_len)",
        "median_length": "quantile_cont(text_len, 0.5)",
        "empty_posts": posts_if("text_len = 0"),
        "posts_under_50": posts_if("text_len < 50"),
        "posts_under_100": posts_if("text_len < 100"),
        "posts_over_10000": posts_if("text_len > 10000"),
    },
    "non_ascii": {
        "posts_with_non_ascii": posts_if("non_ascii > 0"),
        "share_with_non_ascii": share("non_ascii > 0"),
        "posts_over_50_non_ascii": posts_if("non_ascii > 50"),
    },
    "crossposts": {
        "cross_posted": posts_if("newsgroups > 1"),
        "share_cross_posted": share("newsgroups > 1"),
        "max_newsgroups": "max(newsgroups)",
    },
    "bodies": {
        "empty_bodies": posts_if("body_len = 0"),
        "bodies_under_20": posts_if("body_len < 20"),
        "bodies_under_50": posts_if("body_len < 50"),
    },
    "markup": {
        "posts_with_html": posts_if("has_html"),
        "posts_with_mime": posts_if("has_mime"),
        "posts_with_base64": posts_if("has_base64"),
    },
    "emails": {"posts_with_emails": posts_if("emails > 0"), "share_with_emails": share("emails > 0")},
}


def profile_sql(part: str) -> str:
    columns = ", ".join(f"round(({e})::double, 6) as {name}" for name, e in PROFILE[part].items())
    return f"with {POSTS}, {FEATURES % 'posts'} select {columns} from features"


def profile_all_sql() -> str:
    metrics = {"documents": "count(*)"}
    for part in PROFILE.values():
        metrics |= part
    metrics["exact_duplicates"] = "count(*) - count(distinct text_key)"
    metrics["body_duplicates"] = "count(*) - count(distinct body_key)"
    rows = " union all ".join(
        f"select '{name}' as metric, round(({e})::double, 6) as value from features" for name, e in metrics.items()
    )
    return f"with {MIXED}, {FEATURES % 'mixed'} {rows}"


# --- hashing embedding ----------------------------------------------------------------------------


def hash_vectors(source: str, key: str, text: str, name: str) -> str:
    """CTEs that end in ``name(key, vec)``: the dense hashing embedding as doubles of 32-bit values."""
    return f"""{name}_tokens as (select {key}, ('0x'||substr(md5(token), 1, 9))::bigint as v from (
    select {key}, unnest(list_filter(regexp_split_to_array(lower({text}), '[^a-z0-9]+'), lambda x: x <> '')) as token from {source})),
  {name}_counts as (select {key}, (v >> 4) % {EMBED_DIMENSION} as d, sum(case when v % 2 = 0 then 1 else -1 end)::double as c
    from {name}_tokens group by all),
  {name}_norms as (select {key}, sqrt(sum(c * c)) as norm from {name}_counts group by all),
  {name} as (select s.{key}, list(coalesce((c / nullif(norm, 0))::float::double, 0.0) order by g.d) as vec
    from {source} s cross join (select unnest(range({EMBED_DIMENSION})) as d) g
    left join {name}_norms n on n.{key} = s.{key} left join {name}_counts t on t.{key} = s.{key} and t.d = g.d
    group by s.{key})"""


CLEANED_DOCS = f"{PLAIN}, docs as (select doc_id, category, filename, {cleaned('text')} as cleaned_text from plain)"

# --- vectors and clusters -------------------------------------------------------------------------

VECTORS = "vectors as (select vec_id as doc_id, embedding::double[] as v, label, 'label_'||label as category from embeddings)"
ELEMENTS = (
    "elements as (select doc_id, label, unnest(v) as x, generate_subscripts(v, 1) as d from vectors)"
)
LABEL_QUERIES = f"""{VECTORS}, {ELEMENTS},
  means as (select label, list(x order by d) as m from (select label, d, avg(x) as x from elements group by all) group by label),
  questions as (select label::bigint as qid, list_transform(m, lambda x: x / sqrt(list_inner_product(m, m))) as q,
    'label_'||label as wanted from means),
  scores as (select qid, doc_id, category, wanted, list_inner_product(q, v) as score from questions, vectors)"""


def ranked(source: str, k: int, where: str = "true") -> str:
    return (
        f"(select *, (row_number() over (partition by qid order by score desc, doc_id))::integer as rank from {source} "
        f"where {where} qualify rank <= {k})"
    )


PARAMETERS = """parameters as (select label as k, d, avg(x) as mu, avg(x * x) - avg(x) * avg(x) + 1e-6 as var from elements group by all),
  weights as (select label as k, count(*) / (select count(*) from vectors) as w from vectors group by all)"""


def memberships(source: str, name: str = "probs") -> str:
    """CTEs that end in ``name(id, k, p)`` and ``name_best(id, best, top)`` for ``source(id, v)``."""
    return f"""{name}_x as (select id, unnest(v) as x, generate_subscripts(v, 1) as d from {source}),
  {name}_joint as (select id, k, ln(any_value(w)) + sum(-0.5 * (ln(2 * pi() * var) + (x - mu) * (x - mu) / var)) as l
    from {name}_x join parameters using (d) join weights using (k) group by id, k),
  {name}_shift as (select id, k, exp(l - max(l) over (partition by id)) as e, max(l) over (partition by id) as m from {name}_joint),
  {name} as (select id, k, e / sum(e) over (partition by id) as p, m + ln(sum(e) over (partition by id)) as lse,
    row_number() over (partition by id order by e desc, k) as place from {name}_shift),
  {name}_best as (select id, k as best, p as top from {name} where place = 1)"""


ASSIGNED = f"{VECTORS}, {ELEMENTS}, {PARAMETERS}, points as (select doc_id as id, v from vectors), {memberships('points')}"
PROBABILITY_TEXT = (
    "(select id, string_agg('cluster_'||k||'='||printf('%.4f', round(p, 4)), ',' order by place) as probabilities "
    "from probs where place <= 5 group by id)"
)
SOURCES = """sourced as (select b.id, b.best, source as category from documents d
    join probs_best b on b.id = d.doc_id % (select max(vec_id) + 1 from embeddings))"""


def composition(clusters: int, top: int, label: str, separator: str) -> str:
    return f"""with {ASSIGNED}, {SOURCES},
  counts as (select best, category, count(*) as n from sourced group by all),
  places as (select *, row_number() over (partition by best order by n desc, category) as place from counts),
  listed as (select best, string_agg({label}, '{separator}' order by place) as top_categories from places where place <= {top} group by best),
  totals as (select best, sum(n)::bigint as n from counts group by best)
select c::integer as cluster, coalesce(t.n, 0)::bigint as total_docs, coalesce(top_categories, '') as top_categories
from (select unnest(range({clusters})) as c) left join listed l on l.best = c left join totals t on t.best = c"""


# --- cache ----------------------------------------------------------------------------------------

NEIGHBOURS = """neighbours as (select a.vec_id, a.embedding::double[] as v,
    coalesce(b.embedding, a.embedding)::double[] as v1, coalesce(c.embedding, a.embedding)::double[] as v2
    from embeddings a left join embeddings b on b.vec_id = a.vec_id + 1 left join embeddings c on c.vec_id = a.vec_id + 2),
  mixes as (select vec_id, v, list_transform(list_zip(v, v1), lambda e: e[1] + (0.2::double + 0.1::double * (vec_id % 13)) * e[2]) as p,
    list_transform(list_zip(v1, v2), lambda e: e[1] + e[2]) as u from neighbours),
  queries3 as (select vec_id, v, list_transform(p, lambda x: x / sqrt(list_inner_product(p, p))) as p,
    list_transform(u, lambda x: x / sqrt(list_inner_product(u, u))) as u from mixes)"""
LOG = f"""{NEIGHBOURS}, log as (
    select 2 * vec_id as id, v, coalesce(ts, make_timestamp(vec_id * 1000000)) as ts from queries3 left join events on event_id = vec_id
    union all select 2 * vec_id + 1, p, coalesce(ts, make_timestamp(vec_id * 1000000)) from queries3 left join events on event_id = vec_id)"""
ASSIGNED_LOG = f"""{VECTORS}, {ELEMENTS}, {PARAMETERS}, {LOG}, {memberships('log')},
  routes as (select id, k, place from probs where place <= 3)"""
ENTRIES = """entries as (select l.id as entry_id, 'q'||l.id as query, l.v, b.best, l.ts
    from log l join probs_best b on b.id = l.id where l.id % 2 = 0)"""
LOOKUP = """found as (select l.id, entry_id, query, best, e.ts as entry_ts, list_inner_product(l.v, e.v) as score, place
    from log l join routes r on r.id = l.id join entries e on e.best = r.k where l.id % 2 = 1
    qualify row_number() over (partition by l.id order by score desc, place, entry_id) = 1),
  hits as (select * from found where score >= 0.85)"""
CACHE = f"{ASSIGNED_LOG}, {ENTRIES}, {LOOKUP}"


def replayed(pairs: str, capacity: int | None = 10000, slice_rows: int = 1_000_000) -> str:
    """CTEs that end in ``hits(id, entry_id, score)`` for ``seq(id, i)`` numbering the log from 0.

    ``held`` lists the entries from the longest unused to the last used; a slice ends with the last ``capacity``, if there is one.
    """
    held = "case when x.p is not null then list_append(list_filter(r.held, lambda e: e <> x.p), x.p) else list_append(r.held, r.q + 1) end"
    kept = held if capacity is None else f"case when (r.q + 2) % {slice_rows} = 0 then ({held})[-{capacity}:] else {held} end"
    return f"""s as materialized (select qi.i as q, pi.i as p, sc, place from ({pairs}) join seq qi on qi.id = qid join seq pi on pi.id = pid),
  r as (select -1::bigint as q, []::bigint[] as held, null::bigint as m
    union all
    select r.q + 1, {kept}, x.p
    from r left join lateral (select p from s where s.q = r.q + 1 and list_contains(r.held, s.p)
      order by sc desc, place, p limit 1) x on true
    where r.q < (select max(i) from seq)),
  hits as (select sq.id, sp.id as entry_id, s.sc as score from r join s on s.q = r.q and s.p = r.m
    join seq sq on sq.i = r.q join seq sp on sp.i = r.m)"""


SEQUENCE = "seq as (select id, row_number() over (order by id) - 1 as i from log)"
ROUTED_PAIRS = """select a.id as qid, b.id as pid, list_inner_product(a.v, b.v) as sc, r.place from log a
    join routes r on r.id = a.id join probs_best e on e.best = r.k join log b on b.id = e.id
    where b.id < a.id and sc >= 0.85"""
REPLAY = f"{ASSIGNED_LOG}, {SEQUENCE}, {replayed(ROUTED_PAIRS)}"
# The vectors first, then the paraphrases.
TWO_ROUNDS = "seq as (select id, row_number() over (order by id % 2, id) - 1 as i from log)"
TWO_ROUNDS_PAIRS = ROUTED_PAIRS.replace("b.id < a.id", "(b.id % 2, b.id) < (a.id % 2, a.id)")
SMALL_REPLAY = f"{ASSIGNED_LOG}, {TWO_ROUNDS}, {replayed(TWO_ROUNDS_PAIRS, SMALL_CACHE, SLICE)}"


# Queries before the cut and from it on see the entries of their own part only.
CUT = "halves as (select 2 * (max(vec_id) * 2 // 3 + 1) as cut from embeddings)"
FLUSHED_PAIRS = ROUTED_PAIRS + " and (a.id >= (select cut from halves)) = (b.id >= (select cut from halves))"
FLUSHED = f"{ASSIGNED_LOG}, {CUT}, {SEQUENCE}, {replayed(FLUSHED_PAIRS)}"
# Every seventh query has no vector: it is in the log, but finds nothing and is found by none.
NO_VECTOR = (
    f"{ASSIGNED_LOG}, every as (select id from log), vectored as (select id from log where id % 7 <> 0), "
    "seq as (select id, row_number() over (order by id) - 1 as i from vectored), "
    + replayed(ROUTED_PAIRS + " and a.id % 7 <> 0 and b.id % 7 <> 0")
)


def result_lists(source: str) -> str:
    return f"""answers as (select qid, string_agg(category||':'||printf('%.4f', round(score, 4)), ',' order by rank) as result
    from {ranked(source, 5)} group by qid)"""


ANSWER_LOG = f"""with recursive {REPLAY},
  open as (select id, v from log where id not in (select id from hits)),
  scored as (select o.id as qid, x.doc_id, x.category, list_inner_product(o.v, x.v) as score from open o, vectors x),
  {result_lists('scored')}
select l.id as qid, h.entry_id is not null as cache_hit, 'q'||h.entry_id as matched_query, round(h.score, 4) as similarity_score,
  coalesce(a.result, '') as result, coalesce(e.best, b.best) as dominant_cluster, t.probabilities
from log l left join hits h on h.id = l.id left join answers a on a.qid = coalesce(h.entry_id, l.id)
left join probs_best e on e.id = h.entry_id join probs_best b on b.id = l.id join {PROBABILITY_TEXT} t on t.id = l.id"""

TURNS = "turns as (select conv_id * 4294967296 + turn as id, text from conversations where role = 'user' and length(text) >= 1)"
ANSWER_CONVERSATIONS = f"""with recursive {CLEANED_DOCS}, {hash_vectors('docs', 'doc_id', 'cleaned_text', 'doc_vectors')},
  {TURNS}, {hash_vectors('turns', 'id', 'text', 'turn_vectors')},
  log as (select id, vec as v from turn_vectors), {SEQUENCE},
  {replayed("select a.id as qid, b.id as pid, list_inner_product(a.v, b.v) as sc, 0 as place from log a join log b on b.id < a.id where sc >= 0.85", capacity=None)},
  open as (select id, v from log where id not in (select id from hits)),
  scored as (select o.id as qid, x.doc_id, category, list_inner_product(o.v, x.vec) as score
    from open o, doc_vectors x join docs using (doc_id)),
  {result_lists('scored')}
select l.id as qid, h.entry_id is not null as cache_hit, m.text as matched_query, round(h.score, 4) as similarity_score,
  coalesce(a.result, '') as result, 0 as dominant_cluster
from log l left join hits h on h.id = l.id left join answers a on a.qid = coalesce(h.entry_id, l.id)
left join turns m on m.id = h.entry_id"""

SWEEP_ROWS = " union all ".join(
    f"""select {t}::double as threshold, count(*) filter (where score >= {t}) as hits,
  count(*) filter (where not coalesce(score >= {t}, false)) as misses,
  round(count(*) filter (where score >= {t}) / count(*), 6) as hit_rate,
  count(*) filter (where score >= {t} and kind = 'unrelated') as false_positives from best"""
    for t in THRESHOLDS
)

STEP = """updated as (select k, d, sum(p) as n, sum(p * x) / sum(p) as mean, sum(p * x * x) / sum(p) as square
  from probs join probs_x using (id) group by k, d)"""



def rounds(n: int, tag: str = "", start: str = "p0 as (select * from parameters), w0 as (select * from weights)") -> str:
    """CTEs that end in ``p<n>(k, d, mu, var)`` and ``w<n>(k, w)`` after ``n`` rounds from ``start``; names end in ``tag``."""
    steps = [start]
    for i in range(n):
        steps.append(f"""j{i}{tag} as (select e.doc_id as id, k, ln(any_value(w)) + sum(-0.5 * (ln(2 * pi() * var) + (x - mu) * (x - mu) / var)) as l
    from elements e join p{i}{tag} using (d) join w{i}{tag} using (k) group by e.doc_id, k),
  s{i}{tag} as (select id, k, exp(l - max(l) over (partition by id)) as e from j{i}{tag}),
  r{i}{tag} as materialized (select id, k, e / sum(e) over (partition by id) as p from s{i}{tag}),
  w{i + 1}{tag} as materialized (select k, sum(p) / (select count(*) from vectors) as w from r{i}{tag} group by k),
  p{i + 1}{tag} as materialized (select k, d, sum(p * x) / sum(p) as mu,
    sum(p * x * x) / sum(p) - (sum(p * x) / sum(p)) * (sum(p * x) / sum(p)) + 1e-6 as var
    from r{i}{tag} join elements e on e.doc_id = id group by k, d)""")
    return ",\n  ".join(steps)


def grid_fit(k: int) -> str:
    """CTEs that end in ``m<k>(id, k, l)``, the joint log densities after the rounds of a fit with ``k`` components."""
    tag, last = f"_{k}", GRID_ROUNDS
    start = f"""c{tag} as (select row_number() over (order by md5('42:'||doc_id), doc_id) - 1 as k, v from vectors
    order by md5('42:'||doc_id), doc_id limit {k}),
  near{tag} as (select doc_id, k from vectors x, c{tag} c
    qualify row_number() over (partition by doc_id order by list_distance(x.v, c.v), k) = 1),
  p0{tag} as materialized (select k, d, avg(x) as mu, greatest(avg(x * x) - avg(x) * avg(x), 0) + 1e-6 as var
    from near{tag} join elements using (doc_id) group by k, d),
  w0{tag} as materialized (select k, count(*) / (select count(*) from vectors) as w from near{tag} group by k)"""
    return f"""{rounds(last, tag, start)},
  m{tag} as materialized (select e.doc_id as id, k, ln(any_value(w)) + sum(-0.5 * (ln(2 * pi() * var) + (x - mu) * (x - mu) / var)) as l
    from elements e join p{last}{tag} using (d) join w{last}{tag} using (k) group by e.doc_id, k),
  best{tag} as (select id as doc_id, k as own from m{tag} qualify row_number() over (partition by id order by l desc, k) = 1)"""


def grid_row(k: int) -> str:
    return f"""select {k} as k, (select sum(ll) from (select max(l) + ln(sum(exp(l - top))) as ll
      from (select *, max(l) over (partition by id) as top from m_{k}) group by id)) as ll,
    (select 2 * {k} * count(distinct d) + {k} - 1 from elements) as free, (select count(*) from vectors) as n,
    (select avg(case when a is null then 0 else (b - a) / greatest(a, b) end) from
      (select doc_id, any_value(total / n) filter (where own = other and n > 0) as a, min(total / n) filter (where own <> other) as b from
        (select x.doc_id, bx.own, bo.own as other, sum(list_distance(x.v, o.v)) filter (where x.doc_id <> o.doc_id) as total,
            count(*) filter (where x.doc_id <> o.doc_id) as n
          from sample x join best_{k} bx on bx.doc_id = x.doc_id, sample o join best_{k} bo on bo.doc_id = o.doc_id
          group by x.doc_id, bx.own, bo.own) group by doc_id)) as silhouette"""


GRID_SQL = (
    f"with {VECTORS}, {ELEMENTS}, sample as (select * from vectors order by md5('42:'||doc_id), doc_id limit 5000), "
    + ", ".join(grid_fit(k) for k in GRID)
    + f", grid as ({' union all '.join(grid_row(k) for k in GRID)}), "
    "scored as (select k, -2 * ll + free * ln(n) as bic, -2 * ll + 2 * free as aic, silhouette from grid), "
    "won as (select k as winner from scored order by bic, k limit 1) "
    "select k, round(bic, 3) as bic, round(aic, 3) as aic, round(silhouette, 6) as silhouette, k = winner as optimal, "
    f"k = winner and winner in ({min(GRID)}, {max(GRID)}) as at_edge from scored, won"
)
TRAINED_SQL = (
    f"with {VECTORS}, {ELEMENTS}, {grid_fit(GRID[-1])} select id as doc_id, k::integer as dominant_cluster, "
    f"round(1 / sum(exp(l - top)) over (partition by id), 4) as dominant_prob from (select *, max(l) over (partition by id) as top from m_{GRID[-1]}) "
    "qualify row_number() over (partition by id order by l desc, k) = 1"
)


ORACLE_SQL: dict[str, str] = {
    "clean_posts": f"with {POSTS} select doc_id, {cleaned('text')} as cleaned_text from posts",
    "clean_pages": f"select page_id, {cleaned('html')} as cleaned_text from pages",
    "clean_rules": f"with {POSTS}, texts as (select 'd'||filename as id, text from posts "
    "union all select 'p'||page_id, html from pages) select id, "
    + ", ".join(
        f"md5({rule(RULES['remove_non_ascii']('text') if name == 'normalize_whitespace' else 'text')}) as {name}"
        for name, rule in RULES.items()
    )
    + " from texts",
    "dedup_exact": f"with {PLAIN} {first_of('text', 'plain', 'category, filename, text')}",
    "dedup_body": f"with {POSTS}, c as (select *, {cleaned('text')} as cleaned_text from posts) "
    + first_of("cleaned_text", "c", "category, filename, cleaned_text"),
    "corpus_clean_job": f"with {POSTS}, d1 as ({first_of('text', 'posts', 'category, filename, text')}), "
    f"c as (select *, {cleaned('text')} as cleaned_text from d1), "
    f"d2 as ({first_of('cleaned_text', 'c', 'category, filename, text, cleaned_text')}) "
    "select * from d2 where length(cleaned_text) >= 50",
    "clean_step_counts": f"with {CLEANED_MIXED} select count(*) as loaded, count(*) - count(distinct text) as exact_duplicates, "
    "count(distinct text) - count(distinct cleaned_text) as body_duplicates, "
    "count(distinct cleaned_text) filter (where length(cleaned_text) < 50) as too_short, "
    "count(distinct cleaned_text) filter (where length(cleaned_text) >= 50) as remaining from c",
    "corpus_summary": f"with {CLEANED_MIXED}, d as ({first_of('cleaned_text', 'c', '*')}) "
    "select count(*) as documents, count(distinct category) as categories, round(avg(length(cleaned_text)), 6) as mean_length, "
    "min(length(cleaned_text))::integer as min_length, max(length(cleaned_text))::integer as max_length from d where length(cleaned_text) >= 50",
    "saved_corpus": f"with {POSTS}, c as (select *, {cleaned('text')} as cleaned_text from posts), "
    f"d as ({first_of('cleaned_text', 'c', 'category, filename, cleaned_text')}) select * from d where length(cleaned_text) >= 50",
    "posts_tree_job": f"with {MIXED}, tree as (select category, filename, "
    r"regexp_replace(regexp_replace(text, '[^\x{00}-\x{FF}]', '?', 'g'), '\r\n?', chr(10), 'g') as text from mixed), "
    f"c as (select *, {cleaned('text')} as cleaned_text from tree), "
    f"d as (select * from ({first_of('cleaned_text', 'c', '*')}) where length(cleaned_text) >= 50) "
    "select count(*) as loaded, count(*) - count(distinct text) as exact_duplicates, "
    "count(distinct text) - count(distinct cleaned_text) as body_duplicates, "
    "count(distinct cleaned_text) filter (where length(cleaned_text) < 50) as too_short, "
    "count(distinct cleaned_text) filter (where length(cleaned_text) >= 50) as remaining, "
    "(select count(*) from d) as written, (select sum(length(text))::bigint from d) as characters, "
    "(select sum(length(cleaned_text))::bigint from d) as cleaned_characters, (select min(category||'/'||filename) from d) as first_file from c",
    "sample_documents": "select doc_id, source as category from documents order by md5('42:'||doc_id), doc_id limit 5000",
    "sample_some": "select doc_id, source as category from documents "
    "order by md5('7:'||doc_id), doc_id limit (select count(*) // 3 from documents)",
    "rejected_queries": "select role, count(*) filter (where length(text) >= 1) as valid, "
    "count(*) filter (where not coalesce(length(text) >= 1, false)) as rejected from conversations group by role",
    "docs_per_category": "select source as category, count(*) as n from documents group by 1 order by n desc, category",
    "load_totals": "select count(*) as documents, count(distinct source) as categories from documents",
    "first_document": "select source as category, doc_id::varchar as filename, substr(text, 1, 500) as sample "
    "from documents order by 1, 2 limit 1",
    "duplicate_counts": f"with {MIXED} select count(*) - count(distinct text) as exact_duplicates, "
    f"count(*) - count(distinct {body('text')}) as body_duplicates from mixed",
    **{f"profile_{part}": profile_sql(part) for part in PROFILE},
    "profile_pages": f"with pages_text as (select html as text from pages), {FEATURES % 'pages_text'} "
    + "select "
    + ", ".join(f"{e} as {name}" for name, e in PROFILE["markup"].items())
    + " from features",
    "profile_all": profile_all_sql(),
    "hash_embed": f"with {CLEANED_DOCS}, {hash_vectors('docs', 'doc_id', 'cleaned_text', 'vectors')} "
    "select doc_id, array_to_string(list_transform(vec, lambda x: round(x * 1000000)::bigint::varchar), ',') as embedding_e6 from vectors",
    "topk_search": f"with {LABEL_QUERIES} select qid, rank, doc_id, round(score, 6) as score from {ranked('scores', 5)}",
    "topk_all": f"with {LABEL_QUERIES} select qid, count(*) as hits, min(rank) as first_rank, max(rank) as last_rank, "
    "bool_and(place = rank) as in_order from (select *, (row_number() over (partition by qid order by score desc, doc_id))::integer as rank, "
    "row_number() over (partition by qid order by score desc, doc_id) as place from scores) group by qid",
    "topk_none": "select 0::bigint as hits",
    "topk_tiles": f"with {VECTORS}, {LOG}, scores as (select l.id as qid, x.doc_id, list_inner_product(l.v, x.v) as score from log l, vectors x) "
    f"select qid, rank, doc_id, round(score, 6) as score from {ranked('scores', 3)}",
    "search_defaults": f"with {LABEL_QUERIES} select qid, rank, doc_id, case when doc_id % 3 = 0 then 'unknown' else category end as category, "
    "round(score, 6) as score, case when doc_id % 3 = 0 then '' else 'text' end as text, "
    f"case when doc_id % 3 = 0 then '' else doc_id::varchar end as filename from {ranked('scores', 5)}",
    "topk_filtered": f"with {LABEL_QUERIES} select qid, rank, doc_id, round(score, 6) as score "
    f"from {ranked('scores', 5, 'category = wanted')}",
    "topk_overfetch": f"with {LABEL_QUERIES}, fetched as (select * exclude (rank) from {ranked('scores', 25)}) "
    "select qid, rank, doc_id, category, round(score, 6) as score, '' as text, doc_id::varchar as filename "
    f"from {ranked('fetched', 5, 'category = wanted')}",
    "smoke_search": f"with {CLEANED_DOCS}, {hash_vectors('docs', 'doc_id', 'cleaned_text', 'doc_vectors')}, "
    "smoke as (select * from (values "
    + ", ".join(f"({i}::bigint, '{q}')" for i, q in enumerate(SMOKE_QUERIES))
    + f") t(qid, query)), {hash_vectors('smoke', 'qid', 'query', 'smoke_vectors')}, "
    "scores as (select qid, doc_id, category, filename, substr(cleaned_text, 1, 500) as text, "
    "list_inner_product(s.vec, d.vec) as score from smoke_vectors s, doc_vectors d join docs using (doc_id)) "
    f"select qid, rank, doc_id, category, round(score, 6) as score, text, filename from {ranked('scores', 3)}",
    "saved_index": "select doc_id, source as category, doc_id::varchar as filename, substr(text, 1, 500) as snippet, "
    "len(embedding)::integer as dimension from documents join embeddings on vec_id = doc_id % (select max(vec_id) + 1 from embeddings)",
    "tag_clusters": f"with {ASSIGNED} select doc_id, substr(text, 1, 500) as snippet, best as dominant_cluster "
    "from documents left join probs_best on id = doc_id",
    "tag_index": f"with {ASSIGNED} select doc_id, category, best as dominant_cluster from vectors join probs_best on id = doc_id",
    "dominant_cluster": f"with {ASSIGNED} select id as doc_id, best as dominant_cluster, round(top, 6) as dominant_prob from probs_best",
    "confidence_bands": f"with {ASSIGNED} select count(*) as n_documents, "
    + ", ".join(
        f"{posts_if(c)} as {name}_count, printf('%.1f%%', {share(c)}) as {name}_pct"
        for name, c in {"high_confidence": "top > 0.7", "boundary": "top >= 0.3 and top <= 0.5", "uncertain": "top < 0.3"}.items()
    )
    + f", {posts_if('top > 0.5 and top <= 0.7')} as other_count from probs_best",
    "cluster_composition": composition(12, 5, "category||':'||n", ","),
    "cluster_report": composition(10, 3, "category||'('||n||')'", ", "),
    "prob_map_top5": f"with {ASSIGNED} select id as doc_id, probabilities from {PROBABILITY_TEXT}",
    "membership_check": f"with {ASSIGNED}, sums as (select id, sum(p) as total, count(*) as n from probs group by id) "
    "select count(*) as n_documents, min(n)::integer as n_clusters, max(abs(total - 1)) < 1e-5 and min(n) > 1 as is_distribution from sums",
    "pca_variance": f"with {VECTORS}, {ELEMENTS}, centered as (select doc_id, d, x - avg(x) over (partition by d) as x from elements), "
    "cov as (select a.d as i, b.d as j, sum(a.x * b.x) / ((select count(*) from vectors) - 1) as c "
    "from centered a join centered b using (doc_id) group by a.d, b.d), "
    "total as (select sum(c) filter (where i = j) as trace, sum(c * c) as squares, count(distinct i) as n from cov) "
    "select n as components, 1.0::double as share_sum, round(squares / (trace * trace), 6) as share_squares, true as falling from total",
    "pca_projection": f"with {VECTORS}, {ELEMENTS}, spread as (select var_samp(x) as variance from elements group by d) "
    "select (select count(*) from vectors) as n, round(sum(variance), 6) as total_variance, true as centered, true as uncorrelated from spread",
    "saved_model": f"with {ASSIGNED_LOG} select b.id as qid, best as dominant_cluster, round(top, 6) as dominant_prob, "
    "case when b.id % 2 = 0 then (select count(*) from weights)::integer end as known_clusters from probs_best b",
    "saved_reports": composition(10, 5, "category||':'||n", ","),
    "gmm_one_step": f"with {ASSIGNED}, {STEP} select k, (d - 1)::integer as d, round(n / (select count(*) from vectors), 6) as weight, "
    "round(mean, 6) as mean, round(square - mean * mean + 1e-6, 6) as var from updated",
    "gmm_rounds": f"with {VECTORS}, {ELEMENTS}, {PARAMETERS}, {rounds(GMM_ROUNDS)} "
    f"select k, (d - 1)::integer as d, round(w, 6) as weight, round(mu, 6) as mean, round(var, 6) as var "
    f"from p{GMM_ROUNDS} join w{GMM_ROUNDS} using (k)",
    "bic_aic": f"with {ASSIGNED}, fit as (select count(*) as n, sum(lse) as ll from probs where place = 1), "
    "size as (select count(distinct k)::integer as k, count(*) as cells from parameters), "
    "total as (select n, ll, k, 2 * cells + k - 1 as free from fit, size) "
    "select k, n, round(ll, 4) as log_likelihood, round(-2 * ll + free * ln(n), 4) as bic, round(-2 * ll + 2 * free, 4) as aic from total",
    "silhouette_sample": f"""with {VECTORS},
  sample as (select * from vectors order by md5('42:'||doc_id), doc_id limit 5000),
  pairs as (select a.doc_id, a.label as own, b.label as other, a.doc_id = b.doc_id as self, list_distance(a.v, b.v) as dist
    from sample a, sample b),
  sums as (select doc_id, own, other, sum(dist) filter (where not self) as total, count(*) filter (where not self) as n from pairs group by all),
  parts as (select doc_id, any_value(total / n) filter (where own = other and n > 0) as a, min(total / n) filter (where own <> other) as b
    from sums group by doc_id)
select 'label' as labelling, round(avg(case when a is null then 0 else (b - a) / greatest(a, b) end), 6) as silhouette, count(*) as n from parts""",
    "k_selection_rounds": GRID_SQL,
    "train_rounds": TRAINED_SQL,
    "saved_projection": "select count(*) as n, count(*) as same, count(distinct label)::integer as n_clusters from embeddings",
    "pair_similarity": f"with {NEIGHBOURS} select vec_id as pair_id, round(list_inner_product(v, p), 6) as similarity from queries3",
    "cache_lookup": f"with {CACHE} select l.id as qid, h.entry_id is not null as cache_hit, h.query as matched_query, "
    "round(h.score, 6) as score, h.best as dominant_cluster from log l left join hits h on h.id = l.id where l.id % 2 = 1",
    "cache_stats": f"with {CACHE}, counted as (select (select count(*) from entries) as total_entries, (select count(*) from hits) as hit_count, "
    "(select count(*) from log where id % 2 = 1) as probes) select total_entries, hit_count, probes - hit_count as miss_count, "
    "round(hit_count / probes, 4) as hit_rate from counted",
    "cache_admit": f"with {ASSIGNED_LOG} select best as dominant_cluster, count(*) as entries, min(id) as first_entry, "
    "max(id) as last_entry from probs_best group by best",
    "cache_lru": f"with {CACHE}, touched as (select h.entry_id, max(l.ts + interval 1 day) as ts from hits h join log l on l.id = h.id group by all) "
    "select e.entry_id, e.query, strftime(greatest(e.ts, coalesce(t.ts, e.ts)), '%Y-%m-%d %H:%M:%S.%f') as last_accessed "
    "from entries e left join touched t on t.entry_id = e.entry_id "
    f"order by greatest(e.ts, coalesce(t.ts, e.ts)) desc, e.entry_id desc limit {LRU_ENTRIES}",
    "cache_sweep": f"with {NEIGHBOURS}, entries as (select vec_id as entry_id, v from queries3), "
    "probes as (select 'paraphrase' as kind, vec_id, p as v from queries3 union all select 'unrelated', vec_id, u from queries3), "
    "best as (select kind, probes.vec_id, max(list_inner_product(probes.v, entries.v)) as score from probes, entries group by all) "
    + SWEEP_ROWS,
    "cache_replay": f"with recursive {REPLAY} select l.id as qid, h.entry_id is not null as cache_hit, h.entry_id, "
    "round(h.score, 6) as score from log l left join hits h on h.id = l.id",
    "cache_evict": f"with recursive {SMALL_REPLAY} select l.id % 2 * 1000000000 + l.id // 2 as qid, h.entry_id is not null as cache_hit, "
    "h.entry_id % 2 * 1000000000 + h.entry_id // 2 as entry_id, round(h.score, 6) as score from log l left join hits h on h.id = l.id",
    "answer_log": ANSWER_LOG,
    "answer_conversations": ANSWER_CONVERSATIONS,
    "cache_stream": ANSWER_LOG,
    "cache_flush": f"with recursive {FLUSHED}, counted as (select count(*) as n, count(h.id) as hits from log l left join hits h on h.id = l.id "
    "where l.id >= (select cut from halves)) select n - hits as total_entries, hits as hit_count, n - hits as miss_count, "
    "round(hits / n, 4) as hit_rate from counted",
    "cache_no_vector": f"with recursive {NO_VECTOR} select l.id as qid, h.entry_id is not null as cache_hit, h.entry_id from every l left join hits h on h.id = l.id",
}
ORACLE_SQL["saved_bands"] = ORACLE_SQL["confidence_bands"]
