"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

OP11 = r"""
with recursive steps as (
  select list(v order by i) as t from (
    select i, list_reduce([i::bigint] || range(8), lambda a, b: case when a % 2 = 1 then xor(a >> 1, 3988292384::bigint) else a >> 1 end) as v from range(256) r(i))),
each_run as (
  select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents),
runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from each_run where length(run) >= 6 group by all),
bytes as (
  select *, coalesce(doc_id::varchar, '') || ':' || run as named, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as h from runs),
summed as (
  select run, n, xor(4294967295::bigint, list_reduce([4294967295::bigint] || [('0x' || h[2 * k + 1:2 * k + 2])::bigint for k in range(length(h) // 2)],
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) as c from bytes, steps),
written as (
  select case when c % 199 = 0 then substr(run, 1, (c % length(run))::bigint) || substr(run, (c % length(run))::bigint + 2) else run end as word, n from summed),
words as (
  select word, sum(n)::bigint as n from written where length(word) >= 6 group by word having sum(n) >= 5),
gone as (
  select word, n, length(word) as size, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select distinct a.word, b.word as other, b.n as other_n from gone a join gone b on a.i = b.i and a.size = b.size and a.rest = b.rest and a.word <> b.word
  union select a.word, b.word, b.n from gone a join words b on a.rest = b.word
  union select b.word, a.word, a.n from gone a join words b on a.rest = b.word),
best as (
  select *, row_number() over (partition by word order by other_n desc, other) as place, count(*) over (partition by word) as n_near from near),
linked as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.other_n >= 5 * w.n then b.other end as form, case when b.other_n >= 5 * w.n then b.other_n end as form_n
  from words w left join best b on b.word = w.word and b.place = 1),
paths as (
  select word, word as at, form as next from linked
  union all select p.word, l.word, l.form from paths p join linked l on l.word = p.next)
select l.word, l.form, p.at as root, l.n, l.n_near, l.form_n from linked l join paths p on p.word = l.word and p.next is null
"""

OP12 = r"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
first as (select text, min(doc_id) as first from texts group by text),
split as (
  select t.doc_id, t.part, t.text, f.first, list_filter(string_split_regex(t.text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as words from texts t join first f on f.text = t.text),
marked as (
  select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic from labels group by doc_id),
failed as (
  select s.part, coalesce(m.good, false) as good, coalesce(m.toxic, false) as toxic,
    [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text),
     regexp_matches(text, '[#$%&*|]'), coalesce(s.doc_id > s.first, false)] as fails
  from split s left join marked m on m.doc_id = s.doc_id),
combined as (
  select part, good, toxic, fails, count(*) as n, len(list_filter(fails, lambda f: f)) as failing from failed group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as c),
orders as (
  select a.c || b.c || c.c || d.c || e.c as filter_order from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps as (
  select filter_order, step::int as step, [ascii(filter_order[k]) - 64 for k in range(1, step + 1)] as upto from orders, range(1, 6) s(step)),
counted as (
  select part, filter_order, step, upto[step] as filter,
    sum(n * (not list_bool_or([fails[f] for f in upto]))::int) as kept,
    sum(n * (fails[upto[step]] and not coalesce(list_bool_or([fails[f] for f in upto[1:step - 1]]), false))::int) as removed,
    sum(n * (fails[upto[step]] and coalesce(list_bool_or([fails[f] for f in upto[1:step - 1]]), false))::int) as redundant,
    sum(n * (fails[upto[step]] and failing = 1)::int) as unique_fails,
    sum(n * (good and fails[upto[step]] and not coalesce(list_bool_or([fails[f] for f in upto[1:step - 1]]), false))::int) as good_lost,
    sum(n * (toxic and fails[upto[step]] and not coalesce(list_bool_or([fails[f] for f in upto[1:step - 1]]), false))::int) as toxic_lost
  from combined, steps group by all)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, filter))::bigint as shapley
from counted
"""

OP13 = r"""
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from usable q join usable c on c.vec_id <> q.vec_id where q.vec_id % 100 = 0)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 10
"""

ORACLES = {"op11_spelling_variants": OP11, "op12_filter_audit": OP12, "op13_inner_products": OP13}
