"""DuckDB SQL for the queries of this subpackage that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = rf"""
with docs as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
items as (select item_id, {_WORDS} as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 10) as k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as phrase
  from items, lateral (select unnest(generate_series(1, greatest(len(w) - 9, 1))) as i)
  where len(w) > 0
),
lengths as (select distinct k from windows),
spots as (
  select r, k, i, array_to_string(w[i : i + k - 1], ' ') as phrase
  from docs, lengths, lateral (select unnest(generate_series(1, len(w) - k + 1)) as i)
),
found as (select distinct r, item_id, k, i from spots join windows using (k, phrase)),
hits as (select r, count(distinct p) as n_hit from (select r, unnest(generate_series(i, i + k - 1)) as p from found) group by r),
ids as (
  select r, count(*) as n_items, string_agg(id, ',' order by id) filter (where id is not null) as ids
  from (select distinct r, item_id::varchar as id from found) group by r
),
spoken as (select r, unnest(w) as t, unnest(generate_series(1, len(w))) as p from docs),
counts as (select t, count(*) as n from spoken group by t),
asked as (select i, item_id, t from (select row_number() over () as i, item_id, unnest(list_distinct(w)) as t from items)),
rare as (
  select i, item_id, t, count(*) over (partition by i) as k
  from (select i, item_id, t, row_number() over (partition by i order by coalesce(n, 0), t) as place from asked left join counts using (t))
  where place <= 5
),
stands as (select i, item_id, k, r, p, t from rare join spoken using (t)),
close as (
  select distinct a.r, a.item_id from stands a join stands b on a.i = b.i and a.r = b.r and b.p between a.p and a.p + 29
  group by a.i, a.item_id, a.k, a.r, a.p having count(distinct b.t) = a.k
),
nears as (select r, count(*) as n_near from close group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated,
       coalesce(n_near, 0)::bigint as n_near
from docs left join hits using (r) left join ids using (r) left join nears using (r)
"""

OP7 = r"""
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
s as (
  select a.r, a.vec_id as query_id, b.r as r2, b.vec_id, list_inner_product(a.e, b.e)::bigint as score
  from v a join v b on a.r <> b.r where a.vec_id % 20 = 0
),
p as (select *, row_number() over (partition by r order by score desc, vec_id, r2) as rank from s)
select query_id, rank::int as rank, vec_id, score from p where rank <= 20
"""

OP4 = r"""
with docs as (select row_number() over () as r, doc_id, encode(coalesce(text, '')) as b, coalesce(text, '') as t from documents),
starts as (select r, unnest(generate_series(1, octet_length(b) - 399)) as p from docs where octet_length(b) >= 400),
spots as (select r, p, p + 400 as e, md5(hex(b[p : p + 399])) as h from starts join docs using (r)),
pieces as (select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, string_split_regex(t, '[^\x20\x09-\x0D]+') as g from docs),
laid as (select r, unnest(generate_series(1, len(w))) as i, unnest(list_transform(w, lambda x: strlen(x))) as n, unnest(list_transform(g[1 : len(w)], lambda x: strlen(x))) as d from pieces where len(w) > 0),
words as (select r, i, n, sum(d + n) over (partition by r order by i) as e from laid),
runs as (select r, e - n + 1 as p, lead(e + 1, 50) over (partition by r order by i) as e from words),
phrases as (select r, p::bigint as p, e::bigint as e, md5(hex(b[p::bigint : e::bigint - 1])) as h from runs join docs using (r) where e is not null),
gone as (select r, p, e from spots where h in (select h from spots group by h having count(*) > 1)),
again as (select r, p, e from phrases where h in (select h from phrases group by h having count(*) > 1)),
edges as (select r, p, e, max(e) over (partition by r order by p, e rows between unbounded preceding and 1 preceding) as before from gone),
islands as (select r, min(p) as p, max(e) as e from (select *, sum(case when before >= p then 0 else 1 end) over (partition by r order by p, e) as k from edges) group by r, k),
edges2 as (select r, p, e, max(e) over (partition by r order by p, e rows between unbounded preceding and 1 preceding) as before from (select * from gone union all select * from again)),
passages as (select r, sum(e - greatest(p, coalesce(before, p))) filter (where before is null or e > before) as n from edges2 group by r),
facts as (select r, count(*) as n_spans, sum(e - p) as n_removed from islands group by r),
kept as (
  select r, lag(e, 1, 1) over (partition by r order by p) as p, p as e from islands
  union all select r, coalesce(max(islands.e), 1), any_value(octet_length(b)) + 1 from docs left join islands using (r) group by r),
rest as (select r, string_agg(hex(b[p : e - 1]), '' order by p) filter (where e > p) as x from kept join docs using (r) group by r)
select doc_id, octet_length(b) as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(x, ''))) as kept_sha256, coalesce(passages.n, 0)::bigint as n_passage
from docs left join facts using (r) left join passages using (r) left join rest using (r)
"""

OP8 = r"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
kinds as (
  select * from (values (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
    (2, 'card', '[0-9]([\x20-]?[0-9])+'), (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]'), (4, 'term', '[^\x00-\x40\x5B-\x60\x7B-\x7F]{4,}')) as k(k, kind, pattern)),
cut as (
  select r, 0 as k, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') as m, string_split_regex(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') as g from docs
  union all select r, 1, regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), string_split_regex(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') from docs
  union all select r, 2, regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'), string_split_regex(t, '[0-9]([\x20-]?[0-9])+') from docs
  union all select r, 3, regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), string_split_regex(t, '\+[0-9][\x20().0-9-]+[0-9]') from docs
  union all select r, 4, regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]{4,}'), string_split_regex(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]{4,}') from docs),
laid as (select r, k, unnest(generate_series(1, len(m))) as i, unnest(m) as v, unnest(list_transform(g[1 : len(m)], lambda x: length(x))) as d from cut where len(m) > 0),
placed as (select r, k, v, regexp_replace(v, '[^0-9]', '', 'g') as num, sum(d + length(v)) over (partition by r, k order by i)::bigint as b from laid),
matched as (
  select r, k, v, b - length(v) as a, b from placed
  where case k when 1 then list_bool_and(list_transform(string_split(v, '.'), lambda x: length(ltrim(x, '0')) < 4 and coalesce(try_cast(nullif(ltrim(x, '0'), '') as int), 0) <= 255))
               when 2 then length(num) between 12 and 19 and list_sum(list_transform(generate_series(1, length(num)), lambda i:
                 case when (length(num) - i) % 2 = 0 then num[i]::int else num[i]::int * 2 - case when num[i]::int > 4 then 9 else 0 end end)) % 10 = 0
               when 3 then length(num) between 9 and 15 else true end),
base as (select * from matched where k < 4),
held as (select distinct r, k || ':' || lower(v) as e from base),
said as (select distinct r, unnest(regexp_extract_all(lower(t), '[^\x00-\x40\x5B-\x60\x7B-\x7F]{4,}')) as w from docs),
df_t as (select w, count(*) as n from said group by w),
df_e as (select e, count(*) as n from held group by e),
pair as (select w, e, count(*) as n from said join held using (r) group by w, e),
total as (select count(*)::double as n from docs),
telling as (
  select distinct w from pair join df_t using (w) join df_e using (e), total
  where log2(total.n / df_e.n) > 0 and log2(total.n * pair.n / (df_t.n * df_e.n)::double) >= 0.8::double * log2(total.n / df_e.n) - 1e-9::double),
terms as (
  select * from matched x where k = 4 and lower(v) in (select w from telling)
  and not exists (select 1 from base y where y.r = x.r and y.a < x.b and x.a < y.b)),
spans as (select r, k, a, b, kind || ':' || a || ':' || b as s from (select r, k, a, b from base union all select r, k, a, b from terms) join kinds using (k)),
sums as (
  select r, count(*) filter (where k = 0) as n_email, count(*) filter (where k = 1) as n_ip, count(*) filter (where k = 2) as n_card, count(*) filter (where k = 3) as n_phone,
         count(*) filter (where k = 4) as n_term, string_agg(s, ',' order by a, k) as spans, string_agg(s, ',' order by a, k) filter (where k < 4) as own
  from spans group by r)
select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone, sha256(coalesce(own, '')) as base_sha256,
       coalesce(spans, '') as spans, coalesce(n_term, 0) as n_term
from docs left join sums using (r)
"""

#: Profiles are learnt from all documents here, as the operator does.
OP9 = r"""
with docs as (
  select row_number() over () as r, doc_id, lang, text, trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}]+', ' ', 'g')) as t,
         coalesce(xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda x: ord(x)::bigint), lambda c, x:
           list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: case when a % 2 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295), 4294967295) % 4 = 2, false) as held_out
  from documents),
padded as (select r, ' ' || t || ' ' as p, held_out, lang, text from docs where t <> ''),
places as (select r, p, unnest(generate_series(1, length(p))) as i from padded),
every as (
  select r, unnest([substr(p, i, 1), case when i < length(p) then substr(p, i, 2) end, case when i + 1 < length(p) then substr(p, i, 3) end]) as g from places),
counted as (select r, g, count(*) as n from every where g is not null and g <> ' ' group by r, g),
coded as (
  select r, g, n, case length(g) when 1 then ord(g)::bigint when 2 then (ord(g)::bigint << 21) + ord(substr(g, 2)) else (ord(g)::bigint << 42) + (ord(substr(g, 2))::bigint << 21) + ord(substr(g, 3)) end as code from counted),
own as (select * from (select r, g, row_number() over (partition by r order by n desc, code) - 1 as rank from coded) where rank < 300),
learnt as (select lang, g, any_value(code) as code, sum(n) as n from coded join padded using (r) where not held_out and lang is not null group by lang, g),
profiles as (select * from (select lang, g, row_number() over (partition by lang order by n desc, code) - 1 as place from learnt) where place < 300),
names as (select distinct lang from profiles),
far as (
  select r, names.lang, sum(coalesce(abs(place - rank), 300))::bigint as far, count(*) as n
  from own cross join names left join profiles on profiles.lang = names.lang and profiles.g = own.g group by all),
best as (select r, lang, 1.0::double - far / (300 * n)::double as score from (select *, row_number() over (partition by r order by far, lang) as nth from far) where nth = 1)
select doc_id, held_out, coalesce(best.lang, 'und') as lang_pred, coalesce(score, 0.0::double) as score from docs left join best using (r)
"""

ORACLE = {"op4_suffix_dedup": OP4, "op6_decontamination": OP6, "op7_topk": OP7, "op8_pii": OP8, "op9_language_id": OP9}
