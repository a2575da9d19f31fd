"""The same results in plain SQL, for the queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
with low as (select row_number() over () as r, doc_id, {WORDS} as ws from documents),
items as (select cast(item_id as varchar) as name, {WORDS} as ws from benchmark where text is not null),
starts as (select name, ws, least(10, len(ws)) as n, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as i from items where len(ws) > 0),
win as (select distinct name, n, array_to_string(ws[i:i + n - 1], ' ') as w from starts),
places as (select r, ws, n, unnest(range(1, len(ws) - n + 2)) as i from low, (select distinct n from win) where len(ws) >= n),
found as (select r, i, n, name from (select r, i, n, array_to_string(ws[i:i + n - 1], ' ') as w from places) join win using (n, w)),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from found) group by r),
named as (select r, count(distinct name) as n_items, string_agg(distinct name, ',' order by name) as names from found group by r)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from low left join hit using (r) left join named using (r)"""

MIXING = r"""
with d as (select doc_id, cast(source as varchar) as source, md5(coalesce(cast(doc_id as varchar), '')) as h,
                  cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
per as (select source, cast(sum(size) as bigint) as source_size from d group by source),
placed as (select *, row_number() over (order by source nulls last) as place from per),
weighed as (select *, case (place - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight, 3 * source_size as cap,
                   cast(sum(source_size) over () as bigint) as total from placed),
levels as (select *, (total - coalesce(sum(cap) over (order by cap / weight, place rows between unbounded preceding and 1 preceding), 0))
                     / sum(weight) over (order by cap / weight, place rows between current row and unbounded following) as level,
                  greatest(1, (total + 1048575) // 1048576) as block from weighed),
goals as (select *, least(cast(cap as double), weight * max(level) over ()) as target from levels),
ends as (select *, sum(target) over (order by place rows unbounded preceding) / sum(target) over () as hi,
                (source_size + block - 1) // block as blocks from goals),
lines as (select *, coalesce(lag(hi) over (order by place), 0) as lo from ends),
slots as (select i, (i * cast(0.6180339887498949 as double)) % 1 as point
          from (select unnest(range(1, (max(total) + max(block) - 1) // max(block) + 1)) as i from lines)),
ranked as (select place, blocks, row_number() over (partition by place order by i) - 1 as rank
           from slots join lines on point >= lo and point < hi),
times as (select place, rank % blocks as b, count(*) as n from ranked where rank < 3 * blocks group by all),
docs as (select row_number() over () as r, doc_id, size, source_size, target, place, block,
                cast(coalesce(sum(size) over (partition by place order by h, doc_id nulls first, size
                                              rows between unbounded preceding and 1 preceding), 0) as bigint) as start
         from d join lines on d.source is not distinct from lines.source),
pieces as (select *, unnest(range(start // block, (start + size - 1) // block + 1)) as b from docs where size > 0),
taken as (select r, cast(sum((least((b + 1) * block, start + size) - greatest(b * block, start)) * n) as bigint) as taken
          from pieces join times using (place, b) group by r)
select doc_id, size, source_size, target, coalesce(taken, 0) as taken from docs left join taken using (r)"""


# the least significant bit first, as zlib counts it
CRC_BYTE = "list_reduce(list_prepend(({byte}), range(8)), lambda a, k: xor(a >> 1, 3988292384 * (a & 1)))"
CRC32 = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda c: cast(ascii(c) as bigint))), "
         "lambda s, b: xor(s >> 8, " + CRC_BYTE.format(byte="xor(s, b) & 255") + ")), 4294967295)")

TRIE = rf"""
with t as (select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
own as (select c, role, text, row_number() over (partition by c order by turn nulls first, role, md5(octet_length(encode(role)) || ':' || role || text)) as k from t),
ids as (select distinct c, {CRC32.format(text="cast(c as varchar)")} % 4 as h from own),
rows_ as (select i.c, k, role, text from ids i join own b on b.c = i.c - i.c % 20 and b.k <= i.h
          union all
          select i.c, k - i.h + (select count(*) from own b where b.c = i.c - i.c % 20 and b.k <= i.h), role, text
          from ids i join own o on o.c = i.c and o.k > i.h),
seqs as (select i.c, coalesce(list(md5(role) || md5(text) order by k) filter (k is not null), []) as ids,
                coalesce(list(len(regexp_extract_all(text, '[^ 	-
]+')) order by k) filter (k is not null), []) as ws
         from ids i left join rows_ r on r.c = i.c group by i.c),
steps as (select c, ids, ws, unnest(range(0, len(ids) + 1)) as d from seqs),
nodes as (select d, ids[1:d] as path, min(c) as conv_id, count(*) as n_convs, any_value(case when d > 0 then ws[d] else 0 end) as w,
                 coalesce(string_agg(cast(c as varchar), ',' order by c) filter (len(ids) = d), '') as ends
          from steps group by 1, 2),
kids as (select d - 1 as d, path[1:d - 1] as path, count(*) as n from nodes where d > 0 group by all),
full_ as (select n.*, coalesce(k.n, 0) as n_children from nodes n left join kids k using (d, path)),
below as (select a.d, a.path, count(*) filter (b.n_children = 0) as n_leaves, sum((b.n_convs - 1) * b.w) as saved
          from full_ a join full_ b on b.d >= a.d and b.path[1:a.d] = a.path group by all)
select f.conv_id, cast(f.d as bigint) as depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, b.n_leaves,
       cast(b.saved as bigint) as saved_tokens, sha256(f.ends) as ends_sha256
from full_ f join below b using (d, path) left join nodes p on p.d = f.d - 1 and p.path = f.path[1:f.d - 1]"""

TERMS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED = f"""
with d as (select row_number() over () as r, doc_id, {TERMS} as ts from documents),
counts as (select cast(count(*) filter (len(ts) > 0) as bigint) as n_docs, cast(sum(len(ts)) as bigint) as n_terms from d),
tf as (select r, t, count(*) as tf from (select r, unnest(ts) as t from d) group by all),
w as (select t, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
      from tf, counts group by t, n_docs),
items as (select row_number() over () as i, item_id, ts from (select distinct item_id, {TERMS} as ts, text from benchmark where text is not null)),
asked as (select i, t, count(*) as times from (select i, unnest(ts) as t from items) group by all),
scores as (select i, r, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(ts) * n_docs) // n_terms)))) as bigint) as score
           from asked join tf using (t) join w using (t) join d using (r), counts group by i, r),
ranked as (select i, r, score, row_number() over (partition by i order by score desc, doc_id nulls first) as rank
           from scores join d using (r) where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked join d using (r) join items using (i) where rank <= 10"""

PASSAGES = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
starts as (select r, unnest(range(1, len(ws) - 33)) as i from d where len(ws) >= 35),
named as (select r, i, md5(array_to_string(ws[i:i + 34], ' ')) as w from starts join d using (r)),
twice as (select w from named group by w having count(*) > 1),
gone as (select r, list(distinct p) as ps from (select r, unnest(range(i, i + 35)) as p from named join twice using (w)) group by r),
flagged as (select d.r, unnest(ws) as word, generate_subscripts(ws, 1) as p from d),
kept as (select f.r, string_agg(word, ' ' order by p) as rest from flagged f left join gone g on g.r = f.r
         where ps is null or not list_contains(ps, cast(p as bigint)) group by f.r)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(len(ps), 0) as bigint) as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from d left join gone using (r) left join kept using (r)"""


REPEATS = """
with d as (select row_number() over (order by doc_id) as r, doc_id, encode(coalesce(text, '')) as b from documents),
starts as (select r, unnest(range(1, octet_length(b) - 98)) as s,
                  unnest(list_transform(range(1, octet_length(b) - 98), lambda s: md5(b[s:s + 99]))) as w from d where octet_length(b) >= 100),
seen as (select r, s, row_number() over (partition by w order by r, s) > 1 as repeated from starts),
marked as (select r, s, s > coalesce(lag(s) over (partition by r order by s) + 100, 0) as opens from seen where repeated),
runs as (select r, s, count_if(opens) over (partition by r order by s) as run from marked),
spans as (select r, run, min(s) as lo, max(s) + 100 as hi from runs group by r, run),
gaps as (select r, coalesce(lag(hi) over (partition by r order by lo), 1) as kept_from, lo as kept_to from spans
         union all select d.r, coalesce(max(hi), 1), any_value(octet_length(b)) + 1 from d left join spans using (r) group by d.r),
kept as (select r, string_agg(case when kept_from < kept_to then hex(b[kept_from:kept_to - 1]) else '' end, '' order by kept_from, kept_to) as h
         from gaps join d using (r) group by r),
removed as (select r, cast(sum(hi - lo) as bigint) as n_removed, count(*) as n_spans from spans group by r)
select doc_id, cast(octet_length(b) as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(h)) as kept_sha256
from d join kept using (r) left join removed using (r)"""


NEARDUP = rf"""
with recursive d as (select doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') as ws from documents),
places as (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as i from d where len(ws) > 0),
shingles as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as s from places),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as x, b.doc_id as y, count(*) as shared from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (select x, y from common join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * shared >= 75 * (a.n + b.n - shared)),
steps as (select x, y from links union all select y, x from links),
reached as (select doc_id, doc_id as other from d union select doc_id, y from reached join steps on x = other),
least_of as (select doc_id, min(other) as component_id from reached group by doc_id)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from d join least_of using (doc_id) left join sizes using (doc_id)"""


# letters in either case are written out: the flag for it would let other alphabets' letters in
def either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" for c in word)


# The kinds in their order, their patterns and what a match must have.
SECRET_KINDS = (
    ("assign", "(" + "|".join(map(either, ("password", "passwd", "secret", "token"))) + "|" + either("api") + "_?" + either("key") + ")"
     r"[\"\x27]?\x20*[:=]\x20*[\"\x27]?([A-Za-z0-9+/_.=-]+)", "length(regexp_extract(hit, '{pattern}', 2)) >= 8"),
    ("access", "AKIA[A-Z0-9]+", "length(hit) >= 16"),
    ("hex", "[0-9a-f]{32,}", "true"),  # the whole runs of 32 and more
    ("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", "true"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", "true"),
)
SECRETS = """
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
""" + ",\n".join(f"""
{kind}_pieces as (select r, unnest(range(len(hits) + 1)) as i, unnest(pieces) as piece, unnest(list_append(hits, null)) as hit
    from (select r, string_split_regex(t, '{pattern}') as pieces, regexp_extract_all(t, '{pattern}') as hits from d)),
{kind}_spans as (select r, {k} as k, '{kind}' as kind, start, start + length(hit) as stop
    from (select r, hit, sum(length(piece)) over before + coalesce(sum(length(hit)) over (before rows between unbounded preceding and 1 preceding), 0) as start
          from {kind}_pieces window before as (partition by r order by i))
    where hit is not null and {holds.format(pattern=pattern) if '{pattern}' in holds else holds})""" for k, (kind, pattern, holds) in enumerate(SECRET_KINDS)) + """,
spans as (""" + " union all ".join(f"select * from {kind}_spans" for kind, _, _ in SECRET_KINDS) + """),
listed as (select r, count_if(k = 0) as n_assign, count_if(k = 1) as n_access, count_if(k = 2) as n_hex,
                  string_agg(kind || ':' || start || ':' || stop, ',' order by start, k) filter (k < 3) as base,
                  string_agg(kind || ':' || start || ':' || stop, ',' order by start, k) as spans from spans group by r)
select doc_id, cast(coalesce(n_assign, 0) as bigint) as n_assign, cast(coalesce(n_access, 0) as bigint) as n_access,
       cast(coalesce(n_hex, 0) as bigint) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join listed using (r)"""
