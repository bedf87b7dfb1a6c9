"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from warehaus.llm import licenses, mixing

OP1 = """
with t as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first from t)
select page_id, payload_bytes, payload_digest, case when page_id > first then 'revisit' else 'response' end as record_type,
  case when page_id > first then first end as refers_to
from f
"""

OP4 = """
with t as (select doc_id, sha256(coalesce(text, '')) as h from documents)
select doc_id, max(doc_id) over (partition by h) as keep_id, count(*) over (partition by h) as group_size,
  row_number() over (partition by h order by doc_id desc) = 1 as kept, h as text_sha256
from t
"""

OP6 = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as g from w),
n as (select w.doc_id, count(g) as n from w left join s on w.doc_id = s.doc_id group by w.doc_id),
o as (select a.doc_id as x, b.doc_id as y, count(*) as common from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
  group by 1, 2),
e as (select x, y from o join n a on a.doc_id = x join n b on b.doc_id = y
  where 100 * common >= 85 * (a.n + b.n - common)),
r as (select doc_id as x, doc_id as y from n union select r.x, e.y from r join e on r.y = e.x)
select n.doc_id, n.n as n_shingles, min(r.y) as component_id from n join r on r.x = n.doc_id group by 1, 2
"""


def op3() -> str:
    """Every start of every template is tried, without any index."""
    lists = []
    for t in licenses.templates():
        agree = " + ".join(f"(case when w[i + {j}] = '{x}' then 1 else 0 end)" for j, x in enumerate(t["words"], 1))
        key = " and ".join(f"coalesce(w[i + {t['at'] + j}] = '{x}', false)" for j, x in enumerate(t["key"], 1))
        need = " and ".join(f"list_contains(w, '{x}')" for x in t["key"])
        lists.append(
            f"case when {need} then list_filter(list_transform(range(0 - {len(t['words'])}, len(w)), lambda i: "
            f"{{'start': i, 'label': '{t['label']}', 'base': {str(t['base']).lower()}, "
            f"'share': case when i >= -{t['at']} and {key} then ({agree}) else 0 end, 'need': {t['need']}, 'len': {len(t['words'])}}}), "
            f"lambda x: x.share >= x.need) else [] end")
    places = "list_concat(" * (len(lists) - 1) + lists[0] + "".join(f", {x})" for x in lists[1:])
    return f"""
with t as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from documents),
p as (select doc_id, w, {places} as places from t),
b as (select *, list_filter(places, lambda x: x.base) as base from p)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(base) as bigint) as n_base,
  cast(list_min(list_transform(base, lambda x: x.start)) as bigint) as first_word,
  cast(list_max(list_transform(base, lambda x: x.start)) as bigint) as last_word,
  coalesce(array_to_string(list_sort(list_distinct(list_transform(base, lambda x: x.label))), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x.label))), ','), '') as labels,
  coalesce(list_max(list_transform(places, lambda x: x.share / x.len)), 0.0) as score
from b
"""


def op10() -> str:
    b, e, seed, rows = mixing.BLOCK_WORDS, mixing.MAX_EPOCHS, mixing.SEED, mixing.SHARD_ROWS

    def seats(votes: str, total: str, group: str, rows_in: str) -> str:
        """Sainte-Lague by listing every quotient that could win a seat."""
        return f"""
  select {group}, party, sum(case when n <= seats then 1 else 0 end) as quota from (
    select *, row_number() over (partition by {group} order by v / (2 * k + 1) desc, v desc, party, k) as n from (
      select *, unnest(range(0, cast(ceil(2 * coalesce(v * seats / nullif(sum(v) over (partition by {group}), 0), 0)) as bigint) + 3)) as k
      from (select {group}, party, cast({votes} as double) as v, {total} as seats from {rows_in})))
  group by {group}, party"""

    return f"""
with d as (
  select doc_id, coalesce('s' || source, '~') as place,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
    md5(concat_ws(':', '{seed}', cast(doc_id as varchar))) as key from documents),
n as (select greatest(1, ceil(count(*) / {rows}.0)) as shards from d),
h as (select d.*, cast('0x' || substr(key, 1, 8) as bigint) % cast(shards as bigint) as shard from d, n),
per as (select place, shard as party, cast(sum(size) as bigint) as shard_size from h group by place, shard),
s0 as (select place, cast(sum(shard_size) as bigint) as source_size from per group by place),
s1 as (select *, cast((row_number() over (order by place) - 1) % 3 + 1 as double) as weight,
  cast({e} * source_size as double) as cap from s0),
s2 as (select *, (sum(source_size) over ()
    - coalesce(sum(cap) over (order by cap / weight, place rows between unbounded preceding and 1 preceding), 0.0))
    / sum(weight) over (order by cap / weight, place rows between current row and unbounded following) as level from s1),
s3 as (select *, max(case when level * weight <= cap then level end) over () as met from s2),
s4 as (select place, place as party, 0 as everything, source_size,
  round(least(cap, coalesce(met, 1e300) * weight), 6) as target from s3),
s5 as (select *, cast(round(sum(target) over () / {b}) as bigint) as all_seats from s4),
q as ({seats('target', 'all_seats', 'everything', 's5')}),
g as (select s4.place, source_size, target, q.quota from s4 join q on q.party = s4.place),
p2 as (select per.*, g.quota, source_size, target from per join g on per.place = g.place),
q2 as ({seats('shard_size', 'quota', 'place', 'p2')}),
w0 as (select p2.place, p2.party, p2.source_size, p2.target, p2.shard_size,
  cast(least(q2.quota * {b}, {e} * p2.shard_size) as bigint) as words from p2 join q2 on p2.place = q2.place and p2.party = q2.party),
w1 as (select *, cast(round(target) as bigint) - sum(words) over (partition by place) as owed from w0),
w2 as (select *, case when owed > 0 then {e} * shard_size - words else words end as room from w1),
w3 as (select *, least(room, greatest(abs(owed) - coalesce(sum(room) over (partition by place order by room desc, party
  rows between unbounded preceding and 1 preceding), 0), 0)) as moved from w2),
w as (select place, party, source_size, target, shard_size, cast(words + sign(owed) * moved as bigint) as words from w3),
l as (select h.*, coalesce(sum(size) over (partition by place, shard order by key, doc_id, size
  rows between unbounded preceding and 1 preceding), 0) as start from h)
select doc_id, size, source_size, target, cast(
    (case when shard_size > 0 then words // shard_size else 0 end) * size
    + least(greatest(words - (case when shard_size > 0 then words // shard_size else 0 end) * shard_size - start, 0), size)
  as bigint) as taken
from l join w on l.place = w.place and l.shard = w.party
"""


#: CRC-32 of the decimal text ``{}``, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(regexp_extract_all({}, '.'), lambda c: cast(ascii(c) as bigint))),
  lambda a, x: list_reduce(list_prepend(xor(a, x), [cast(0 as bigint) for z in range(8)]),
    lambda c, z: xor(c >> 1, (c & 1) * 3988292384))), 4294967295)"""

OP11 = """
with recursive d as (
  select doc_id, lang, n_chars, sha256(p_id || p_source || p_lang || coalesce(strlen(n) || ':' || n, '-') || p_text) as leaf,
    sha256(p_id || p_source || p_lang || coalesce(strlen(m) || ':' || m, '-') || p_text) as changed,
    coalesce(@crc % 7 = 0, false) as tampered
  from (select *, coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') as p_id, coalesce(strlen(source) || ':' || source, '-') as p_source,
      coalesce(strlen(lang) || ':' || lang, '-') as p_lang, coalesce(strlen(text) || ':' || text, '-') as p_text,
      cast(n_chars as varchar) as n, cast(cast(n_chars as hugeint) + 1 as varchar) as m from documents)),
l as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
  count(*) over (partition by lang) as n from d),
t as (select lang, 0 as level, pos, n, leaf as h from l
  union all select lang, level + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' order by pos)) from t
  where n > 1 group by lang, level, pos // 2),
g as (select lang, h, row_number() over (order by encode(lang) nulls first) - 1 as pos, count(*) over () as n from t where n = 1),
u as (select 0 as level, pos, n, h from g
  union all select level + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' order by pos)) from u
  where n > 1 group by level, pos // 2),
r as (select h as root from u where n = 1),
ls as (select l.doc_id, l.lang, l.pos, t.level, t.pos & 1 as side, b.h as beside from l
  join t on t.lang is not distinct from l.lang and t.pos = l.pos >> t.level and t.n > 1
  left join t b on b.lang is not distinct from t.lang and b.level = t.level and b.pos = xor(t.pos, 1)),
us as (select g.lang, u.level + 1000 as level, u.pos & 1 as side, b.h as beside from g
  join u on u.pos = g.pos >> u.level and u.n > 1 left join u b on b.level = u.level and b.pos = xor(u.pos, 1)),
s as (select lang, pos, level, side, beside from ls
  union all select l.lang, l.pos, us.level, side, beside from l join us on us.lang is not distinct from l.lang),
p as (select lang, pos, list(case when beside is null then '=' when side = 1 then '<' || beside else '>' || beside end order by level) as path
  from s group by lang, pos),
f as (select l.*, coalesce(path, []) as path, g.h as subroot, root from l left join p on p.lang is not distinct from l.lang and p.pos = l.pos
  join g on g.lang is not distinct from l.lang cross join r),
o as (select *, list_reduce(list_prepend(case when tampered and n_chars is not null then changed else leaf end, path),
  lambda a, x: sha256(case x[1] when '=' then a when '<' then x[2:] || a else a || x[2:] end)) as folded_root from f)
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x[2:]), '')) as proof_sha256,
  folded_root, folded_root = root as verified
from o
""".replace("@crc", CRC32.format("cast(doc_id as varchar)"))


OP12 = """
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
o as (select conv_id, list({'r': role, 't': text} order by turn nulls first, sha256(strlen(role) || ':' || role || text)) as l
  from t group by conv_id),
h as (select *, @crc % 4 as h from o),
c as (select h.conv_id, list_concat(coalesce(b.l[1:h.h], []), h.l[h.h + 1:]) as l
  from h left join o b on b.conv_id = h.conv_id - h.conv_id % 20),
m as (select conv_id, len(l) as turns, l, unnest(range(0, len(l) + 1)) as depth from c),
n as (select l[1:depth] as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
    len(regexp_extract_all(coalesce(l[1:depth][depth].t, ''), '[^\\x20\\x09-\\x0D]+')) as words,
    sha256(coalesce(string_agg(case when depth = turns then conv_id end, ',' order by conv_id), '')) as ends_sha256
  from m group by 1, 2, words),
k as (select path[1:depth - 1] as path, depth - 1 as depth, count(*) as n_children from n where depth > 0 group by 1, 2),
s as (select n.*, coalesce(n_children, 0) as n_children from n left join k on k.path = n.path and k.depth = n.depth),
u as (select path, depth, n_children, (n_convs - 1) * words as saved, unnest(range(0, depth + 1)) as up from s),
f as (select path[1:up] as path, up as depth, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved from u group by 1, 2)
select s.conv_id, cast(s.depth as bigint) as depth, p.conv_id as parent_conv_id, s.n_convs, s.n_children, f.n_leaves,
  cast(f.saved as bigint) as saved_tokens, s.ends_sha256
from s join f on f.path = s.path and f.depth = s.depth
left join n p on s.depth > 0 and p.depth = s.depth - 1 and p.path = s.path[1:s.depth - 1]
""".replace("@crc", CRC32.format("cast(conv_id as varchar)"))


def queries() -> dict[str, str]:
    return {"op1_warc": OP1, "op3_license_scan": op3(), "op4_exact_dedup": OP4, "op6_ngram_jaccard": OP6, "op10_mixing": op10(),
            "op11_merkle": OP11, "op12_prefix_trie": OP12}
