"""SQL for the queries whose results it can express, after the contracts and not after the operators' plans."""

from __future__ import annotations

from .license_scan import TEMPLATES

ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
SPACED = r"'[^\x20\x09-\x0D]+'"


def _words(table: str, key: str, pattern: str) -> str:
    return f"select {key}, regexp_extract_all({ASCII.format('coalesce(text, chr(32))')}, {pattern}) as k from {table}"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _case(of: str, values: dict[str, str]) -> str:
    return f"case {of} " + " ".join(f"when {_text(k)} then {_text(v)}" for k, v in values.items()) + " end"


WARC = """with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, upper(sha1(coalesce(html, ''))) as h from pages),
 o as (select h, min(page_id) as owner from p group by 1),
 j as (select p.*, o.owner from p join o using (h))
 select page_id, payload_bytes::bigint as payload_bytes,
 array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 8) * 10 + 1, 10))::bigint >> (35 - 5 * (i % 8))::int) & 31)::int + 1, 1)), '') as payload_digest,
 case when owner = page_id then 'response' else 'revisit' end as record_type, case when owner <> page_id then owner end as refers_to from j"""

#: CRC-32 byte by byte; its table has 256 values by the rule of the reflected polynomial.
_CRC_STEP = "case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
_CRC = f"""t as (select list(c order by n) as crc from (with recursive s as (select n::bigint as n, n::bigint as c, 0 as k from range(256) r(n) union all select n, {_CRC_STEP}, k + 1 from s where k < 8) select n, c from s where k = 8))"""
SHARDING = f"""with recursive {_CRC},
 b as (select doc_id, coalesce(text, '') as text, (strlen(coalesce(text, '')) + 1)::bigint as size from documents),
 x as (select doc_id, size, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda y: ('0x' || y)::bigint) as bytes from b),
 h as (select doc_id, size, xor(list_reduce(bytes, lambda c, y: xor(c >> 8, crc[(xor(c, y) & 255) + 1]), 4294967295::bigint), 4294967295)::bigint as text_crc32 from x cross join t),
 o as (select *, sum(size) over w - size as below, sum(size) over () as total from h window w as (order by text_crc32, doc_id nulls first rows unbounded preceding)),
 s as (select *, least(floor((below::double + size::double / 2) / (total::double / 8)), 7)::int as shard from o)
 select doc_id, size, text_crc32, 'bytes' as law, shard, (row_number() over (partition by shard order by text_crc32, doc_id nulls first) - 1)::bigint as slot, null::int as grown_shard from s"""


def licenses(phrases: dict[str, str]) -> str:
    notices = [(n, [(p + j, w) for p, k in own for j, w in enumerate(k.split())], label) for label, n, own in TEMPLATES]
    notices += [(p, list(enumerate(p.split())), label) for p, label in phrases.items()]
    names = ", ".join(f"({t}, {_text(label)}, {len(keys)}, {t >= len(TEMPLATES)})" for t, (_, keys, label) in enumerate(notices))
    tokens = ", ".join(f"({t}, {j}, {_text(w)})" for t, (n, _, _) in enumerate(notices) for j, w in enumerate(n.split()))
    keys = ", ".join(f"({t}, {p}, {_text(w)})" for t, (_, own, _) in enumerate(notices) for p, w in own)
    return f"""with nm(t, label, size, is_base) as (values {names}), tk(t, j, w) as (values {tokens}), ky(t, p, w) as (values {keys}),
 d as ({_words('documents', 'row_number() over () as r, doc_id', ALNUM)}),
 pos as (select r, unnest(k) as w, unnest(range(len(k))) as i from d),
 df as (select w, count(distinct r) as n from pos where w in (select w from tk) group by 1),
 idf as (select w, greatest(ln(((select count(*) from d) + 1)::double / (coalesce(n, 0) + 1)), 1e-9) as x from (select distinct w from tk) left join df using (w)),
 found as (select r, nm.t, i - p as o from pos join ky using (w) join nm on nm.t = ky.t group by r, nm.t, i - p, nm.size having count(*) = nm.size),
 share as (select f.r, f.t, f.o, sum(case when pos.w is not null then x end) as s from found f join tk using (t) join idf using (w) left join pos on pos.r = f.r and pos.i = f.o + tk.j and pos.w = tk.w group by all),
 whole as (select t, sum(x) as z from tk join idf using (w) group by 1),
 best as (select r, max(s / z) as score from share join whole using (t) join nm using (t) where not is_base group by 1),
 g as (select r, count(*) filter (is_base) as n_base, min(o) filter (is_base) as first_word, max(o) filter (is_base) as last_word,
  array_to_string(list_sort(list(distinct label) filter (is_base)), ',') as base_labels, array_to_string(list_sort(list(distinct label)), ',') as labels from found join nm using (t) group by 1)
 select doc_id, len(k)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
 coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(round(score, 9), 0)::double as score from d left join g using (r) left join best using (r)"""


DECONTAMINATION = f"""with d as ({_words('documents', 'row_number() over () as r, doc_id', ALNUM)}), b as ({_words('benchmark', 'item_id', ALNUM)}),
 win as (select distinct item_id, least(len(k), 10) as n, unnest(list_transform(range(1, greatest(len(k) - 9, 1) + 1), lambda i: array_to_string(list_slice(k, i, i + 9), ' '))) as w from b where len(k) > 0),
 size as (select distinct n from win),
 places as (select r, n, unnest(range(1, len(k) - n + 2)) as i, k from d cross join size where len(k) >= n),
 hit as (select r, i, n, item_id from (select r, i, n, array_to_string(list_slice(k, i, i + n - 1), ' ') as w from places) x join win using (n, w)),
 own as (select r, count(distinct j) as n_hit from (select r, unnest(range(i, i + n)) as j from (select distinct r, i, n from hit)) group by 1),
 its as (select r, count(distinct item_id) as n_items, sha256(array_to_string(list_sort(list(distinct item_id::varchar)), ',')) as items_sha256 from hit group by 1)
 select doc_id, len(k)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated from d left join own using (r) left join its using (r)"""

NGRAM_JOIN = f"""with recursive d as ({_words('documents', 'doc_id', SPACED)}),
 s as (select doc_id, case when len(k) = 0 then [] else list_distinct(list_transform(range(1, greatest(len(k) - 4, 1) + 1), lambda i: array_to_string(list_slice(k, i, i + 4), ' '))) end as own from d),
 c as (select own_key, min(doc_id) as head, any_value(n) as n from (select doc_id, len(own) as n, md5(array_to_string(list_sort(own), chr(10))) as own_key from s where len(own) > 0) group by 1),
 g as (select head, n, unnest(own) as g from c join s on s.doc_id = c.head),
 p as (select a.head as x, b.head as y, a.n + b.n as z, count(*) as shared from g a join g b on a.g = b.g and a.head < b.head and 5 * a.n >= 4 * b.n and 5 * b.n >= 4 * a.n group by 1, 2, 3),
 e as materialized (select x, y from p where 100 * shared >= 80 * (z - shared)),
 l as materialized (select x, y from e union select y, x from e),
 w(x, y) as (select head, head from c union select w.x, l.y from w join l on l.x = w.y),
 m as (select x, min(y) as component_id from w group by 1),
 k as (select doc_id, len(own)::bigint as n_shingles, md5(array_to_string(list_sort(own), chr(10))) as own_key from s)
 select doc_id, n_shingles, case when n_shingles = 0 then doc_id else component_id end as component_id from k left join c using (own_key) left join m on m.x = c.head"""


#: The article of a page as the tables' pages are marked up: one article element, with paragraphs, headings, breaks and these character references.
_BLOCK = "trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))"
HTML_TEXT = f"""with a as (select page_id, url, regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<br>', ' ', 'g') as html from pages),
 b as (select page_id, url, array_to_string(list_filter(list_transform(string_split_regex(html, '</?(?:p|h1)>'), lambda x: {_BLOCK}), lambda x: x <> ''), chr(10)) as text from a)
 select page_id, url, text, length(text) as n_chars from b"""


_M64 = "18446744073709551616::uhugeint"


def _times(a: str, b: str) -> str:
    return f"(({a})::uhugeint * ({b})::uhugeint % {_M64})::ubigint"


def _mixed(source: str, value: str, name: str, columns: str) -> str:
    """``name(columns, v)``: the finaliser of splitmix64 of ``value`` of ``source``, in three steps."""
    return f"""{name}1 as (select {columns}, {_times("xor(x, x >> 30)", "13787848793156543929")} as x from (select {columns}, {value} as x from {source})),
 {name}2 as (select {columns}, {_times("xor(x, x >> 27)", "10723151780598845931")} as x from {name}1),
 {name} as (select {columns}, xor(x, x >> 31) as v from {name}2)"""


_BASE = 0x9E3779B97F4A7C15
_SHINGLE = " + ".join(f"coalesce({_times(f'h{j}', f's[{j + 1}]')}, 0)::uhugeint" for j in range(5))
FINGERPRINTS = f"""with {_mixed("(select unnest(range(1, 6)) as j)", "j::ubigint", "mx", "j")},
 slots as (select list(v | 1 order by j) as s from mx),
 d as (select doc_id, coalesce(text, '') as t from documents),
 n as (select doc_id, t, coalesce(lead(doc_id) over w, max(doc_id) over ()) as after from d window w as (order by doc_id desc)),
 e as (select n.doc_id, n.t, after, substr(n.t, 1, length(n.t) - length(n.t) // 3) || substr(d.t, 1, length(n.t) // 3) as ed from n join d on d.doc_id = after),
 x as (select doc_id, 0 as kind, t as text from e union all select doc_id, 1, ed from e),
 k as ({_words("x", "doc_id, kind", SPACED)}),
 p as (select doc_id, kind, len(k) as n, unnest(k) as w, unnest(range(len(k))) as i from k),
 u as (select w, strlen(w) as size, list_reduce(list_transform(list_reverse(regexp_extract_all(hex(encode(w)), '..')), lambda y: ('0x' || y)::uhugeint), lambda a, y: (a * {_BASE}::uhugeint + y + 1) % {_M64}, 0::uhugeint) as x from (select distinct w from p)),
 {_mixed("u", f"((x + size::uhugeint) % {_M64})::ubigint", "hw", "w")},
 g as (select doc_id, kind, n, i, v as h0, lead(v) over o as h1, lead(v, 2) over o as h2, lead(v, 3) over o as h3, lead(v, 4) over o as h4 from p join hw using (w) window o as (partition by doc_id, kind order by i)),
 {_mixed("(select * from g cross join slots where i = 0 or i + 5 <= n)", f"(({_times('least(n, 5)', str(_BASE))}::uhugeint + {_SHINGLE}) % {_M64})::ubigint", "hs", "doc_id, kind")},
 f as materialized (select distinct doc_id, kind, v from hs),
 low as (select doc_id, kind, min(v) as least, count(*) as n, count(*) filter (v < 2305843009213693952) as few from f group by 1, 2),
 r as materialized (select distinct doc_id, kind, v >> 16 as v from f join low using (doc_id, kind) where v < 2305843009213693952 or few = 0 and v = least),
 z as (select doc_id, kind, count(*) as m, string_agg(printf('%012x', v::bigint), '' order by v) as print from r group by 1, 2),
 pairs as (select doc_id, 'e' as what, doc_id as b, 1 as kb from e union all select doc_id, 'n', after, 0 from e),
 bf as (select pairs.doc_id, what, count(*) as c from pairs join f x on x.doc_id = pairs.doc_id and x.kind = 0 join f y on y.doc_id = b and y.kind = kb and y.v = x.v group by 1, 2),
 br as (select pairs.doc_id, what, count(*) as c from pairs join r x on x.doc_id = pairs.doc_id and x.kind = 0 join r y on y.doc_id = b and y.kind = kb and y.v = x.v group by 1, 2),
 near as (select pairs.doc_id, pairs.what, case when coalesce(la.n, 0) = 0 or coalesce(lb.n, 0) = 0 then (coalesce(la.n, 0) = coalesce(lb.n, 0))::int::double
  when least(za.m, zb.m) >= 64 then coalesce(br.c, 0)::double / least(za.m, zb.m) else coalesce(bf.c, 0)::double / least(la.n, lb.n) end as near
  from pairs left join low la on la.doc_id = pairs.doc_id and la.kind = 0 left join low lb on lb.doc_id = b and lb.kind = kb left join z za on za.doc_id = pairs.doc_id and za.kind = 0 left join z zb on zb.doc_id = b and zb.kind = kb
  left join bf on bf.doc_id = pairs.doc_id and bf.what = pairs.what left join br on br.doc_id = pairs.doc_id and br.what = pairs.what)
 select e.doc_id, length(t) as n_chars, sha256(ed) as edited_sha256, coalesce(z0.print, '') as fingerprint, coalesce(z1.print, '') as edited_fingerprint, ne.near as near_edited, nn.near as near_next
 from e left join z z0 on z0.doc_id = e.doc_id and z0.kind = 0 left join z z1 on z1.doc_id = e.doc_id and z1.kind = 1 join near ne on ne.doc_id = e.doc_id and ne.what = 'e' join near nn on nn.doc_id = e.doc_id and nn.what = 'n'"""
