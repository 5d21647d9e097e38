"""Registered queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from .bagminhash import op10_bagminhash
from .imatch import SUBSETS, op12_imatch
from .lpt_shards import op5_lpt_shards
from .maxent_lm import op2_maxent_lm
from .quality_divergence import op8_quality_divergence
from .simhash_windows import op6_simhash_windows
from .site_lines import op9_site_lines
from .source_schedule import op3_mix_sources
from .threshold_search import op13_threshold_search
from .token_scan import op1_token_scan
from .turn_repair import op11_turn_repair
from .warc_revisit import op4_warc_revisit
from .zstd_toxicity import op7_zstd_toxicity

QUERIES = {
    "op1_token_scan": op1_token_scan,
    "op2_maxent_lm": op2_maxent_lm,
    "op3_mix_sources": op3_mix_sources,
    "op4_warc_revisit": op4_warc_revisit,
    "op5_lpt_shards": op5_lpt_shards,
    "op6_simhash_windows": op6_simhash_windows,
    "op7_zstd_toxicity": op7_zstd_toxicity,
    "op8_quality_divergence": op8_quality_divergence,
    "op9_site_lines": op9_site_lines,
    "op10_bagminhash": op10_bagminhash,
    "op11_turn_repair": op11_turn_repair,
    "op12_imatch": op12_imatch,
    "op13_threshold_search": op13_threshold_search,
}

_GAP = "[\\x20\\x09-\\x0D]+"

_NO_TERM = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

_BELOW = ", ".join(f"'{256 >> k:02x}'" for k, n in enumerate(SUBSETS, 1) for _ in range(n))

_TAGS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul"

ORACLES = {
    "op4_warc_revisit": """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
d as (select page_id, payload_bytes, list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31), 1)), 'string_agg', '') as payload_digest from p)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when page_id = max(page_id) over g then 'response' else 'revisit' end as record_type,
  case when page_id <> max(page_id) over g then max(page_id) over g end as refers_to
from d window g as (partition by payload_digest)
""",
    "op6_simhash_windows": r"""
with icut as materialized (select item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D!-/:-@\[-`{-~]+'), lambda w: w <> '') as a from benchmark),
its as materialized (select item_id, md5_number(array_to_string(a[p + 1 : p + 5], ' ')) as s from (select item_id, a, unnest(range(0, len(a) - 4)) as p from icut where len(a) >= 5)),
want as materialized (select item_id, s, c, sum(c) over (partition by item_id)::bigint as m from (select item_id, s, count(*) as c from its group by item_id, s)),
cut as materialized (select doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D!-/:-@\[-`{-~]+'), lambda w: w <> '') as a from documents),
ds as materialized (select doc_id, p, n, md5_number(array_to_string(a[p + 1 : p + 5], ' ')) as s from (select doc_id, a, len(a) - 4 as n, unnest(range(0, len(a) - 4)) as p from cut where len(a) >= 5) group by all),
of_s as materialized (select s, list({'item_id': item_id, 'c': c, 'm': m}) as items from want group by s),
hit as materialized (select doc_id, x.item_id as item_id, p, s, n, x.c as c, x.m as m from (select doc_id, p, s, n, unnest(found) as x
  from (select *, max(items) over (partition by s) as found from (select doc_id, p, n, s, null as items from ds union all select null, null, null, s, items from of_s)) where p is not null and found is not null)),
pair as materialized (select doc_id, item_id, m, least(m, n) as w, n, min(p) as lo, max(p) as hi, list({'p': p, 's': s, 'c': c}) as hits from hit group by doc_id, item_id, m, n),
win as materialized (select doc_id, item_id, m, w, hits, unnest(range(greatest(0, lo - m + 1), least(n - w, hi) + 1)) as start from pair),
near as materialized (select doc_id, item_id, m, w, start, unnest(list_filter(hits, lambda x: x.p >= start and x.p < start + w)) as x from win),
got as materialized (select doc_id, item_id, m, w, start, x.s as s, x.c as c, count(*) as k from near group by doc_id, item_id, m, w, start, x.s, x.c),
alike as materialized (select doc_id, item_id, w, start, sum(least(k, c)) / (w + m - sum(least(k, c))) as similarity from got group by doc_id, item_id, m, w, start)
select doc_id, item_id, best.a::double as similarity, (-best.b)::bigint as first_word, (best.w + 4)::bigint as words
from (select doc_id, item_id, max({'a': similarity, 'b': -start, 'w': w}) as best from alike where similarity >= 0.8 group by doc_id, item_id)
""",
    "op8_quality_divergence": rf"""
with d as (select doc_id, text, case when lang is null then 'null' else '=' || lang end as key,
    coalesce(list_filter(regexp_split_to_array(text, '{_GAP}'), lambda w: w <> ''), []::varchar[]) as words from documents),
r as (select d.*, key as ref from d),
m as (select doc_id, key, ref, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
    coalesce(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')), 0)::bigint as n_symbols,
    coalesce(len(lines) - len(list_distinct(lines)), 0)::bigint as n_dup_lines,
    coalesce(length(regexp_replace(text, '[^\p{{Ll}}]+', '', 'g')), 0) as lo, coalesce(length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')), 0) as up,
    coalesce(length(regexp_replace(text, '[^\p{{Nd}}]+', '', 'g')), 0) as di, coalesce(length(regexp_replace(text, '[^.,;:!?''"()-]+', '', 'g')), 0) as pu
  from (select *, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines from r)),
w as (select doc_id, key, ref, unnest(range(1, len(words) + 1)) as i, unnest(words) as word from r),
t as (select *, case when lead(word, 2) over o is not null then word || chr(1) || lead(word) over o || chr(1) || lead(word, 2) over o end as tri from w window o as (partition by doc_id order by i)),
s as (select doc_id, i, case when tri is not null and count(*) over (partition by doc_id, tri) > 1 then 1 else 0 end as again from t),
rep as (select doc_id, sum(c)::bigint as n_repeat_words from (select doc_id, max(again) over (partition by doc_id order by i rows between 2 preceding and current row) as c from s) group by doc_id),
cnt as (select key, lower(word) as word, count(*) as n from w group by all),
top as (select * from (select *, row_number() over (partition by key order by n desc, word) as rk, sum(n) over (partition by key) as all_words from cnt) where rk <= 12),
rest as (select key, any_value(all_words) as all_words, 1 - sum(n) / any_value(all_words) as r from top group by key),
lim as (select key, all_words, least(0.3, 0.9 * sqrt(greatest(((1 - r) + log2(2 / (1 + r)) + case when r > 0 then r * log2(2 * r / (1 + r)) else 0 end) / 2, 0))) as word_limit from rest),
chars as (select key, sum(word_chars) as all_chars from m group by key),
cls as (select doc_id, key, ref, unnest(['lo', 'up', 'di', 'pu', 'sy', 'ot']) as c, unnest([lo, up, di, pu, n_symbols, word_chars - lo - up - di - pu - n_symbols]) as x from m),
refc as (select key, c, sum(x) as y from cls group by all),
docw as (select m.doc_id, m.ref, top.rk, top.n as y, (select count(*) from w where w.doc_id = m.doc_id and lower(w.word) = top.word) as x from m join top on top.key = m.ref),
hw as (select doc_id, x, y from docw union all
  select m.doc_id, m.n_words - coalesce(sum(docw.x), 0), any_value(a.all_words) - sum(docw.y) from m join docw using (doc_id) join (select distinct key, all_words from top) a on a.key = m.ref group by m.doc_id, m.n_words),
hc as (select cls.doc_id, x, y from cls join refc on refc.key = cls.ref and refc.c = cls.c),
js as (select 'w' as k, doc_id, x / greatest(sum(x) over (partition by doc_id), 1) as p, y / greatest(sum(y) over (partition by doc_id), 1) as q from hw union all
  select 'c', doc_id, x / greatest(sum(x) over (partition by doc_id), 1), y / greatest(sum(y) over (partition by doc_id), 1) from hc),
dist as (select doc_id, k, sqrt(greatest(sum(case when p > 0 then p * log2(2 * p / (p + q)) else 0 end + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2, 0)) as v from js group by all)
select m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words, base_failed,
  not base_failed and (word_chars < 200 or all_chars - word_chars < 2000 or c.v <= 0.3) and (n_words < 100 or all_words - n_words < 1000 or w.v <= word_limit) as kept,
  round(c.v, 6) as class_distance, round(coalesce(w.v, 0), 6) as word_distance
from (select *, n_words < 50 or 100 * coalesce(n_repeat_words, 0) > 50 * n_words as base_failed from m left join rep using (doc_id)) m
join dist c on c.doc_id = m.doc_id and c.k = 'c' left join dist w on w.doc_id = m.doc_id and w.k = 'w' join chars on chars.key = m.key left join lim on lim.key = m.key
""",
    "op9_site_lines": rf"""
with t as (select page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') as host,
  regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[ >].*?</script *>|<style[ >].*?</style *>|<!--.*?-->', '', 'g'),
    '(?i)</?(?:{_TAGS})(?:[ \t\r\n/][^>]*)?>', chr(10), 'g'), '<[^>]*>', '', 'g') as text from pages),
u as (select page_id, host, replace(replace(replace(replace(replace(replace(text, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') as text from t),
v as (select page_id, host, trim(regexp_replace(regexp_replace(text, '[ \t\x0B\f]+', ' ', 'g'), ' ?[\r\n]+[ \r\n]*', chr(10), 'g'), ' ') as text from u),
l as (select page_id, host, i, line from (select page_id, host, unnest(range(1, len(a) + 1)) as i, unnest(a) as line from (select page_id, host, string_split(text, chr(10)) as a from v)) where line <> ''),
s as (select host, count(*) as host_pages from t where host is not null group by host having count(*) >= 5),
f as (select host, line from (select host, line, count(distinct page_id) as n from l group by all) join s using (host) where n / host_pages > 0.3),
k as (select l.page_id, count(*) as n_lines, count(f.line) as n_dropped, string_agg(l.line, chr(10) order by i) filter (f.line is null) as text
  from l left join f on f.host = l.host and f.line = l.line group by l.page_id)
select t.page_id, t.host, s.host_pages, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_dropped, 0)::bigint as n_dropped, coalesce(k.text, '') as text
from t left join s on s.host = t.host left join k on k.page_id = t.page_id
""",
    "op3_mix_sources": rf"""
with docs as (
  select doc_id, source, md5(text) as seed, coalesce(len(list_filter(regexp_split_to_array(text, '{_GAP}'), lambda x: x <> '')), 0)::bigint as size
  from documents),
src as (select source, sum(size)::bigint as source_size from docs group by source),
num as (select *, row_number() over (order by source nulls last) as source_no from src),
w as (select *, (((source_no - 1) % 3) + 1)::double as w, source_size * 3.0::double as cap from num),
lv as (select *, cap / w as lvl, sum(source_size::double) over () as total, sum(w) over () as weight from w),
fill as (
  select *, coalesce(sum(cap) over b, 0) as caps_before, coalesce(sum(w) over b, 0) as w_before from lv
  window b as (order by lvl, source nulls last rows between unbounded preceding and 1 preceding)),
cp as (select *, caps_before + lvl * (weight - w_before) <= total as capped from fill),
sp as (select *, coalesce(sum(cap) filter (capped) over (), 0) as spent, coalesce(sum(w) filter (not capped) over (), 0) as open from cp),
tgt as (select source, source_no, source_size, case when capped then cap else w * (total - spent) / open end as target from sp),
sh as (
  select source_no, ceil(source_size / 64.0)::bigint as blocks, target * ceil(source_size / 64.0)::bigint / source_size as slots
  from tgt where source_size > 0),
cum as (select *, sum(slots) over () as n_all, sum(slots) over (order by source_no) as upto from sh),
iv as (select *, (upto - slots) / n_all as lo from cum),
points as (
  select k as slot, (k + 1) * 0.6180339887498949::double - floor((k + 1) * 0.6180339887498949::double) as u
  from (select unnest(range(0, (select ceil(max(n_all))::bigint from iv))) as k)),
hit as (select p.slot, i.source_no, i.blocks from points p asof join iv i on p.u >= i.lo),
rk as (select *, row_number() over (partition by source_no order by slot) - 1 as r from hit),
times as (select source_no, r % blocks as block, count(*) as times from rk where r < blocks * 3 group by all),
lay as (
  select d.doc_id, d.source, d.size, t.source_no, t.source_size, t.target,
    coalesce(sum(d.size) over (partition by t.source_no
      order by ('0x' || substr(h, 1, 4))::int % 256, h, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from (select *, md5('mix:' || coalesce(doc_id::varchar, seed, 'null')) as h from docs where size > 0) d
  join tgt t on d.source is not distinct from t.source),
pc as (
  select *, unnest(range(((start + 1) * n - 1) // source_size, ((start + size) * n - 1) // source_size + 1)) as block
  from (select *, ceil(source_size / 64.0)::bigint as n from lay)),
tk as (
  select p.source_no, p.start,
    sum((least(start + size, (p.block + 1) * source_size // n) - greatest(start, p.block * source_size // n)) * times)::bigint as taken
  from pc p join times using (source_no, block) group by all)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken from lay left join tk using (source_no, start)
union all
select doc_id, size, source_size, target, 0::bigint from docs join tgt on docs.source is not distinct from tgt.source where size = 0
""",
    "op11_turn_repair": r"""
with recursive
k as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
c as (select *, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, len(key) + 1), lambda i: ascii(key[i])::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 as f from k),
d as (select conv_id, turn, case when f = 4 then 'user' else role end as role, case when f = 1 then '' when f = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
  unnest(range(case when f = 3 then 2 else 1 end)) as copy from c where f <> 0),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare from d),
m as (select *, bare = '' as blank, bare <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as again,
  lag(role) over (partition by conv_id order by i) as before from o),
t as (select *, not blank and not again and right(bare, 1) not in ('.', '!', '?') as cut, blank or again as gone from m),
n as (select conv_id, max(i) as n, case when count(turn) > 0 then max(turn) - min(turn) + 1 - count(distinct turn) else 0 end as gaps, count(*) filter (blank) as blank, count(*) filter (again) as duplicate,
  count(*) filter (cut) as truncated, count(*) filter (before is not null and left(before, 1) || left(role, 1) not in ('su', 'ua', 'au')) as illegal from t group by conv_id),
go as (
  select conv_id, n + 1 as i, {'c': 0::bigint, 'a': '', 'r': ''} as v0, {'c': 6::bigint, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'} as v1,
    {'c': 3::bigint, 'a': 'I', 'r': chr(10) || 'assistant:'} as v2, {'c': 0::bigint, 'a': '', 'r': ''} as v3 from n
  union all
  select conv_id, i, list_sort([w0, {'c': w2.c + 3, 'a': 'I' || w2.a, 'r': chr(10) || 'user:' || w2.r}, {'c': w3.c + 6, 'a': 'II' || w3.a, 'r': chr(10) || 'user:' || chr(10) || 'assistant:' || w3.r}])[1],
    list_sort([w1, {'c': w2.c + 3, 'a': 'I' || w2.a, 'r': chr(10) || 'user:' || w2.r}, {'c': w3.c + 6, 'a': 'II' || w3.a, 'r': chr(10) || 'user:' || chr(10) || 'assistant:' || w3.r}])[1],
    list_sort([w2, {'c': w3.c + 3, 'a': 'I' || w3.a, 'r': chr(10) || 'assistant:' || w3.r}])[1],
    list_sort([w3, {'c': w2.c + 3, 'a': 'I' || w2.a, 'r': chr(10) || 'user:' || w2.r}])[1]
  from (select t.conv_id, t.i,
      list_sort([{'c': v0.c + 4, 'a': 'D' || v0.a, 'r': v0.r}, {'c': v1.c + 3 * cut::int + 1000000 * (gone or left(role, 1) <> 's')::int, 'a': 'K' || v1.a, 'r': chr(10) || role || ':' || text || v1.r},
        {'c': v2.c + 3 * cut::int + 1000000 * (gone or left(role, 1) <> 'u')::int, 'a': 'K' || v2.a, 'r': chr(10) || role || ':' || text || v2.r},
        {'c': v2.c + 3 + 3 * cut::int + 1000000 * gone::int, 'a': 'R' || v2.a, 'r': chr(10) || 'user:' || text || v2.r}])[1] as w0,
      list_sort([{'c': v1.c + 4, 'a': 'D' || v1.a, 'r': v1.r}, {'c': v2.c + 3 * cut::int + 1000000 * (gone or left(role, 1) <> 'u')::int, 'a': 'K' || v2.a, 'r': chr(10) || role || ':' || text || v2.r},
        {'c': v2.c + 3 + 3 * cut::int + 1000000 * gone::int, 'a': 'R' || v2.a, 'r': chr(10) || 'user:' || text || v2.r}])[1] as w1,
      list_sort([{'c': v2.c + 4, 'a': 'D' || v2.a, 'r': v2.r}, {'c': v3.c + 3 * cut::int + 1000000 * (gone or left(role, 1) <> 'a')::int, 'a': 'K' || v3.a, 'r': chr(10) || role || ':' || text || v3.r},
        {'c': v3.c + 3 + 3 * cut::int + 1000000 * gone::int, 'a': 'R' || v3.a, 'r': chr(10) || 'assistant:' || text || v3.r}])[1] as w2,
      list_sort([{'c': v3.c + 4, 'a': 'D' || v3.a, 'r': v3.r}, {'c': v2.c + 3 * cut::int + 1000000 * (gone or left(role, 1) <> 'u')::int, 'a': 'K' || v2.a, 'r': chr(10) || role || ':' || text || v2.r},
        {'c': v2.c + 3 + 3 * cut::int + 1000000 * gone::int, 'a': 'R' || v2.a, 'r': chr(10) || 'user:' || text || v2.r}])[1] as w3
    from go join t on t.conv_id is not distinct from go.conv_id and t.i = go.i - 1))
select x.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(v0.c, 0) as cost, coalesce(v0.a, '') as audit, sha256(coalesce(v0.r[2:], '')) as repaired_sha256
from (select distinct conv_id from conversations) x left join n on n.conv_id is not distinct from x.conv_id left join go on go.conv_id is not distinct from x.conv_id and go.i = 1
""",
    "op12_imatch": rf"""
with d as (select doc_id, coalesce(text, '') as text, row_number() over (order by doc_id desc nulls last, md5(coalesce(text, ''))) as r from documents),
n as (select *, length(text)::bigint as n_chars, coalesce(lead(text) over (order by r), first_value(text) over (order by r)) as next from d),
e as (select *, left(text, n_chars - n_chars // 2) || left(next, n_chars // 2) as edited from n),
x as (select r, 'a' as side, text as body from e union all select r, 'b', edited from e),
t as (select r, side, unnest(list_distinct(list_filter(regexp_split_to_array(lower(body), '{_NO_TERM}'), lambda w: w <> ''))) as term from x),
l as (select term, md5('0:' || term) || md5('1:' || term) || md5('2:' || term) || md5('3:' || term) as digits from t where side = 'a'
  group by term having count(*) * 1000 >= (select count(*) from d) and count(*) * 10 <= (select count(*) from d)),
s as (select unnest(range(0, {sum(SUBSETS)})) as s, unnest([{_BELOW}]) as below),
h as (select r, side, s, substr(md5(string_agg(term, ' ' order by term)), 1, 8) as h from t join l using (term) join s on substr(digits, 2 * s + 1, 2) < below group by r, side, s),
m as (select r, side, map_from_entries(list((s, h))) as m from h group by r, side),
f as (select x.r, x.side, case when m is null then ['=' || md5(body)] else list_transform(range(0, {sum(SUBSETS)}), lambda s: coalesce(m[s], '')) end as f from x left join m on m.r = x.r and m.side = x.side),
p as (select e.*, a.f as f, b.f as g, coalesce(lead(a.f) over (order by e.r), first_value(a.f) over (order by e.r)) as o from e join f a on a.r = e.r and a.side = 'a' join f b on b.r = e.r and b.side = 'b')
select doc_id, n_chars, sha256(edited) as edited_sha256, array_to_string(f, '.') as fingerprint, array_to_string(g, '.') as edited_fingerprint,
  case when len(f) <> len(g) then 0 else len(list_filter(list_zip(f, g), lambda z: z[1] = z[2] and z[1] <> '')) / len(list_filter(list_zip(f, g), lambda z: z[1] <> '' or z[2] <> '')) end as near_edited,
  case when len(f) <> len(o) then 0 else len(list_filter(list_zip(f, o), lambda z: z[1] = z[2] and z[1] <> '')) / len(list_filter(list_zip(f, o), lambda z: z[1] <> '' or z[2] <> '')) end as near_next
from p
""",
    "op13_threshold_search": rf"""
with d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_NO_TERM}'), lambda w: w <> '') as a, row_number() over () as r from documents),
i as (select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_NO_TERM}'), lambda w: w <> '') as a, row_number() over () as q from benchmark),
s as (select count(*)::bigint as docs, sum(len(a))::bigint as terms from d where len(a) > 0),
tf as (select r, w, count(*)::bigint as tf from (select r, unnest(a) as w from d) group by all),
qt as (select q, w, count(*)::bigint as times from (select q, unnest(a) as w from i) group by all),
wt as (select w, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as weight from (select w, count(*)::bigint as df from tf group by w), s),
im as (select r, w, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(a) * docs) // s.terms))) as part from tf join d using (r) join wt using (w), s),
sc as (select q, r, sum(times * part)::bigint as score from qt join im using (w) group by q, r),
rk as (select q, r, score, row_number() over (partition by q order by score desc, doc_id nulls last)::int as rank from sc join d using (r) where score > 0)
select item_id, rank, doc_id, score from rk join d using (r) join i using (q) where rank <= 20
""",
}
