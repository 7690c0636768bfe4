"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTER_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SPACED_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+')"

OP3 = f"""
with d as (select row_number() over () as r, doc_id, {LETTER_WORDS} as w from documents),
b as (select item_id::varchar as item_id, {LETTER_WORDS} as w from benchmark),
windows as (select distinct item_id, list_slice(w, k, k + 9) as g
  from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) as k from b where len(w) > 0)),
sizes as (select distinct len(g) as n from windows),
places as (select r, k, n, list_slice(w, k, k + n - 1) as g
  from (select r, w, n, unnest(generate_series(1, len(w) - n + 1)) as k from d, sizes where len(w) >= n)),
hits as (select r, k, n, item_id from places join windows using (g)),
covered as (select r, count(distinct p) as n_hit
  from (select r, unnest(generate_series(k, k + n - 1)) as p from hits) group by r),
items as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as s
  from hits group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (r) left join items using (r)
"""

OP2 = f"""
with recursive d as (select row_number() over () as r, doc_id, {SPACED_WORDS} as w from documents),
sets as (select r, doc_id, case when len(w) = 0 then [] when len(w) < 5 then [w]
  else list_distinct(list_transform(generate_series(1, len(w) - 4), lambda k: list_slice(w, k, k + 4))) end as s from d),
shingles as (select r, unnest(s) as g from sets),
pairs as (select x.r as a, y.r as b, count(*) as n from shingles x join shingles y on x.g = y.g and x.r <> y.r group by 1, 2),
links as (select a, b from pairs join sets x on x.r = a join sets y on y.r = b
  where 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
walk as (select r, r as to_r from sets union select walk.r, links.b from walk join links on links.a = walk.to_r),
least as (select walk.r, min(sets.doc_id) as component_id from walk join sets on sets.r = walk.to_r group by 1)
select doc_id, len(s)::bigint as n_shingles, component_id, coalesce(doc_id = component_id, false) as kept
from sets join least using (r)
"""

OP10 = """
with d as (select doc_id, coalesce(strlen(text), 0)::bigint as bytes,
  ('0x' || substr(md5('=' || doc_id::varchar), 1, 8))::bigint as h from documents),
levels as (select unnest(generate_series(0, 32)) as k),
nodes as (select k, h >> (32 - k) as p, sum(bytes) as n, count(*) as c from d, levels group by 1, 2),
own as (select doc_id, bytes, h, min(k) as depth from d, levels join nodes using (k)
  where nodes.p = h >> (32 - k) and (n <= 1048576 or c = 1) group by 1, 2, 3)
select doc_id, own.bytes, right(lpad(bin(h >> (32 - depth)), 32, '0'), depth) as shard, depth::integer as depth,
  n::bigint as shard_bytes from own join nodes on k = depth and p = h >> (32 - depth)
"""

DISTANCE = """sqrt(greatest(0, sum(case when p > 0 then p * log2(2 * p / (p + q)) else 0 end
  + case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2))"""

OP8 = rf"""
with d as (select row_number() over () as r, doc_id, lang::varchar as lang, coalesce(text, '') as text from documents),
parts as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w, length(text) as n_chars, strlen(text) as n_bytes,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines,
  [length(regexp_replace(text, '[^A-Z]+', '', 'g')), length(regexp_replace(text, '[^0-9]+', '', 'g')),
   length(regexp_replace(text, '[^.,;:?!''"()-]+', '', 'g')), length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))] as c from d),
sizes as (select *, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars
  from parts),
places as (select r, k, list_slice(w, k, k + 4) as g
  from (select r, w, unnest(generate_series(1, len(w) - 4)) as k from sizes)),
covered as (select r, count(distinct p) as n from (select r, unnest(generate_series(k, k + 4)) as p
  from (select r, k, count(*) over (partition by r, g) as often from places) where often > 1) group by r),
plain as (select r, doc_id, lang, w, n_bytes, n_words, word_chars, c[4]::bigint as n_symbols,
  (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
  list_concat(c, [n_chars - word_chars, n_bytes - n_chars, n_bytes - list_sum(c) - (n_bytes - word_chars)]) as c
  from sizes left join covered using (r)),
chars as (select r, lang, n_bytes, unnest(generate_series(1, 7)) as i, unnest(c) as c from plain),
char_shares as (select lang, i, sum(c) / greatest(sum(n_bytes), 1)::double as q from chars group by 1, 2),
char_distances as (select r, {DISTANCE} as char_distance
  from (select r, c / n_bytes::double as p, q from chars join char_shares s
    on chars.lang is not distinct from s.lang and chars.i = s.i where n_bytes >= 200) group by r),
words as (select r, lang, lower(unnest(w)) as word from plain),
counts as (select lang, word, count(*) as n, sum(count(*)) over (partition by lang) as all_words from words group by 1, 2),
common as (select lang, word, n / all_words::double as q from counts where n >= 0.005::double * all_words),
own as (select r, word, count(*) as n from words group by 1, 2),
pairs as (select plain.r, coalesce(own.n, 0) / n_words::double as p, q
  from plain join common on plain.lang is not distinct from common.lang
  left join own on own.r = plain.r and own.word = common.word where n_words >= 50),
word_distances as (select r, {DISTANCE} as word_distance
  from (select * from pairs union all select r, 1 - sum(p), 1 - sum(q) from pairs group by r) group by r),
verdicts as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  coalesce(char_distance > 0.22 + 1.5 / sqrt(n_bytes), false) or coalesce(word_distance > 0.35 + 1.2 / sqrt(n_words), false) as far
  from plain left join char_distances using (r) left join word_distances using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not far as kept,
  round(char_distance, 6) as char_distance, round(word_distance, 6) as word_distance from verdicts
"""

ORACLE: dict[str, str] = {"op2_near_dedup": OP2, "op3_decontamination": OP3,
                          "op8_quality_rules": OP8, "op10_extendible_shards": OP10}
