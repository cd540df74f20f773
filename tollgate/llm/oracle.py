"""DuckDB SQL for the corpus queries that SQL can express: license scans, WARC
records and contamination. The others need tokenizers, trained models or hash
functions that SQL lacks; their tests are brute force."""

from __future__ import annotations

import string

from .licenses import TEMPLATES

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _licenses() -> str:
    rows = []
    for i, t in enumerate(TEMPLATES):
        sequence = t.text.split()
        need = next(k for k in range(len(set(sequence)) + 1) if k >= t.threshold * len(set(sequence)) - 1e-9)
        rows.append(f"({i}, '{t.label}', {sequence}, {sorted(set(sequence))}, {len(sequence)}, {need}, {str(t.base).lower()})")
    return f"""
with t as (select * from (values {', '.join(rows)}) as t(k, label, seq, tokens, size, need, base)),
d as (select doc_id, {_WORDS} as w from documents),
near as (select doc_id, w, t.* from d, t where len(list_intersect(list_distinct(w), tokens)) >= need),
block as (select doc_id, k, label, seq, tokens, need, base, i, w[i:i + size - 1] as words
          from (select *, unnest(range(1, greatest(1, len(w) - size + 1) + 1)) as i from near) x),
hit as (select doc_id, label, len(list_intersect(list_distinct(words), tokens)) / len(tokens) as share,
               base and words = seq as place, i - 1 as start
        from block where len(list_intersect(list_distinct(words), tokens)) >= need),
found as (select doc_id, count(*) filter (where place) as n_base, min(start) filter (where place) as first_word,
                 max(start) filter (where place) as last_word,
                 string_agg(distinct label, ',' order by label) filter (where place) as base_labels,
                 string_agg(distinct label, ',' order by label) as labels, max(share) as score
          from hit group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base,
       cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from d left join found using (doc_id)"""


_WARC = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
f as (select h, min(page_id) as first from p group by h)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + list_sum(
           list_transform(range(0, 5), lambda k: ((instr('0123456789abcdef', substr(p.h, 1 + (5 * j + k) // 4, 1)) - 1)
               >> cast(3 - (5 * j + k) % 4 as integer)) % 2 * cast(power(2, 4 - k) as integer))) as bigint), 1)), '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from p join f on p.h = f.h"""

_CONTAMINATION = f"""
with b as (select item_id, {_WORDS} as w from benchmark where text is not null),
win as (select distinct item_id, least(13, len(w)) as k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as gram
        from (select *, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from b where len(w) > 0) x),
sizes as (select distinct k from win),
d as (select doc_id, {_WORDS} as w from documents),
dw as (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as gram
       from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, sizes where len(w) >= k) x),
hits as (select doc_id, dw.k, i, item_id from dw join win on dw.gram = win.gram and dw.k = win.k),
covered as (select doc_id, count(distinct i + j) as n_hit from (select doc_id, i, unnest(range(0, k)) as j from hits) x group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
          from (select distinct doc_id, cast(item_id as varchar) as item from hits where item_id is not null) x group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(list, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join covered using (doc_id) left join items using (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_licenses": _licenses(), "op7_warc": _WARC, "op8_decontamination": _CONTAMINATION}
