"""DuckDB SQL for those of the registered queries that SQL can express, over whole tables."""

from __future__ import annotations

from facilitymetrics.llm.quality import PRODUCTION, RULES

# CRC-32 of the distinct words: bytes from their hexadecimal form, folded with a table that is worked out first.
_IMPORTANCE = r"""
with crc_table as (
  select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
texts as (
  select row_number() over () as r, true as corpus, doc_id, text from documents
  union all select -row_number() over (), false, null, text from benchmark),
listed as (
  select r, corpus, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from texts),
words as (select r, corpus, unnest(words) as w from listed),
spelled as (select w, hex(encode(w)) as h from (select distinct w from words)),
hashed as (
  select w, xor(list_reduce(list_concat([4294967295], list_transform(range(length(h) // 2), lambda i:
      cast((instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16
        + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1 as bigint))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket
  from spelled, crc_table),
features as (select r, corpus, bucket from words join hashed using (w)),
counts as (
  select bucket, count(*) filter (corpus) as s, count(*) filter (not corpus) as t from features group by bucket),
totals as (select coalesce(sum(s), 0) as s_all, coalesce(sum(t), 0) as t_all from counts),
gains as (
  select bucket, floor(1000 * ln((t + 1) * (t_n.s_all + 10000) / ((s + 1) * (t_n.t_all + 10000)))) as gain
  from counts, totals t_n),
weights as (
  select r, count(*) as n_features, cast(sum(gain) as bigint) as weight
  from features join gains using (bucket) where corpus group by r),
scored as (
  select r, doc_id, len(words) >= 20 as eligible, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), '')), 1, 8)
      as bigint) + 0.5) / 4294967296))) as bigint) as score
  from listed left join weights using (r) where corpus),
placed as (
  select *, row_number() over (order by eligible desc, score desc, doc_id nulls last) as place,
    count(*) filter (eligible) over () * 10 // 100 as drawn
  from scored)
select doc_id, n_features, weight, score, case when eligible and place <= drawn then place end as rank from placed
"""


def _quality() -> str:
    bits = " + ".join(f"case when {rule.fails} then {1 << rule.bit} else 0 end" for rule in RULES)
    return rf"""
with texts as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
parts as (
  select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from texts),
windows as (
  select r, unnest(list_transform(range(1, len(words) - 6), lambda i: words[i : i + 7])) as found,
    unnest(range(1, len(words) - 6)) as begins
  from parts),
repeats as (
  select distinct r, begins + unnest(range(8)) as word
  from (select r, begins, count(*) over (partition by r, found) as n from windows) where n > 1),
repeated as (select r, count(*) as n_repeat_words from repeats group by r),
measured as (
  select doc_id, len(words) as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    len(list_filter(words, lambda x: not regexp_matches(x, '\p{{L}}'))) as n_letterless,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{{Lu}}.*\p{{Lu}}') and not regexp_matches(x, '\p{{Ll}}')))
      as n_capitals,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*\x{{2022}}\x{{25CF}}\x{{25AA}}]'))) as n_bullets,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})[\x20\x09-\x0D]*$'))) as n_ellipses
  from parts left join repeated using (r)),
judged as (select *, {bits} as failed_bits from measured)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
  cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  failed_bits & {PRODUCTION.mask} = 0 as kept, cast(failed_bits as bigint) as failed_bits
from judged
"""


def statements() -> dict[str, str]:
    return {"op11_importance_resampling": _IMPORTANCE, "op13_quality_rules": _quality()}
