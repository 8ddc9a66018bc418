"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from courtline.llm import quality

_GAP = r"[\x20\x09-\x0D]+"


def _quality() -> str:
    stop = ", ".join(f"'{x}'" for x in quality._STOP_FORMS)
    sides = []
    for r in quality.RULES:
        top, bottom = (x.strip() for x in r.metric.split("/"))
        ratio = f"{top}::double / nullif({bottom}, 0)"
        sides += [f"coalesce({ratio} < {r.low}, false)"] if r.low is not None else []
        sides += [f"coalesce({ratio} > {r.high}, false)"] if r.high is not None else []
    return rf"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
split as (
  select *, list_filter(string_split_regex(t, '{_GAP}'), lambda x: x <> '') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{_GAP}', '', 'g') <> '') as lines
  from d),
starts as (
  select rid, unnest(range(1, len(w) - 1)) as i, w from split),
windows as (
  select rid, i, count(*) over (partition by rid, w[i], w[i + 1], w[i + 2]) as n from starts),
covered as (
  select rid, count(distinct p) as n_repeat_words
  from (select rid, unnest([i, i + 1, i + 2]) as p from windows where n > 1) group by rid),
counts as (
  select doc_id, len(w)::bigint as n_words,
    length(regexp_replace(t, '{_GAP}', '', 'g'))::bigint as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
    len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}')))::bigint as n_alpha_words,
    len(list_filter(w, lambda x: x in ({stop})))::bigint as n_stop_words,
    len(regexp_extract_all(t, '\p{{Lu}}'))::bigint as n_upper,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from split left join covered using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {quality.MIN_WORDS}
    or 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words as base_failed,
  not (n_words < {quality.MIN_WORDS}
    or 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words
    or {" or ".join(sides)}) as kept
from counts"""


_FIM = r"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t,
    sha256('7:' || coalesce(doc_id::varchar, '')) as h
  from documents),
lines as (
  select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as l from d),
picks as (
  select *, len(l)::bigint as n, ('0x' || h[1:8])::ubigint % (len(l) + 1) as p1,
    ('0x' || h[9:16])::ubigint % (len(l) + 1) as p2, ('0x' || h[17:24])::ubigint % 100 as r,
    ('0x' || h[25:32])::ubigint % 100 as s
  from lines),
parts as (
  select doc_id, t, n,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or r >= 100
      then 'plain' when s < 50 then 'spm' else 'psm' end as form,
    array_to_string(l[1:least(p1, p2)::bigint], '') as prefix,
    array_to_string(l[least(p1, p2)::bigint + 1:greatest(p1, p2)::bigint], '') as middle,
    array_to_string(l[greatest(p1, p2)::bigint + 1:], '') as suffix
  from picks)
select doc_id, n, form, if(form = 'plain', null, length(prefix)) as prefix_chars,
  if(form = 'plain', null, length(middle)) as middle_chars,
  sha256(case form when 'plain' then t
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(t) as restored_sha256
from parts"""


ORACLES = {"op9_quality": _quality(), "op11_fim": _FIM}
