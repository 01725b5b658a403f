"""The line-first quality rules in SQL, for the check against another engine."""

from __future__ import annotations

from terrace.llm.line_rules import BOILERPLATE, LineRules

_BLANK = "[\\x20\\x09-\\x0D]"


def _without(x: str, pattern: str) -> str:
    return f"length(regexp_replace({x}, '{pattern}', '', 'g'))"


def line_rules_sql(rules: LineRules = LineRules()) -> str:
    """The rows of ``clean_lines`` without the cleaned text."""
    gaps = f"(length(x) - {_without('x', _BLANK)})"
    symbols = f"(length(x) - {_without('x', '[#*$%&|<>]')})"
    separators = f"(length(x) - {_without('x', '[|»•›]')})"
    ending = """[.!?…:;。！？][\\p{Pe}\\p{Pf}"''*_]*\\s*$"""
    fails = f"""
      not (regexp_matches(right(x, 16), '{ending}')
           or (regexp_matches(x, '[.!?]\\s') and {gaps} >= {rules.long_line_words}))
      or {separators} >= greatest({rules.nav_separators}, {gaps} / 10.0)
      or (length(x) <= {rules.long_line_chars} and regexp_matches(lower(x), '{"|".join(BOILERPLATE)}'))
      or (upper(x) = x and lower(x) <> x and {gaps} >= 3)
      or {symbols} > ({gaps} + 1) * {rules.max_symbols_per_word}"""
    return f"""
    with d as (
      select doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w,
             list_filter(string_split(t, chr(10)), lambda x: {_without('x', _BLANK)} > 0) as full_lines
      from (select doc_id, coalesce(text, '') as t from documents)),
    g as (
      select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as c
      from (select doc_id, w, unnest(generate_series(1, len(w) - 2)) as i from d)),
    r as (
      select doc_id, count(distinct p) as n from (
        select doc_id, unnest([i, i + 1, i + 2]) as p from g where c > 1) group by 1),
    m as (
      select doc_id, cast(len(w) as bigint) as n_words, cast({_without('t', _BLANK)} as bigint) as word_chars,
             cast(length(t) - {_without('t', '[#*$%&|<>]')} as bigint) as n_symbols,
             cast(len(full_lines) - len(list_distinct(full_lines)) as bigint) as n_dup_lines,
             cast(coalesce(r.n, 0) as bigint) as n_repeat_words,
             cast(coalesce(list_sum(list_transform(
               list_distinct(list_filter(full_lines, lambda x: not ({fails}))),
               lambda x: {_without('x', _BLANK)})), 0) as bigint) as kept_chars
      from d left join r using (doc_id)),
    v as (
      select *, n_words < {rules.min_words} or 100 * n_repeat_words > {rules.max_repeat_pct} * n_words as base_failed,
             case when word_chars > 0 then 1.0::double - kept_chars::double / word_chars::double else 1.0::double end
               as lost_share
      from m)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_share,
           not base_failed and lost_share <= {rules.max_lost_share} as kept
    from v"""
