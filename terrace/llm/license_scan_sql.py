"""The licence scan in SQL, for the check against another engine."""

from __future__ import annotations

from terrace.llm.license_scan import BASE, TEMPLATES, ScanRules


def license_scan_sql(rules: ScanRules = ScanRules()) -> str:
    """The rows of ``scan`` without the spans; ids are taken to be unique."""
    grams = []
    for k, (label, phrase) in enumerate([*BASE, *TEMPLATES]):
        words = phrase.split(" ")
        grams += [f"({k}, '{label}', {k < len(BASE)}, {len(words) - 1}, {i}, '{words[i]} {words[i + 1]}')"
                  for i in range(len(words) - 1)]
    return f"""
    with templates(template, label, base, n_grams, place, gram) as (values {", ".join(grams)}),
    w as (
      select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
    g as (
      select doc_id, pos, words[pos + 1] || ' ' || words[pos + 2] as gram
      from (select doc_id, words, unnest(generate_series(0, len(words) - 2)) as pos from w)),
    votes as (
      select doc_id, template, label, base, n_grams, pos - place as diagonal, list(distinct place) as places,
             min(pos) as low, max(pos) as high
      from g join templates using (gram) group by all),
    islands as (
      select *, sum(fresh) over (partition by doc_id, template order by diagonal) as island
      from (select *, case when not base and diagonal - lag(diagonal) over (
              partition by doc_id, template order by diagonal) <= {rules.max_shift} then 0 else 1 end as fresh
            from votes)),
    spans as (
      select doc_id, template, label, base, n_grams, min(diagonal) as start, min(low) as low, max(high) as high,
             len(list_distinct(flatten(list(places)))) / n_grams::double as share
      from islands group by doc_id, template, label, base, n_grams, island),
    found as (
      select * from spans
      where case when base then share = 1
                 else share >= {rules.min_share} and high + 1 - low <= {rules.slack} * n_grams end),
    per as (
      select doc_id, count(*) filter (where base) as n_base, min(start) filter (where base) as first_word,
             max(start) filter (where base) as last_word,
             string_agg(distinct label, ',' order by label) filter (where base) as base_labels,
             string_agg(distinct label, ',' order by label) as labels, max(share) as score
      from found group by 1)
    select doc_id, len(words) as n_words, coalesce(n_base, 0) as n_base, cast(first_word as bigint) as first_word,
           cast(last_word as bigint) as last_word, coalesce(base_labels, '') as base_labels,
           coalesce(labels, '') as labels, coalesce(score, 0.0::double) as score
    from w left join per using (doc_id)"""
