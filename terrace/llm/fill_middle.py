"""Fill-in-middle transformation by counted quantifiers.

A text is a run of units (code points by default). ``regexp_count`` gives their
number; a pattern of the row's own, ``(unit{a}+)(unit{m}+)(rest)`` with
possessive counts, captures prefix, middle and suffix in one match, and its
replacement puts them in their new order between markers. Possessive counts
never step back, so a match reads the text once, whatever its length.

Where a row is cut and what becomes of it follows from a hash of its key, so
reruns agree and equal rows get equal results. No shuffle: a row needs itself
only. All of it is one projection of JVM expressions.

A null text is an empty one; an empty text, one that holds a marker, and the
share of rows that the rules leave alone stay plain. A null key is hashed as an
empty one. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import text_of


@dataclass(frozen=True)
class FillRules:
    """``unit`` is a pattern fragment that takes a quantifier and whose matches tile every text."""

    unit: str = "."
    seed: str = "1"
    changed_pct: int = 90     # of the rows, by hash
    spm_pct: int = 20         # of the changed rows: suffix first
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    block: int = 1024         # units counted at once


def hash_parts(key: Column, seed: str, parts: int = 4) -> list[Column]:
    """The first groups of eight digits of the sha256 of seed and key, as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(parts)]


def unit_count(text: Column, rules: FillRules = FillRules()) -> Column:
    """Units of a text: whole blocks, then what is left, so that no array holds a string per unit."""
    block = f"(?:{rules.unit}{{{rules.block}}}+)"
    left = F.regexp_replace(text, rf"(?s)\A{block}*+", "")
    return (F.regexp_count(text, F.lit(f"(?s){block}")).cast("long") * rules.block
            + F.regexp_count(left, F.lit(f"(?s){rules.unit}")))


def _quoted(mark: str) -> str:
    return mark.replace("\\", "\\\\").replace("$", "\\$")


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text",
                   rules: FillRules = FillRules()) -> DataFrame:
    """(key, n, form, n_prefix, n_middle, output) of every row; the counts are of units, null where plain."""
    h = hash_parts(F.col(key), rules.seed)
    rows = df.select(F.col(key), text_of(text).alias("_text"), *[x.alias(f"_h{i}") for i, x in enumerate(h)])
    rows = rows.withColumn("n", unit_count(F.col("_text"), rules))
    t, p, s, m = F.col("_text"), rules.prefix, rules.suffix, rules.middle
    marked = F.contains(t, F.lit(p)) | F.contains(t, F.lit(s)) | F.contains(t, F.lit(m))
    plain = (t == "") | marked | (F.col("_h2") % 100 >= rules.changed_pct)
    first, second = F.col("_h0") % (F.col("n") + 1), F.col("_h1") % (F.col("n") + 1)
    rows = rows.select(
        key, "n", "_text",
        F.when(plain, "plain").when(F.col("_h3") % 100 < rules.spm_pct, "spm").otherwise("psm").alias("form"),
        F.least(first, second).alias("_a"), F.abs(first - second).alias("_m"))
    u = rules.unit
    pattern = F.concat(F.lit(rf"(?s)\A({u}{{"), F.col("_a"), F.lit(rf"}}+)({u}{{"), F.col("_m"), F.lit(r"}+)(.*+)\z"))
    p, s, m = _quoted(p), _quoted(s), _quoted(m)
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    changed = F.col("form") != "plain"
    return rows.select(
        key, "n", "form", F.when(changed, F.col("_a")).alias("n_prefix"), F.when(changed, F.col("_m")).alias("n_middle"),
        F.when(changed, F.regexp_replace(t, pattern, order)).otherwise(t).alias("output"))


def restored(output: Column, form: Column, rules: FillRules = FillRules()) -> Column:
    """The text from which an output was made: the parts between the markers in their old order.

    Markers neither hold nor overlap one another, and a changed text holds none, so the
    first of each kind is the one that was put in.
    """
    p, s, m = map(re.escape, (rules.prefix, rules.suffix, rules.middle))
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_sql(rules: FillRules = FillRules()) -> str:
    """The digests of the query in SQL, for units of one code point; ids are taken to be unique."""
    marked = " or ".join(f"contains(t, '{x}')" for x in (rules.prefix, rules.suffix, rules.middle))
    parts = ", ".join(f"cast('0x' || substr(d, {8 * i + 1}, 8) as bigint) as h{i}" for i in range(4))
    p, s, m = rules.prefix, rules.suffix, rules.middle
    return f"""
    with d as (
      select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
             sha256('{rules.seed}:' || coalesce(cast(doc_id as varchar), '')) as d from documents),
    h as (select *, {parts} from d),
    c as (
      select doc_id, t, n, least(h0 % (n + 1), h1 % (n + 1)) as a, greatest(h0 % (n + 1), h1 % (n + 1)) as b,
             case when t = '' or {marked} or h2 % 100 >= {rules.changed_pct} then 'plain'
                  when h3 % 100 < {rules.spm_pct} then 'spm' else 'psm' end as form from h),
    o as (
      select *, case form when 'plain' then t
        when 'psm' then '{p}' || substr(t, 1, a) || '{s}' || substr(t, b + 1) || '{m}' || substr(t, a + 1, b - a)
        else '{s}' || substr(t, b + 1) || '{p}' || substr(t, 1, a) || '{m}' || substr(t, a + 1, b - a) end as output
      from c)
    select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
           case when form <> 'plain' then b - a end as middle_chars,
           sha256(output) as output_sha256, sha256(t) as restored_sha256 from o"""
