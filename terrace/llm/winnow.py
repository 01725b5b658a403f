"""Benchmark decontamination by winnowing.

A benchmark text leaks where ``span`` consecutive words of it stand in a
document; a shorter benchmark text leaks as a whole. Of every ``span - k + 1``
neighbouring k-gram hashes winnowing keeps the smallest, so two texts that
share so many words share a kept hash: none is missed, whatever stands around
it. Spans shorter than ``span`` words, of shorter benchmark texts, have windows
and grams of their own size; sizes that do not occur cost nothing.

The kept hashes of the documents, each in one number with its place, meet the
different kept hashes of the benchmark. Each hit is extended: the windows of the document that reach over it
are looked up among the different windows of the benchmark by 128 bits of hash.
Both joins find at most one partner for a row, so a passage that is common in
documents or benchmark multiplies nothing. Only the last step names items, once
per document and item. The benchmark's hashes are stored first: Spark knows
their true size and broadcasts them only under its threshold; else both sides
are shuffled, and adaptive execution splits a hash that is frequent.

DataFrame functions only. Documents are read twice, the second time for those
with a hit. Every document carries one mark through the first join and so stays
in the result. Rows that repeat a key are told apart by their text; equal rows
get equal results. A null text has no words. Benchmark rows that share an id are
one item; an item without an id is listed as an empty text. Empty tables of
either kind give no hit or no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import lower_ascii, split_words, text_of
from terrace.llm.license_scan import WORD_EDGE, WORD_GAP
from terrace.sources.staging import stage

PLACE_BITS = 24              # a kept gram is one number: 39 bits of hash, a set bit, and its place modulo 2**24
FIRST = 1 << PLACE_BITS
MARKS = 1 << 12              # every document carries one of so many numbers without the set bit
ROW = ["_row", "_alt"]


@dataclass(frozen=True)
class WinnowRules:
    span: int = 10     # words that must be shared


def words_of(text: str) -> Column:
    return split_words(lower_ascii(text_of(text)), WORD_GAP, WORD_EDGE)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(words: Column, size: int) -> Column:
    """Starts, from 0, of all runs of ``size`` words; there must be so many words."""
    return F.sequence(F.lit(0), F.size(words) - size)


def kept_grams(words: Column, size: int) -> Column:
    """Winnowing: of the grams in every run of ``size`` words the one with the smallest hash, as packed numbers.

    A gram has half of these words, rounded up; its hash depends on ``size`` too, so
    grams for runs of different sizes do not meet. Hashes decide first, then places.
    """
    k = (size + 1) // 2
    width = size - k + 1

    def packed(i: Column) -> Column:
        hashed = F.xxhash64(F.lit(size), F.slice(words, i + 1, k))
        return hashed.bitwiseAND(F.lit(-2 * FIRST)).bitwiseOR(F.pmod(i, F.lit(FIRST)) + F.lit(FIRST))

    def lows(grams: Column) -> Column:
        return F.transform(_starts(words, size), lambda i: F.array_min(F.slice(grams, i + 1, width)))

    kept = F.array_distinct(_let(F.transform(_starts(words, k), packed), lows))
    return F.when(F.size(words) >= size, kept).otherwise(F.array().cast("array<bigint>"))


def gram_hash(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _windows(df: DataFrame, starts: Column, *keys: str) -> DataFrame:
    """(keys, size, start, w1, w2) of the windows of ``size`` words at ``starts``: 128 bits of hash."""
    def cut(i: Column) -> Column:
        words = F.slice("_words", i + 1, F.col("size"))
        return F.struct(i.alias("start"), F.xxhash64(words).alias("w1"), F.xxhash64(F.lit(7), words).alias("w2"))

    return df.select(*keys, "size", F.explode(F.transform(starts, cut)).alias("_c")).select(
        *keys, "size", "_c.start", "_c.w1", "_c.w2")


def item_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text",
                 rules: WinnowRules = WinnowRules()) -> tuple[DataFrame, DataFrame, list[int]]:
    """The different kept hashes (size, hash), the windows (size, w1, w2, item), and the sizes in use."""
    items = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words_of(text).alias("_words"))
    items = stage(items.withColumn("size", F.least(F.size("_words"), F.lit(rules.span))).where("size > 0"), "items")
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # ``span`` numbers at most
    grams = F.array().cast("array<bigint>")
    for size in sizes:
        grams = F.when(F.col("size") == size, kept_grams(F.col("_words"), size)).otherwise(grams)
    grams = items.select("size", F.explode(grams).alias("_g")).select("size", gram_hash(F.col("_g")).alias("hash")).distinct()
    marks = items.sparkSession.range(MARKS).select(F.lit(0).alias("size"), (2 * F.col("id")).alias("hash"))
    windows = _windows(items, F.sequence(F.lit(0), F.size("_words") - F.col("size")), "item").drop("start").distinct()
    return stage(grams.unionByName(marks), "item-grams"), stage(windows, "item-windows"), sizes


def gram_hits(rows: DataFrame, grams: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(_key, row, n_words, size, place) of the documents' kept grams that the benchmark keeps too; size 0: the mark."""
    kept = rows.select("_key", *ROW, words_of("_text").alias("_words"))
    mark = F.pmod("_row", F.lit(MARKS)) * (2 * FIRST)
    every = F.concat(F.array(mark), *[kept_grams(F.col("_words"), size) for size in sizes])
    kept = kept.select("_key", *ROW, F.size("_words").cast("long").alias("n_words"), F.explode(every).alias("_g"))
    hits = kept.withColumn("hash", gram_hash(F.col("_g"))).join(grams, "hash")
    return hits.select("_key", *ROW, "n_words", "size", F.col("_g").bitwiseAND(F.lit(FIRST - 1)).cast("int").alias("place"))


def extended(rows: DataFrame, hits: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, size, start, w1, w2) of the benchmark's windows in the documents: those that reach over a hit gram."""
    at = hits.where("size > 0").groupBy(*ROW, "size").agg(F.collect_set("place").alias("_at"))
    texts = rows.select(*ROW, "_text").join(at, ROW).select(*ROW, "size", "_at", words_of("_text").alias("_words"))
    size, n = F.col("size"), F.size("_words")
    # places are known modulo 2**24
    places = F.flatten(F.transform("_at", lambda p: F.sequence(p, n - 1, F.lit(FIRST))))
    reach = F.flatten(F.transform(places, lambda p: F.sequence(
        F.greatest(p - F.floor(size / 2).cast("int"), F.lit(0)), F.least(p, n - size))))
    known = stage(windows.select("size", "w1", "w2").distinct(), "known")
    return _windows(texts, F.array_distinct(reach), *ROW).distinct().join(known, ["size", "w1", "w2"], "left_semi")


def merged_spans(found: DataFrame) -> DataFrame:
    """(row, spans): the ranges of words (start, end exclusive), those that overlap or touch made one."""
    ends = found.select(*ROW, "start", (F.col("start") + F.col("size")).alias("end"))
    order = Window.partitionBy(*ROW).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("start") > before).cast("int"), F.lit(1))
    islands = ends.withColumn("_fresh", fresh).withColumn("_island", F.sum("_fresh").over(order))
    islands = islands.groupBy(*ROW, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return islands.groupBy(*ROW).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text",
               rules: WinnowRules = WinnowRules()) -> DataFrame:
    """(key, n_words, n_hit, spans, items) of every row of ``docs``.

    ``spans`` are the hit ranges of words, ``items`` the sorted ids of the items that leaked.
    """
    grams, windows, sizes = item_windows(benchmark, item_key, item_text, rules)
    rows = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"))
    rows = rows.select("_key", F.xxhash64("_key", "_text").alias("_row"),
                       F.xxhash64(F.lit(7), "_key", "_text").alias("_alt"), "_text")
    hits = stage(gram_hits(rows, grams, sizes), "hits")
    found = stage(extended(rows, hits, windows), "leaks")
    named = found.select(*ROW, "size", "w1", "w2").distinct().join(windows, ["size", "w1", "w2"])
    items = named.select(*ROW, "item").distinct().groupBy(*ROW).agg(F.sort_array(F.collect_list("item")).alias("items"))
    leaks = stage(merged_spans(found).join(items, ROW), "leaky")
    words = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return hits.where("size = 0").join(leaks, ROW, "left").select(
        F.col("_key").alias(key), "n_words", F.coalesce(words, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def leaks_sql(rules: WinnowRules = WinnowRules()) -> str:
    """The rows of the query in SQL: every window of every document; ids are taken to be unique."""
    words = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
    return f"""
    with d as (select doc_id, {words} as w from documents),
    i as (select item_id, {words} as w from benchmark),
    sized as (select item_id, w, least(len(w), {rules.span}) as k from i where len(w) > 0),
    iw as (
      select distinct item_id, k, array_to_string(w[s : s + k - 1], ' ') as win
      from (select *, unnest(generate_series(1, len(w) - k + 1)) as s from sized)),
    dw as (
      select doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') as win
      from (select *, unnest(generate_series(1, len(w) - k + 1)) as s
            from d, (select distinct k from sized) where len(w) >= k)),
    hit as (select doc_id, item_id, k, s from dw join iw using (k, win)),
    n as (
      select doc_id, count(distinct p) as n_hit
      from (select doc_id, unnest(generate_series(s, s + k - 1)) as p from hit) group by 1),
    named as (
      select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
      from (select distinct doc_id, cast(item_id as varchar) as item from hit) group by 1)
    select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join n using (doc_id) left join named using (doc_id)"""
