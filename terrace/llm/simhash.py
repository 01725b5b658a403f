"""SimHash near-duplicates by pigeonhole blocks.

A 64-bit fingerprint is cut into blocks. Two fingerprints that differ in at
most ``max_bits`` bits leave all but ``max_bits`` blocks untouched, so they
share the value of some choice of ``blocks - max_bits`` blocks: the choice and
its value form the bucket in which they meet, and their Hamming distance is
then verified. Only distinct fingerprints take part.

A bucket with many fingerprints is not paired off. There each fingerprint lists
the values within half of ``max_bits`` flips of its own outside the shared
blocks; two fingerprints are close exactly if they list a common value, and
those that do are linked to the smallest of them. This needs ``max_bits`` 2 or
less and gives the same links up to transitivity.

Hashing is in the JVM, the bit votes are numpy on Arrow batches, everything
else is DataFrame work. A text without a word has fingerprint 0 and is linked
like any other; a null text is an empty one; a null key is kept but names no
component; repeated rows fall into one component; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from terrace.llm.common import lower_ascii, split_words, text_of
from terrace.llm.components import components
from terrace.sources.staging import stage


@dataclass(frozen=True)
class SimhashRules:
    shingle: int = 3
    max_bits: int = 2
    blocks: int = 4
    pair_limit: int = 64      # fingerprints in a bucket that are paired off


def vote(hashes: np.ndarray, step: int = 1 << 16) -> int:
    """The fingerprint of the hashes as a signed long: bits set in over half of them."""
    set_bits = np.zeros(64, np.int64)
    for k in range(0, len(hashes), step):
        part = np.ascontiguousarray(hashes[k:k + step], dtype="<i8")
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def _vote(hashes: pd.Series) -> pd.Series:
    return pd.Series([vote(h) for h in hashes], dtype="int64")


def run_hashes(df: DataFrame, text: str, width: int, *more: Column) -> DataFrame:
    """The columns ``more`` with the hashes of all runs of ``width`` words; a shorter text is one run."""
    # words first, as a column of their own, so that they are split once
    rows = df.select(*more, split_words(lower_ascii(text_of(text))).alias("_words"))
    w, n = F.col("_words"), F.size("_words")
    runs = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(
        F.concat_ws(" ", *[F.get(w, i + k) for k in range(width)])))
    hashes = F.when(n == 0, F.array().cast("array<bigint>")).when(
        n < width, F.array(F.xxhash64(F.concat_ws(" ", w)))).otherwise(runs)
    return rows.withColumn("_hashes", hashes).drop("_words")


def fingerprints(df: DataFrame, key: str, text: str, rules: SimhashRules) -> DataFrame:
    """(_key, fp) of every row."""
    return run_hashes(df, text, rules.shingle, F.col(key).alias("_key")).select("_key", _vote("_hashes").alias("fp"))


def _shared(rules: SimhashRules) -> list[int]:
    """Bit masks of all choices of blocks that a close pair can share."""
    edges = [64 * k // rules.blocks for k in range(rules.blocks + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(masks, rules.blocks - rules.max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct: DataFrame, rules: SimhashRules) -> DataFrame:
    """(a, b) between different fingerprints of ``distinct`` (column fp), enough for all components."""
    if rules.max_bits > 2:
        raise ValueError("max_bits above 2 would need larger neighbourhoods in full buckets")
    masks = _shared(rules)
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
        for k, m in enumerate(masks)])).alias("_b")).select("fp", "_b.choice", "_b.part")
    keyed = stage(keyed, "blocks")
    full = keyed.groupBy("choice", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(keyed.join(full, ["choice", "part"]), "buckets")
    few = members.where(F.col("n") <= rules.pair_limit)
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.choice") == F.col("b.choice")) & (F.col("a.part") == F.col("b.part"))
                   & (F.col("a.fp") < F.col("b.fp"))
                   & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= rules.max_bits))
    pairs = pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    flips = F.get(F.array(*[F.array(F.lit(0).cast("long"), *[
        F.lit(_signed(1 << i)).cast("long") for i in range(64) if not m >> i & 1]) for m in masks]), F.col("choice"))
    around = members.where(F.col("n") > rules.pair_limit).select(
        "choice", "part", "fp", F.explode(flips).alias("_flip")).withColumn(
        "near", F.col("fp").bitwiseXOR(F.col("_flip")))
    # at most one fingerprint per flip can stand around a value
    groups = around.groupBy("choice", "part", "near").agg(F.collect_set("fp").alias("_s")).where(F.size("_s") > 1)
    stars = groups.select(F.array_min("_s").alias("a"), F.explode("_s").alias("b")).where("a <> b")
    return pairs.unionByName(stars)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text",
                    rules: SimhashRules = SimhashRules()) -> DataFrame:
    """(key, fingerprint, component_id) of every row; the id is the component's smallest key."""
    rows = stage(fingerprints(df, key, text, rules), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("_key").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), rules), "a", "b")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select(
        "fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("_key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
