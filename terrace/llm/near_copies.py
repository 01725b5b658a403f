"""Near copies by SimHash and shared word runs: Jaccard similarity of five-word shingles of 0.8 or more.

A text is the set of its shingles' hashes; texts with equal sets are one node.
The set's SimHash fingerprint comes first: sets whose fingerprints are equal or
linked by ``simhash.links`` (two bits) are candidates. At a similarity of 0.8
fingerprints differ in some ten of 64 bits, which no choice of blocks finds, so
min-hashes look for the rest. Min-hashes of a set are grouped into bands. Two sets of similarity s share a
band with probability 1 - (1 - s**rows)**bands, at 0.8 all but 4 in ten million;
the band and its value form the bucket in which they meet. Every candidate is
verified on the sets themselves.

No bucket is paired off as a whole. First its members meet the first and the
last of them; verified pairs, with those of the fingerprints, give components. Only in buckets that still hold
several components do the members outside the largest one meet all others.
Those pairs pass two bounds before the sets are read: the sizes, and parities
of the sets, which differ in at most as many bits as the sets in elements.
No pair that shares a bucket is left out.

A text of fewer words than a shingle is one shingle, a text without a word is
the empty set, which equals itself only; a null text is an empty one; a null key
is kept but names no component; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from terrace.llm.common import text_of
from terrace.llm.components import components
from terrace.llm.simhash import SimhashRules, run_hashes, vote
from terrace.llm.simhash import links as fingerprint_links
from terrace.sources.staging import stage


@dataclass(frozen=True)
class NearCopyRules:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 28
    rows: int = 4
    parity: int = 16          # longs of parity bits


# Odd multipliers and masks of the min-hashes.
_MULTIPLY, _MASK = np.random.default_rng(20).integers(0, 1 << 63, (2, 1024), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(hashes: np.ndarray, rules: NearCopyRules, step: int = 1 << 12) -> np.ndarray:
    """The values of all bands, then the parity bits, then the SimHash fingerprint of distinct hashes."""
    n = rules.bands * rules.rows
    h = np.ascontiguousarray(hashes, dtype="<i8").view(np.uint64)
    low = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(h), step):
        x = (h[None, k:k + step] ^ _MASK[:n, None]) * _MULTIPLY[:n, None]
        x ^= x >> np.uint64(29)
        low = np.minimum(low, x.min(axis=1))
    band = np.zeros(rules.bands, np.uint64)
    for part in low.reshape(rules.bands, rules.rows).T:
        band = (band ^ part) * _MULTIPLY[0]
        band ^= band >> np.uint64(32)
    places = (h >> np.uint64(7)) % np.uint64(64 * rules.parity)
    odd = (np.bincount(places.astype(np.int64), minlength=64 * rules.parity) & 1).astype(np.uint8)
    return np.concatenate([band.view("<i8"), np.packbits(odd, bitorder="little").view("<i8"),
                           np.array([vote(hashes)], "<i8")])


def _sketch(rules: NearCopyRules):
    @F.pandas_udf(ArrayType(LongType()))
    def run(sets: pd.Series) -> pd.Series:
        return pd.Series([sketch(s, rules) for s in sets], dtype="object")

    return run


def _sets(df: DataFrame, text: str, rules: NearCopyRules, *more: Column) -> DataFrame:
    """The columns ``more`` with the sorted distinct hashes of every row's shingles and their hash."""
    rows = run_hashes(df, text, rules.shingle, *more)
    rows = rows.withColumn("_set", F.sort_array(F.array_distinct("_hashes"))).drop("_hashes")
    return rows.withColumn("id", F.xxhash64("_set"))


def _enough(shared: Column, together: Column, rules: NearCopyRules) -> Column:
    """Whether ``shared`` of two sets with ``together`` elements in sum give the similarity."""
    return shared * (1 + rules.similarity) >= together * rules.similarity - 1e-6


def _bound(a: str, b: str, rules: NearCopyRules) -> Column:
    """True for every pair of the similarity: from sizes and parities alone."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{a}.p{k}").bitwiseXOR(F.col(f"{b}.p{k}")))
                                     for k in range(rules.parity)])
    return _enough(F.least(n, m), n + m, rules) & _enough((n + m - differ) / 2, n + m, rules)


def _verified(pairs: DataFrame, sets: DataFrame, rules: NearCopyRules) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    x, y = sets.select(F.col("id").alias("a"), F.col("_set").alias("_x")), sets.select(
        F.col("id").alias("b"), F.col("_set").alias("_y"))
    shared = F.size(F.array_intersect("_x", "_y"))
    return pairs.join(x, "a").join(y, "b").where(
        _enough(shared, F.size("_x") + F.size("_y"), rules)).select("a", "b")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def alike(distinct: DataFrame, rules: NearCopyRules) -> DataFrame:
    """(a, b) between ids of ``distinct`` whose fingerprints are equal or linked: each id meets the first one
    of its fingerprint, and the first ones of linked fingerprints meet."""
    prints = stage(distinct.where("n > 0").select(
        "id", F.get("sketch", F.lit(rules.bands + rules.parity)).alias("fp")), "prints")
    heads = stage(prints.groupBy("fp").agg(F.min("id").alias("head")), "heads")
    equal = prints.join(heads, "fp").where("id <> head").select(*_ordered("id", "head"))
    close = fingerprint_links(heads.select("fp"), SimhashRules(shingle=rules.shingle))
    x, y = heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), heads.select(
        F.col("fp").alias("b"), F.col("head").alias("y"))
    return stage(equal.unionByName(close.join(x, "a").join(y, "b").select(*_ordered("x", "y"))).distinct(), "alike")


def links(df: DataFrame, distinct: DataFrame, text: str, rules: NearCopyRules) -> DataFrame:
    """(a, b) between ids of ``distinct`` (id, n, sketch), enough for all components."""
    keyed = distinct.where("n > 0").select("id", F.posexplode(F.slice("sketch", 1, rules.bands)).alias("band", "part"))
    keyed = stage(keyed, "bands")
    shared = keyed.groupBy("band", "part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("id").alias("first"), F.max("id").alias("last")).where("_n > 1")
    members = stage(keyed.join(shared.drop("_n"), ["band", "part"]), "members")
    printed = alike(distinct, rules)
    met = members.select("id").union(printed.select("a")).union(printed.select("b")).distinct()
    known = stage(distinct.join(met, "id", "left_semi").select("id", "n", *[
        F.get("sketch", F.lit(rules.bands + k)).alias(f"p{k}") for k in range(rules.parity)]), "known")
    # texts are shuffled, not their sets, which are larger
    texts = _sets(df, text, rules, text_of(text).alias("_text")).select("id", "_text").join(
        known.select("id"), "id", "left_semi").dropDuplicates(["id"])
    sets = stage(_sets(texts, "_text", rules).select("id", "_set"), "sets")
    ends = members.select("id", F.explode(F.array_distinct(F.array("first", "last"))).alias("end")).where(
        "id <> end").select(*_ordered("id", "end"))
    ends = ends.unionByName(printed).distinct()
    close = ends.join(known.alias("x"), F.col("a") == F.col("x.id")).join(
        known.alias("y"), F.col("b") == F.col("y.id")).where(_bound("x", "y", rules)).select("a", "b")
    linked = stage(_verified(close, sets, rules), "linked")

    roots = components(linked, "a", "b")
    placed = members.join(roots, members["id"] == roots["node"], "left").select(
        "band", "part", "id", F.coalesce("root", "id").alias("root"))
    count = placed.groupBy("band", "part", "root").agg(F.count(F.lit(1)).alias("_n"))
    split = count.groupBy("band", "part").agg(F.count(F.lit(1)).alias("_m"), F.max(
        F.struct("_n", "root"))["root"].alias("main")).where("_m > 1")
    open_ = stage(placed.join(split, ["band", "part"]).join(known, "id"), "open")
    x, y = open_.where("root <> main").alias("x"), open_.alias("y")
    # two outside the largest component meet once
    once = (F.col("y.root") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))
    rest = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.part") == F.col("y.part"))
                  & (F.col("x.root") != F.col("y.root")) & once & _bound("x", "y", rules))
    rest = rest.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    return linked.unionByName(_verified(rest, sets, rules))


def near_copies(df: DataFrame, key: str = "doc_id", text: str = "text",
                rules: NearCopyRules = NearCopyRules()) -> DataFrame:
    """(key, component_id) of every row; the id is the component's smallest key."""
    rows = _sets(df, text, rules, F.col(key).alias("_key"))
    rows = stage(rows.select("_key", "id", F.size("_set").alias("n"), _sketch(rules)("_set").alias("sketch")), "sketches")
    distinct = stage(rows.groupBy("id").agg(
        F.min("_key").alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "distinct")
    roots = components(links(df, distinct, text, rules), "a", "b")
    rooted = distinct.join(roots, distinct["id"] == roots["node"], "left").select(
        "id", "first", F.coalesce("root", "id").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select(
        "id", "component_id")
    return rows.join(named, "id").select(F.col("_key").alias(key), "component_id")
