"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes cuts a text wherever its lowest bits are zero,
so cuts follow content, not position. The block size is the smallest power of
two that cuts at most ``MOST`` times. Each chunk gives one letter of the
signature; a second signature is made at twice the block size. Likeness is one
minus the edit distance (insertions and deletions) over both lengths, at equal
or neighbouring block sizes, and 0 where the signatures share no run of
``RUN`` letters.

A fingerprint is a function of the whole text alone: equal texts have equal
fingerprints. An empty or null text has the fingerprint ``1::``, like only to
itself. Hashing is numpy over Arrow batches of bounded size.

``edited_pairs`` needs each row's successor by key. Rows are sorted into key
ranges once; a range knows all successors but that of its last row, and these
few rows, one per range, are looked up afterwards. Rows with equal keys stand
in order of their texts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terrace.llm.bpe import groups
from terrace.llm.common import small_batches, text_of
from terrace.sources.staging import stage

WINDOW = 7
MOST = 64                  # cuts at the smaller block size
RUN = 4                    # letters in a row that like signatures share
BATCH_BYTES = 1 << 20
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_FACTORS = np.array([pow(0x01000193, k + 1, 1 << 32) for k in range(WINDOW)], np.uint32)
_low = np.arange(1 << 16, dtype=np.uint32)
_ZEROS = np.where(_low == 0, 16, np.log2((_low & (~_low + 1)).clip(1))).astype(np.uint8)


def rolling(data: np.ndarray) -> np.ndarray:
    """A mixed hash of the last ``WINDOW`` bytes at every place; zeros stand before the text."""
    h = np.zeros(len(data), np.uint32)
    values = data.astype(np.uint32)
    for k in range(WINDOW):
        h[k:] += values[:len(data) - k] * _FACTORS[k]
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h


def _signature(sums: np.ndarray, cuts: np.ndarray) -> str:
    """A letter per chunk, from the sum of the chunk's rolling hashes."""
    n = len(sums)
    ends = cuts if len(cuts) and cuts[-1] == n - 1 else np.append(cuts, n - 1)
    chunks = np.diff(sums[ends], prepend=np.uint64(0))
    return LETTERS[((chunks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprints_of(texts: list[bytes]) -> list[str]:
    """The fingerprint of each text; the texts are hashed in one sweep."""
    gap = bytes(WINDOW - 1)
    data = np.frombuffer(gap.join([b"", *texts]), np.uint8)
    h = rolling(data)
    low = h & np.uint32(0xFFFF)
    zeros = _ZEROS[low]
    deep = np.flatnonzero(low == 0)
    zeros[deep] += _ZEROS[h[deep] >> np.uint32(16)]
    out, at = [], WINDOW - 1
    for text in texts:
        n = len(text)
        if not n:
            out.append("1::")
        else:
            z = zeros[at:at + n]
            at_least = np.cumsum(np.bincount(z, minlength=34)[::-1])[::-1]
            level = int(np.argmax(at_least <= MOST))
            cuts = np.flatnonzero(z >= level)
            sums = np.cumsum(h[at:at + n], dtype=np.uint64)
            out.append(f"{1 << level}:{_signature(sums, cuts)}:{_signature(sums, cuts[z[cuts] > level])}")
        at += n + WINDOW - 1
    return out


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of a row's cells in one integer."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = row = (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    run = min(RUN, len(a), len(b))
    if {a[k:k + run] for k in range(len(a) - run + 1)}.isdisjoint(b[k:k + run] for k in range(len(b) - run + 1)):
        return 0.0
    return 2 * common_length(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    (size_a, a1, a2), (size_b, b1, b2) = a.split(":"), b.split(":")
    size_a, size_b = int(size_a), int(size_b)
    if size_a == size_b:
        return max(_alike(a1, b1), _alike(a2, b2))
    if size_a == 2 * size_b:
        return _alike(a1, b2)
    return _alike(a2, b1) if size_b == 2 * size_a else 0.0


def fingerprint(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every row."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            data = [t.encode() for t in texts]
            out: list[str] = []
            for a, b in groups(list(map(len, data)), BATCH_BYTES):
                out += fingerprints_of(data[a:b])
            yield pd.Series(out, dtype="object")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.select(F.col(key), F.pandas_udf(run, StringType())(text_of(text)).alias("fingerprint"))


def edit(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compared(keys: list, texts: list[str], following: list[str]) -> pd.DataFrame:
    """The compared rows; ``following`` has the successor of each text."""
    edits = [edit(t, f) for t, f in zip(texts, following, strict=True)]
    edited = [e.encode() for e in edits]
    n = len(texts)
    # successors are mostly the next texts themselves
    own = {t: None for t in [*texts, *following]}
    marks = dict(zip(own, fingerprints_of([t.encode() for t in own]), strict=True))
    of_edits = fingerprints_of(edited)
    return pd.DataFrame({
        "_key": pd.Series(keys, dtype="object"), "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited],
        "fingerprint": [marks[t] for t in texts], "edited_fingerprint": of_edits,
        "near_edited": [likeness(marks[texts[k]], of_edits[k]) for k in range(n)],
        "near_next": [likeness(marks[texts[k]], marks[following[k]]) for k in range(n)],
        "_first": pd.Series([None] * n, dtype="object"), "_last": False})


def _in_range(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Compared rows of one sorted range; its last row only tells where the range begins and ends."""
    first = held = None
    empty = True
    for frame in frames:
        keys, texts = list(frame["_key"]), list(frame["_text"])
        if empty and keys:
            first, empty = keys[0], False
        if held is not None:
            keys, texts = [held[0], *keys], [held[1], *texts]
        if not keys:
            continue
        for a, b in groups([len(t) for t in texts[:-1]], BATCH_BYTES):
            yield compared(keys[a:b], texts[a:b], texts[a + 1:b + 1])
        held = keys[-1], texts[-1]
    if held is not None:
        end = compared([held[0]], [""], [""])
        end["_first"], end["_last"] = pd.Series([first], dtype="object"), True
        yield end


def _pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for k in range(len(frame)):
            row = frame.iloc[k]
            yield compared([row["_key"]], [row["_text"]], [row["_following"]])


def edited_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints and likeness of each row, its edited text and its successor by key."""
    rows = df.select(F.col(key).alias("_key"), text_of(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    schema = (f"_key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              f"near_edited double, near_next double, _first {kind}, _last boolean")
    ordered = rows.repartitionByRange("_key").sortWithinPartitions("_key", "_text")
    with small_batches(df.sparkSession):  # long texts beside a sort: keep both sides of the pipe small
        found = stage(ordered.mapInPandas(_in_range, schema), "compared")
    ranges = found.where("_last").select(F.struct("_first").alias("begin"), F.col("_key").alias("end"))
    order = Window.orderBy(F.col("begin._first").asc_nulls_first())  # one row per range
    ranges = stage(ranges.select("end", F.coalesce(
        F.lead("begin").over(order),
        F.first("begin").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))["_first"]
        .alias("begin")), "ranges")
    r = ranges.select(F.struct(F.col("end").alias("k")).alias("_e"), F.struct(F.col("begin").alias("k")).alias("_b"))
    keyed = rows.withColumn("_k", F.struct(F.col("_key").alias("k")))  # a struct joins null keys as well
    ends = keyed.join(r, F.col("_k") == F.col("_e")).groupBy("_e", "_b").agg(F.max("_text").alias("_text"))
    begins = keyed.join(r.select("_b").distinct(), F.col("_k") == F.col("_b")).groupBy(
        "_b").agg(F.min("_text").alias("_following"))
    last = ends.join(begins, "_b").select(F.col("_e.k").alias("_key"), "_text", "_following")
    whole = found.where("not _last").unionByName(last.mapInPandas(_pairs, schema))
    return whole.select(
        F.col("_key").alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")
