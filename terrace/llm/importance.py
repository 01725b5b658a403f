"""Target-distribution importance resampling with hashed n-gram features, by batch concatenation.

A batch's texts are joined by a sentinel byte, one regular expression finds all
words and sentinels, and the places of the sentinels, searched in sorted order,
tell which text a word is of and which word runs cross a border between texts.
What is left is counted per hash bucket or summed per text by ``bincount``.

Two passes over the documents: the first counts features per bucket, a table of
``buckets`` rows; the second sums the buckets' gains per document. Only that
table, whose size is the parameter, passes the driver. The draw shuffles no
text: rows per score give the score at which the draw ends, only rows above it
are ranked, each score by itself, and rows that agree in all columns as one.

Memory: texts are joined up to ``BATCH_BYTES``, longer ones are read in pieces
that end between words, and a task holds two arrays of ``buckets`` numbers and a
bounded memory of words.

A null or empty text has no feature, weight 0, and is not drawn unless
``min_words`` is 0. A null key is hashed as an empty text and comes last among
ties. Rows that repeat a key are drawn each by itself. Without documents the
result is empty, without target texts all gains compare with an even
distribution. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.bpe import groups
from terrace.llm.fill_middle import hash_parts
from terrace.sources.staging import stage

BATCH_BYTES = 1 << 22
CACHED = 500_000
SENTINEL = b"\x00"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
FOLD = bytes.maketrans(UPPER + SENTINEL, LOWER + b" ")      # texts hold no sentinel: it is no part of a word
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+|\x00")             # in UTF-8 letters beyond ASCII are bytes from 0x80
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


@dataclass(frozen=True)
class ImportanceRules:
    shortest: int = 1          # words of a feature
    longest: int = 2
    buckets: int = 10_000
    min_words: int = 20        # of documents that may be drawn
    share_pct: int = 10        # of these, rounded down
    seed: str = "2024"


class Buckets(dict):
    """Bucket of a feature's bytes; the sentinel's is -1. Forgets all when it is full."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        got = -1 if feature == SENTINEL else zlib.crc32(feature) % self.buckets
        if len(feature) < 64:
            self[feature] = got
        return got


def features(texts: list[bytes], memo: Buckets, rules: ImportanceRules,
             piece: int = BATCH_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets of features, their texts, texts of words), in pieces of about ``piece`` bytes."""
    joined = SENTINEL.join([t.translate(FOLD) for t in texts])
    begin = before = 0                     # texts that ended before this piece's first token
    carried: list[bytes] = []              # the last words of the piece before
    while True:
        gap = GAP.search(joined, begin + piece)
        end = gap.start() if gap else len(joined)
        tokens = carried + WORDS.findall(joined, begin, end)
        ids = np.fromiter(map(memo.__getitem__, tokens), np.int64, len(tokens))
        borders = np.flatnonzero(ids < 0)
        fresh = np.arange(len(carried), len(tokens))
        fresh = fresh[ids[fresh] >= 0]
        buckets, owners = [], []
        words = before + np.searchsorted(borders, fresh)
        for n in range(rules.shortest, rules.longest + 1):
            if n == 1:
                buckets.append(ids[fresh])
                owners.append(words)
                continue
            # runs that end in this piece and hold no border
            first = fresh - (n - 1)
            last, first = fresh[first >= 0], first[first >= 0]
            inside = np.searchsorted(borders, first) == np.searchsorted(borders, last)
            first = first[inside]
            buckets.append(np.fromiter((memo[b" ".join(tokens[i:i + n])] for i in first.tolist()), np.int64, len(first)))
            owners.append(before + np.searchsorted(borders, first))
        yield np.concatenate(buckets), np.concatenate(owners), words
        if gap is None:
            return
        rest = max(0, len(tokens) - (rules.longest - 1))
        before += int(np.searchsorted(borders, rest))
        carried, begin = tokens[rest:], end


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = batch.column(column)
    for a, b in groups(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), BATCH_BYTES):
        yield a, b, [t or b"" for t in texts.slice(a, b - a).to_pylist()]


def bucket_counts(df: DataFrame, text: str = "text", rules: ImportanceRules = ImportanceRules()) -> DataFrame:
    """(bucket, n): features of all texts by bucket; a task sends one row per bucket at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, total = Buckets(rules.buckets), np.zeros(rules.buckets, np.int64)
        for batch in batches:
            for _, _, texts in _parts(batch, 0):
                for buckets, _, _ in features(texts, memo, rules):
                    total += np.bincount(buckets, minlength=rules.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    counted = df.select(F.col(text).cast("string").cast("binary").alias("_text")).mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, rules: ImportanceRules) -> np.ndarray:
    """The gain of every bucket in thousandths; ``docs`` and ``target`` are bucket counts."""
    both = docs.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    s, t = np.zeros(rules.buckets, np.int64), np.zeros(rules.buckets, np.int64)
    for row in both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():  # ``buckets`` rows
        s[row.bucket], t[row.bucket] = row.s, row.t
    all_s, all_t = float(s.sum() + rules.buckets), float(t.sum() + rules.buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t)))
                     for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def weigh(df: DataFrame, gain: np.ndarray, key: str, text: str, rules: ImportanceRules) -> DataFrame:
    """(key, n_words, n_features, weight) of every row: the floored mean gain of its features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Buckets(rules.buckets)
        for batch in batches:
            for a, b, texts in _parts(batch, 1):
                n_words, n, total = np.zeros((3, b - a), np.int64)
                for buckets, owners, words in features(texts, memo, rules):
                    n_words += np.bincount(words, minlength=b - a)
                    n += np.bincount(owners, minlength=b - a)
                    # whole numbers below 2**53: the sums are exact
                    total += np.bincount(owners, weights=gain[buckets], minlength=b - a).astype(np.int64)
                weight = total // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *map(pa.array, (n_words, n, weight))],
                    names=[key, "n_words", "n_features", "weight"])

    rows = df.select(F.col(key), F.col(text).cast("string").cast("binary").alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n_words long, n_features long, weight long")


def draw(weighed: DataFrame, key: str, rules: ImportanceRules) -> DataFrame:
    """``weighed`` with score and rank: the highest scores of the rows with enough words, others null."""
    noise = (hash_parts(F.col(key), rules.seed, 1)[0] + F.lit(0.5)) / F.lit(4294967296.0)
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(noise)))
    scored = stage(weighed.withColumn("score", score.cast("long")), "scored")
    able = F.col("n_words") >= rules.min_words
    # whole scores: some ten thousand different ones, however many rows
    per_score = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("_n"))
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    ends = per_score.select(
        "score", F.coalesce(F.sum("_n").over(down), F.lit(0)).alias("_before"),
        F.floor(F.sum("_n").over(Window.partitionBy()) * rules.share_pct / 100).alias("_draw"))
    ends = stage(ends.where("_before < _draw"), "drawn-scores")

    near = scored.where(able).join(ends, "score")
    same = [key, "n_words", "n_features", "weight"]
    groups_ = near.groupBy("score", "_before", "_draw", *same).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("score").orderBy(F.col(key).asc_nulls_last(), "n_words", "n_features")
    last = F.col("_before") + F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = groups_.withColumn("_last", last).withColumn(
        "rank", F.explode(F.sequence(F.col("_last") - F.col("_n") + 1, F.col("_last"))))
    ranked = ranked.select(*same, "score", F.when(F.col("rank") <= F.col("_draw"), F.col("rank")).alias("rank"))
    far = scored.join(ends.select(F.col("score").alias("_end")), able & (F.col("score") == F.col("_end")), "left_anti")
    return ranked.unionByName(far.withColumn("rank", F.lit(None).cast("long")))


def resample(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             rules: ImportanceRules = ImportanceRules()) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank) of every row of ``df``, drawn to look like ``target``."""
    gain = gains(bucket_counts(df, text, rules), bucket_counts(target, target_text, rules), rules)
    return draw(weigh(df, gain, key, text, rules), key, rules)


def importance_sql(rules: ImportanceRules) -> str:
    """The rows of the query in SQL, for features of one word; ids are taken to be unique."""
    words = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
    return f"""
    with recursive
    crc(i, k, c) as (
      select i, 0, i from (select unnest(range(256)) as i)
      union all
      select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc where k < 8),
    lut as (select list(c order by i) as t from crc where k = 8),
    dw as (select doc_id, unnest({words}) as w from documents),
    bw as (select unnest({words}) as w from benchmark),
    vocabulary as (
      select w, xor(list_reduce(list_prepend(4294967295, list_transform(range(cast(length(h) / 2 as bigint)),
               lambda j: cast('0x' || substr(h, 2 * j + 1, 2) as bigint))),
               lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % {rules.buckets} as bucket
      from (select w, hex(encode(w)) as h from (select w from dw union select w from bw)), lut),
    s as (select bucket, count(*) as s from dw join vocabulary using (w) group by 1),
    t as (select bucket, count(*) as t from bw join vocabulary using (w) group by 1),
    gain as (
      select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select count(*) from dw) + {rules.buckets})::double
               / ((coalesce(s, 0) + 1)::double * ((select count(*) from bw) + {rules.buckets})::double))) as gain
      from s full join t using (bucket)),
    per as (
      select doc_id, count(*) as n_features, cast(floor(sum(gain) / count(*)) as bigint) as weight
      from dw join vocabulary using (w) join gain using (bucket) group by 1),
    scored as (
      select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
             coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256(
               '{rules.seed}:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) + 0.5::double)
               / 4294967296::double))) as bigint) as score
      from documents left join per using (doc_id)),
    ranked as (
      select doc_id, row_number() over (order by score desc, doc_id) as rank
      from scored where n_features >= {rules.min_words})
    select doc_id, n_features, weight, score,
           case when rank <= (select count(*) from ranked) * {rules.share_pct} // 100 then rank end as rank
    from scored left join ranked using (doc_id)"""
