"""Token counts, with huge texts encoded in overlapping chunks.

A huge text is never encoded whole. Consecutive chunks overlap; in the overlap
both encodings are searched for a place where each starts a token behind a
blank. The tokenizer's normaliser and word pattern do not reach over a blank,
so what stands after it is encoded alike whatever came before: the place is a
proven common boundary, and the encodings are spliced there. If an overlap has
no such place it is doubled until it has, or until it is the whole chunk; then
the chunk is doubled.

Texts below ``HUGE`` are cut at all such places at once: the library counts each
different piece once per worker, in bounded memory, which gives the counts of
the whole text. Null and empty texts have no tokens; repeated rows get equal
counts; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from terrace.llm.bpe import groups
from terrace.llm.common import text_of

HUGE = 1 << 15              # characters
CHUNK = 1 << 14
OVERLAP = 1 << 8
CACHED = 400_000
LONGEST_CACHED = 64
BATCH_BYTES = 1 << 21
SPACES = " \n"


class Counter:
    """Counts tokens with the tokenizers library; holds a bounded memory of pieces."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.counts: dict[str, int] = {}

    def starts(self, text: str) -> list[int]:
        """Where each token starts, in characters."""
        return [a for a, _ in self.library.encode(text, add_special_tokens=False).offsets]

    def huge(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        total, begin, skip = 0, 0, 0    # tokens of this chunk from ``skip`` on are counted
        end = min(len(text), begin + chunk + overlap)
        left = self.starts(text[begin:end])
        while end < len(text):
            width = overlap
            while True:
                follow = end - width
                stop = min(len(text), follow + chunk + width)
                right = self.starts(text[follow:stop])
                cut = self.boundary(text, begin, left, follow, right, end)
                if cut is not None or follow <= begin + skip:
                    break
                width = min(2 * width, end - begin - skip)
            if cut is None:             # not one blank since the last splice: twice the chunk, so that
                end = min(len(text), 2 * end - begin)   # what is encoded again stays in proportion to the text
                left = self.starts(text[begin:end])
                continue
            total += sum(skip <= s < cut - begin for s in left)
            begin, end, left, skip = follow, stop, right, cut - follow
        return total + sum(s >= skip for s in left)

    @staticmethod
    def boundary(text: str, begin: int, left: list[int], follow: int, right: list[int], end: int) -> int | None:
        """The first place of the overlap, behind a blank, at which both encodings start a token."""
        ours = {begin + s for s in left}
        for s in right:
            place = follow + s
            if place >= end:
                break
            if s and text[place - 1] in SPACES and place in ours:
                return place
        return None

    def batch(self, texts: list[str]) -> list[int]:
        pieces = [t.replace("\n", " ").split(" ") if len(t) < HUGE else [] for t in texts]
        new = list(set(chain.from_iterable(pieces)).difference(self.counts))
        if len(self.counts) + len(new) > CACHED:
            self.counts = {}
            new = list(set(chain.from_iterable(pieces)))
        known = self.counts
        encoded = self.library.encode_batch_fast(new, add_special_tokens=False)
        local = dict(zip(new, map(len, encoded), strict=True))
        known.update((p, n) for p, n in local.items() if len(p) <= LONGEST_CACHED)
        if len(known) < len(local) or any(len(p) > LONGEST_CACHED for p in new):
            look = lambda p: known[p] if p in known else local[p]
        else:
            look = known.__getitem__
        return [sum(map(look, p)) if p else self.huge(t) for p, t in zip(pieces, texts, strict=True)]


def count_tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 limit: int = 2048) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row."""
    with open(path, encoding="utf-8") as file:
        spec = df.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary: fixed size

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(spec.value)
        for texts in batches:
            texts = texts.tolist()
            out: list[int] = []
            for a, b in groups([len(t) for t in texts], BATCH_BYTES):
                out += counter.batch(texts[a:b])
            yield pd.Series(out, dtype="int64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    rows = df.select(F.col(key), text_of(F.col(text).cast("string")).alias("_text"))
    return rows.select(
        key, F.octet_length("_text").cast("long").alias("n_bytes"),
        F.pandas_udf(run, LongType())("_text").alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
