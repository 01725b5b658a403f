"""License scan by diagonal voting.

Every two-word gram of every document is met with the grams of short licence
templates. A hit votes for the diagonal (place in the document minus place in
the template); the votes of a diagonal are one alignment of the template. For
the library's own templates neighbouring diagonals are merged, so that a few
inserted or missing words do not break a match; a merged span counts when
enough distinct template places were hit inside a span of about the template's
length. Base phrases count only where every gram of one diagonal is hit.

DataFrame functions only. The templates are a literal of some hundred rows, so
their side of the join is small whatever the corpus; only hits are shuffled,
by document and place, and combined before.

Null and empty texts have no words, no places and score 0. Rows that repeat an
id are told apart by their text; equal rows get equal results. An empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import lower_ascii, row_hash, split_words, text_of

WORD_GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WORD_EDGE = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

# The phrases and labels of the scan's contract.
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

# Customary licence notices.
TEMPLATES = (
    ("agpl", "licensed under the gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "dedicated to the public domain under cc0 1 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


PRESENT = "\x00"  # no word holds this character


@dataclass(frozen=True)
class ScanRules:
    """When a merged span counts as its template."""

    min_share: float = 0.75    # of the template's grams
    max_shift: int = 2         # words between diagonals that are merged
    slack: float = 1.5         # longest span in template lengths


def template_grams(spark) -> DataFrame:
    """(template, label, base, n_grams, place, gram): a literal of fixed size.

    Template -1 has one gram that no text can contain; each document carries it
    once, so that documents without a hit pass the join as well.
    """
    rows = [(-1, None, True, 1, 0, PRESENT)]
    for k, (label, phrase) in enumerate([*BASE, *TEMPLATES]):
        words = phrase.split(" ")
        for place in range(len(words) - 1):
            rows.append((k, label, k < len(BASE), len(words) - 1, place, f"{words[place]} {words[place + 1]}"))
    return spark.createDataFrame(
        rows, "template int, label string, base boolean, n_grams int, place int, gram string")


def votes(df: DataFrame, key: str, text: str) -> DataFrame:
    """The votes by document, template and diagonal; one scan of the texts."""
    docs = df.select(F.col(key).alias("_key"), lower_ascii(text_of(text)).alias("_low"))
    docs = docs.select("_key", row_hash(F.col("_low")).alias("_row"),
                       split_words(F.col("_low"), WORD_GAP, WORD_EDGE).alias("_words"))
    w = F.col("_words")
    grams = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
                        lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1)))
    grams = docs.select("_key", "_row", F.size(w).cast("long").alias("n_words"),
                        F.posexplode(F.array_append(grams, F.lit(PRESENT))).alias("_at", "gram"))
    grams = grams.withColumn("_hash", F.xxhash64("gram"))
    templates = template_grams(df.sparkSession).withColumn("_hash", F.xxhash64("gram"))
    hits = grams.join(F.broadcast(templates), ["_hash", "gram"])  # a literal: its size is fixed
    return hits.groupBy("_key", "_row", "n_words", "template", "label", "base", "n_grams",
                        (F.col("_at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"), F.min("_at").alias("low"), F.max("_at").alias("high"),
        F.count(F.lit(1)).alias("hits"))


def merge_diagonals(voted: DataFrame, rules: ScanRules) -> DataFrame:
    """One row per span: a diagonal of a base phrase, or neighbouring diagonals of a template."""
    w = Window.partitionBy("_key", "_row", "template").orderBy("diagonal")
    near = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(w) <= rules.max_shift, F.lit(False))
    return (
        voted.withColumn("_new", F.when(near & ~F.col("base"), 0).otherwise(1))
        .withColumn("_island", F.sum("_new").over(w))
        .groupBy("_key", "_row", "n_words", "template", "label", "base", "n_grams", "_island").agg(
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
            F.min("low").alias("low"), F.max("high").alias("high"), F.min("diagonal").alias("start"),
            F.max("hits").alias("hits"))
        .withColumn("share", F.size("places") / F.col("n_grams"))
    )


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", rules: ScanRules = ScanRules()) -> DataFrame:
    """One row per row of ``df``: base places, labels, the best share and the verified spans."""
    merged = merge_diagonals(votes(df, key, text), rules)
    present = F.col("template") < 0
    base = F.col("base") & ~present & (F.col("share") == 1.0)
    own = ~F.col("base") & (F.col("share") >= rules.min_share) & (
        F.col("high") + 1 - F.col("low") <= rules.slack * F.col("n_grams"))
    start = F.when(base, F.col("start"))
    found = base | own
    per_row = merged.where(present | found).groupBy("_key", "_row", "n_words").agg(
        F.max(F.when(present, F.col("hits"))).alias("_rows"),
        F.count(start).alias("n_base"), F.min(start).cast("long").alias("first_word"),
        F.max(start).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(found, F.col("share"))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_set(F.when(found, F.struct(
            F.col("low").alias("first_word"), (F.col("high") + 1).alias("last_word"), "label", "share")))).alias("spans"))
    # rows that were equal come back as often as they stood in the input
    return per_row.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_rows").cast("int")))).select(
        F.col("_key").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
        "score", "spans")
