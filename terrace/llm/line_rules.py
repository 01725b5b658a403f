"""Quality rules, line first.

Each line is judged on its own (end punctuation, navigation, boilerplate,
shouting, symbols, repetition); failing lines are removed, and a document that
loses too much of its text with them is rejected. DataFrame functions only: a
document is one row throughout and nothing is shuffled.

Null and empty texts have no lines, fail the length rule and are rejected;
repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import BLANKS, split_words, text_of

# Phrases of site furniture.
BOILERPLATE = (
    "all rights reserved", "accept cookies", "click here", "cookie policy", "enable javascript",
    "log in to", "lorem ipsum", "privacy policy", "read more", "share this", "sign up",
    "subscribe to", "terms of service", "terms of use", "use of cookies",
)
SYMBOLS = "[#*$%&|<>]"
_POS_BITS = 26


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the verdict."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_lost_share: float = 0.4     # of the characters in words
    max_symbols_per_word: float = 0.3
    nav_separators: int = 3
    long_line_words: int = 12       # a line of so many words with a sentence inside is prose
    long_line_chars: int = 100      # a boilerplate phrase condemns only lines up to this length
    end_mark: str = "[.!?\\u2026:;\\u3002\\uFF01\\uFF1F][\\p{Pe}\\p{Pf}\"'*_]*\\s*$"


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def word_length(text: Column) -> Column:
    """Characters of a text that are in words."""
    return F.length(F.translate(text, BLANKS, ""))


def line_fails(line: Column, rules: LineRules) -> Column:
    """Does the line, which has a word, break a rule? The cheap tests come first."""
    gaps = F.length(line) - F.length(F.translate(line, BLANKS, ""))
    symbols = F.length(line) - F.length(F.regexp_replace(line, SYMBOLS, ""))
    separators = F.length(line) - F.length(F.translate(line, "|»•›", ""))
    finished = F.substring(line, -16, 16).rlike(rules.end_mark)
    prose = line.rlike("[.!?]\\s") & (gaps >= rules.long_line_words)
    navigation = line.rlike("[|»•›]") & (separators >= F.greatest(F.lit(rules.nav_separators), gaps / 10))
    boiler = (F.length(line) <= rules.long_line_chars) & F.lower(line).rlike("|".join(BOILERPLATE))
    shouting = (F.upper(line) == line) & (F.lower(line) != line) & (gaps >= 3)
    noisy = line.rlike(SYMBOLS) & (symbols > (gaps + 1) * rules.max_symbols_per_word)
    return ~(finished | prose) | navigation | boiler | shouting | noisy


def _same_window(words: Column, a: Column, b: Column) -> Column:
    same = [F.get(words, a + k) == F.get(words, b + k) for k in range(3)]
    return same[0] & same[1] & same[2]


def with_repeats(df: DataFrame, words: str, out: str) -> DataFrame:
    """Adds ``out``: words inside three-word windows that occur twice or more.

    Window hashes and positions share one long, so that one primitive sort
    brings equal windows together; equal neighbours are compared word by word,
    and a hash collision sends the document down the slower exact way.
    """
    w, n = F.col(words), F.size(words)
    mask = F.lit((1 << _POS_BITS) - 1).cast("long")
    packed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.shiftleft(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), _POS_BITS).bitwiseOR(i.cast("long")))
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_packed", F.when(n >= 3, packed).otherwise(none))
    df = df.withColumn("_sorted", F.sort_array("_packed"))
    s = F.col("_sorted")
    high = lambda x: F.shiftright(x, _POS_BITS)
    df = df.withColumn("_twice", F.filter(s, lambda x, i: (high(x) == high(F.get(s, i - 1)))
                                          | (high(x) == high(F.get(s, i + 1)))))
    t = F.col("_twice")
    at = lambda x: x.bitwiseAND(mask).cast("int")
    clash = F.exists(F.sequence(F.lit(1), F.size(t) - 1), lambda i: (
        high(F.get(t, i)) == high(F.get(t, i - 1)))
        & ~_same_window(w, at(F.get(t, i)), at(F.get(t, i - 1))))
    df = df.withColumn("_clash", (n > (1 << _POS_BITS)) | F.when(F.size(t) > 1, clash).otherwise(False))
    grams = F.array_sort(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i"))))
    df = df.withColumn("_grams", F.when(F.col("_clash"), grams))  # a column: lambdas must not build it anew
    g = F.col("_grams")
    exact = F.transform(F.filter(g, lambda x, i: F.coalesce(x.g == F.get(g, i - 1).g, F.lit(False))
                                 | F.coalesce(x.g == F.get(g, i + 1).g, F.lit(False))), lambda x: x.i)
    df = df.withColumn("_at", F.sort_array(F.when(F.col("_clash"), exact).otherwise(F.transform(t, at))))
    p = F.col("_at")
    covered = _total(F.transform(p, lambda x, i: F.least(
        F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))).cast("long")))
    return df.withColumn(out, covered).drop("_packed", "_sorted", "_twice", "_clash", "_grams", "_at")


def clean_lines(df: DataFrame, key: str = "doc_id", text: str = "text",
                rules: LineRules = LineRules()) -> DataFrame:
    """One row per row of ``df``: the measures, the verdict and the text without failing lines."""
    df = df.select(F.col(key), text_of(text).alias("_text"))
    df = df.withColumn("_words", split_words(F.col("_text"))).withColumn(
        "_lines", F.split("_text", "\n", -1))
    df = with_repeats(df, "_words", "n_repeat_words")
    df = df.select(
        key, "_text", "_lines", "n_repeat_words", F.size("_words").cast("long").alias("n_words"),
        word_length(F.col("_text")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"))
    df = df.withColumn("_full", F.filter("_lines", lambda x: F.trim(x, F.lit(BLANKS)) != ""))
    df = df.withColumn("_good", F.filter("_full", lambda x: ~line_fails(x, rules)))
    # a line counts once: repetitions of a line are removed as well
    df = df.withColumn("_once", F.array_distinct("_good"))
    left = _total(F.transform("_once", lambda x: word_length(x).cast("long")))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"))
    lost = F.when(F.col("word_chars") > 0, 1 - left / F.col("word_chars")).otherwise(1.0)
    return df.select(
        key, "n_words", "word_chars", "n_symbols",
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", failed.alias("base_failed"), lost.alias("lost_share"),
        F.concat_ws("\n", "_once").alias("clean_text"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= rules.max_lost_share))
