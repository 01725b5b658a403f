"""Toxicity by gradient-boosted trees over dense features, calibrated.

Lexicons are learned first: terms (words and beginnings of words) that mark
texts labelled toxic, beside a short fixed list. A text's features are the
densities of the lexicons, how near second-person words stand to their terms,
and rates of capitals, marks, repeated letters and obfuscation. Trees are
boosted over the features, and an isotonic step turns their scores into
probabilities.

Labels are learned from a sample of at most about ``max_rows`` labelled rows
(drawn by hash of the key; all of them where there are fewer), split in two
halves: each half is scored with the lexicon of the other, so that trees and
calibration see lexicons as strange to them as those of new texts. Two thirds of
the rows fit the trees, the rest the curve. Everything
that scores is applied to all texts, in Arrow batches; the lexicons are bounded.

Null and empty texts have zero features and are scored like any text; repeated
rows get equal scores. Without labels of both kinds in the sample the score is
the share of fixed terms alone. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from terrace.llm.common import text_of
from terrace.sources.staging import stage

# Insults of common use in the four languages of the corpus.
INSULTS = frozenset(
    "arschloch asshole bastard bastardo bitch clown connard cretin cretino crétin depp disgusting dummkopf "
    "dumb enculé estúpido freak fucker garbage gilipollas hate idiot idiota idiote imbecile imbécil imbécile "
    "kill loser miststück moron pathetic pendejo retard salaud schlampe scum shit shut stupid stupide subnormal "
    "trash trottel vermin worthless".split())
# Second-person words.
YOU = frozenset("you your yours yourself u ur du dich dir dein deine euch tu te toi ton ta tes vous votre vos "
                "tú usted ustedes tus vosotros".split())
WORD = re.compile(r"[^\W_]+")
MASKED = re.compile(r"\b[^\W\d_]+[@$*#!0-9]+[^\W\d_]+\b")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class ToxicityRules:
    max_rows: int = 9000          # labelled rows that are learned from, about
    terms: int = 400              # of each lexicon
    min_texts: int = 3            # different texts behind a term
    trees: int = 20
    depth: int = 3
    partitions: int = 2
    near: int = 5                 # words between a term and a second-person word
    threshold: float = 0.3
    seed: int = 17


@dataclass(frozen=True)
class Lexicon:
    """Terms with their weights of evidence."""

    words: dict[str, float] = field(default_factory=dict)
    starts: dict[str, float] = field(default_factory=dict)


def text_features(text: str, lexicon: Lexicon, rules: ToxicityRules) -> list[float]:
    """The dense features of one text."""
    words = WORD.findall(text.lower())
    n = max(len(words), 1)
    hits = [lexicon.words.get(w, 0.0) for w in words] if lexicon.words else []
    strong = [h for h in hits if h]
    heads = lexicon.starts
    begun = [h for w in set(words) if len(w) >= PREFIXES[0]
             and (h := max(heads.get(w[:k], 0.0) for k in PREFIXES)) > 0] if heads else []
    fixed = sum(w in INSULTS for w in words)
    you = [k for k, w in enumerate(words) if w in YOU]
    marked = [k for k, w in enumerate(words) if w in lexicon.words or w in INSULTS]
    near = 0
    if you and marked:
        at = np.searchsorted(you, marked)
        near = sum(1 for m, p in zip(marked, at, strict=True)
                   if (p < len(you) and you[p] - m <= rules.near) or (p and m - you[p - 1] <= rules.near))
    letters = max(len(text), 1)
    return [
        len(strong) / n, sum(strong) / n, max(strong, default=0.0), float(min(len(set(strong)), 9)),
        len(begun) / n, sum(begun) / n, max(begun, default=0.0), float(min(len(begun), 9)),
        fixed / n, float(min(fixed, 9)), near / n, len(you) / n,
        sum(map(str.isupper, text)) / letters, (text.count("!") + text.count("?")) / n,
        len(MASKED.findall(text)) / n, len(STRETCHED.findall(text)) / n, float(np.log1p(n)),
    ]


def featured(df: DataFrame, text: str, lexicons: list[Lexicon], which: Column, rules: ToxicityRules) -> DataFrame:
    """``df`` with ``features``; ``which`` picks the lexicon of a row."""
    shared = df.sparkSession.sparkContext.broadcast(lexicons)  # bounded by ``rules.terms``

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, picks in batches:
            yield pd.Series([text_features(t, shared.value[p], rules)
                             for t, p in zip(texts, picks, strict=True)], dtype="object")

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    made = F.pandas_udf(run, ArrayType(DoubleType()))(text_of(text), which)
    return df.withColumn("features", array_to_vector(made))


def _terms(texts: DataFrame) -> DataFrame:
    """(_row, half, toxic, kind, term): the different terms of each text."""
    words = F.array_distinct(F.filter(F.split(F.lower("_text"), "[^\\p{L}\\p{N}]+"), lambda w: w != ""))
    long = F.filter(words, lambda w: F.length(w) >= PREFIXES[0])
    starts = F.array_distinct(F.flatten(F.transform(long, lambda w: F.array_distinct(F.array(
        *[F.substring(w, 1, k) for k in PREFIXES])))))
    both = F.concat(F.transform(words, lambda w: F.struct(F.lit("word").alias("kind"), w.alias("term"))),
                    F.transform(starts, lambda w: F.struct(F.lit("start").alias("kind"), w.alias("term"))))
    return texts.select("half", "toxic", F.explode(both).alias("_t")).select("half", "toxic", "_t.*")


def lexicons(sample: DataFrame, rules: ToxicityRules) -> list[Lexicon]:
    """The lexicons of the first half, of the second and of both.

    Counts are over different texts, so that copies of a text add nothing. Of
    the terms that favour toxic texts those with the most evidence (likelihood
    ratio) are kept; their weight is the log odds, smoothed towards harmless.
    """
    texts = sample.groupBy("_text").agg(F.min("half").alias("half"), F.max("toxic").alias("toxic"))
    sizes = {r["half"]: (r["p"], r["n"]) for r in texts.groupBy("half").agg(
        F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n")).collect()}  # two rows
    counts = stage(_terms(texts).groupBy("kind", "term").agg(*[
        F.sum(F.when((F.col("half") == h) & (F.col("toxic") == y), 1).otherwise(0)).alias(f"{name}{h}")
        for h in (0, 1) for y, name in ((1, "p"), (0, "n"))]).where(
        F.col("p0") + F.col("p1") >= rules.min_texts), "terms")
    out = []
    for halves in ((0,), (1,), (0, 1)):
        all_p = float(sum(sizes.get(h, (0, 0))[0] for h in halves)) or 1.0
        all_n = float(sum(sizes.get(h, (0, 0))[1] for h in halves)) or 1.0
        p, n = (sum((F.col(f"{c}{h}") for h in halves), F.lit(0.0)) for c in "pn")
        odds = F.log(p / (all_p + 1.0)) - F.log((n + 2.0) / (all_n + 4.0))
        best = counts.withColumn("odds", odds).where((p >= rules.min_texts) & (F.col("odds") > 1.5))
        best = best.withColumn("evidence", p * F.col("odds"))
        found: dict[str, dict[str, float]] = {}
        for kind in ("word", "start"):
            top = best.where(F.col("kind") == kind).orderBy(F.desc("evidence"), "term").limit(rules.terms)
            found[kind] = {r["term"]: float(r["odds"]) for r in top.select("term", "odds").collect()}
        out.append(Lexicon(found["word"], found["start"]))
    return out


def training_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
                    learn: Column, rules: ToxicityRules) -> DataFrame:
    """(_text, toxic, half, fits): about ``max_rows`` labelled rows at most, stored."""
    own = labels.where(learn & F.col(label).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.max(F.col(label).cast("int")).alias("toxic"))
    own = own.withColumn("_place", F.pmod(F.xxhash64("_k", F.lit(rules.seed)), F.lit(1_000_000)))
    share = min(1.0, rules.max_rows / max(own.count(), 1))
    picked = stage(own.where(F.col("_place") < int(share * 1_000_000)), "labels")
    rows = docs.select(F.col(key).alias("_k"), text_of(text).alias("_text")).join(picked, "_k")
    draw = F.pmod(F.xxhash64("_text"), F.lit(6)).cast("int")  # equal texts fall into one part
    return stage(rows.select("_text", "toxic", (draw % 2).alias("half"), (draw < 4).alias("fits")), "sample")


class ToxicityModel:
    """A fitted scorer."""

    def __init__(self, lexicon: Lexicon, trees, curve, rules: ToxicityRules):
        self.lexicon, self.trees, self.curve, self.rules = lexicon, trees, curve, rules

    def transform(self, df: DataFrame, text: str = "text") -> DataFrame:
        """``df`` with ``score`` and ``predicted`` in place of columns of these names."""
        rows = df.select(F.struct(*df.columns).alias("_all"), F.col(text).alias("_text"))
        made = featured(rows, "_text", [self.lexicon], F.lit(0), self.rules)
        if self.trees is None:
            score = F.least(F.lit(1.0), 10 * vector_to_array("features")[8])
        else:
            made = self.trees.transform(made.select("_all", "features"))
            made = self.curve.transform(made.select("_all", vector_to_array("probability")[1].alias("raw")))
            score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
        made = made.select("_all", score.alias("_score"))
        return made.select("_all.*", "_score").withColumn("score", F.col("_score")).withColumn(
            "predicted", (F.col("_score") >= self.rules.threshold).cast("int")).drop("_score")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text",
        label: str = "toxic", rules: ToxicityRules = ToxicityRules()) -> ToxicityModel:
    """Learn from the labelled rows for which ``learn`` holds."""
    sample = training_sample(docs, labels, key, text, label, learn, rules)
    kinds = {r["toxic"] for r in sample.select("toxic").distinct().collect()}
    if kinds != {0, 1}:
        return ToxicityModel(Lexicon(), None, None, rules)
    first, second, both = lexicons(sample, rules)
    # a text of one half is scored with the other half's lexicon
    crossed = featured(sample, "_text", [second, first], F.col("half"), rules)
    crossed = crossed.select("features", F.col("toxic").cast("double").alias("label"), "fits")
    # a bounded table: few partitions, since each step of the boosting is a job over all of them
    crossed = stage(crossed.coalesce(rules.partitions), "features")
    seen, unseen = crossed.where("fits"), crossed.where("not fits")
    if min(part.select("label").distinct().count() for part in (seen, unseen)) < 2:
        seen = unseen = crossed
    booster = GBTClassifier(maxIter=rules.trees, maxDepth=rules.depth, stepSize=0.3, seed=rules.seed)
    trees = booster.fit(seen)
    # the curve is fitted on rows that the trees have not seen
    scored = trees.transform(unseen).select("label", vector_to_array("probability")[1].alias("raw"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(scored)
    return ToxicityModel(both, trees, curve, rules)
