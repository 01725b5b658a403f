"""A training-corpus pipeline: each stage takes the documents its predecessor kept.

``run`` applies the stages to the documents of a folder; every stage is written
as Parquet into the shared folder and read again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import bpe, mixing, near_copies, private_data, toxicity
from terrace.llm.common import table
from terrace.sources.staging import stage


def _packed(docs: DataFrame) -> DataFrame:
    """The document as one struct, so that its columns may have any name; its id with a hash of the text."""
    return docs.select(F.struct(*docs.columns).alias("_doc"), "text",
                       F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("_id"))


def _chosen(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The packed documents that ``chosen`` (_id and more) names."""
    c = chosen.withColumnRenamed("_id", "_which")
    return _packed(docs).join(c, F.col("_id").eqNullSafe(F.col("_which")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return model.transform(_packed(docs)).where("predicted = 0").select("_doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (candidates by SimHash and min-hash bands, five-word similarity
    of 0.8): the one with the smallest id (null before all)."""
    groups = near_copies.near_copies(_packed(docs), "_id", "text")
    kept = stage(groups.where(F.col("_id").eqNullSafe(F.col("component_id"))).groupBy("_id").agg(
        F.count(F.lit(1)).alias("_rows")), "kept")
    out = _chosen(docs, kept)
    # rows that agree in id and text are copies too
    out = out.dropDuplicates(["_id"]) if kept.where("_rows > 1").limit(1).count() else out
    return out.select("_doc.*")


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return private_data.mask(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their copies in the target mix."""
    rows = _packed(docs).select("_id", "text", F.col("_doc.source").alias("source"))
    taken = mixing.mix(rows, "_id").where("copies > 0").groupBy("_id").agg(F.max("copies").alias("_copies"))
    times = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return _chosen(docs, stage(taken, "copies")).select("_doc", times.alias("_copy")).select("_doc.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with a check that they decode to its tokens."""
    rows = docs.select(F.struct("doc_id", "source", "lang", "n_chars").alias("_doc"), "text")
    coded = bpe.encode(rows, public_tokenizers.path("word_bpe_49k.json"), "_doc", "text")
    return coded.select("_doc.*", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("private_data", mask_private),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

# Boosted trees, Newton steps and merges of a vocabulary are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of the documents that pass all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
