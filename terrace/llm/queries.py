"""Registered queries of the corpus operators: each over its whole table with production parameters."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from terrace.llm import toxicity
from terrace.llm.bpe import encode
from terrace.llm.common import table
from terrace.llm.fill_middle import fill_in_middle, fill_sql, restored
from terrace.llm.html_text import extract
from terrace.llm.importance import ImportanceRules, importance_sql, resample
from terrace.llm.license_scan import scan
from terrace.llm.license_scan_sql import license_scan_sql
from terrace.llm.line_rules import clean_lines
from terrace.llm.line_rules_sql import line_rules_sql
from terrace.llm.mixing import mix
from terrace.llm.piecewise_hash import edited_pairs
from terrace.llm.private_data import KINDS, find, listed
from terrace.llm.simhash import near_duplicates
from terrace.llm.token_counts import count_tokens
from terrace.llm.winnow import find_leaks, leaks_sql
from terrace.plans.registry import query


@query("op1_license_scan", license_scan_sql())
def op1_license_scan(spark, sf_dir):
    """Licence phrases and notices of every document."""
    return scan(table(spark, sf_dir, "documents")).drop("spans")


@query("op5_mix_sources")
def op5_mix_sources(spark, sf_dir):
    """Copies of every document in the target mix."""
    return mix(table(spark, sf_dir, "documents"))


@query("op7_line_rules", line_rules_sql())
def op7_line_rules(spark, sf_dir):
    """Quality rules of every document."""
    return clean_lines(table(spark, sf_dir, "documents")).drop("clean_text")


@query("op8_simhash")
def op8_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_html_text")
def op2_html_text(spark, sf_dir):
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from the labels of three quarters of the ids."""
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder != 2)
    return model.transform(docs).select("doc_id", (remainder == 2).alias("held_out"), "score", "predicted")


@query("op4_bpe")
def op4_bpe(spark, sf_dir):
    """Digests of every document's token ids and of the text decoded from them."""
    coded = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_token_counts")
def op9_token_counts(spark, sf_dir):
    """Tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_piecewise_hash")
def op6_piecewise_hash(spark, sf_dir):
    """Fingerprints of every document, its edited text and its successor, and their likeness."""
    return edited_pairs(table(spark, sf_dir, "documents"))


@query("op10_private_data")
def op10_private_data(spark, sf_dir):
    """Personal data of every document."""
    found = find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[_count(kind) for kind in KINDS], F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))


def _count(kind):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


ONE_WORD = ImportanceRules(longest=1)


@query("op11_importance", importance_sql(ONE_WORD))
def op11_importance(spark, sf_dir):
    """Weight of every document against the benchmark, and its rank in the draw."""
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), rules=ONE_WORD)
    return drawn.drop("n_words")


@query("op12_fill_middle", fill_sql())
def op12_fill_middle(spark, sf_dir):
    """Digests of every document cut for filling in the middle, and of the text restored from it."""
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", F.col("n_prefix").alias("prefix_chars"), F.col("n_middle").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query("op13_decontaminate", leaks_sql())
def op13_decontaminate(spark, sf_dir):
    """Words of every document that stand in windows of the benchmark, and the items they leak."""
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("pipeline")
def pipeline(spark, sf_dir):
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)
