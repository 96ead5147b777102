"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import (
    collocations,
    decontaminate,
    embedding_forest,
    html_text,
    importance,
    language_id,
    license_scan,
    mixing,
    quality_rules,
    simhash,
    substring,
    tokens,
    url_filter,
)

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pages are blocked, by the longest rule or as aliases of blocked ones."""
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), url_filter.RULES)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document stands in the mix of all sources, weighted by the root of their sizes."""
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source"), block_docs=8)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a network trained on a sample of the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    network = language_id.train(docs.where(~held_out))
    return language_id.predict(docs.select("doc_id", "text"), network).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of every document, its probability of being good and whether it is kept."""
    scored = quality_rules.score(_table(spark, sf_dir, "documents"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which benchmark items each document holds windows of 10 words of, and how many words they cover."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.count_hits(decontaminate.find_hits(docs, _table(spark, sf_dir, "benchmark"), window=10))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page, laid out in lines."""
    pages = html_text.extract_text(_table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose fingerprints lead to each other in steps of 3 bits or fewer."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' token ids, written to ORC files in doc_id order and read back."""
    path = public_tokenizers.path(TOKENIZER)
    return tokens.tokenize(_table(spark, sf_dir, "documents").select("doc_id", "text"), path)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases of every document, and the labels of notices that a block of words contains."""
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that smaller doc_ids have too."""
    kept = substring.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How like the benchmark every document is, and the 5 per cent that are drawn."""
    found = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of embeddings that links of cosine 0.95 and more lead between, and how many links each has."""
    return embedding_forest.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of every language."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_source_mix": op2_source_mix,
        "op3_language_id": op3_language_id,
        "op4_quality_rules": op4_quality_rules,
        "op5_decontamination": op5_decontamination,
        "op6_html_text": op6_html_text,
        "op7_simhash": op7_simhash,
        "op8_token_store": op8_token_store,
        "op9_license_scan": op9_license_scan,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_embedding_dedup": op12_embedding_dedup,
        "op13_collocations": op13_collocations,
    }
