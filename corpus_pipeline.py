"""From documents to token files: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import decontaminate, language_id, mixing, simhash, tokens
from slotwise.llm.staging import new_folder

SHINGLE_WORDS = 3
MAX_BITS = 3
BENCHMARK_WORDS = 10
BLOCK_DOCS = 8
TOKENIZER = "byte_bpe_50k.json"

#: Training a network and near-duplicate classes are not SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that was learned, go; the limits follow from the labelled rows."""
    return language_id.keep_learned(docs, *language_id.train_with_limits(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, SHINGLE_WORDS, MAX_BITS)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark, BENCHMARK_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: that of the files and of the rows in them."""
    return mixing.in_mix_order(docs, block_docs=BLOCK_DOCS)


def _file_order(docs: DataFrame) -> list[Column] | None:
    """The order in which ``docs`` was written to files; None if it does not come from files."""
    file = F.col("_metadata.file_name")
    order = [F.regexp_extract(file, r"part-(\d+)", 1).try_cast("long"), file, F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        return None
    return order


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mix, and what is read from them: doc_id, start, n_tokens, ids_crc32."""
    return tokens.tokenize(docs, public_tokenizers.path(TOKENIZER), order=_file_order(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_documents),
    ("source_mix", mix_sources),
    ("token_store", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            folder = new_folder(spark)
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
