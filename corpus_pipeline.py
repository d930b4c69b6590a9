"""From raw documents to token files: quality, near copies, benchmark leaks, mix, token ids.

Every stage takes all its predecessor kept, written as Parquet and read again, and all but the
last return the columns of the documents. Repeated rows after the mix are its epochs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parityframe.llm import decontaminate, mixing, near_copies, quality, tokens
from parityframe.workspace import Scope, scratch_path

END_ID = 2


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules.

    A null text has no words and goes, like any text of under 50 words. Every row is judged by its
    text alone, so repeated rows stay or go together; null ids and sources stay as they are.
    """
    return quality.keep_good(docs, bands=quality.FITTED)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id (null: last).

    Of repeated rows one stays. Texts without words, null ones too, are copies of nothing.
    """
    return near_copies.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the passages of test items cut out of their texts.

    ``n_chars`` follows the text; documents left without words go, those that had none stay. An
    empty benchmark changes nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove(docs, benchmark, length="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them; a null source is a source."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; one row per stored document, read back from them.

    A null text is a document of the end id alone; repeated rows are documents of their own.
    """
    folder = scratch_path(spark, "pipeline-tokens")
    tokens.write(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return tokens.digest(spark, folder)


STAGES = [
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("decontaminate", remove_benchmark),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

#: SQL has neither compression nor tokenizers; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; what the stages stage on the way is deleted as it goes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scope(spark) as outputs:
        for name, function in STAGES:
            with Scope(spark) as work:
                docs = work.hand_over(function(spark, docs, sf_dir), f"pipeline-{name}")
        return outputs.hand_over(docs, "pipeline")
