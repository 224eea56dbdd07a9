"""Corpus pipeline: quality rules, line dedup, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between
stages the rows are written as Parquet and read again.  All stages but the
last return the columns of ``documents``.

1. quality        documents that the rules reject go
2. line_dedup     recurring lines go from the texts; every row stays
3. near_dedup     one document of each SimHash group stays (smallest id)
4. mixing         documents (whole, repeated or cut) make up the target mix
5. bpe            ids of every text of the mix, and a digest of their decoding
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm import bpe, common, linededup, mixing, quality, simhash

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.drop_recurring_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_representatives(docs, shingle=4, max_bits=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    rows = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return rows.select("doc_id", "n_tokens", F.col("ids_bytes").alias("ids"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_dedup", near_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: components, template trees and merges have no SQL form: tests compare each
#: stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
