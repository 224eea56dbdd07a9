"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunesmith.llm import common, oracle

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@query("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunesmith.llm.sharding import shard_documents
    return shard_documents(common.documents(spark, sf_dir), 16)


OP5_COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


@query("op5_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunesmith.llm.mixing import plan_mix
    return plan_mix(common.documents(spark, sf_dir)).select(*OP5_COLUMNS)


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunesmith.llm.quality import quality_rules
    return quality_rules(common.documents(spark, sf_dir))


@query("op2_line_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunesmith.llm.linededup import line_dedup
    return line_dedup(common.documents(spark, sf_dir))


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunesmith.llm.simhash import near_duplicates
    return near_duplicates(common.documents(spark, sf_dir), shingle=4, max_bits=4)


@query("op10_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunesmith.llm.blobscan import scan_secrets
    return scan_secrets(common.documents(spark, sf_dir))


def multilingual_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tunesmith.llm.bpe import digests
    return digests(common.documents(spark, sf_dir), multilingual_ranks(),
                   public_tokenizers.PATTERN)


@query("op6_token_codes")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from pyspark.sql import functions as F

    from tunesmith.llm.dac import read_documents, write_tokens
    from tunesmith.session import scratch_path
    path = scratch_path(spark, "dac")
    write_tokens(common.documents(spark, sf_dir), path,
                 public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_documents(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op1_embedding_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunesmith.llm.embed import near_duplicates
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tunesmith.llm.repeats import remove_repeats
    rows = remove_repeats(common.documents(spark, sf_dir))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_merkle_manifest", oracle.MERKLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tunesmith.llm.merkle import manifest
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest(common.documents(spark, sf_dir), tamper=third)


@query("op11_threshold_topk", oracle.TOP_PRODUCTS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunesmith.llm.topk import top_products
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=5, every=50)


@query("op12_prefix_trie", oracle.PREFIX_TRIE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunesmith.llm.trie import prefix_trie
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
