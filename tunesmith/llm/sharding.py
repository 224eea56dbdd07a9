"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair gets a score from a hash of the two; the record goes
to the shard with the highest score.  A new shard changes only the records
it wins, so growing from n to n + 1 shards moves about 1/(n + 1) of them,
all into the new shard.  With weights the score is ``-w / ln(u)``, which
makes a shard's share proportional to its weight.

The shard is a row-local expression.  Only the slot (gapless position inside
the shard) needs an order, and it comes from range partitions over
(shard, key), so one hot shard is spread over many tasks.

Defined results: null keys hash as a constant of their own; null or empty
text has size 1 and checksum 0; repeated rows keep one slot each; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import placed, prepare

_UNIT = float(1 << 53)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Index of the winning shard for ``key`` (ties: the lower index)."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be a non-empty list of positive numbers")
    named = F.coalesce(key.cast("string"), F.lit("\x00null"))
    scored = []
    for shard, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(named, F.lit(shard)), 11)
        unit = (bits.cast("double") + 0.5) / F.lit(_UNIT)
        scored.append(F.struct((-F.lit(float(weight)) / F.log(unit)).alias("score"),
                               F.lit(-shard).alias("shard")))
    best = scored[0] if len(scored) == 1 else F.greatest(*scored)
    return (-best["shard"]).cast("int")


def shard_documents(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id",
                    text_col: str = "text",
                    weights: Sequence[float] | None = None) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot and the
    shard it would have with one more shard (weight 1, or the mean weight)."""
    prepare(docs.sparkSession)
    weights = list(weights) if weights else [1.0] * n_shards
    if len(weights) != n_shards:
        raise ValueError("one weight per shard")
    text = F.coalesce(F.col(text_col), F.lit(""))
    grown = [*weights, sum(weights) / len(weights)]
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).cast("bigint").alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(id_col), weights).alias("shard"),
        rendezvous(F.col(id_col), grown).alias("grown_shard"))
    ordered = placed(rows, "shard", ["id", "text_crc32", "size"])
    return ordered.select(F.col("id").alias(id_col), "size", "text_crc32", "law", "shard",
                          F.col("idx").cast("bigint").alias("slot"), "grown_shard")
