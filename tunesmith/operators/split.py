"""Sampling, shuffling and splitting (SPL1-SPL3), all seeded and key-stable.

The split of a row depends only on its key and the seed, never on how the
data is partitioned, so reruns after executor loss give the same result.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.config import DEFAULT_SEED, HOLDOUT_FRACTION, TRAIN_FRACTION
from tunesmith.operators.position import with_position
from tunesmith.operators.select import divided


def seeded_hash(key, seed: int = DEFAULT_SEED) -> Column:
    """``md5('{seed}:{key}')`` as 32 hex digits."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def hash_threshold(frac: float) -> str:
    """Hex string t such that ``md5 < t`` holds for a ``frac`` share."""
    # the shortest decimal of ``frac`` as an exact ratio: 0.8 is 4/5
    ratio = Fraction(str(frac))
    value = min((ratio.numerator << 128) // ratio.denominator, (1 << 128) - 1)
    return format(value, "032x")


def train_eval_split(df: DataFrame, key: str, frac: float = TRAIN_FRACTION,
                     seed: int = DEFAULT_SEED, exact: bool = False,
                     name: str = "split", labels=("train", "eval")) -> DataFrame:
    """SPL1: ``frac`` of the rows to ``labels[0]``, the rest to ``labels[1]``.

    Default: narrow hash test, no shuffle, expected share ``frac``.
    ``exact=True``: the first ``ceil(frac*n)`` rows in hash order, by selection
    of the last one's hash.
    """
    if not exact:
        cond = seeded_hash(key, seed) < F.lit(hash_threshold(frac))
        return df.withColumn(name, F.when(cond, labels[0]).otherwise(labels[1]))
    hashed = df.withColumn("__h", seeded_hash(key, seed))
    share = Fraction(str(frac))
    up = F.lit(share.denominator)
    rows = divided(hashed, ["__h", key], lambda n: F.floor(
        (n * F.lit(share.numerator) + up - 1) / up).cast("bigint"))
    return rows.withColumn(name, F.when(F.col("__in"), labels[0]).otherwise(labels[1])).drop("__h", "__in")


def shuffle(df: DataFrame, key: str, seed: int = DEFAULT_SEED,
            name: str = "pos") -> DataFrame:
    """SPL2: whole-table shuffle with a fresh 0-based index."""
    return with_position(df.withColumn("__h", seeded_hash(key, seed)),
                         [F.col("__h").asc(), F.col(key).asc()],
                         name=name).drop("__h")


def shard_holdout(df: DataFrame, shard: str = "shard",
                  frac: float = HOLDOUT_FRACTION, cap: int | None = None,
                  seed: int = DEFAULT_SEED, name: str = "split") -> DataFrame:
    """SPL3: ``floor(frac * shards)`` shards (in seeded hash order) become
    test, the rest train; with ``cap`` at most so many shards each (the
    default keeps all).

    The distinct-shard table is ranked with positions (range partitioned,
    not one task).  With a cap the chosen table has at most ``2*cap`` rows,
    so it is broadcast into a semi join; without a cap it is shuffle joined.
    """
    shards = df.select(shard).distinct()
    ranked = with_position(shards.withColumn("__h", seeded_hash(shard, seed)),
                           [F.col("__h").asc(), F.col(shard).asc()],
                           name="__rank", total="__n")
    n_test = F.floor(F.col("__n") * F.lit(frac))
    chosen = ranked.withColumn(
        name, F.when(F.col("__rank") < n_test, "test").otherwise("train")
    ).withColumn(
        "__rank_in_split",
        F.when(F.col("__rank") < n_test, F.col("__rank"))
         .otherwise(F.col("__rank") - n_test))
    if cap is not None:
        chosen = chosen.filter(F.col("__rank_in_split") < cap)
    chosen = chosen.select(shard, name)
    if cap is not None and 2 * cap <= 100_000:
        chosen = F.broadcast(chosen)
    return df.join(chosen, shard, "inner")
