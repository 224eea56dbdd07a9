"""Preference and label shaping (PRF1-PRF4).  All narrow: no shuffle.

One rule for all four: a comparison needs two answers, neither null.  Rows
without them are left out and returned by :func:`pair_rejects`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keep(df: DataFrame, drop) -> list:
    return [c for c in df.columns if c not in drop]


def _has_pair(output: str) -> Column:
    answers = F.col(output)
    return (F.coalesce(F.size(answers), F.lit(-1)) >= 2) & (
        F.get(answers, 0).isNotNull() & F.get(answers, 1).isNotNull())


def split_pair(df: DataFrame, instruction="instruction",
               output="output") -> DataFrame:
    """PRF1: ``output[0]`` -> chosen, ``output[1]`` -> rejected."""
    return (df.filter(_has_pair(output))
              .select(*_keep(df, (instruction, output)),
                      F.col(instruction).alias("prompt"),
                      F.get(F.col(output), 0).alias("chosen"),
                      F.get(F.col(output), 1).alias("rejected")))


def pair_rejects(df: DataFrame, output="output") -> DataFrame:
    """Comparisons without two answers that are not null."""
    return df.filter(~_has_pair(output))


def parity_pick(df: DataFrame, instruction="instruction",
                output="output") -> DataFrame:
    """PRF2: even code-point length -> answer 0 with label true,
    odd -> answer 1 with label false."""
    parity = F.length(F.col(instruction)) % 2
    return df.filter(_has_pair(output)).select(
        *_keep(df, (output,)), F.get(F.col(output), parity).alias("answer"),
        (parity == 0).alias("label"))


def paired_lists(df: DataFrame, instruction="instruction",
                 output="output") -> DataFrame:
    """PRF3: completion = both answers, label = ``[1, 0]``."""
    return df.filter(_has_pair(output)).select(
        *_keep(df, (instruction, output)), F.col(instruction).alias("prompt"),
        F.slice(F.col(output), 1, 2).alias("completion"),
        F.array(F.lit(1), F.lit(0)).alias("label"))


def explode_unpaired(df: DataFrame, instruction="instruction",
                     output="output") -> DataFrame:
    """PRF4: each comparison -> ``(prompt, answer0, 1)`` and
    ``(prompt, answer1, 0)``."""
    return (df.filter(_has_pair(output))
              .select(*_keep(df, (instruction, output)),
                      F.col(instruction).alias("prompt"),
                      F.posexplode(F.slice(F.col(output), 1, 2))
                      .alias("answer_pos", "completion"))
              .withColumn("label",
                          F.when(F.col("answer_pos") == 0, 1).otherwise(0)))
