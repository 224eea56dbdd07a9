"""Record views derived from the driver tables (Spark side).

Each view turns the ``conversations`` table (one row per turn) into the
record shapes the fine-tuning scripts read: instruction rows, comparisons,
question pairs, message lists, dialogues and prediction pairs.  The
matching DuckDB definitions live in :mod:`tunesmith.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunesmith.functions import templates as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  ``spark.tunesmith.read.partitions`` deals its rows to so
    many partitions (unset: as the files are split), for tables whose one
    row group a single task would read and explode."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get("spark.tunesmith.read.partitions", None)
    return df.repartition(int(n)) if n else df


def conversations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _system(conv: DataFrame) -> DataFrame:
    # at most one system turn per conversation
    return conv.filter(F.col("role") == "system").select(
        "conv_id", F.col("text").alias("system"))


def instruction_view(spark, sf_dir, with_system: bool = True) -> DataFrame:
    """``v_instruction``: a user turn answered by the next assistant turn.

    Keys are ``(conv_id, turn)`` of the user turn; the pairing join is on
    that composite key, so no single conversation becomes a hot key.
    """
    conv = conversations(spark, sf_dir)
    user = conv.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("instruction"))
    answer = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"),
        F.col("text").alias("output"))
    rows = user.join(answer, ["conv_id", "turn"], "inner")
    if not with_system:
        return rows.select("conv_id", "turn", "instruction",
                           F.lit("").alias("input"), "output")
    return (rows.join(_system(conv), "conv_id", "left")
                .select("conv_id", "turn", "instruction",
                        F.coalesce(F.col("system"), F.lit("")).alias("input"),
                        "output", "system"))


def comparison_view(spark, sf_dir) -> DataFrame:
    """``v_comparison``: first user text and the first two assistant texts
    of every conversation with at least two assistant turns.

    The per-(conversation, role) ``row_number() <= 2`` is planned as a
    window group limit, applied map-side before the shuffle, so a huge
    conversation sends at most two rows per role per task.
    """
    conv = conversations(spark, sf_dir).filter(
        F.col("role").isin("user", "assistant"))
    w = Window.partitionBy("conv_id", "role").orderBy("turn")
    first = conv.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= 2)
    user1 = (F.col("role") == "user") & (F.col("rn") == 1)
    a1 = (F.col("role") == "assistant") & (F.col("rn") == 1)
    a2 = (F.col("role") == "assistant") & (F.col("rn") == 2)
    agg = first.groupBy("conv_id").agg(
        F.max(F.when(user1, F.col("text"))).alias("instruction"),
        F.max(F.when(a1, F.col("text"))).alias("a1"),
        F.max(F.when(a2, F.col("text"))).alias("a2"))
    return (agg.filter(F.col("a2").isNotNull())
               .select("conv_id", "instruction",
                       F.array("a1", "a2").alias("output")))


def question_pair_view(spark, sf_dir) -> DataFrame:
    """``v_question_pair``: comparison plus the system text (or '')."""
    conv = conversations(spark, sf_dir)
    comp = comparison_view(spark, sf_dir)
    return (comp.join(_system(conv), "conv_id", "left")
                .select("conv_id",
                        F.coalesce(F.col("system"), F.lit("")).alias("system"),
                        F.col("instruction").alias("question"),
                        F.get("output", 0).alias("chosen"),
                        F.get("output", 1).alias("rejected")))


def messages_view(spark, sf_dir) -> DataFrame:
    """``v_messages``: one ``array<struct<role,content>>`` per conversation,
    ordered by turn (a conversation is one record)."""
    conv = conversations(spark, sf_dir)
    msgs = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return conv.groupBy("conv_id").agg(msgs.alias("m")).select(
        "conv_id",
        F.transform("m", lambda x: F.struct(x["role"].alias("role"),
                                            x["text"].alias("content"))
                    ).alias("messages"))


def dialogue_view(spark, sf_dir) -> DataFrame:
    """``v_dialogue``: ``\\n\\nHuman: …`` / ``\\n\\nAssistant: …`` by turn."""
    conv = conversations(spark, sf_dir).filter(F.col("role") != "system")
    piece = T.dialogue_piece("role", "text")
    parts = F.array_sort(F.collect_list(F.struct(F.col("turn"), piece.alias("p"))))
    return conv.groupBy("conv_id").agg(parts.alias("parts")).select(
        "conv_id", F.array_join(F.transform("parts", lambda x: x["p"]), "")
        .alias("text"))


def prediction_view(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """``v_predictions`` inputs: assistant texts as predictions keyed by
    ``(conv_id, turn)``, and the preceding user text as the reference."""
    conv = conversations(spark, sf_dir)
    preds = conv.filter(F.col("role") == "assistant").select(
        "conv_id", "turn", F.col("text").alias("predict"))
    refs = conv.filter(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"),
        F.col("text").alias("labels"))
    return preds, refs
