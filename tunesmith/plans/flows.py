"""The three entry points of the fine-tuning scripts as composed Spark jobs.

* :func:`seq2seq_rows` -- named split files -> bound role columns -> blank
  rows dropped -> prefix -> token rows padded for a seq2seq trainer.
* :func:`seq2seq_eval_rows` -- one split -> bound columns -> history rendered
  before the prompt -> fixed batches -> inputs padded per batch.
* :func:`preference_rows` -- comparison JSON -> chosen/rejected pairs ->
  seeded split -> token ids with preference length limits -> dataset folder
  partitioned by split.
* :func:`evaluate_generations` -- generated ids minus the prompt and label
  ids (-100 read as pad) decoded to text -> paired by key -> written as
  JSON-line predictions -> ROUGE-1/2/L and BLEU-4 per row.
* :func:`corpus_batches` -- JSON-array files (broken ones skipped) ->
  seeded shuffle -> 666-row CSV shards -> shard holdout -> context/target ->
  causal token rows -> batches of 4 -> collated rows.

Each step is one of the operators; the flows only fix the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tunesmith.config import (
    HOLDOUT_FRACTION, PREF_MAX_LENGTH, PREF_MAX_PROMPT_LENGTH,
    SEQ2SEQ_SOURCE_LENGTH, SEQ2SEQ_TARGET_LENGTH, SHARD_ROWS, SourceSpec,
    TokenSpec)
from tunesmith.operators import filters as FL
from tunesmith.operators import layout as LA
from tunesmith.operators import position as PO
from tunesmith.operators import preference as PR
from tunesmith.operators import prompts as PM
from tunesmith.operators import split as SP
from tunesmith.functions import arrays as A
from tunesmith.operators import evaluate as EV
from tunesmith.operators.vocab import Vocabulary, decode
from tunesmith.session import scratch_path
from tunesmith.sources import readers as R
from tunesmith.sources import sinks as S

DEFAULT_SPEC = TokenSpec()


def seq2seq_rows(spark: SparkSession, splits: dict | SourceSpec, schema, key, vocab: Vocabulary,
                 prompt: str, response: str, prefix: str = "",
                 src: int = SEQ2SEQ_SOURCE_LENGTH, tgt: int = SEQ2SEQ_TARGET_LENGTH,
                 spec: TokenSpec = DEFAULT_SPEC) -> DataFrame:
    """Seq2seq training rows for every split; ``splits`` names the files, or is
    a `SourceSpec` that has checked them before any job starts."""
    key = [key] if isinstance(key, str) else list(key)
    raw = R.read_splits(spark, splits.splits() if isinstance(splits, SourceSpec) else splits, schema)
    bound = FL.bind(raw, prompt, response, keep=(*key, "split"))
    return LA.seq2seq_train(bound, key, vocab, prefix=prefix, src=src, tgt=tgt, spec=spec)


def seq2seq_eval_rows(spark: SparkSession, source: dict | SourceSpec, schema, key, vocab: Vocabulary,
                      prompt: str, response: str, history: str | None = None, prefix: str = "",
                      split: str = "validation", batch_size: int = 16,
                      src: int = SEQ2SEQ_SOURCE_LENGTH, tgt: int = SEQ2SEQ_TARGET_LENGTH,
                      max_history_tokens: int | None = None,
                      spec: TokenSpec = DEFAULT_SPEC) -> DataFrame:
    """Evaluation rows of one split: blank rows dropped, a history column
    rendered before the prompt (the oldest exchanges go beyond
    ``max_history_tokens``), fixed batches in key order, inputs padded per batch."""
    key = [key] if isinstance(key, str) else list(key)
    splits = source.splits() if isinstance(source, SourceSpec) else source
    raw = R.read_splits(spark, {split: splits[split]}, schema)
    rows = FL.drop_blank(FL.bind(raw, prompt, response, history, keep=key))
    if prefix:
        rows = FL.with_prefix(rows, prefix)
    if history:
        rows = PM.history_column(rows, max_tokens=max_history_tokens).drop("history")
    rows = PO.with_batch_id(PO.with_position(rows, key), batch_size).drop("pos")
    return LA.seq2seq_eval(rows, key, vocab, src=src, tgt=tgt, spec=spec)


def preference_rows(spark: SparkSession, files, schema, vocab: Vocabulary, out_dir: str,
                    key: str = "conv_id", max_length: int = PREF_MAX_LENGTH,
                    max_prompt_length: int = PREF_MAX_PROMPT_LENGTH,
                    max_target_length: int | None = None, on_error: str = "raise") -> DataFrame:
    """Preference pairs with ids, written as a dataset partitioned by split.

    Records without two answers are written as JSON to ``<out_dir>-rejects``; with
    ``on_error="reject"`` lines that are no records to ``<out_dir>-malformed``.
    """
    out = out_dir.rstrip("/")
    comp = R.read_json(spark, files, schema, on_error=on_error).drop("split")
    if on_error == "reject":
        R.json_rejects(spark, files, schema).write.mode("overwrite").text(f"{out}-malformed")
    PR.pair_rejects(comp).write.mode("overwrite").json(f"{out}-rejects")
    pairs = SP.train_eval_split(PR.split_pair(comp), key)
    limited = LA.pair_rows(pairs, key, vocab, max_length=max_length,
                           max_prompt_length=max_prompt_length, max_target_length=max_target_length)
    limited.write.mode("overwrite").partitionBy("split").parquet(out_dir)
    return R.read_dataset(spark, out_dir)


def corpus_batches(spark: SparkSession, globs, schema, key: str, vocab: Vocabulary,
                   shard_rows: int = SHARD_ROWS, batch_size: int = 4,
                   holdout: float = HOLDOUT_FRACTION, cap: int | None = None,
                   spec: TokenSpec = DEFAULT_SPEC) -> DataFrame:
    """Collated causal-LM rows for the held-out shard splits."""
    raw = R.read_json_glob(spark, globs, schema)
    shard_dir = scratch_path(spark, "corpus-shards")
    hashed = raw.withColumn("__h", SP.seeded_hash(key))
    S.write_shards(hashed, shard_dir, [F.col("__h").asc(), F.col(key).asc()],
                   rows=shard_rows, drop=("__h",))
    shards = S.read_shards(spark, shard_dir, schema)
    held = SP.shard_holdout(shards, "shard", frac=holdout, cap=cap)
    shaped = FL.drop_null(PM.context_target(held).select(key, "split", "context", "target"))
    parts = []
    for split in ("train", "test"):
        part = shaped.filter(F.col("split") == split).withColumn("__h", SP.seeded_hash(key))
        pos = PO.with_position(part, [F.col("__h").asc(), F.col(key).asc()])
        parts.append(PO.with_batch_id(pos, batch_size).drop("__h"))
    batched = LA.causal_rows(parts[0].unionByName(parts[1]), key, vocab, spec=spec)
    return LA.collate(batched.withColumn("batch_key", F.concat_ws(
        ":", F.col("split"), F.col("batch_id").cast("string"))), batch="batch_key", spec=spec)


def evaluate_generations(gen: DataFrame, key, vocab: Vocabulary, out_dir: str,
                         prompt: str = "prompt_ids", output: str = "output_ids",
                         labels: str = "label_ids", spec: TokenSpec = DEFAULT_SPEC) -> DataFrame:
    """Predict/evaluate path: decode, pair, write predictions, score."""
    key = [key] if isinstance(key, str) else list(key)
    g = gen.select(*key, A.strip_prompt(output, prompt).alias("__gen"),
                   A.unmask(labels, spec.pad).alias("__lab"))
    dec = decode(g, key, {"predict": "__gen", "labels": "__lab"}, vocab, keep_input=False)
    S.write_predictions(dec, out_dir, keys=key)
    # score what was written: the decode runs once and the lineage ends here
    schema = StructType([gen.schema[k] for k in key] + [
        StructField("labels", StringType()), StructField("predict", StringType())])
    pairs = gen.sparkSession.read.schema(schema).json(out_dir)
    scored = EV.rouge_l(EV.rouge_n(EV.rouge_n(pairs, 1), 2))
    return EV.bleu4(scored, key)
