"""Queries: sources, sinks, union, file stream and user functions.

Each round-trip query writes rows derived from the driver tables into a
fresh folder below the shared checkpoint folder and reads them back through
the operator under test.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunesmith.operators import filters as FL
from tunesmith.operators import preference as PR
from tunesmith.operators import split as SP
from tunesmith.operators import udf as UD
from tunesmith.plans import views as V
from tunesmith.plans.oracle import md5_key
from tunesmith.plans.q_prompts import _split_case
from tunesmith.plans.registry import query
from tunesmith.session import scratch_path
from tunesmith.sources import readers as R
from tunesmith.sources import sinks as S
from tunesmith.streaming import files as ST

TURN_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
COMPARISON_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("instruction", T.StringType()),
    T.StructField("output", T.ArrayType(T.StringType()))])
INSTRUCTION_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("instruction", T.StringType()), T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType())])
DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType())])


@query("src1_read_jsonl", """
SELECT conv_id, turn, role, text FROM conversations
""")
def src1(spark, d):
    path = scratch_path(spark, "jsonl")
    V.conversations(spark, d).write.mode("overwrite").json(path)
    return R.read_jsonl(spark, path, TURN_SCHEMA)


@query("src2_read_json", """
SELECT conv_id, instruction, output[1] AS answer_0, output[2] AS answer_1, 'train' AS split
FROM v_comparison
""")
def src2(spark, d):
    path = scratch_path(spark, "json")
    V.comparison_view(spark, d).write.mode("overwrite").json(path)
    df = R.read_json(spark, [path], COMPARISON_SCHEMA)
    return df.select("conv_id", "instruction", F.get("output", 0).alias("answer_0"),
                     F.get("output", 1).alias("answer_1"), "split")


@query("src3_read_splits", f"""
SELECT doc_id, text, CASE WHEN {_split_case('doc_id')} = 'train' THEN 'train' ELSE 'validation' END AS split
FROM documents
""")
def src3(spark, d):
    base = scratch_path(spark, "splits")
    docs = SP.train_eval_split(V.documents(spark, d).select("doc_id", "text"), "doc_id")
    docs.filter(F.col("split") == "train").drop("split").write.mode("overwrite").json(
        f"{base}/train.json")
    S.write_csv(docs.filter(F.col("split") == "eval").drop("split"), f"{base}/validation.csv")
    return R.read_splits(spark, {"train": f"{base}/train.json",
                                 "validation": f"{base}/validation.csv"}, DOC_SCHEMA)


ARRAY_FILE_ROWS = 50


@query("src4_read_json_glob", """
SELECT conv_id, turn, instruction, input, output FROM v_instruction
""")
def src4(spark, d):
    base = scratch_path(spark, "json-arrays")
    inst = V.instruction_view(spark, d).select("conv_id", "turn", "instruction", "input", "output")
    files = S.with_shards(inst, ["conv_id", "turn"], ARRAY_FILE_ROWS, name="file")
    arrays = files.groupBy("file").agg(
        F.to_json(F.collect_list(F.struct("conv_id", "turn", "instruction", "input",
                                          "output"))).alias("value"))
    arrays.write.mode("overwrite").partitionBy("file").text(base)
    # a truncated file: must contribute no rows
    spark.createDataFrame([('[{"conv_id": 1, "turn": 0, "instruction": "cut',)], "value string") \
        .write.mode("overwrite").text(f"{base}/file=broken")
    return R.read_json_glob(spark, [f"{base}/file=*/*.txt"], INSTRUCTION_SCHEMA)


@query("src5_read_csv", """
SELECT page_id, url, html FROM pages
""")
def src5(spark, d):
    path = scratch_path(spark, "csv")
    S.write_csv(V.table(spark, d, "pages"), path)
    return R.read_csv(spark, [path], PAGE_SCHEMA)


@query("src6_read_dataset", f"""
SELECT doc_id, lang, {_split_case('doc_id')} AS split FROM documents
""")
def src6(spark, d):
    path = scratch_path(spark, "dataset")
    docs = SP.train_eval_split(V.documents(spark, d).select("doc_id", "lang"), "doc_id")
    docs.write.mode("overwrite").partitionBy("split").parquet(path)
    return R.read_dataset(spark, path).select("doc_id", "lang", "split")


@query("uni1_union_by_name", """
SELECT doc_id, text, lang, 'documents' AS origin FROM documents
UNION ALL
SELECT item_id AS doc_id, text, NULL AS lang, 'benchmark' AS origin FROM benchmark
""")
def uni1(spark, d):
    docs = V.documents(spark, d).select("doc_id", "text", "lang", F.lit("documents").alias("origin"))
    bench = V.table(spark, d, "benchmark").select(
        F.col("item_id").alias("doc_id"), F.lit("benchmark").alias("origin"), "text")
    return R.union_all(docs, bench)


@query("snk1_write_shards", f"""
SELECT doc_id, (row_number() OVER (ORDER BY {md5_key('doc_id')}, doc_id) - 1) // 666 AS shard, text
FROM documents
""")
def snk1(spark, d):
    path = scratch_path(spark, "shards")
    docs = V.documents(spark, d).select("doc_id", "text", SP.seeded_hash("doc_id").alias("__h"))
    S.write_shards(docs, path, [F.col("__h").asc(), F.col("doc_id").asc()], drop=("__h",))
    # the shard comes back from the folder and the file's place in it
    return S.read_shards(spark, path, DOC_SCHEMA).select("doc_id", "shard", "text")


@query("snk2_overwrite", """
SELECT conv_id, turn, instruction AS prompt FROM v_instruction
""")
def snk2(spark, d):
    path = scratch_path(spark, "overwrite")
    V.conversations(spark, d).select("conv_id", "turn", F.col("text").alias("prompt")) \
        .write.mode("overwrite").json(path)
    inst = V.instruction_view(spark, d, False).select(
        "conv_id", "turn", F.col("instruction").alias("prompt"))
    inst.write.mode("overwrite").json(path)
    schema = "conv_id bigint, turn bigint, prompt string"
    return spark.read.schema(schema).json(path)


@query("snk3_write_predictions", rf"""
SELECT conv_id, turn, regexp_replace(labels, '^[{S.WHITE}]+|[{S.WHITE}]+$', '', 'g') AS labels,
       regexp_replace(predict, '^[{S.WHITE}]+|[{S.WHITE}]+$', '', 'g') AS predict
FROM v_predictions
""")
def snk3(spark, d):
    path = scratch_path(spark, "predictions")
    preds, refs = V.prediction_view(spark, d)
    S.write_predictions(preds.join(refs, ["conv_id", "turn"]), path, keys=("conv_id", "turn"))
    return spark.read.schema("conv_id bigint, turn bigint, labels string, predict string").json(path)


@query("snk4_run_metrics", f"""
SELECT split, count(*) AS eval_samples, round(avg(n_chars), 6) AS eval_chars, 'eval' AS phase
FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS place
      FROM (SELECT {_split_case('doc_id')} AS split, doc_id, n_chars FROM documents))
WHERE place <= 50
GROUP BY split
""")
def snk4(spark, d):
    docs = SP.train_eval_split(V.documents(spark, d).select("doc_id", "n_chars"), "doc_id")
    out = S.run_metrics(docs, "eval", cap=50, metrics={"chars": "n_chars"}, order_by="doc_id")
    return out.withColumn("eval_chars", F.round("eval_chars", 6))


_PHASES = """SELECT run, phase, split, count(*) AS n, avg(x) AS mean FROM (
  SELECT 'a' AS run, 'eval' AS phase, {0} AS split, n_chars AS x FROM documents
  UNION ALL SELECT 'a', 'test', {0}, 2 * n_chars FROM documents
  UNION ALL SELECT 'b', 'eval', {0}, n_chars FROM documents) GROUP BY run, phase, split"""


@query("snk4_metrics_store", f"""
SELECT run, phase, split, concat(phase, '_samples') AS metric, CAST(n AS DOUBLE) AS value
FROM ({_PHASES.format(_split_case('doc_id'))})
UNION ALL
SELECT run, phase, split, concat(phase, '_chars') AS metric, round(mean, 6) AS value
FROM ({_PHASES.format(_split_case('doc_id'))})
""")
def snk4_store(spark, d):
    """Three phases of two runs; the first is run twice and stands once."""
    store = scratch_path(spark, "metrics")
    docs = SP.train_eval_split(V.documents(spark, d).select("doc_id", "n_chars"), "doc_id")
    twice = docs.withColumn("n_chars", F.col("n_chars") * 2)
    for run, phase, rows in (("a", "eval", twice), ("a", "test", twice), ("b", "eval", docs),
                             ("a", "eval", docs)):
        S.save_metrics(S.run_metrics(rows, phase, metrics={"chars": "n_chars"}), store, run)
    return S.read_metrics(spark, store).withColumn("value", F.round("value", 6))


BROKEN_EVERY = 7


REJECTS_SQL = f"""
SELECT CASE WHEN conv_id % {BROKEN_EVERY} = 0 THEN 'rejected' ELSE 'kept' END AS kind, conv_id, turn,
       CASE WHEN conv_id % {BROKEN_EVERY} = 0 THEN length(text) END AS junk
FROM conversations
"""


def _broken_lines(spark, d, path):
    """Conversations as JSON lines; every turn of some is followed by as many
    ``#`` as its text has characters (and one), so its line is no record."""
    line = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    junk = F.concat(line, F.repeat(F.lit("#"), F.length("text") + 1))
    V.conversations(spark, d).select(F.when(F.col("conv_id") % BROKEN_EVERY == 0, junk).otherwise(line)
                                     .alias("value")).write.mode("overwrite").text(path)


def _kept_and_rejected(kept, bad):
    def number(name):
        return F.regexp_extract("record", f'"{name}":([0-9]+)', 1).cast("bigint").alias(name)

    none = F.lit(None).cast("bigint").alias("junk")
    junk = (F.length(F.regexp_extract("record", "#*$", 0)) - 1).cast("bigint").alias("junk")
    return kept.select(F.lit("kept").alias("kind"), "conv_id", "turn", none).unionByName(
        bad.select(F.lit("rejected").alias("kind"), number("conv_id"), number("turn"), junk))


@query("src2_rejects", REJECTS_SQL)
def src2_rejects(spark, d):
    path = scratch_path(spark, "json-broken")
    _broken_lines(spark, d, path)
    return _kept_and_rejected(R.read_json(spark, [path], TURN_SCHEMA, on_error="reject"),
                              R.json_rejects(spark, [path], TURN_SCHEMA))


@query("str1_stream_rejects", REJECTS_SQL)
def str1_rejects(spark, d):
    """The same lines as a stream with two sinks."""
    path, kept, bad = (scratch_path(spark, f"stream-{n}") for n in ("broken", "kept", "rejects"))
    _broken_lines(spark, d, path)
    ST.run_with_rejects(spark, path, TURN_SCHEMA, kept, bad, scratch_path(spark, "stream-broken-ckpt"))
    return _kept_and_rejected(spark.read.parquet(kept), spark.read.parquet(bad))


@query("str1_stream_jsonl", """
SELECT conv_id, instruction, output[length(instruction) % 2 + 1] AS answer,
       length(instruction) % 2 = 0 AS label
FROM v_comparison
""")
def str1(spark, d):
    src = scratch_path(spark, "stream-in")
    V.comparison_view(spark, d).repartition(4, "conv_id").write.mode("overwrite").json(src)
    stream = ST.stream_jsonl(spark, src, COMPARISON_SCHEMA)
    picked = PR.parity_pick(stream).select("conv_id", "instruction", "answer", "label")
    sink = scratch_path(spark, "stream-out")
    ST.run_available(picked, sink, scratch_path(spark, "stream-ckpt"))
    return spark.read.parquet(sink)


def _count_lines(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"conv_id": batch["conv_id"], "turn": batch["turn"],
                         "n_lines": batch["text"].str.count("\n").astype("int64") + 1})


@query("udf1_map_batches", """
SELECT conv_id, turn, length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines
FROM conversations
""")
def udf1(spark, d):
    conv = V.conversations(spark, d).select("conv_id", "turn", "text")
    return UD.map_batches(conv, _count_lines, "conv_id bigint, turn bigint, n_lines bigint")


@query("udf1_filter_rows", """
SELECT conv_id, turn, role FROM conversations WHERE role = 'assistant' AND length(text) > 500
""")
def udf1_filter(spark, d):
    conv = V.conversations(spark, d).select("conv_id", "turn", "role", "text")
    kept = UD.filter_rows(conv, lambda b: (b["role"] == "assistant") & (b["text"].str.len() > 500))
    return FL.reshape(kept, ["conv_id", "turn", "role"])


def _turn_summary(row: dict) -> dict:
    text = row["text"]
    return {"conv_id": row["conv_id"], "turn": row["turn"],
            "n_chars": len(text), "first_line": text.split("\n", 1)[0]}


@query("udf1_map_rows", r"""
SELECT conv_id, turn, length(text) AS n_chars,
       CASE WHEN strpos(text, chr(10)) > 0 THEN left(text, strpos(text, chr(10)) - 1) ELSE text END AS first_line
FROM conversations
""")
def udf1_rows(spark, d):
    conv = V.conversations(spark, d).select("conv_id", "turn", "text")
    return UD.map_rows(conv, _turn_summary,
                       "conv_id bigint, turn bigint, n_chars bigint, first_line string")


@query("str1_stream_context", """
SELECT conv_id, turn,
       concat('Instruction: ', instruction, chr(10),
              CASE WHEN input <> '' THEN concat('Input: ', input, chr(10)) ELSE '' END,
              'Answer: ') AS context,
       output AS target
FROM v_instruction
""")
def str1_context(spark, d):
    """Instruction rows streamed from JSON lines through PRM2 and FLT4."""
    from tunesmith.operators import prompts as PM

    src = scratch_path(spark, "stream-ctx-in")
    V.instruction_view(spark, d).select("conv_id", "turn", "instruction", "input", "output") \
        .repartition(4, "conv_id").write.json(src)
    stream = ST.stream_jsonl(spark, src, INSTRUCTION_SCHEMA, max_files_per_trigger=2)
    shaped = FL.drop_null(PM.context_target(stream).select("conv_id", "turn", "context", "target"))
    sink = scratch_path(spark, "stream-ctx-out")
    ST.run_available(shaped, sink, scratch_path(spark, "stream-ctx-ckpt"))
    return spark.read.parquet(sink)


def _length_gap(prediction: str, reference: str) -> float:
    return abs(len(prediction) - len(reference)) / max(len(reference), 1)


@query("udf1_row_metric", """
SELECT conv_id, turn, round(abs(length(predict) - length(labels)) / greatest(length(labels), 1), 6) AS length_gap
FROM v_predictions
""")
def udf1_metric(spark, d):
    preds, refs = V.prediction_view(spark, d)
    pairs = preds.join(refs, ["conv_id", "turn"])
    out = UD.row_metric(pairs, _length_gap, out="length_gap")
    return out.select("conv_id", "turn", F.round("length_gap", 6).alias("length_gap"))
