"""Queries: the three end-to-end flows and a capped vocabulary."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunesmith.config import PREF_MAX_TARGET_LENGTH, SourceSpec
from tunesmith.functions.arrays import ids_text
from tunesmith.operators import prompts as PM
from tunesmith.operators import split as SP
from tunesmith.operators import vocab as VO
from tunesmith.plans import flows as FW
from tunesmith.plans import views as V
from tunesmith.plans.oracle import encode_sql, md5_key, view, words
from tunesmith.plans.q_io import COMPARISON_SCHEMA
from tunesmith.plans.q_evaluate import score_views
from tunesmith.plans.q_layout import (
    KEY, MASK, S2S_IDS, S2S_LABELS_RAW, _limit_pair_sql, cat, rep, runs)
from tunesmith.plans.q_layout import s as ids_sql
from tunesmith.plans.q_prompts import TRAIN_T
from tunesmith.plans.q_tokens import conversation_vocab
from tunesmith.plans.registry import query
from tunesmith.session import scratch_path
from tunesmith.sources import sinks as S

ROW_KEY = "conv_id * 1000 + turn"


def _row_key():
    return (F.col("conv_id") * 1000 + F.col("turn")).alias("row_key")


# -- TOK1 with min_count / max_size ------------------------------------------

@query("tok1_vocab_capped", f"""
SELECT token, cnt AS count, CAST(rk + 3 AS BIGINT) AS id FROM (
  SELECT token, cnt, row_number() OVER (ORDER BY cnt DESC, token ASC) AS rk
  FROM (SELECT token, count(*) AS cnt
        FROM (SELECT unnest({words('text')}) AS token FROM documents)
        GROUP BY token HAVING count(*) >= 2))
WHERE rk <= 5000
""")
def tok1_capped(spark, d):
    v = VO.build_vocab(V.documents(spark, d), "text", min_count=2, max_size=5000)
    return v.table.select("token", "count", F.col("id").cast("bigint"))


# -- seq2seq flow ---------------------------------------------------------------

@query("e2e_seq2seq_rows", f"""
SELECT conv_id, turn, CASE WHEN {md5_key(ROW_KEY)} < '{TRAIN_T}' THEN 'train' ELSE 'validation' END AS split,
       {ids_sql(S2S_IDS)} AS input_ids, {ids_sql(MASK.format(x=S2S_LABELS_RAW))} AS labels
FROM v_s2s
""")
def e2e_seq2seq(spark, d):
    base = scratch_path(spark, "e2e-seq2seq")
    inst = V.instruction_view(spark, d, False).select(*KEY, _row_key(), "instruction", "output")
    inst = SP.train_eval_split(inst, "row_key", labels=("train", "validation"))
    inst.filter(F.col("split") == "train").drop("split", "row_key").write.json(f"{base}/train.json")
    S.write_csv(inst.filter(F.col("split") == "validation").drop("split", "row_key"),
                f"{base}/validation.csv")
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("instruction", T.StringType()),
                           T.StructField("output", T.StringType())])
    spec = SourceSpec(train_file=f"{base}/train.json", validation_file=f"{base}/validation.csv")
    rows = FW.seq2seq_rows(spark, spec, schema, KEY,
                           conversation_vocab(spark, d), "instruction", "output")
    return rows.select(*KEY, "split", ids_text("input_ids").alias("input_ids"),
                       ids_text("labels").alias("labels"))


# -- seq2seq evaluation flow ------------------------------------------------------

HISTORY_TOKENS = 120

view("v_history", """
SELECT i.conv_id, i.turn, i.instruction, i.output,
       coalesce((SELECT list({'user': h.instruction, 'assistant': h.output} ORDER BY h.turn)
                 FROM v_instruction h WHERE h.conv_id = i.conv_id AND h.turn < i.turn), []) AS history
FROM v_instruction i
""", ("v_instruction",))

_EXCHANGE = ("concat('<|im_start|>user', chr(10), h.\"user\", '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10), "
             "h.assistant, '<|im_end|>', chr(10))")
_NOW = ("concat('<|im_start|>user', chr(10), instruction, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10))")

view("v_history_prompt", f"""
SELECT conv_id, turn, output, n_kept, len(pieces) AS n_exchanges,
       concat(array_to_string(pieces[len(pieces) - n_kept + 1:], ''), now) AS prompt
FROM (SELECT *, len(list_filter(range(1, len(pieces) + 1), lambda i:
             used + list_sum(sizes[len(sizes) - i + 1:]) <= {HISTORY_TOKENS})) AS n_kept
      FROM (SELECT *, list_transform(pieces, lambda p: len({words('p')})) AS sizes, len({words('now')}) AS used
            FROM (SELECT *, list_transform(history, lambda h: {_EXCHANGE}) AS pieces, {_NOW} AS now
                  FROM v_history)))
""", ("v_history",))


def histories(spark, d):
    """``v_history``: every instruction row with the exchanges before it; a
    conversation is one record."""
    inst = V.instruction_view(spark, d, False).select(*KEY, "instruction", "output")
    told = inst.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("turn").alias("at"), F.col("instruction").alias("user"),
        F.col("output").alias("assistant")))).alias("told"))
    rows = inst.join(told, "conv_id").withColumn("before", F.filter("told", lambda h: h["at"] < F.col("turn")))
    return rows.select(*KEY, "instruction", "output", F.transform("before", lambda h: F.struct(
        h["user"].alias("user"), h["assistant"].alias("assistant"))).alias("history"))


@query("prm9_history_column", "SELECT conv_id, turn, prompt FROM v_history_prompt")
def prm9_column(spark, d):
    """The newest exchanges of a row's own history that fit, then its prompt."""
    out = PM.history_column(histories(spark, d), prompt="instruction", max_tokens=HISTORY_TOKENS)
    return out.select(*KEY, "prompt")


@query("e2e_seq2seq_eval", f"""
WITH a AS {encode_sql("v_history_prompt", KEY, "prompt", 96, True, out="a")},
b AS {encode_sql("v_history_prompt", KEY, "output", 24, True, out="b")}
SELECT conv_id, turn, batch_id, {ids_sql("list_resize(a, L, 0)")} AS input_ids,
       {ids_sql("list_resize(list_transform(a, lambda x: 1), L, 0)")} AS attention_mask,
       {ids_sql(MASK.format(x='b'))} AS labels
FROM (SELECT *, max(len(a)) OVER (PARTITION BY batch_id) AS L
      FROM (SELECT a.conv_id, a.turn, a.a, b.b,
                   (row_number() OVER (ORDER BY a.conv_id, a.turn) - 1) // 16 AS batch_id
            FROM a JOIN b USING (conv_id, turn)))
""")
def e2e_seq2seq_eval(spark, d):
    """Records with a history column, written as JSON lines and read back
    through the input checks."""
    path = f"{scratch_path(spark, 'e2e-eval')}/validation.json"
    histories(spark, d).write.json(path)
    exchange = T.StructType([T.StructField("user", T.StringType()), T.StructField("assistant", T.StringType())])
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("instruction", T.StringType()), T.StructField("output", T.StringType()),
                           T.StructField("history", T.ArrayType(exchange))])
    rows = FW.seq2seq_eval_rows(spark, SourceSpec(validation_file=path), schema, KEY,
                                conversation_vocab(spark, d), "instruction", "output", "history",
                                src=96, tgt=24, max_history_tokens=HISTORY_TOKENS)
    return rows.select(*KEY, "batch_id", *[ids_text(c).alias(c) for c in (
        "input_ids", "attention_mask", "labels")])


# -- preference flow ----------------------------------------------------------

@query("e2e_preference_rows", f"""
SELECT *, CASE WHEN {md5_key('conv_id')} < '{TRAIN_T}' THEN 'train' ELSE 'eval' END AS split
FROM ({_limit_pair_sql(512, 128, PREF_MAX_TARGET_LENGTH)})
""")
def e2e_preference(spark, d):
    src = scratch_path(spark, "e2e-pref-in")
    V.comparison_view(spark, d).write.json(src)
    rows = FW.preference_rows(spark, [src], COMPARISON_SCHEMA, conversation_vocab(spark, d),
                              scratch_path(spark, "e2e-pref-out"),
                              max_target_length=PREF_MAX_TARGET_LENGTH)
    return rows.select("conv_id", "split", *[ids_text(c).alias(c) for c in (
        "prompt_ids", "chosen_ids", "rejected_ids")], "truncated")


# -- corpus flow ----------------------------------------------------------------

CORPUS_SHARD_ROWS = 50

view("v_corpus_split", f"""
SELECT i.conv_id, i.turn, c.split, (i.conv_id * 1000 + i.turn) AS row_key
FROM (SELECT *, (row_number() OVER (ORDER BY {md5_key(ROW_KEY)}, {ROW_KEY}) - 1) // {CORPUS_SHARD_ROWS} AS shard
      FROM v_instruction) i
JOIN (SELECT shard, CASE WHEN rk < floor(n * 0.25) THEN 'test' ELSE 'train' END AS split
      FROM (SELECT shard, row_number() OVER (ORDER BY {md5_key('shard')}, shard) - 1 AS rk,
                   count(*) OVER () AS n
            FROM (SELECT DISTINCT (row_number() OVER (ORDER BY {md5_key(ROW_KEY)}, {ROW_KEY}) - 1) // {CORPUS_SHARD_ROWS} AS shard
                  FROM v_instruction))) c
  ON i.shard = c.shard
""", ("v_instruction",))


@query("e2e_corpus_batches", f"""
SELECT row_key, split, batch AS batch_id, row_in_batch, L AS longest,
       {ids_sql("list_resize(ids, L, 1)")} AS input_ids,
       {ids_sql(cat(rep(-100, 'seq_len - 1'), 'ids[seq_len:]', '[1]', rep(-100, 'L - len(ids) - 1')))} AS labels
FROM (SELECT *, max(len(ids)) OVER (PARTITION BY split, batch) + 1 AS L,
             row_number() OVER (PARTITION BY split, batch ORDER BY len(ids) DESC, pos) AS row_in_batch
      FROM (SELECT *, pos // 4 AS batch
            FROM (SELECT s.split, s.row_key, c.ids, c.seq_len,
                         row_number() OVER (PARTITION BY s.split ORDER BY {md5_key('s.row_key')}, s.row_key) - 1 AS pos
                  FROM v_corpus_split s JOIN v_causal c USING (conv_id, turn))))
""")
def e2e_corpus(spark, d):
    base = scratch_path(spark, "e2e-corpus")
    inst = V.instruction_view(spark, d).select(
        _row_key(), "conv_id", "turn", "instruction", "input", "output")
    files = S.with_shards(inst, "row_key", CORPUS_SHARD_ROWS, name="file")
    files.groupBy("file").agg(F.to_json(F.collect_list(F.struct(
        "row_key", "conv_id", "turn", "instruction", "input", "output"))).alias("value")) \
        .write.partitionBy("file").text(base)
    spark.createDataFrame([('[{"row_key": 1, "instruction": "cut',)], "value string") \
        .write.text(f"{base}/file=broken")
    schema = T.StructType([T.StructField("row_key", T.LongType()),
                           T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("instruction", T.StringType()),
                           T.StructField("input", T.StringType()),
                           T.StructField("output", T.StringType())])
    rows = FW.corpus_batches(spark, [f"{base}/file=*/*.txt"], schema, "row_key",
                             conversation_vocab(spark, d), shard_rows=CORPUS_SHARD_ROWS)
    return rows.select("row_key", "split", "batch_id", F.col("row_in_batch").cast("bigint"),
                       F.col("longest").cast("bigint"), ids_text("input_ids").alias("input_ids"),
                       ids_text("labels").alias("labels"))


# -- evaluation flow ----------------------------------------------------------

view("v_gen", f"""
SELECT conv_id, turn, array_to_string({words('predict')}, ' ') AS predict,
       array_to_string({words('labels')}, ' ') AS labels
FROM v_predictions
""", ("v_predictions",))
score_views("v_gen", "v_gen_words", "v_gen_rouge", "v_gen_bleu_p", "v_gen_bleu_m",
            "v_gen_bleu", "v_gen_scores")


@query("e2e_eval_generations", """
SELECT conv_id, turn, rouge_1, rouge_2, rouge_l, bleu_4 FROM v_gen_scores
""")
def e2e_eval(spark, d):
    """Run logs (prompt ids, prompt + answer ids) with the reference ids as
    labels -> decoded, paired, written and scored."""
    gen = runs(spark, d).withColumn("label_ids", F.col("prompt_ids"))
    scored = FW.evaluate_generations(gen, KEY, conversation_vocab(spark, d),
                                     scratch_path(spark, "e2e-eval-predictions"))
    return scored.select(*KEY, "rouge_1", "rouge_2", "rouge_l", "bleu_4")
