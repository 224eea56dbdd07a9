"""Queries: prompt shaping, preference shaping, filters and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith.operators import filters as FL
from tunesmith.operators import preference as PR
from tunesmith.operators import prompts as PM
from tunesmith.operators import split as SP
from tunesmith.plans import views as V
from tunesmith.plans.oracle import chatml_msg, md5_key
from tunesmith.plans.registry import query

NL = "chr(10)"
# fixed value: md5 below it holds for four fifths of all keys
TRAIN_T = "c" * 32


def _split_case(key: str) -> str:
    return f"CASE WHEN {md5_key(key)} < '{TRAIN_T}' THEN 'train' ELSE 'eval' END"


# -- minimum slice: comparison -> pair -> tagged text -> split -> summary --

def preference_split_summary(spark, d):
    comp = V.comparison_view(spark, d)
    pairs = PR.split_pair(comp)
    tagged = PM.kto_tagged(pairs, instruction="prompt", answer="chosen")
    split = SP.train_eval_split(tagged, "conv_id")
    return split.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.round(F.avg(F.length("prompt")), 4).alias("avg_prompt_chars"),
        F.round(F.avg(F.length("completion")), 4).alias("avg_completion_chars"))


query("slice_preference_split", f"""
SELECT split, count(*) AS n_rows,
       round(avg(length(p)), 4) AS avg_prompt_chars,
       round(avg(length(c)), 4) AS avg_completion_chars
FROM (SELECT {_split_case('conv_id')} AS split,
             concat('<|im_start|>user', {NL}, 'Q:', instruction, {NL}, 'A:<|im_end|>', {NL}) AS p,
             concat('<|im_start|>assistant', {NL}, output[1], '<|im_end|>', {NL}) AS c
      FROM v_comparison)
GROUP BY split
""")(preference_split_summary)


# -- PRM ---------------------------------------------------------------------

@query("prm1_qa_prompt", f"""
SELECT conv_id, turn, concat('### Question: ', instruction, {NL}, ' ### Answer: ', output) AS prompt
FROM v_instruction
""")
def prm1(spark, d):
    return PM.qa_prompt(V.instruction_view(spark, d, False)).select(
        "conv_id", "turn", "prompt")


@query("prm2_context_target", f"""
SELECT conv_id, turn,
       concat('Instruction: ', instruction, {NL},
              CASE WHEN input <> '' THEN concat('Input: ', input, {NL}) ELSE '' END,
              'Answer: ') AS context,
       output AS target
FROM v_instruction
""")
def prm2(spark, d):
    return PM.context_target(V.instruction_view(spark, d)).select(
        "conv_id", "turn", "context", "target")


@query("prm3_sft_text", """
SELECT conv_id, concat(instruction, output[1]) AS text FROM v_comparison
""")
def prm3(spark, d):
    return PM.sft_text(V.comparison_view(spark, d)).select("conv_id", "text")


@query("prm4_chatml", f"""
SELECT conv_id,
       array_to_string(list_transform(messages, lambda m: {chatml_msg('m.role', 'm.content')}), '') AS text
FROM v_messages
""")
def prm4(spark, d):
    return PM.chatml(V.messages_view(spark, d)).select("conv_id", "text")


@query("prm5_chatml_pair", f"""
SELECT conv_id,
       concat({chatml_msg("'user'", 'instruction')}, {chatml_msg("'assistant'", 'output[1]')}) AS chosen,
       concat({chatml_msg("'user'", 'instruction')}, {chatml_msg("'assistant'", 'output[2]')}) AS rejected
FROM v_comparison
""")
def prm5(spark, d):
    comp = V.comparison_view(spark, d)

    def msgs(answer):
        return F.array(
            F.struct(F.lit("user").alias("role"), F.col("instruction").alias("content")),
            F.struct(F.lit("assistant").alias("role"), answer.alias("content")))

    pairs = comp.select("conv_id", msgs(F.get("output", 0)).alias("chosen"),
                        msgs(F.get("output", 1)).alias("rejected"))
    return PM.chatml_pair(pairs)


@query("prm6_chatml_kto", f"""
SELECT conv_id, turn,
       {chatml_msg("'user'", 'instruction')} AS prompt,
       {chatml_msg("'assistant'", 'output')} AS completion
FROM v_instruction
""")
def prm6(spark, d):
    rows = V.instruction_view(spark, d, False).select(
        "conv_id", "turn",
        F.array(F.struct(F.lit("user").alias("role"),
                         F.col("instruction").alias("content"))).alias("prompt"),
        F.array(F.struct(F.lit("assistant").alias("role"),
                         F.col("output").alias("content"))).alias("completion"))
    return PM.chatml_kto(rows)


@query("prm7_system_question_pair", f"""
SELECT conv_id,
       concat(CASE WHEN length(system) > 0 THEN {chatml_msg("'system'", 'system')} ELSE '' END,
              {chatml_msg("'user'", 'question')}, '<|im_start|>assistant', {NL}) AS prompt,
       concat(chosen, '<|im_end|>', {NL}) AS chosen,
       concat(rejected, '<|im_end|>', {NL}) AS rejected
FROM v_question_pair
""")
def prm7(spark, d):
    return PM.system_question_pair(V.question_pair_view(spark, d))


@query("prm8_kto_tagged", f"""
SELECT conv_id,
       concat('<|im_start|>user', {NL}, 'Q:', instruction, {NL}, 'A:<|im_end|>', {NL}) AS prompt,
       concat('<|im_start|>assistant', {NL}, output[length(instruction) % 2 + 1], '<|im_end|>', {NL}) AS completion,
       length(instruction) % 2 = 0 AS label
FROM v_comparison
""")
def prm8(spark, d):
    picked = PR.parity_pick(V.comparison_view(spark, d))
    return PM.kto_tagged(picked).select("conv_id", "prompt", "completion", "label")


@query("prm9_history_prompt", f"""
SELECT conv_id, turn,
       concat(string_agg({chatml_msg('role', 'text')}, '' ORDER BY turn)
                OVER (PARTITION BY conv_id ORDER BY turn
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
              '<|im_start|>assistant', {NL}) AS prompt
FROM conversations
""")
def prm9(spark, d):
    return PM.history_prompt(V.conversations(spark, d)).select(
        "conv_id", "turn", "prompt")


@query("prm10_code_edit_prompt", f"""
SELECT conv_id, turn,
       concat('[INST] Code:```python', {NL}, output, '``` ', {NL}, {NL}, ' Question: ',
              instruction, ' ', {NL}, {NL}, ' Modified code:[/INST]') AS prompt
FROM v_instruction
""")
def prm10(spark, d):
    rows = V.instruction_view(spark, d, False).select(
        "conv_id", "turn", F.col("output").alias("code"),
        F.col("instruction").alias("question"))
    return PM.code_edit_prompt(rows).select("conv_id", "turn", "prompt")


@query("prm11_chat_requests", """
SELECT conv_id, turn,
       CAST(to_json({'model': 'chat-model',
                     'messages': [{'role': 'user', 'content': instruction}]}) AS VARCHAR) AS payload
FROM v_instruction
""")
def prm11(spark, d):
    rows = V.instruction_view(spark, d, False).select(
        "conv_id", "turn", F.col("instruction").alias("prompt"))
    return PM.chat_requests(rows, "chat-model").select("conv_id", "turn", "payload")


@query("prm12_dialogue_prompt", f"""
SELECT conv_id,
       CASE WHEN strpos(text, concat({NL}, {NL}, 'Assistant:')) > 0
            THEN left(text, length(text) - length(string_split(text, concat({NL}, {NL}, 'Assistant:'))[-1]))
       END AS prompt,
       strpos(text, concat({NL}, {NL}, 'Assistant:')) > 0 AS prompt_ok
FROM v_dialogue
""")
def prm12(spark, d):
    return PM.dialogue_prompt(V.dialogue_view(spark, d)).select(
        "conv_id", "prompt", "prompt_ok")


# -- PRF ---------------------------------------------------------------------

@query("prf1_split_pair", """
SELECT conv_id, instruction AS prompt, output[1] AS chosen, output[2] AS rejected
FROM v_comparison
""")
def prf1(spark, d):
    return PR.split_pair(V.comparison_view(spark, d))


@query("prf2_parity_pick", """
SELECT conv_id, instruction, output[length(instruction) % 2 + 1] AS answer,
       length(instruction) % 2 = 0 AS label
FROM v_comparison
""")
def prf2(spark, d):
    return PR.parity_pick(V.comparison_view(spark, d))


SEP = "\n---\n"


@query("prf3_paired_lists", f"""
SELECT conv_id, instruction AS prompt,
       concat(output[1], {NL}, '---', {NL}, output[2]) AS completion,
       '1,0' AS label
FROM v_comparison
""")
def prf3(spark, d):
    rows = PR.paired_lists(V.comparison_view(spark, d))
    return rows.select("conv_id", "prompt",
                       F.array_join("completion", SEP).alias("completion"),
                       F.array_join("label", ",").alias("label"))


@query("prf4_explode_unpaired", """
SELECT conv_id, instruction AS prompt, output[1] AS completion, CAST(1 AS BIGINT) AS label
FROM v_comparison
UNION ALL
SELECT conv_id, instruction AS prompt, output[2] AS completion, CAST(0 AS BIGINT) AS label
FROM v_comparison
""")
def prf4(spark, d):
    rows = PR.explode_unpaired(V.comparison_view(spark, d))
    return rows.select("conv_id", "prompt", "completion",
                       F.col("label").cast("bigint"))


# -- FLT ---------------------------------------------------------------------

@query("flt1_reshape", """
SELECT doc_id, lang, n_chars FROM documents
""")
def flt1(spark, d):
    return FL.reshape(V.documents(spark, d), ["doc_id", "lang", "n_chars"])


@query("flt2_bind_roles", """
SELECT conv_id, turn, instruction AS prompt, output AS response, system AS history
FROM v_instruction
""")
def flt2(spark, d):
    return FL.bind(V.instruction_view(spark, d), "instruction", "output",
                   history="system", keep=("conv_id", "turn"))


@query("flt3_drop_blank", """
SELECT conv_id, turn, instruction AS prompt, input AS response
FROM v_instruction WHERE instruction <> '' AND input <> ''
""")
def flt3(spark, d):
    bound = FL.bind(V.instruction_view(spark, d), "instruction", "input",
                    keep=("conv_id", "turn"))
    return FL.drop_blank(bound)


@query("flt4_drop_null", f"""
SELECT conv_id, turn,
       concat('Instruction: ', instruction, {NL}, 'Answer: ') AS context,
       system AS target
FROM v_instruction WHERE system IS NOT NULL
""")
def flt4(spark, d):
    rows = V.instruction_view(spark, d).select(
        "conv_id", "turn", "instruction", F.lit("").alias("input"),
        F.col("system").alias("output"))
    shaped = PM.context_target(rows).select("conv_id", "turn", "context", "target")
    return FL.drop_null(shaped)


@query("flt5_cap_per_split", f"""
SELECT doc_id, split FROM (
  SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS rn
  FROM (SELECT doc_id, {_split_case('doc_id')} AS split FROM documents))
WHERE rn <= 50
""")
def flt5(spark, d):
    docs = SP.train_eval_split(V.documents(spark, d).select("doc_id"), "doc_id")
    return FL.cap(docs, 50, "doc_id", by="split")


@query("flt6_with_prefix", """
SELECT conv_id, turn, concat('[corpus] ', instruction) AS prompt FROM v_instruction
""")
def flt6(spark, d):
    bound = FL.bind(V.instruction_view(spark, d, False), "instruction", "output",
                    keep=("conv_id", "turn"))
    return FL.with_prefix(bound, "[corpus] ").select("conv_id", "turn", "prompt")


# -- SPL ---------------------------------------------------------------------

@query("spl1_train_eval_split", f"""
SELECT doc_id, {_split_case('doc_id')} AS split FROM documents
""")
def spl1(spark, d):
    return SP.train_eval_split(V.documents(spark, d).select("doc_id"), "doc_id")


@query("spl1_exact_split", f"""
SELECT doc_id, CASE WHEN rn <= ceil(0.8 * n) THEN 'train' ELSE 'eval' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY {md5_key('doc_id')}, doc_id) AS rn,
             count(*) OVER () AS n FROM documents)
""")
def spl1_exact(spark, d):
    return SP.train_eval_split(V.documents(spark, d).select("doc_id"), "doc_id",
                               exact=True)


@query("spl2_shuffle", f"""
SELECT doc_id, row_number() OVER (ORDER BY {md5_key('doc_id')}, doc_id) - 1 AS pos
FROM documents
""")
def spl2(spark, d):
    return SP.shuffle(V.documents(spark, d).select("doc_id"), "doc_id")


HOLDOUT_SHARD_ROWS = 50


@query("spl3_shard_holdout", f"""
WITH s AS (
  SELECT doc_id, (row_number() OVER (ORDER BY {md5_key('doc_id')}, doc_id) - 1) // {HOLDOUT_SHARD_ROWS} AS shard
  FROM documents),
r AS (
  SELECT shard, row_number() OVER (ORDER BY {md5_key('shard')}, shard) - 1 AS rk,
         count(*) OVER () AS n
  FROM (SELECT DISTINCT shard FROM s)),
c AS (
  SELECT shard, CASE WHEN rk < floor(n * 0.25) THEN 'test' ELSE 'train' END AS split
  FROM r)
SELECT s.doc_id, s.shard, c.split FROM s JOIN c ON s.shard = c.shard
""")
def spl3(spark, d):
    shuffled = SP.shuffle(V.documents(spark, d).select("doc_id"), "doc_id")
    sharded = shuffled.select(
        "doc_id",
        F.floor(F.col("pos") / HOLDOUT_SHARD_ROWS).cast("bigint").alias("shard"))
    return SP.shard_holdout(sharded, "shard").select("doc_id", "shard", "split")


@query("prm4_chatml_generation", f"""
SELECT conv_id,
       concat(array_to_string(list_transform(messages, lambda m: {chatml_msg('m.role', 'm.content')}), ''),
              '<|im_start|>assistant', {NL}) AS text
FROM v_messages
""")
def prm4_generation(spark, d):
    return PM.chatml(V.messages_view(spark, d), add_generation_prompt=True).select("conv_id", "text")
