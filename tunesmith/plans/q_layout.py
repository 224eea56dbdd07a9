"""Queries: token-row layout, masks, positions, padding and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith.config import PREF_MAX_TARGET_LENGTH, TokenSpec
from tunesmith.functions import arrays as A
from tunesmith.functions import templates as T
from tunesmith.operators import filters as FL
from tunesmith.operators import layout as LA
from tunesmith.operators import position as PO
from tunesmith.operators import preference as PR
from tunesmith.operators import prompts as PM
from tunesmith.operators import vocab as VO
from tunesmith.plans import views as V
from tunesmith.plans.oracle import encode_sql, md5_key, view, words
from tunesmith.plans.q_tokens import conversation_vocab
from tunesmith.plans.registry import query
from tunesmith.session import scratch_table

KEY = ["conv_id", "turn"]


def rep(value: int, n: str) -> str:
    """DuckDB: list of ``n`` copies of ``value`` (empty for n <= 0)."""
    return f"list_transform(range(greatest({n}, 0)), lambda i: {value})"


def cat(*parts: str) -> str:
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


def s(x: str) -> str:
    return f"array_to_string({x}, ',')"


def _instruction_pairs(spark, d):
    return FL.bind(V.instruction_view(spark, d, False), "instruction", "output",
                   keep=KEY)


# -- LAY1 / LAY4 ------------------------------------------------------------

view("v_s2s", f"""
SELECT a.conv_id, a.turn, a.a, b.b
FROM {encode_sql("v_instruction", KEY, "instruction", 1024, True, out="a")} a
JOIN {encode_sql("v_instruction", KEY, "output", 128, False, out="b")} b
USING (conv_id, turn)
""", ("v_instruction", "v_vocab"))

S2S_IDS = f"list_resize({cat('a', 'b', '[1]')}, 1153, 0)"
S2S_LABELS_RAW = f"list_resize({cat(rep(0, 'len(a)'), 'b', '[1]')}, 1153, 0)"
MASK = "list_transform({x}, lambda v: CASE WHEN v = 0 THEN -100 ELSE v END)"


@query("lay1_seq2seq_train", f"""
SELECT conv_id, turn, {s(S2S_IDS)} AS input_ids,
       {s(MASK.format(x=S2S_LABELS_RAW))} AS labels
FROM v_s2s
""")
def lay1(spark, d):
    rows = LA.seq2seq_train(_instruction_pairs(spark, d), KEY, conversation_vocab(spark, d))
    return rows.select(*KEY, A.ids_text("input_ids").alias("input_ids"),
                       A.ids_text("labels").alias("labels"))


@query("lay4_mask_pad", f"""
SELECT conv_id, turn, {s(MASK.format(x=S2S_LABELS_RAW))} AS masked,
       {s(S2S_LABELS_RAW)} AS restored,
       len(list_filter({S2S_LABELS_RAW}, lambda v: v = 0)) AS n_masked
FROM v_s2s
""")
def lay4(spark, d):
    spec = TokenSpec(ignore_pad_for_loss=False)
    rows = LA.seq2seq_train(_instruction_pairs(spark, d), KEY,
                            conversation_vocab(spark, d), spec=spec)
    masked = A.mask_pad("labels", spec.pad)
    return rows.select(
        *KEY, A.ids_text(masked).alias("masked"),
        A.ids_text(A.unmask(masked, spec.pad)).alias("restored"),
        F.size(F.filter(masked, lambda x: x == -100)).cast("bigint").alias("n_masked"))


# -- LAY2 -------------------------------------------------------------------

EVAL_BATCH = 16


@query("lay2_seq2seq_eval", f"""
SELECT conv_id, turn, batch_id, {s("list_resize(a, L, 0)")} AS input_ids,
       {s("list_resize(list_transform(a, lambda x: 1), L, 0)")} AS attention_mask,
       {s(MASK.format(x='b'))} AS labels
FROM (SELECT *, max(len(a)) OVER (PARTITION BY batch_id) AS L
      FROM (SELECT a.conv_id, a.turn, a.a, b.b,
                   (row_number() OVER (ORDER BY a.conv_id, a.turn) - 1) // {EVAL_BATCH} AS batch_id
            FROM {encode_sql("v_instruction", KEY, "instruction", 1024, True, out="a")} a
            JOIN {encode_sql("v_instruction", KEY, "output", 128, True, out="b")} b
            USING (conv_id, turn)))
""")
def lay2(spark, d):
    rows = PO.with_batch_id(PO.with_position(_instruction_pairs(spark, d), KEY),
                            EVAL_BATCH)
    out = LA.seq2seq_eval(rows, KEY, conversation_vocab(spark, d))
    return out.select(*KEY, "batch_id",
                      A.ids_text("input_ids").alias("input_ids"),
                      A.ids_text("attention_mask").alias("attention_mask"),
                      A.ids_text("labels").alias("labels"))


# -- LAY3 / LAY6 / LAY7 / LAY8 / LAY11 ---------------------------------------

view("v_context", """
SELECT conv_id, turn,
       concat('Instruction: ', instruction, chr(10),
              CASE WHEN input <> '' THEN concat('Input: ', input, chr(10)) ELSE '' END,
              'Answer: ') AS context,
       output AS target
FROM v_instruction
""", ("v_instruction",))

view("v_causal", f"""
SELECT p.conv_id, p.turn, {cat('p.p', 't.t', '[1]')} AS ids, len(p.p) AS seq_len
FROM {encode_sql("v_context", KEY, "context", 1024, True, out="p")} p
JOIN {encode_sql("v_context", KEY, "target", 1024, False, out="t")} t
USING (conv_id, turn)
""", ("v_context", "v_vocab"))


def contexts(spark, d):
    ctx = PM.context_target(V.instruction_view(spark, d)).select(*KEY, "context", "target")
    return FL.drop_null(ctx)


def causal(spark, d):
    return LA.causal_rows(contexts(spark, d), KEY, conversation_vocab(spark, d))


@query("lay3_causal_rows", f"""
SELECT conv_id, turn, {s('ids')} AS input_ids, seq_len FROM v_causal
""")
def lay3(spark, d):
    return causal(spark, d).select(*KEY, A.ids_text("input_ids").alias("input_ids"),
                                   F.col("seq_len").cast("bigint"))


COLLATE_BATCH = 4
POS2D = ("concat(array_to_string(list_transform(range(L), lambda i: CASE WHEN i >= seq_len - 1 "
         "THEN seq_len - 2 ELSE i END), ','), '|', array_to_string(list_transform(range(L), "
         "lambda i: CASE WHEN i >= seq_len - 1 THEN i - seq_len + 2 ELSE 0 END), ','))")


@query("lay6_collate", f"""
SELECT conv_id, turn, batch_id, row_in_batch,
       {s("list_resize(ids, L, 1)")} AS input_ids,
       {s(cat(rep(-100, 'seq_len - 1'), 'ids[seq_len:]', '[1]', rep(-100, 'L - len(ids) - 1')))} AS labels,
       {POS2D} AS position_ids
FROM (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) + 1 AS L,
             row_number() OVER (PARTITION BY batch_id ORDER BY len(ids) DESC, pos) AS row_in_batch
      FROM (SELECT *, pos // {COLLATE_BATCH} AS batch_id
            FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos FROM v_causal)))
""")
def lay6(spark, d):
    # batches are numbered before the ids are there
    rows = PO.with_batch_id(PO.with_position(contexts(spark, d), KEY), COLLATE_BATCH)
    out = LA.collate(LA.causal_rows(rows, KEY, conversation_vocab(spark, d)))
    pos = F.concat_ws("|", A.ids_text(F.get("position_ids", 0)),
                      A.ids_text(F.get("position_ids", 1)))
    return out.select(*KEY, "batch_id", F.col("row_in_batch").cast("bigint"),
                      A.ids_text("input_ids").alias("input_ids"),
                      A.ids_text("labels").alias("labels"), pos.alias("position_ids"))


MASK_WINDOW = 4
BOUND = "CASE WHEN seq_len >= 3 THEN seq_len - 3 ELSE greatest(L + seq_len - 3, 0) END"


@query("lay7_prefix_mask", f"""
SELECT conv_id, turn, seq_len, L,
       CAST(list_sum(list_transform(range(L), lambda i:
         len(list_filter(range(L), lambda j: j > i AND j >= {BOUND})))) AS BIGINT) AS n_hidden,
       CAST(list_sum(list_transform(range(L), lambda i:
         greatest(L - greatest(i + 1, {BOUND}), 0))) AS BIGINT) AS n_hidden_closed
FROM (SELECT conv_id, turn, seq_len, seq_len + {MASK_WINDOW} AS L FROM v_causal)
""")
def lay7(spark, d):
    rows = causal(spark, d).select(*KEY, F.col("seq_len").cast("bigint"))
    rows = rows.withColumn("L", F.col("seq_len") + MASK_WINDOW)
    mask = A.prefix_mask("seq_len", F.col("L"))
    hidden = F.aggregate(mask, F.lit(0).cast("bigint"),
                         lambda acc, r: acc + F.size(F.filter(r, lambda x: x)))
    return rows.select(*KEY, "seq_len", "L", hidden.alias("n_hidden"),
                       A.hidden_cells("seq_len", F.col("L")).alias("n_hidden_closed"))


@query("lay8_position_ids", f"""
SELECT conv_id, turn, {POS2D} AS pos_2d,
       array_to_string(list_transform(range(L), lambda i: CASE WHEN i = L - 1 THEN seq_len - 2 ELSE i END), ',') AS pos_1d
FROM (SELECT conv_id, turn, seq_len, len(ids) + 1 AS L FROM v_causal)
""")
def lay8(spark, d):
    rows = causal(spark, d).withColumn("L", F.size("input_ids") + 1)
    p2 = A.position_ids("seq_len", F.col("L"))
    p1 = A.position_ids("seq_len", F.col("L"), two_d=False)
    return rows.select(*KEY, F.concat_ws("|", A.ids_text(F.get(p2, 0)),
                                         A.ids_text(F.get(p2, 1))).alias("pos_2d"),
                       A.ids_text(p1).alias("pos_1d"))


@query("lay11_length_grouped", f"""
SELECT conv_id, turn, mega_batch, (row_number() OVER (PARTITION BY mega_batch
         ORDER BY len(ids) DESC, sp) - 1) // 4 AS batch
FROM (SELECT *, sp // 200 AS mega_batch
      FROM (SELECT *, row_number() OVER (ORDER BY {md5_key('conv_id * 1000 + turn')},
                                         conv_id * 1000 + turn) - 1 AS sp
            FROM v_causal))
""")
def lay11(spark, d):
    rows = scratch_table(causal(spark, d).select(
        *KEY, (F.col("conv_id") * 1000 + F.col("turn")).alias("row_key"),
        F.size("input_ids").alias("length")), "lengths")
    out = LA.length_grouped(rows, "row_key", 4, "length")
    return out.select(*KEY, "mega_batch", "batch")


# -- LAY5 -------------------------------------------------------------------

view("v_qa", """
SELECT conv_id, turn, concat('### Question: ', instruction, chr(10), ' ### Answer: ', output) AS text
FROM v_instruction
""", ("v_instruction",))

view("v_qa_vocab", f"""
SELECT token, CAST(row_number() OVER (ORDER BY cnt DESC, token ASC) + 3 AS BIGINT) AS id
FROM (SELECT token, count(*) AS cnt
      FROM (SELECT unnest({words('text')}) AS token FROM v_qa) GROUP BY token)
""", ("v_qa",))

view("v_qa_marker", """
SELECT list(coalesce(v.id, 3) ORDER BY m.ord) AS m
FROM (SELECT 1 AS ord, '###' AS token UNION ALL SELECT 2, 'Answer:') m
LEFT JOIN v_qa_vocab v USING (token)
""", ("v_qa_vocab",))


@query("lay5_completion_only", f"""
SELECT conv_id, turn, {s('ids')} AS input_ids,
       {s("list_transform(range(1, len(ids) + 1), lambda i: CASE WHEN e IS NULL OR i <= e THEN -100 ELSE ids[i] END)")} AS labels
FROM (SELECT conv_id, turn, ids,
             list_filter(range(1, len(ids) - len(m) + 2), lambda p: ids[p:p + len(m) - 1] = m)[-1] + len(m) - 1 AS e
      FROM {encode_sql("v_qa", KEY, "text", None, False, vocab="v_qa_vocab")}, v_qa_marker)
""")
def lay5(spark, d):
    inst = V.instruction_view(spark, d, False)
    qa = PM.qa_prompt(inst, out="text").select(*KEY, "text")
    vocab = VO.build_vocab(qa, "text")
    marker = VO.ids_of(vocab, T.RESPONSE_MARKER)
    enc = VO.encode(qa, KEY, {"input_ids": ("text", None, False)}, vocab)
    return LA.completion_only(enc, "input_ids", marker).select(
        *KEY, A.ids_text("input_ids").alias("input_ids"),
        A.ids_text("labels").alias("labels"))


# -- LAY9 / LAY10 / LAY13 ----------------------------------------------------

PAD_TO = 129  # max_new_tokens + 1 with the default target length 128


@query("lay9_pad_to", f"""
SELECT conv_id, turn, {s(f"list_resize(ids, greatest(len(ids), {PAD_TO}), 0)")} AS padded
FROM {encode_sql("conversations", KEY, "text", None, True)}
""")
def lay9(spark, d):
    conv = V.conversations(spark, d).select(*KEY, "text")
    enc = VO.encode(conv, KEY, {"ids": ("text", None, True)},
                    conversation_vocab(spark, d), keep_input=False)
    padded = LA.pad_generated(enc, "ids", max_new_tokens=PAD_TO - 1)
    return padded.select(*KEY, A.ids_text("ids").alias("padded"))


view("v_runs", f"""
SELECT p.conv_id, p.turn, p.p AS prompt_ids, list_concat(p.p, o.o) AS output_ids
FROM {encode_sql("v_predictions", KEY, "labels", None, True, out="p")} p
JOIN {encode_sql("v_predictions", KEY, "predict", None, False, out="o")} o
USING (conv_id, turn)
""", ("v_predictions", "v_vocab"))


def runs(spark, d):
    """``v_runs``: per assistant turn, prompt ids (the user turn) and output ids
    (prompt followed by the answer)."""
    preds, refs = V.prediction_view(spark, d)
    pairs = preds.join(refs, KEY, "inner")
    enc = VO.encode(pairs, KEY, {"prompt_ids": ("labels", None, True),
                                 "__o": ("predict", None, False)},
                    conversation_vocab(spark, d), keep_input=False)
    return enc.withColumn("output_ids", F.concat("prompt_ids", "__o")).drop("__o")


@query("lay10_strip_prompt", f"""
SELECT conv_id, turn, {s('output_ids[len(prompt_ids) + 1:]')} AS generated FROM v_runs
""")
def lay10(spark, d):
    r = runs(spark, d)
    return r.select(*KEY, A.ids_text(A.strip_prompt("output_ids", "prompt_ids"))
                    .alias("generated"))


@query("lay13_limit_text", f"""
SELECT doc_id, len(ids) AS n_ids, {s('ids')} AS input_ids
FROM {encode_sql("documents", ["doc_id"], "text", 1024, True, vocab="v_doc_vocab")}
""")
def lay13(spark, d):
    docs = V.documents(spark, d).select("doc_id", "text")
    vocab = VO.build_vocab(docs, "text")
    # the words are cut, with room for the leading id, before the lookup
    cut = LA.limit_text(VO.word_arrays(docs, {"input_ids": "text"}), "input_ids", 1023)
    out = VO.encode(cut, "doc_id", {"input_ids": ("input_ids", None, True)}, vocab,
                    keep_input=False)
    return out.select("doc_id", F.size("input_ids").cast("bigint").alias("n_ids"),
                      A.ids_text("input_ids").alias("input_ids"))


# -- LAY12 ------------------------------------------------------------------

def _limit_pair_sql(max_length: int, max_prompt: int, max_target: int | None = None) -> str:
    keep = max_length - max_prompt
    cut = "" if max_target is None else f"[1:{max_target}]"
    return f"""
SELECT conv_id, {s('p2')} AS prompt_ids,
       {s(f'CASE WHEN len(p2) + greatest(len(c), len(r)) > {max_length} THEN c[1:{keep}] ELSE c END')} AS chosen_ids,
       {s(f'CASE WHEN len(p2) + greatest(len(c), len(r)) > {max_length} THEN r[1:{keep}] ELSE r END')} AS rejected_ids,
       truncated
FROM (SELECT conv_id, c, r, over AS truncated,
             CASE WHEN over THEN p[greatest(len(p) - {max_prompt} + 1, 1):] ELSE p END AS p2
      FROM (SELECT *, len(p) + greatest(len(c), len(r)) > {max_length} AS over
            FROM (SELECT p.conv_id, p.p, c.c{cut} AS c, r.r{cut} AS r
                  FROM {encode_sql("v_comparison", ["conv_id"], "instruction", None, True, out="p")} p
                  JOIN {encode_sql("v_comparison", ["conv_id"], "output[1]", None, False, out="c")} c USING (conv_id)
                  JOIN {encode_sql("v_comparison", ["conv_id"], "output[2]", None, False, out="r")} r USING (conv_id))))
"""


def _pair_rows(spark, d, max_length, max_prompt, max_target=None):
    return LA.pair_rows(PR.split_pair(V.comparison_view(spark, d)), "conv_id", conversation_vocab(spark, d),
                        max_length=max_length, max_prompt_length=max_prompt, max_target_length=max_target)


def _lay12(spark, d, *limits):
    out = _pair_rows(spark, d, *limits)
    return out.select("conv_id", A.ids_text("prompt_ids").alias("prompt_ids"),
                      A.ids_text("chosen_ids").alias("chosen_ids"),
                      A.ids_text("rejected_ids").alias("rejected_ids"), "truncated")


@query("lay12_limit_pair", _limit_pair_sql(512, 128))
def lay12(spark, d):
    return _lay12(spark, d, 512, 128)


@query("lay12_limit_pair_tight", _limit_pair_sql(160, 24))
def lay12_tight(spark, d):
    return _lay12(spark, d, 160, 24)


@query("lay12_limit_pair_target", _limit_pair_sql(140, 24, PREF_MAX_TARGET_LENGTH))
def lay12_target(spark, d):
    return _lay12(spark, d, 140, 24, PREF_MAX_TARGET_LENGTH)


@query("lay12_truncated_share", f"""
SELECT count(*) AS n_rows, CAST(sum(CASE WHEN truncated THEN 1 ELSE 0 END) AS BIGINT) AS n_truncated,
       round(sum(CASE WHEN truncated THEN 1 ELSE 0 END) / count(*), 6) AS truncated_share
FROM ({_limit_pair_sql(160, 24)})
""")
def lay12_share(spark, d):
    out = LA.truncated_share(_pair_rows(spark, d, 160, 24))
    return out.withColumn("truncated_share", F.round("truncated_share", 6))


@query("lay2_seq2seq_eval_left", f"""
SELECT conv_id, turn, batch_id,
       {s(cat(rep(0, 'L - len(a)'), 'a'))} AS input_ids,
       {s(cat(rep(0, 'L - len(a)'), "list_transform(a, lambda x: 1)"))} AS attention_mask,
       {s(MASK.format(x='b'))} AS labels
FROM (SELECT *, max(len(a)) OVER (PARTITION BY batch_id) AS L
      FROM (SELECT a.conv_id, a.turn, a.a, b.b,
                   (row_number() OVER (ORDER BY a.conv_id, a.turn) - 1) // {EVAL_BATCH} AS batch_id
            FROM {encode_sql("v_instruction", KEY, "instruction", 1024, True, out="a")} a
            JOIN {encode_sql("v_instruction", KEY, "output", 128, True, out="b")} b
            USING (conv_id, turn)))
""")
def lay2_left(spark, d):
    """Left padding (the padding side some tokenizers default to)."""
    rows = PO.with_batch_id(PO.with_position(_instruction_pairs(spark, d), KEY),
                            EVAL_BATCH)
    out = LA.seq2seq_eval(rows, KEY, conversation_vocab(spark, d),
                          spec=TokenSpec(padding_side="left"))
    return out.select(*KEY, "batch_id",
                      A.ids_text("input_ids").alias("input_ids"),
                      A.ids_text("attention_mask").alias("attention_mask"),
                      A.ids_text("labels").alias("labels"))


@query("lay8_position_ids_gmask", """
SELECT conv_id, turn,
       concat(array_to_string(range(L), ','), '|', array_to_string(list_transform(range(L),
              lambda i: CASE WHEN i >= seq_len - 1 THEN i - seq_len + 2 ELSE 0 END), ',')) AS pos_2d,
       array_to_string(range(L), ',') AS pos_1d
FROM (SELECT conv_id, turn, seq_len, len(ids) + 1 AS L FROM v_causal)
""")
def lay8_gmask(spark, d):
    rows = causal(spark, d).withColumn("L", F.size("input_ids") + 1)
    p2 = A.position_ids("seq_len", F.col("L"), gmask=True)
    p1 = A.position_ids("seq_len", F.col("L"), gmask=True, two_d=False)
    return rows.select(*KEY, F.concat_ws("|", A.ids_text(F.get(p2, 0)),
                                         A.ids_text(F.get(p2, 1))).alias("pos_2d"),
                       A.ids_text(p1).alias("pos_1d"))


@query("pos6_preview_labels", f"""
SELECT conv_id, turn, {s(S2S_IDS)} AS input_ids,
       array_to_string(list_concat({words('instruction')}[1:1023], {words('output')}[1:128]), ' ') AS inputs,
       array_to_string({words('output')}[1:128], ' ') AS label_text
FROM (SELECT s.*, i.instruction, i.output,
             row_number() OVER (ORDER BY s.conv_id, s.turn) - 1 AS pos
      FROM v_s2s s JOIN v_instruction i USING (conv_id, turn))
WHERE pos = 0
""")
def pos6_labels(spark, d):
    """First seq2seq training row: ids, decoded inputs and decoded labels."""
    vocab = conversation_vocab(spark, d)
    first = PO.row_at(PO.with_position(_instruction_pairs(spark, d), KEY), 0).drop("pos")
    out = VO.preview(LA.seq2seq_train(first, KEY, vocab), KEY, vocab)
    return out.select(*KEY, A.ids_text("input_ids").alias("input_ids"), "inputs", "label_text")
