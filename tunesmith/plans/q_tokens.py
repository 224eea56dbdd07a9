"""Queries: corpus vocabulary, encoding, decoding and the sample preview."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith.functions.arrays import ids_text
from tunesmith.operators import position as PO
from tunesmith.operators import vocab as VO
from tunesmith.plans import views as V
from tunesmith.plans.oracle import encode_sql, words
from tunesmith.plans.registry import query


def conversation_vocab(spark, d) -> VO.Vocabulary:
    """Vocabulary over every conversation turn (used by the token queries)."""
    return VO.build_vocab(V.conversations(spark, d), "text")


@query("tok1_build_vocab", """
SELECT token, count, id FROM v_vocab
""")
def tok1(spark, d):
    return conversation_vocab(spark, d).table.select(
        "token", "count", F.col("id").cast("bigint"))


@query("tok1_document_vocab", """
SELECT token, count, id FROM v_doc_vocab
""")
def tok1_docs(spark, d):
    return VO.build_vocab(V.documents(spark, d), "text").table.select(
        "token", "count", F.col("id").cast("bigint"))


def encoded_turns(spark, d, vocab=None, max_length=1024):
    vocab = vocab or conversation_vocab(spark, d)
    conv = V.conversations(spark, d).select("conv_id", "turn", "text")
    return VO.encode(conv, ["conv_id", "turn"],
                     {"input_ids": ("text", max_length, True)}, vocab, keep_input=False), vocab


ENC_TURNS = encode_sql("conversations", ["conv_id", "turn"], "text", 1024, True)


@query("tok2_encode", f"""
SELECT conv_id, turn, array_to_string(ids, ',') AS input_ids, len(ids) AS n_ids
FROM {ENC_TURNS}
""")
def tok2(spark, d):
    enc, _ = encoded_turns(spark, d)
    return enc.select("conv_id", "turn", ids_text("input_ids").alias("input_ids"),
                      F.size("input_ids").cast("bigint").alias("n_ids"))


@query("tok2_encode_documents", f"""
SELECT doc_id, len(ids) AS n_ids, CAST(list_sum(ids) AS BIGINT) AS id_sum,
       list_count(list_filter(ids, lambda x: x = 3)) AS n_unknown
FROM {encode_sql("documents", ["doc_id"], "text", None, True, "v_vocab")}
""")
def tok2_docs(spark, d):
    """Whole documents (no truncation) against the conversation vocabulary,
    so unknown words (id 3) occur."""
    vocab = conversation_vocab(spark, d)
    docs = V.documents(spark, d).select("doc_id", "text")
    enc = VO.encode(docs, "doc_id", {"ids": ("text", None, True)}, vocab,
                    keep_input=False)
    return enc.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"),
        F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"),
        F.size(F.filter("ids", lambda x: x == 3)).cast("bigint").alias("n_unknown"))


@query("tok3_decode", f"""
SELECT conv_id, turn, array_to_string({words('text')}, ' ') AS decoded
FROM conversations
""")
def tok3(spark, d):
    enc, vocab = encoded_turns(spark, d, max_length=None)
    dec = VO.decode(enc.select("conv_id", "turn", "input_ids"), ["conv_id", "turn"],
                    "input_ids", vocab)
    return dec.select("conv_id", "turn", "decoded")


WHOLE_TURNS = encode_sql("conversations", ["conv_id", "turn"], "text", None, True)


@query("pos6_preview", f"""
SELECT conv_id, turn, array_to_string(ids, ',') AS input_ids,
       array_to_string({words('text')}, ' ') AS decoded
FROM (SELECT e.*, c.text, row_number() OVER (ORDER BY e.conv_id, e.turn) - 1 AS pos
      FROM {WHOLE_TURNS} e JOIN conversations c USING (conv_id, turn))
WHERE pos = 0
""")
def pos6(spark, d):
    """The row is chosen before anything is encoded."""
    vocab, key = conversation_vocab(spark, d), ["conv_id", "turn"]
    conv = V.conversations(spark, d).select(*key, "text")
    first = PO.row_at(PO.with_position(conv, key), 0)
    enc = VO.encode(first, key, {"input_ids": ("text", None, True)}, vocab, keep_input=False)
    dec = VO.decode(enc, key, "input_ids", vocab)
    return dec.select(*key, ids_text("input_ids").alias("input_ids"), "decoded")
