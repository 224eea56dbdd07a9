"""Queries: row count, positions, lookups, slices and fixed batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith.operators import position as PO
from tunesmith.plans import views as V
from tunesmith.plans.registry import query


@query("pos1_row_count", """
SELECT count(*) AS n_rows FROM conversations
""")
def pos1(spark, d):
    return PO.row_count(V.conversations(spark, d))


@query("pos2_with_position", """
SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents
""")
def pos2(spark, d):
    return PO.with_position(V.documents(spark, d).select("doc_id"), "doc_id")


def _turns(spark, d):
    conv = V.conversations(spark, d).select("conv_id", "turn", "role")
    return PO.with_position(conv, ["conv_id", "turn"])


@query("pos3_row_at", """
SELECT conv_id, turn, role, pos FROM (
  SELECT conv_id, turn, role, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos
  FROM conversations) WHERE pos = 7
""")
def pos3(spark, d):
    return PO.row_at(_turns(spark, d), 7)


@query("pos4_slice_rows", """
SELECT doc_id, n_chars, pos FROM (
  SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)
WHERE pos >= 100 AND pos < 164
""")
def pos4(spark, d):
    docs = PO.with_position(V.documents(spark, d).select("doc_id", "n_chars"), "doc_id")
    return PO.slice_rows(docs, 100, 64)


@query("pos5_batches", """
SELECT pos // 4 AS batch_id, count(*) AS n_rows, min(pos) AS first_pos,
       string_agg(concat(conv_id, ':', turn), ',' ORDER BY pos) AS members
FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos
      FROM conversations)
GROUP BY pos // 4
""")
def pos5(spark, d):
    b = PO.batches(_turns(spark, d), 4, ["conv_id", "turn"])
    members = F.array_join(F.transform(
        "rows", lambda r: F.concat_ws(":", r["conv_id"].cast("string"),
                                      r["turn"].cast("string"))), ",")
    return b.select("batch_id", "n_rows", "first_pos", members.alias("members"))
