"""Queries: n-gram continuation lookup, accepted prefixes, run summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith.functions import arrays as A
from tunesmith.operators import ngram as NG
from tunesmith.plans.q_layout import KEY, runs, s
from tunesmith.plans.registry import query


def continuation_sql(a: str, max_n: int = 3, k: int = 10) -> str:
    parts = []
    for n in range(max_n, 0, -1):
        hit = (f"list_filter(range(0, len({a}) - {n} - {k} + 1), lambda p: p + {n} < len({a}) - {n} "
               f"AND {a}[p + 1:p + {n}] = {a}[len({a}) - {n} + 1:len({a})])[1]")
        parts.append(f"CASE WHEN {hit} IS NOT NULL THEN {a}[{hit} + {n} + 1:{hit} + {n} + {k}] END")
    return f"coalesce({', '.join(parts)}, CAST([] AS BIGINT[]))"


@query("ngr1_continuation", f"""
SELECT conv_id, turn, {s('c')} AS candidate, len(c) AS n_candidate
FROM (SELECT conv_id, turn, {continuation_sql('output_ids')} AS c FROM v_runs)
""")
def ngr1(spark, d):
    r = NG.continuation(runs(spark, d), "output_ids")
    return r.select(*KEY, A.ids_text("candidate").alias("candidate"),
                    F.size("candidate").cast("bigint").alias("n_candidate"))


def _half(spark, d):
    r = runs(spark, d)
    ans = A.strip_prompt("output_ids", "prompt_ids")
    h = F.floor(F.size(ans) / 2).cast("int")
    r = r.withColumn("__ans", ans).withColumn("__h", h)
    return (r.withColumn("context", F.concat("prompt_ids", F.slice("__ans", 1, F.col("__h"))))
             .withColumn("truth", F.slice("__ans", F.col("__h") + 1, F.size("__ans")))
             .withColumn("cap", F.size("truth") - 1)
             .drop("__ans", "__h"))


HALF_SQL = """(SELECT conv_id, turn, list_concat(prompt_ids, ans[1:h]) AS context,
        ans[h + 1:] AS truth, len(ans) - h - 1 AS cap
 FROM (SELECT conv_id, turn, prompt_ids, ans, len(ans) // 2 AS h
       FROM (SELECT conv_id, turn, prompt_ids, output_ids[len(prompt_ids) + 1:] AS ans FROM v_runs)))"""


@query("ngr2_accepted_prefix", f"""
SELECT conv_id, turn, len(c) AS n_candidate,
       least(cap, coalesce(nullif(list_position(list_transform(range(1, greatest(len(c), len(truth)) + 1),
             lambda i: coalesce(c[i] = truth[i], false)), false), 0) - 1, least(len(c), len(truth)))) AS accepted
FROM (SELECT conv_id, turn, truth, cap, {continuation_sql('context')} AS c FROM {HALF_SQL})
""")
def ngr2(spark, d):
    r = NG.accepted_prefix(NG.continuation(_half(spark, d), "context"))
    return r.select(*KEY, F.size("candidate").cast("bigint").alias("n_candidate"),
                    F.col("accepted").cast("bigint"))


@query("ngr3_run_summary", """
SELECT turn, count(*) AS n_runs, CAST(sum(len(output_ids) - len(prompt_ids)) AS BIGINT) AS generated
FROM v_runs GROUP BY turn
""")
def ngr3(spark, d):
    """Token counts by turn; the tables hold no measured durations."""
    return NG.run_summary(runs(spark, d), by="turn")


def _gram_sql(n: int) -> str:
    return f"array_to_string(ids[len(ids) - {n - 1}:], ',')"


@query("ngr1_corpus_continuation", f"""
WITH seqs AS (SELECT conv_id, turn, output_ids AS ids FROM v_runs),
grams AS (
  SELECT array_to_string(ids[p + 1:p + n], ',') AS gram,
         min({{'conv_id': conv_id, 'turn': turn, 'p': p, 'f': ids[p + n + 1:p + n + 10]}}) AS hit
  FROM (SELECT *, unnest(range(1, 4)) AS n
        FROM (SELECT *, unnest(range(0, len(ids))) AS p FROM seqs))
  WHERE p + n + 10 <= len(ids) GROUP BY 1)
SELECT conv_id, turn, coalesce({s('hit.f')}, '') AS candidate, hit.conv_id AS from_conv,
       hit.turn AS from_turn, hit.p AS from_at
FROM (SELECT q.conv_id, q.turn, coalesce(c3.hit, c2.hit, c1.hit) AS hit
      FROM seqs q
      LEFT JOIN grams c3 ON len(ids) >= 3 AND c3.gram = {_gram_sql(3)}
      LEFT JOIN grams c2 ON len(ids) >= 2 AND c2.gram = {_gram_sql(2)}
      LEFT JOIN grams c1 ON len(ids) >= 1 AND c1.gram = {_gram_sql(1)})
""")
def ngr1_corpus(spark, d):
    """Every run's suffix probed in an index over all runs."""
    r = runs(spark, d).select(*KEY, "output_ids")
    index = NG.NgramIndex.build(r, KEY, "output_ids")
    out = index.probe(r, "output_ids", place="place")
    return out.select(*KEY, A.ids_text("candidate").alias("candidate"),
                      F.col("place.conv_id").alias("from_conv"), F.col("place.turn").alias("from_turn"),
                      F.col("place.at").cast("bigint").alias("from_at"))
