"""Queries: prediction pairing and corpus scores (ROUGE-1/2/L, BLEU-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunesmith.operators import evaluate as EV
from tunesmith.plans import views as V
from tunesmith.plans.oracle import chars, view, words
from tunesmith.plans.registry import query

KEY = ["conv_id", "turn"]


def pairs(spark, d):
    preds, refs = V.prediction_view(spark, d)
    return EV.pair_predictions(preds, refs, KEY)


@query("evl1_pair_predictions", """
SELECT conv_id, turn, predict, labels FROM v_predictions
""")
def evl1(spark, d):
    return pairs(spark, d).select(*KEY, "predict", "labels")


@query("evl1_orphans", """
SELECT conv_id, turn, 'prediction' AS side FROM conversations a
WHERE role = 'assistant' AND NOT EXISTS (
  SELECT 1 FROM conversations u WHERE u.conv_id = a.conv_id AND u.turn = a.turn - 1 AND u.role = 'user')
UNION ALL
SELECT conv_id, turn + 1 AS turn, 'reference' AS side FROM conversations u
WHERE role = 'user' AND NOT EXISTS (
  SELECT 1 FROM conversations a WHERE a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant')
""")
def evl1_orphans(spark, d):
    preds, refs = V.prediction_view(spark, d)
    return EV.orphans(preds, refs, KEY)


@query("evl2_segment", f"""
SELECT conv_id, turn, len({words('predict')}) AS n_words, len({chars('predict')}) AS n_chars,
       array_to_string({words('predict')}, ' ') AS words
FROM v_predictions
""")
def evl2(spark, d):
    p = pairs(spark, d)
    return p.select(*KEY, F.size(EV.segment("predict", "word")).cast("bigint").alias("n_words"),
                    F.size(EV.segment("predict", "char")).cast("bigint").alias("n_chars"),
                    F.array_join(EV.segment("predict", "word"), " ").alias("words"))


def _grams_sql(x: str, n: int) -> str:
    return (f"list_distinct(list_transform(range(1, len({x}) - {n} + 2), "
            f"lambda i: array_to_string({x}[i:i + {n} - 1], ' ')))")


def _rouge_sql(n: int) -> str:
    h, r = _grams_sql("hw", n), _grams_sql("rw", n)
    ov = f"len(list_intersect({h}, {r}))"
    return (f"round(CASE WHEN {ov} > 0 THEN 2 * ({ov} / len({h})) * ({ov} / len({r})) / "
            f"(({ov} / len({h})) + ({ov} / len({r}))) ELSE 0.0 END * 100, 4)")


# DuckDB LCS: one DP row per hypothesis word, each row built left to right.
LCS_SQL = """list_reduce(hw,
  lambda prev, t: list_reduce(range(1, len(rw) + 1),
     lambda row, j: list_append(row, greatest(row[-1], prev[j + 1],
                                               prev[j] + CASE WHEN rw[j] = t THEN 1 ELSE 0 END)),
     [0]),
  list_transform(range(len(rw) + 1), lambda x: 0))"""


def _f_sql(ov: str, nh: str, nr: str) -> str:
    return (f"round(CASE WHEN {ov} > 0 THEN 2 * ({ov} / {nh}) * ({ov} / {nr}) / "
            f"(({ov} / {nh}) + ({ov} / {nr})) ELSE 0.0 END * 100, 4)")


def score_views(source: str, words_v: str, rouge_v: str, bleu_p: str, bleu_m: str,
                bleu_v: str, scores_v: str) -> None:
    """Register the DuckDB views that score ``source`` (conv_id, turn,
    predict, labels): word lists, ROUGE-1/2/L, char BLEU-4, all scores."""
    view(words_v, f"""
SELECT conv_id, turn, {words('predict')} AS hw, {words('labels')} AS rw FROM {source}
""", (source,))
    view(rouge_v, f"""
SELECT conv_id, turn, {_rouge_sql(1)} AS rouge_1, {_rouge_sql(2)} AS rouge_2,
       {_f_sql('lcs', 'len(hw)', 'len(rw)')} AS rouge_l
FROM (SELECT *, {LCS_SQL}[-1] AS lcs FROM {words_v})
""", (words_v,))
    grams = []
    for side, col in ((0, "h"), (1, "r")):
        grams.append(f"""SELECT conv_id, turn, n, {side} AS side,
       unnest(list_transform(range(1, len({col}) - n + 2), lambda i: array_to_string({col}[i:i + n - 1], ''))) AS g
FROM {bleu_p}, (SELECT unnest([1, 2, 3, 4]) AS n)""")
    ms = ", ".join(f"sum(CASE WHEN n = {k} THEN least(ch, cr) ELSE 0 END) AS m{k}" for k in range(1, 5))
    z = [f"(CASE WHEN coalesce(m{k}, 0) = 0 THEN 1 ELSE 0 END)" for k in range(1, 5)]
    logs = []
    for k in range(1, 5):
        zk = " + ".join(z[:k])
        den = f"greatest(len(h) - {k} + 1, 1)"
        logs.append(f"ln(CASE WHEN coalesce(m{k}, 0) = 0 THEN 1.0 / (pow(2, {zk}) * {den}) "
                    f"ELSE m{k} / {den} END)")
    view(bleu_p, f"""
SELECT conv_id, turn, {chars('predict')} AS h, {chars('labels')} AS r FROM {source}
""", (source,))
    view(bleu_m, f"""
SELECT conv_id, turn, {ms} FROM (
  SELECT conv_id, turn, n, g, sum(1 - side) AS ch, sum(side) AS cr
  FROM ({grams[0]}
        UNION ALL
        {grams[1]})
  GROUP BY conv_id, turn, n, g)
GROUP BY conv_id, turn
""", (bleu_p,))
    view(bleu_v, f"""
SELECT conv_id, turn,
       round(CASE WHEN coalesce(m1, 0) = 0 THEN 0.0
             ELSE (CASE WHEN len(h) > len(r) THEN 1.0 ELSE exp(1 - len(r) / len(h)) END)
                  * exp(({' + '.join(logs)}) * 0.25) END * 100, 4) AS bleu_4
FROM {bleu_p} LEFT JOIN {bleu_m} USING (conv_id, turn)
""", (bleu_p, bleu_m))
    view(scores_v, f"""
SELECT r.conv_id, r.turn, r.rouge_1, r.rouge_2, r.rouge_l, b.bleu_4
FROM {rouge_v} r JOIN {bleu_v} b USING (conv_id, turn)
""", (rouge_v, bleu_v))


score_views("v_predictions", "v_pred_words", "v_rouge", "v_bleu_p", "v_bleu_m", "v_bleu",
            "v_scores")


@query("evl3_rouge_n", f"""
SELECT conv_id, turn, {_rouge_sql(1)} AS rouge_1, {_rouge_sql(2)} AS rouge_2 FROM v_pred_words
""")
def evl3(spark, d):
    p = EV.rouge_n(EV.rouge_n(pairs(spark, d), 1), 2)
    return p.select(*KEY, "rouge_1", "rouge_2")


@query("evl4_rouge_l", """
SELECT conv_id, turn, rouge_l FROM v_rouge
""")
def evl4(spark, d):
    return EV.rouge_l(pairs(spark, d)).select(*KEY, "rouge_l")


@query("evl5_bleu4", """
SELECT conv_id, turn, bleu_4 FROM v_bleu
""")
def evl5(spark, d):
    return EV.bleu4(pairs(spark, d), KEY).select(*KEY, "bleu_4")


def scores(spark, d):
    p = pairs(spark, d)
    p = EV.rouge_n(EV.rouge_n(p, 1), 2)
    p = EV.rouge_l(p)
    return EV.bleu4(p, KEY)


@query("evl6_score_summary", """
SELECT round(avg(rouge_1), 6) AS rouge_1, round(avg(rouge_2), 6) AS rouge_2,
       round(avg(rouge_l), 6) AS rouge_l, round(avg(bleu_4), 6) AS bleu_4, count(*) AS n_rows
FROM v_scores
""")
def evl6(spark, d):
    out = EV.score_summary(scores(spark, d))
    return out.select(*[F.round(c, 6).alias(c) for c in
                        ("rouge_1", "rouge_2", "rouge_l", "bleu_4")], "n_rows")


@query("evl6_score_by_turn_count", """
SELECT n_turns, round(avg(rouge_1), 6) AS rouge_1, round(avg(rouge_2), 6) AS rouge_2,
       round(avg(rouge_l), 6) AS rouge_l, round(avg(bleu_4), 6) AS bleu_4, count(*) AS n_rows
FROM v_scores s
JOIN (SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id) t USING (conv_id)
GROUP BY n_turns
""")
def evl6_by(spark, d):
    """Means per conversation size (number of turns), a rollup-style slice."""
    sizes = V.conversations(spark, d).groupBy("conv_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_turns"))
    s = scores(spark, d).join(sizes, "conv_id", "left")
    out = EV.score_summary(s, by="n_turns")
    return out.select("n_turns", *[F.round(c, 6).alias(c) for c in
                                   ("rouge_1", "rouge_2", "rouge_l", "bleu_4")], "n_rows")


@query("evl6_score_rollup", """
SELECT n_turns, round(avg(rouge_1), 6) AS rouge_1, round(avg(rouge_2), 6) AS rouge_2,
       round(avg(rouge_l), 6) AS rouge_l, round(avg(bleu_4), 6) AS bleu_4, count(*) AS n_rows
FROM v_scores s
JOIN (SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id) t USING (conv_id)
GROUP BY ROLLUP (n_turns)
""")
def evl6_rollup(spark, d):
    """Means per conversation size plus the corpus total (null ``n_turns``)."""
    sizes = V.conversations(spark, d).groupBy("conv_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_turns"))
    s = scores(spark, d).join(sizes, "conv_id", "left")
    out = EV.score_summary(s, by="n_turns", rollup=True)
    return out.select("n_turns", *[F.round(c, 6).alias(c) for c in
                                   ("rouge_1", "rouge_2", "rouge_l", "bleu_4")], "n_rows")
