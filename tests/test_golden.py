"""Hand-computed and brute-force cases for the array operators and metrics."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunesmith.config import TokenSpec
from tunesmith.functions import arrays as A
from tunesmith.operators import evaluate as EV
from tunesmith.operators import layout as LA
from tunesmith.operators import ngram as NG


# -- plain Python definitions used as the expected values -------------------

def candidate_of(ids, max_n=3, k=10):
    """The longest suffix that has an admissible place wins, then the first place.
    Place p is admissible for n if ids[p:p+n] is the suffix, k ids follow the
    copy, and the copy ends before the suffix begins."""
    size = len(ids)
    places = {(-n, p) for n in range(1, max_n + 1) for p in range(size)
              if p + n + k <= size and p + n < size - n
              and all(ids[p + j] == ids[size - n + j] for j in range(n))}
    if not places:
        return []
    n, p = min(places)
    return ids[p - n:p - n + k]


def py_lcs(a, b):
    dp = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            dp[i][j] = dp[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(dp[i - 1][j], dp[i][j - 1])
    return dp[-1][-1]


def py_bleu(hyp, ref):
    hyp, ref = list(hyp), list(ref)
    nums, dens = [], []
    for n in range(1, 5):
        h = Counter(tuple(hyp[i:i + n]) for i in range(len(hyp) - n + 1))
        r = Counter(tuple(ref[i:i + n]) for i in range(len(ref) - n + 1))
        nums.append(sum(min(c, r[g]) for g, c in h.items()))
        dens.append(max(1, sum(h.values())))
    if nums[0] == 0:
        return 0.0
    k, logs = 0, []
    for m, d in zip(nums, dens):
        if m == 0:
            k += 1
            logs.append(math.log(1 / (2 ** k * d)))
        else:
            logs.append(math.log(m / d))
    c, r = len(hyp), len(ref)
    bp = 1.0 if c > r else math.exp(1 - r / c)
    return round(bp * math.exp(sum(logs) / 4) * 100, 4)


# hidden cells, written by hand: (seq_len, row by row)
MASKS = [
    (1, ["..xx", "..xx", "...x", "...."]),
    (2, ["...x", "...x", "...x", "...."]),
    (3, [".xxx", "..xx", "...x", "...."]),
    (1, [".xx", "..x", "..."]),
    (5, ["..xxx", "..xxx", "...xx", "....x", "....."]),
    (6, ["...xx", "...xx", "...xx", "....x", "....."]),
]


def hidden(seq_len, length):
    """Cell (i, j) is hidden if j > i and j >= bound."""
    bound = seq_len - 3 if seq_len >= 3 else length + seq_len - 3
    return [[j > i and j >= bound for j in range(length)] for i in range(length)]


# -- tests -------------------------------------------------------------------

def test_continuation_matches_definition(spark):
    import random
    rnd = random.Random(7)
    seqs = [[rnd.randint(0, 4) for _ in range(rnd.randint(1, 40))] for _ in range(300)]
    seqs += [[1], [1, 2], [1, 2, 3], list(range(30)), [5] * 25]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "k int, ids array<int>")
    got = {r.k: r.candidate for r in NG.continuation(df, "ids").collect()}
    for i, s in enumerate(seqs):
        assert got[i] == candidate_of(s), (i, s)


def test_accepted_prefix(spark):
    rows = [(0, [1, 2, 3], [1, 2, 4], 10, 2), (1, [1, 2, 3], [1, 2, 3, 4], 10, 3),
            (2, [1, 2, 3], [1, 2, 3], 1, 1), (3, [], [1], 5, 0), (4, [7], [8], 5, 0)]
    df = spark.createDataFrame([r[:4] for r in rows], "k int, candidate array<int>, truth array<int>, cap int")
    got = {r.k: r.accepted for r in NG.accepted_prefix(df).collect()}
    assert got == {r[0]: r[4] for r in rows}


def test_lcs_and_rouge_l(spark):
    pairs = [("a b c d", "a c d e"), ("", "x"), ("same text here", "same text here"),
             ("x y z", "p q"), ("a a a b", "a b a b a")]
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(pairs)],
                               "k int, predict string, labels string")
    got = {r.k: r.rouge_l for r in EV.rouge_l(df).collect()}
    for i, (p, r) in enumerate(pairs):
        a, b = p.split(), r.split()
        lcs = py_lcs(a, b)
        want = 0.0 if lcs == 0 else round(2 * (lcs / len(a)) * (lcs / len(b)) / ((lcs / len(a)) + (lcs / len(b))) * 100, 4)
        assert got[i] == pytest.approx(want), (p, r)


def test_bleu_matches_definition(spark):
    pairs = [("the cat sat", "the cat sat on the mat"), ("abc", "xyz"), ("", "abc"),
             ("identical", "identical"), ("ab", "abab"), ("hello world", "hallo welt"),
             ("ééèè", "éèéè")]
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(pairs)],
                               "k int, predict string, labels string")
    for method in ("arrow", "aggregate"):
        got = {r.k: r.bleu_4 for r in EV.bleu4(df, "k", method=method).collect()}
        for i, (p, r) in enumerate(pairs):
            assert got[i] == pytest.approx(py_bleu(p, r)), (method, p, r)


@pytest.mark.parametrize("seq_len,rows", MASKS)
def test_prefix_mask_by_hand(spark, seq_len, rows):
    got = spark.range(1).select(A.prefix_mask(F.lit(seq_len), F.lit(len(rows))).alias("m")).first().m
    assert got == [[c == "x" for c in row] for row in rows]


def test_prefix_mask_rule(spark):
    cases = [(s, n) for s in (1, 2, 3, 4, 6) for n in range(3, 9)]
    df = spark.createDataFrame(cases, "s int, n int").select(
        "s", "n", A.prefix_mask("s", "n").alias("m"), A.hidden_cells("s", "n").alias("cells"))
    for r in df.collect():
        want = hidden(r.s, r.n)
        assert r.m == want and r.cells == sum(map(sum, want)), (r.s, r.n)


def test_position_ids(spark):
    df = spark.range(1).select(A.position_ids(F.lit(4), F.lit(7)).alias("p2"),
                               A.position_ids(F.lit(4), F.lit(7), gmask=True).alias("g2"),
                               A.position_ids(F.lit(4), F.lit(7), two_d=False).alias("p1"))
    r = df.first()
    assert r.p2 == [[0, 1, 2, 2, 2, 2, 2], [0, 0, 0, 1, 2, 3, 4]]
    assert r.g2 == [[0, 1, 2, 3, 4, 5, 6], [0, 0, 0, 1, 2, 3, 4]]
    assert r.p1 == [0, 1, 2, 3, 4, 5, 2]


def test_collate_labels(spark):
    rows = [(0, 0, [10, 11, 12, 13], 2), (1, 0, [20, 21], 1), (2, 0, [30, 31, 32, 33, 34, 35], 3)]
    df = spark.createDataFrame(rows, "pos int, batch_id int, input_ids array<int>, seq_len int")
    out = {r.pos: r for r in LA.collate(df).collect()}
    # 1 is the end id; the batch is one wider than its longest row
    assert {p: r.labels for p, r in out.items()} == {
        0: [-100, 11, 12, 13, 1, -100, -100],
        1: [20, 21, 1, -100, -100, -100, -100],
        2: [-100, -100, 32, 33, 34, 35, 1]}
    assert {p: r.input_ids for p, r in out.items()} == {
        0: [10, 11, 12, 13, 1, 1, 1],
        1: [20, 21, 1, 1, 1, 1, 1],
        2: [30, 31, 32, 33, 34, 35, 1]}
    assert [out[p].row_in_batch for p in (2, 0, 1)] == [1, 2, 3]


def test_completion_only(spark):
    rows = [(0, [5, 1, 2, 9, 1, 2, 7, 8]), (1, [5, 6, 7]), (2, [1, 2]), (3, [1])]
    df = spark.createDataFrame(rows, "k int, input_ids array<int>")
    got = {r.k: r.labels for r in LA.completion_only(df, "input_ids", [1, 2]).collect()}
    assert got[0] == [-100] * 6 + [7, 8]
    assert got[1] == [-100] * 3
    assert got[2] == [-100, -100]
    assert got[3] == [-100]


def test_mask_round_trip_with_pad_as_eos(spark):
    spec = TokenSpec().with_pad_as_eos()
    df = spark.createDataFrame([([4, 5, spec.eos, spec.pad],)], "labels array<int>")
    r = df.select(A.mask_pad("labels", spec.pad).alias("m")).first()
    # pad == eos: the real eos label is masked too (documented behaviour)
    assert r.m == [4, 5, -100, -100]


def test_limit_pair(spark):
    df = spark.createDataFrame([(list(range(10)), list(range(8)), list(range(3)))],
                               "prompt_ids array<int>, chosen_ids array<int>, rejected_ids array<int>")
    r = LA.limit_pair(df, max_length=12, max_prompt_length=4).first()
    assert r.prompt_ids == [6, 7, 8, 9]
    assert r.chosen_ids == list(range(8))
    assert r.truncated
    r = LA.limit_pair(df, max_length=10, max_prompt_length=4).first()
    assert r.chosen_ids == list(range(6)) and r.rejected_ids == [0, 1, 2]


def test_collate_with_mask(spark):
    rows = [(0, 0, [10, 11, 12, 13], 2), (1, 0, [20, 21], 1)]
    df = spark.createDataFrame(rows, "pos int, batch_id int, input_ids array<int>, seq_len int")
    out = {r.pos: r for r in LA.collate(df, with_mask=True).collect()}
    for pos, _b, _ids, s in rows:
        assert out[pos].attention_mask == hidden(s, out[pos].longest)
