"""Property tests: random batches checked against plain Python definitions.

Each hypothesis example is a whole batch of cases run as one Spark job.
"""

import hashlib
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.test_golden import py_bleu, candidate_of, py_lcs
from tunesmith.operators import evaluate as EV
from tunesmith.operators import ngram as NG
from tunesmith.operators import position as PO
from tunesmith.operators import split as SP
from tunesmith.operators import vocab as VO

SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow, HealthCheck.data_too_large])
WORD = st.sampled_from(["a", "b", "c", "dd", "é", "\U0001F600"])
TEXT = st.lists(WORD, max_size=25).map(" ".join)
CHARS = st.text(alphabet="abcé😀 ", max_size=40)


@SETTINGS
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=40))
def test_lcs_property(spark, pairs):
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(pairs)],
                               "k int, predict string, labels string")
    got = {r.k: r.lcs for r in df.select(
        "k", EV.lcs_length(EV.segment("predict"), EV.segment("labels")).alias("lcs")).collect()}
    for i, (p, r) in enumerate(pairs):
        assert got[i] == py_lcs(p.split(), r.split())


@SETTINGS
@given(st.lists(st.tuples(CHARS, CHARS), min_size=1, max_size=40))
def test_bleu_property(spark, pairs):
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(pairs)],
                               "k int, predict string, labels string")
    got = {r.k: r.bleu_4 for r in EV.bleu4(df, "k").collect()}
    for i, (p, r) in enumerate(pairs):
        assert abs(got[i] - py_bleu(p, r)) < 1e-9


@SETTINGS
@given(st.lists(st.lists(st.integers(0, 3), max_size=30), min_size=1, max_size=60))
def test_continuation_property(spark, seqs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "k int, ids array<int>")
    got = {r.k: r.candidate for r in NG.continuation(df, "ids").collect()}
    for i, s in enumerate(seqs):
        assert got[i] == candidate_of(s)


@SETTINGS
@given(st.sets(st.integers(-10**9, 10**9), min_size=1, max_size=300))
def test_positions_property(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.pos for r in PO.with_position(df, "k", num_partitions=3).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


@SETTINGS
@given(st.sets(st.integers(0, 10**12), min_size=1, max_size=300), st.integers(0, 99))
def test_hash_split_property(spark, keys, seed):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.split for r in SP.train_eval_split(df, "k", seed=seed).collect()}
    threshold = SP.hash_threshold(0.8)
    for k in keys:
        h = hashlib.md5(f"{seed}:{k}".encode()).hexdigest()
        assert got[k] == ("train" if h < threshold else "eval")


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_encode_decode_property(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    vocab = VO.build_vocab(df, "text")
    enc = VO.encode(df, "k", {"ids": ("text", None, True)}, vocab)
    dec = {r.k: r.decoded for r in VO.decode(enc, "k", "ids", vocab).collect()}
    assert dec == {i: " ".join(t.split()) for i, t in enumerate(texts)}
    counts = {r.token: r["count"] for r in vocab.table.collect()}
    want = {}
    for t in texts:
        for w in t.split():
            want[w] = want.get(w, 0) + 1
    assert counts == want
    ids = sorted((r.id, r.token) for r in vocab.table.collect())
    order = sorted(want, key=lambda w: (-want[w], w.encode()))
    assert [t for _i, t in ids] == order
    assert [i for i, _t in ids] == list(range(4, 4 + len(order)))


def test_clipped_counts_match_counters():
    """One sort over a batch against a counter for each row, also where codes
    are too many to be packed."""
    from collections import Counter

    from tunesmith.operators.evaluate import clipped_counts

    def counted(h, r):
        out = []
        for n in range(1, 5):
            ch = Counter(tuple(h[i:i + n]) for i in range(len(h) - n + 1))
            cr = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
            out.append(sum((ch & cr).values()))
        return out

    rnd = random.Random(3)
    for alphabet in ("ab", "abc déf日🙂\n", "".join(map(chr, range(0x4E00, 0x9000)))):
        pairs = [["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(50))) for _ in "hr"]
                 for _ in range(200)]
        pairs += [[None, "x"], ["x", None], ["", ""], ["a", "aaaa"], ["aaaa", "a"]]
        for split in (False, True):
            rows = [[x and x.split("b") if split else x for x in p] for p in pairs]
            got = clipped_counts([h for h, _ in rows], [r for _, r in rows]).tolist()
            assert got == [[0] * 4 if h is None or r is None else counted(h, r) for h, r in rows]
    assert clipped_counts([], []).shape == (0, 4)


def test_score_helpers_hold_a_run_of_rows_not_a_batch():
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    from tunesmith.operators.evaluate import (
        RUN_ITEMS, _runs, clipped_counts, clipped_matches, lcs_length)

    h = [("abcd efgh " * 60) + str(i) for i in range(8000)]
    h[0], h[1], h[2] = None, "", "x" * (3 * RUN_ITEMS)
    r = [("bcde fghx " * 60) + str(i % 7) for i in range(8000)]
    r[3] = None
    a, b = pa.array(h), pa.array(r)
    runs = list(_runs(a, b))
    assert [x for run in runs for x in run[0].to_pylist()] == h
    assert all(len(x) == 1 or sum(len(v or "") for side in (x, y) for v in side.to_pylist())
               <= RUN_ITEMS + 3 * RUN_ITEMS + 700 for x, y in runs)
    tracemalloc.start()
    got = clipped_matches.func(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 11 million characters: one sort of all of them would hold some 1,000 MB
    assert peak < 350e6
    some = [0, 1, 3, 4, 5, 7999]
    assert np.array_equal(np.array([got[i].as_py() for i in some]),
                          clipped_counts([h[i] for i in some], [r[i] for i in some]))
    words = [None if x is None else x.split()[:50] for x in h[3:2000]], [
        None if x is None else x.split()[:50] for x in r[3:2000]]
    got = lcs_length.func(*(pa.array(w, pa.list_(pa.string())) for w in words)).to_pylist()
    assert got[0] == 0 and got[1:5] == [py_lcs(x, y) for x, y in zip(words[0][1:5], words[1][1:5])]
    assert clipped_matches.func(a.slice(0, 0), b.slice(0, 0)).to_pylist() == []
