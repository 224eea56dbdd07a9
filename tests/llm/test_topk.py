"""Threshold algorithm against all scores."""
import math
from fractions import Fraction

import numpy as np
import pytest

SCHEMA = "vec_id bigint, embedding array<double>, uid string, dim string, tile string, `x.y` string"


def brute(rows, k, every, scale=256):
    good = []
    for at, (i, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v):
            good.append((at, i, [math.floor(scale * Fraction(x)) for x in v]))
    out = []
    for at, i, q in good:
        if i is None or i % every:
            continue
        found = sorted((-min(max(sum(a * b for a, b in zip(q, v)), -2 ** 63), 2 ** 63 - 1), j is None, j or 0) for other, j, v in good
                       if other != at and len(v) == len(q))[:k]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(found)]
    return sorted(out, key=str)


def run(spark, rows, **options):
    from tunesmith.llm.topk import top_products
    table = spark.createDataFrame([(i, v, *["x"] * 4) for i, v in rows], SCHEMA).repartition(3)
    out = top_products(table, **options)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("tile,query_tile", [(4096, 64), (40, 4)])
def test_against_brute_force(spark, tile, query_tile):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    rows = [(i, [float(x) for x in (centres[i % 6] + rng.normal(size=12) * 0.3)]) for i in range(500)]
    rows += [(i, list(rows[0][1])) for i in range(500, 560)]              # many ties
    rows += [(600, [0.0] * 12), (601, [-1.0] * 12), (602, [1.0] + [0.0] * 11), (None, rows[7][1])]
    rows += [(650, None), (651, []), (652, [float("nan")] + [1.0] * 11), (653, [None] + [1.0] * 11),
             (654, [float("-inf")] + [1.0] * 11)]
    rows += [(700 + 10 * i, [float(i), -1.0]) for i in range(3)]          # another length
    rows += [(50, list(rows[50][1])), (50, [2.0] * 12)]                   # one id, several rows
    assert run(spark, rows, every=10, tile=tile, query_tile=query_tile) == brute(rows, 5, 10)


def test_huge_components_are_exact(spark):
    rows = [(i, [2.0 ** 21 + i, -3.0 ** 14, 1e-3 * i]) for i in range(40)]
    assert run(spark, rows, every=10, k=3) == brute(rows, 3, 10)
    rows = [(0, [1e308, 1.0]), (1, [1e308, 2.0]), (2, [-1e308, 0.0]), (3, [9e307, 5.0])]
    out = run(spark, rows, every=10)
    assert out == brute(rows, 5, 10) and out[0][3] == 2 ** 63 - 1


def test_few_and_none(spark):
    assert run(spark, [(100, [1.0])]) == [] and run(spark, []) == []
    assert run(spark, [(100, [1.0]), (3, [-0.001])]) == [(100, 1, 3, -256)]


def test_reading_stops_at_the_threshold():
    from tunesmith.llm.topk import SortedLists
    n = 4000
    x = np.floor(np.random.default_rng(0).normal(size=(n, 3)) * 256)
    x[:, 0] = np.arange(n) * 50
    met = []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            met.append(len(self))
            return np.asarray(self) @ other

    lists = SortedLists(list(range(n)), list(range(n)), x)
    found = lists._read(x.view(Counting), np.array([5.0, 1.0, -1.0]), lists_limits(lists, [5.0, 1.0, -1.0]),
                        None, 5, None)
    assert [r for r, _ in found] == list(np.argsort(-(x @ [5.0, 1.0, -1.0]), kind="stable")[:5])
    assert sum(met) < n / 4
    # a bound from elsewhere stops earlier still
    met.clear()
    best = int((x @ [5.0, 1.0, -1.0]).max())
    lists._read(x.view(Counting), np.array([5.0, 1.0, -1.0]), lists_limits(lists, [5.0, 1.0, -1.0]), best, 5, None)
    assert sum(met) <= 50


def lists_limits(lists, q):
    q, steps = np.array(q), np.array(lists.depths)
    return np.maximum(q, 0) @ lists.values[len(lists.values) - 1 - steps].T + \
        np.minimum(q, 0) @ lists.values[steps].T
