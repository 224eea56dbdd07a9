"""Exact top-k inner products by the threshold algorithm.

Components become ``floor(scale * x)``.  Every row whose id is divisible by
``every`` is a query against all other rows.  Candidates are dealt to tiles of
about ``tile`` rows.  A tile keeps one sorted list for each dimension.  A query
reads all lists from their good end, the same depth in each, and scores each row
that it meets in full.  No unread row scores more than the threshold, the sum
of the products at the current depth; when the k-th result is above it, reading stops.
Depths double, and the thresholds of a tile of queries come from one product.

Queries travel in tiles of ``query_tile`` rows, so a task holds one tile of
candidates and one of queries.  About a root of all tiles is searched first: the
k-th score found there is a lower bound for the others, which stop (often before
the first read) once their threshold is below it and return only rows that reach
it.  A query therefore gets some ``2 * k * sqrt(tiles)`` rows to rank instead of
``k * tiles``.

Defined results: vectors that are null, empty or hold null or non-finite
components take no part; a null id is never a query, and as a candidate comes
last among equal scores; repeated rows are candidates and queries of their own;
vectors of different lengths do not meet; a query with fewer than k other rows
gets them all; scores beyond 64 bits count as the nearest
long; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import prepare, stored

TILE = 2048
QUERY_TILE = 512
#: whole numbers that doubles hold without a gap
EXACT = 2.0 ** 53


def quantized(values, rows: int, dim: int, scale: int):
    """(rows, dim) whole numbers: doubles, or Python's where doubles overflow."""
    import numpy as np
    x = values.reshape(rows, dim)
    if np.abs(x).max(initial=0) < np.finfo(float).max / scale:
        return np.floor(x * float(scale))
    whole = [[math.floor(Fraction(v) * scale) for v in row] for row in x.tolist()]
    return np.array(whole, dtype=object)


def _longs(scores):
    """Python's whole numbers held to 64 bits; doubles here are far smaller."""
    import numpy as np
    return np.clip(scores, -2 ** 63, 2 ** 63 - 1) if scores.dtype == object else scores


class SortedLists:
    """A tile of candidates with one sorted list for each dimension."""

    def __init__(self, uids, ids, x):
        import numpy as np
        self.ids, self.x = ids, x
        self.at = {u: k for k, u in enumerate(uids)}
        self.order = np.argsort(x, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(x, self.order, axis=0)
        self.most = np.abs(x).max(initial=0)
        self.depths = [0]
        while self.depths[-1] < len(ids) - 1:
            self.depths.append(min(2 * self.depths[-1] + 1, len(ids) - 1))

    def search(self, uids, queries, floors, k: int) -> Iterator[tuple[int, int, int]]:
        """(query's place, candidate's place, score) of each query's k best rows
        that reach its floor."""
        import numpy as np
        x, values, steps = self.x, self.values, np.array(self.depths)
        if x.dtype == object or queries.dtype == object or \
                self.most * np.abs(queries).max(initial=0) * x.shape[1] >= EXACT:
            whole = np.vectorize(int, otypes=[object])
            x, values, queries = whole(x), whole(values), whole(queries)
        up, down = values[steps], values[len(values) - 1 - steps]
        limits = _longs(np.maximum(queries, 0) @ down.T + np.minimum(queries, 0) @ up.T)
        for j, q in enumerate(queries):
            floor = floors[j]
            if floor is None or limits[j, 0] >= floor:
                found = self._read(x, q, limits[j], floor, k, self.at.get(uids[j]))
                for at, score in found:
                    yield j, at, score

    def _read(self, x, q, limits, floor, k, own):
        import numpy as np
        seen = np.zeros(len(x), dtype=bool)
        if own is not None:
            seen[own] = True
        high, low = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        rows, scores, last = [], [], -1
        kth, size = None, 0
        for depth, limit in zip(self.depths, limits):
            new = np.zeros(len(x), dtype=bool)
            new[self.order[len(x) - 1 - depth:len(x) - 1 - last, high]] = True
            new[self.order[last + 1:depth + 1, low]] = True
            if depth == len(x) - 1:
                new[:] = True                       # also rows that all lists leave out
            last = depth
            new &= ~seen
            seen |= new
            fresh = np.flatnonzero(new)
            got = _longs(x[fresh] @ q)
            if kth is not None:
                fresh, got = fresh[got >= kth], got[got >= kth]
            rows.append(fresh)
            scores.append(got)
            size += len(fresh)
            if size >= k:
                together = np.concatenate(scores)
                kth = np.sort(together)[-k] if together.dtype == object else \
                    np.partition(together, len(together) - k)[-k]
            if (kth is not None and kth > limit) or (floor is not None and floor > limit):
                break
        rows, scores = np.concatenate(rows), np.concatenate(scores)
        need = max((v for v in (kth, floor) if v is not None), default=None)
        best = [(-int(s), self.ids[r] is None, self.ids[r] or 0, int(r)) for r, s in zip(rows, scores)
                if need is None or s >= need]
        return [(r, -s) for s, _, _, r in sorted(best)[:k]]


def _searched(rows: DataFrame, queries: DataFrame, lo: int, hi: int, k: int, scale: int) -> DataFrame:
    """(uid, query_id, vec_id, score): what the tiles from ``lo`` to ``hi`` give."""
    nothing = {"uid": "bigint", "vec_id": "bigint", "vec": "array<double>"}
    cands = rows.filter((F.col("tile") >= lo) & (F.col("tile") < hi)).select(
        "dim", "tile", F.lit(0).alias("kind"), *nothing,
        F.lit(None).cast("array<struct<uid:bigint,vec_id:bigint,floor:bigint,vec:array<double>>>").alias("members"))
    asked = queries.select("dim", F.explode(F.sequence(F.lit(lo).cast("bigint"), F.lit(hi - 1).cast("bigint"))).alias("tile"),
                           F.lit(1).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()],
                           "members")
    dealt = (cands.unionByName(asked).repartition("dim", "tile")
             .sortWithinPartitions("dim", "tile", "kind"))

    def answers(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        key, lists, held = None, None, []
        for batch in batches:
            keys = list(zip(batch.column("dim").to_pylist(), batch.column("tile").to_pylist()))
            kinds = batch.column("kind").to_pylist()
            start = 0
            while start < len(kinds):
                stop = start + 1
                while stop < len(kinds) and keys[stop] == keys[start] and kinds[stop] == kinds[start]:
                    stop += 1
                part = batch.slice(start, stop - start)
                if keys[start] != key:
                    key, lists, held = keys[start], None, []
                if kinds[start] == 0:
                    held.append((part.column("uid").to_pylist(), part.column("vec_id").to_pylist(),
                                 part.column("vec").flatten().to_numpy(zero_copy_only=False).copy()))
                elif held or lists:
                    if lists is None:
                        uids = [u for h in held for u in h[0]]
                        lists = SortedLists(uids, [i for h in held for i in h[1]], quantized(
                            np.concatenate([h[2] for h in held]), len(uids), key[0], scale))
                        held = []
                    for k_row in range(len(part)):
                        members = part.column("members").slice(k_row, 1).flatten()
                        uids, names = members.field("uid").to_pylist(), members.field("vec_id").to_pylist()
                        x = quantized(members.field("vec").flatten().to_numpy(zero_copy_only=False),
                                      len(uids), key[0], scale)
                        found = list(lists.search(uids, x, members.field("floor").to_pylist(), k))
                        yield pa.RecordBatch.from_arrays([
                            pa.array([uids[j] for j, _, _ in found], pa.int64()),
                            pa.array([names[j] for j, _, _ in found], pa.int64()),
                            pa.array([lists.ids[r] for _, r, _ in found], pa.int64()),
                            pa.array([s for _, _, s in found], pa.int64())],
                            names=["uid", "query_id", "vec_id", "score"])
                start = stop

    return dealt.mapInArrow(answers, "uid bigint, query_id bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_products(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
                 every: int = 50, scale: int = 256, tile: int = TILE,
                 query_tile: int = QUERY_TILE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's ``k`` best rows."""
    spark = vectors.sparkSession
    prepare(spark)
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    rows = stored(rows.filter((F.size("vec") > 0) & finite).select(
        "vec_id", "vec", F.size("vec").alias("dim"), F.monotonically_increasing_id().alias("uid")), "vectors")
    asked = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    n, n_asked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(asked.cast("bigint")), F.lit(0))).first()
    tiles, query_tiles = max(1, math.ceil(n / tile)), max(1, math.ceil(n_asked / query_tile))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("uid"), F.lit(tiles)))
    queries = rows.filter(asked)

    def packed(floors: DataFrame | None) -> DataFrame:
        known = queries.withColumn("floor", F.lit(None).cast("bigint")) if floors is None else \
            queries.join(floors, "uid", "left")
        deal = F.pmod(F.xxhash64("uid", F.lit("query")), F.lit(query_tiles))
        return known.groupBy("dim", deal.alias("deal")).agg(
            F.collect_list(F.struct("uid", "vec_id", "floor", "vec")).alias("members"))

    first = min(tiles, math.ceil(math.sqrt(tiles)))
    found = stored(_best(_searched(rows, packed(None), 0, first, k, scale), k), "top-first")
    if first < tiles:
        # the k-th score of the first tiles, for queries that have k
        floors = found.filter(F.col("rank") == k).select("uid", F.col("score").alias("floor"))
        more = _searched(rows, packed(floors), first, tiles, k, scale)
        found = _best(found.drop("rank").unionByName(more), k)
    return found.select("query_id", "rank", "vec_id", "score")
