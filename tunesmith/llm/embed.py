"""Embedding near-dedup over a robust-pruned flat graph.

Links join vectors of one label with cosine of at least ``threshold`` (in
double precision); components follow links.

1. Equal vectors of a label are one class; its first id stands for it.
2. Spherical k-means centroids are fitted on a bounded sample
   (``fit_sample`` classes, the smallest by hash).  Every class joins each
   cluster whose centroid is within ``margin`` of its best cosine, so
   clusters overlap and close vectors share one.  A cluster of a label with
   more than ``tile`` members is dealt into tiles by hash, and every pair of
   tiles is a shard: memory is bounded and no pair of members is lost.
3. In each shard every vector gets its nearest and some seeded far candidates
   and keeps those that robust pruning leaves (a candidate goes when a kept
   one is ``alpha`` times closer to it than the vector is).
4. The adjacency lists of all shards are united.
5. In each shard the united graph is searched from the shard's medoid for
   every member: greedy beam search, then expansion through neighbours within
   ``threshold - slack`` until the range is exhausted.  Links are verified.
   Members whose id is divisible by 100 are audited against brute force
   inside the shard; below ``target`` recall the beam is doubled and the
   search repeated, up to the shard's size.

A pair in several shards counts in one of them, the first cluster the two
share; counts per vector and a star per component leave a shard, never the
pairs.

Defined results: a null label, or a vector that is null, empty, zero or has
null or non-finite components, links with nothing; vectors of other length
are other groups; null ids link with nothing and are not kept; rows that
repeat an id and vector count as vectors of their own; an empty table gives
an empty result; clashing input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import prepare, stored
from tunesmith.llm.components import connected_components

THRESHOLD = 0.98
TILE = 1024
_NEAR, _FAR, _DEGREE = 40, 12, 16


def unit_rows(vectors) -> np.ndarray:
    """Rows of length one in double precision."""
    x = np.array(list(vectors), np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spread rows; empty clusters keep theirs."""
    k = min(k, len(x))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        for i in range(k):
            mean = x[own == i].sum(axis=0)
            if (norm := np.sqrt(mean @ mean)) > 0:
                c[i] = mean / norm
    return c


def robust_prune(x: np.ndarray, alpha: float = 1.2) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of the pruned graph over the rows of ``x``."""
    n = len(x)
    near, far = min(_NEAR, n - 1), min(_FAR, n - 1)
    rng = np.random.default_rng(n)
    extra = rng.integers(0, n, (n, far))
    left, right = [], []
    for low in range(0, n, 256):
        rows = np.arange(low, min(low + 256, n))
        cos = x[rows] @ x.T
        cos[np.arange(len(rows)), rows] = -2
        cand = np.concatenate([np.argpartition(-cos, near - 1, axis=1)[:, :near], extra[rows]],
                              axis=1)
        sim = np.take_along_axis(cos, cand, axis=1)
        order = np.argsort(-sim, axis=1, kind="stable")
        cand, sim = np.take_along_axis(cand, order, axis=1), np.take_along_axis(sim, order, axis=1)
        dist = np.sqrt(np.maximum(2 - 2 * sim, 0))
        alive = sim > -2
        each = np.arange(len(rows))
        for _ in range(_DEGREE):
            first = alive.argmax(axis=1)
            has = alive[each, first]
            if not has.any():
                break
            picked = cand[each, first]
            left.append(rows[has])
            right.append(picked[has])
            between = np.sqrt(np.maximum(2 - 2 * np.einsum("rcd,rd->rc", x[cand], x[picked]), 0))
            alive &= ~((alpha * between <= dist) & has[:, None])
            alive[each, first] = False
    return np.concatenate(left), np.concatenate(right)


def _csr(n: int, left: np.ndarray, right: np.ndarray):
    code = np.unique(np.concatenate([left * n + right, right * n + left]))
    left, right = code // n, code % n
    return np.searchsorted(left, np.arange(n + 1)), right


def _beam_search(x: np.ndarray, start: np.ndarray, to: np.ndarray, medoid: int,
                 beam: int) -> np.ndarray:
    """For every row the ``beam`` best nodes met on a greedy walk from the medoid."""
    n = len(x)
    width = min(int(np.diff(start).max(initial=1)), 48)
    table = np.full((n, max(width, 1)), medoid)
    for i in range(n):
        part = to[start[i]:start[i + 1]][:width]
        table[i, :len(part)] = part
    nodes = np.full((n, beam), -1)
    score = np.full((n, beam), -3.0)
    done = np.ones((n, beam), bool)
    nodes[:, 0], score[:, 0], done[:, 0] = medoid, x @ x[medoid], False
    while True:
        best = np.where(done, -4.0, score).argmax(axis=1)
        active = np.flatnonzero(~done[np.arange(n), best])
        if not len(active):
            return nodes
        at = nodes[active, best[active]]
        done[active, best[active]] = True
        new = table[at]
        sims = np.einsum("rwd,rd->rw", x[new], x[active])
        known = (new[:, :, None] == nodes[active][:, None, :]).any(axis=2)
        repeat = np.zeros_like(known)
        order = np.argsort(new, axis=1, kind="stable")
        ranked = np.take_along_axis(new, order, axis=1)
        np.put_along_axis(repeat, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], axis=1)
        sims[known | repeat] = -3.0
        both = np.concatenate([score[active], sims], axis=1)
        keep = np.argsort(-both, axis=1, kind="stable")[:, :beam]
        score[active] = np.take_along_axis(both, keep, axis=1)
        nodes[active] = np.take_along_axis(np.concatenate([nodes[active], new], axis=1), keep, axis=1)
        done[active] = np.take_along_axis(np.concatenate(
            [done[active], sims <= -3.0], axis=1), keep, axis=1)


def range_search(x: np.ndarray, start: np.ndarray, to: np.ndarray, threshold: float,
                 beam: int, slack: float) -> np.ndarray:
    """Boolean matrix of verified links found from the medoid."""
    n = len(x)
    medoid = int((x @ x.sum(axis=0)).argmax())
    seen = np.eye(n, dtype=bool)
    found = np.zeros((n, n), bool)
    nodes = _beam_search(x, start, to, medoid, min(beam, n))
    rows = np.repeat(np.arange(n), nodes.shape[1])
    cols = nodes.ravel()
    rows, cols = np.r_[np.arange(n), rows[cols >= 0]], np.r_[np.arange(n), cols[cols >= 0]]
    seen[rows, cols] = True
    while len(rows):
        sims = np.concatenate([np.einsum("rd,rd->r", x[rows[i:i + 65536]], x[cols[i:i + 65536]])
                               for i in range(0, len(rows), 65536)])
        found[rows, cols] |= sims >= threshold
        go = sims >= threshold - slack
        rows, cols = rows[go], cols[go]
        new_r, new_c = [], []
        for i in range(0, len(rows), 65536):
            r, c = rows[i:i + 65536], cols[i:i + 65536]
            deg = start[c + 1] - start[c]
            rr = np.repeat(r, deg)
            cc = to[np.repeat(start[c] - np.cumsum(deg) + deg, deg) + np.arange(deg.sum())]
            fresh = ~seen[rr, cc]
            code = np.unique(rr[fresh] * n + cc[fresh])
            seen[code // n, code % n] = True
            new_r.append(code // n)
            new_c.append(code % n)
        rows = np.concatenate(new_r) if new_r else rows[:0]
        cols = np.concatenate(new_c) if new_c else cols[:0]
    found |= found.T
    np.fill_diagonal(found, False)
    return found


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    if len(pdf) < 2:
        return pd.DataFrame({"u": [], "v": []}).astype("int64")
    pdf = pdf.sort_values("node")
    ids = pdf["node"].to_numpy()
    left, right = robust_prune(unit_rows(pdf["vec"]))
    return pd.DataFrame({"u": ids[left], "v": ids[right]})


def _search(threshold: float, slack: float, target: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        ids, n = pdf["node"].to_numpy(), len(pdf)
        x = unit_rows(pdf["vec"])
        lists = [np.asarray(a, np.int64) if a is not None else np.zeros(0, np.int64)
                 for a in pdf["near"]]
        left = np.repeat(np.arange(n), [len(a) for a in lists])
        right = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(ids, right), n - 1)
        here = ids[at] == right
        start, to = _csr(n, left[here], at[here])
        audit = np.flatnonzero(ids % 100 == 0)
        true = x[audit] @ x.T >= threshold
        true[np.arange(len(audit)), audit] = False
        beam = 12
        while True:
            found = range_search(x, start, to, threshold, beam, slack)
            hit = int((found[audit] & true).sum())
            if hit >= target * true.sum() or beam >= n:
                break
            beam *= 4
        # the pair's own place: first shared cluster, and the tile pair
        left, right = np.nonzero(found)
        cells = [np.asarray(c) for c in pdf["cells"]]
        width = max(len(c) for c in cells)
        table = np.full((n, width), -1)
        for i, c in enumerate(cells):
            table[i, :len(c)] = c
        cell, own = int(pdf["cell"].iloc[0]), pdf["own"].to_numpy()
        ti, tj = int(pdf["ti"].iloc[0]), int(pdf["tj"].iloc[0])
        earlier = np.where((table >= 0) & (table < cell), table, -1)
        add = np.zeros(n, np.int64)
        size = pdf["size"].to_numpy()
        for i in range(0, len(left), 65536):
            a, b = left[i:i + 65536], right[i:i + 65536]
            shared = ((earlier[a][:, :, None] == earlier[b][:, None, :])
                      & (earlier[a] >= 0)[:, :, None]).any(axis=(1, 2))
            mine = ~shared & (((own[a] != own[b]) | (ti == tj)))
            np.add.at(add, a[mine], size[b[mine]])
        label = np.arange(n)
        while True:
            new = label.copy()
            np.minimum.at(new, left, label[right])
            new = new[new]
            if (new == label).all():
                break
            label = new
        audit_true, audit_found = np.zeros(n, np.int64), np.zeros(n, np.int64)
        audit_true[audit], audit_found[audit] = true.sum(axis=1), (found[audit] & true).sum(axis=1)
        return pd.DataFrame({"node": ids, "links": add, "low": ids[label],
                             "audit_true": audit_true, "audit_found": audit_found})
    return run


def _assigner(centroids: np.ndarray, margin: float):
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            cells = []
            for _, part in pdf.groupby("dim", sort=False):
                x = unit_rows(part["vec"])
                if centroids.size and centroids.shape[1] == x.shape[1]:
                    cos = x @ centroids.T
                    pick = cos >= cos.max(axis=1, keepdims=True) - margin
                    cells += [(i, np.flatnonzero(p).tolist()) for i, p in zip(part.index, pick)]
                else:
                    cells += [(i, [0]) for i in part.index]
            yield pdf.assign(cells=pd.Series(dict(cells)))
    return run


def shards(classes: DataFrame, tile: int, fit_sample: int, max_centroids: int,
           margin: float) -> DataFrame:
    """Members of overlapping cluster shards (see the module's step 2)."""
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    sample = [r["vec"] for r in classes.orderBy(F.xxhash64("node"), "node").limit(fit_sample)
              .select("vec").collect()]
    width = {len(v) for v in sample}
    k = int(min(max_centroids, -(-largest * 2 // tile)))
    centroids = fit_centroids(unit_rows(sample), k) if len(width) == 1 and k > 1 \
        else np.zeros((0, 0))
    kinds = dict(classes.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in classes.columns) + ", cells array<int>"
    placed = classes.mapInPandas(_assigner(centroids, margin), schema)
    members = placed.withColumn("cell", F.explode("cells"))
    sizes = members.groupBy("label", "dim", "cell").agg(F.count(F.lit(1)).alias("n"))
    members = members.join(sizes, ["label", "dim", "cell"]).withColumn(
        "tiles", F.ceil(F.col("n") / tile).cast("int"))
    members = members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return members.withColumns({"ti": F.least("own", "other"), "tj": F.greatest("own", "other")}
                               ).drop("n", "tiles", "other")


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD, tile: int = TILE,
                    fit_sample: int = 4096, max_centroids: int = 256, margin: float = 0.08,
                    slack: float = 0.04, target: float = 0.99) -> DataFrame:
    """id, n_links, component_id, kept, and the audit of the row's searches."""
    prepare(table.sparkSession)
    vec = F.col("vec")
    usable = (F.col("id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull()
              & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v)
                         & (F.abs(v) < F.lit(float("inf"))))
              & F.exists(vec, lambda v: v != 0))
    rows = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                        F.col(vec_col).alias("vec"))
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumns({"h1": F.xxhash64("label", "vec"), "h2": F.hash("vec", "label")})
    good = rows.filter("ok")
    classes = stored(good.groupBy("label", "h1", "h2").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("size"),
        F.first("vec").alias("vec")).withColumn("dim", F.size("vec")), "classes")
    members = stored(shards(classes.select("node", "label", "dim", "size", "vec"), tile,
                            fit_sample, max_centroids, margin), "shards")
    key = ["label", "dim", "cell", "ti", "tj"]
    edges = members.groupBy(*key).applyInPandas(_build, "u bigint, v bigint")
    united = edges.union(edges.select("v", "u")).distinct().groupBy(
        F.col("u").alias("node")).agg(F.collect_list("v").alias("near"))
    found = stored(members.join(united, "node", "left").groupBy(*key).applyInPandas(
        _search(threshold, slack, target),
        "node bigint, links bigint, low bigint, audit_true bigint, audit_found bigint"), "found")
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("low").alias("b")))
    counts = found.groupBy("node").agg(*[F.sum(c).cast("bigint").alias(c)
                                         for c in ("links", "audit_true", "audit_found")])
    result = (classes.select("label", "h1", "h2", "node", "size").join(counts, "node", "left")
              .join(roots.select(F.col("node"), "root"), "node", "left"))
    named = rows.select("id", "ok", *[F.when(F.col("ok"), F.col(c)).alias(f"_{c}")
                                      for c in ("label", "h1", "h2")])
    out = named.join(result, (F.col("_label") == F.col("label")) & (F.col("_h1") == F.col("h1"))
                     & (F.col("_h2") == F.col("h2")), "left")
    component = F.when(F.col("ok"), F.coalesce("root", "node")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("ok"), F.coalesce("links", F.lit(0)) + F.col("size") - 1)
        .otherwise(0).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
        F.coalesce("audit_true", F.lit(0)).cast("bigint").alias("audit_true"),
        F.coalesce("audit_found", F.lit(0)).cast("bigint").alias("audit_found"))
