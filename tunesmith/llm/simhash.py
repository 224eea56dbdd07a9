"""SimHash near-dedup with pivot distance tables.

A fingerprint bit is set when it is set in more than half of the shingle
hashes (XXH64).  Links join fingerprints that differ in at most ``max_bits``
bits; components follow links.

Equal fingerprints are one class.  The 64 bits are cut into ``BLOCKS``
blocks; two fingerprints within ``max_bits`` agree in at least
``BLOCKS - max_bits`` of them, so every combination of that many blocks is a
table and each link shows in the bucket of some table (exact, no link is
lost).  Hamming distances to 16 reference fingerprints are computed once per
class; by the triangle inequality a pair whose largest coordinate difference
exceeds ``max_bits`` is discarded, and survivors are verified on the bits.

Scale: rows of text give one fingerprint in Arrow batches.  Buckets of one
class are dropped before the shuffle of members.  A bucket of more than
``tile`` classes is dealt into tiles by hash and every pair of tiles is its
own group, so a group has at most about 2 * ``tile`` members; each group
gives a spanning forest instead of all its pairs.

Defined results: null, empty and blank texts have fingerprint zero and link
like any other; texts shorter than a shingle hash as a whole; null ids take
part, and a component's id is its smallest id that is not null; repeated
rows are rows of their own; an empty table gives an empty result; clashing
input columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import free_prefix, prepare, quoted, row_key, stored
from tunesmith.llm.components import connected_components

BITS = 64
#: more blocks give smaller buckets and more tables: 6 suits up to some ten
#: million classes, 7 (35 tables of 27 bits) some billion
BLOCKS = 6
TILE = 1024
_PIVOTS = 16


def _pivots() -> list[int]:
    """Reference fingerprints from a fixed seed, as signed longs."""
    rng = np.random.default_rng(64)
    return [int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, _PIVOTS, dtype=np.int64)]


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """SimHash of UTF-8 bytes; A-Z lower-cased, words by ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends[shingle - 1:] - 1).tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at:at + 8192].view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    value = sum(1 << i for i in np.flatnonzero(counts * 2 > len(hashes)).tolist())
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text_col: str, shingle: int, seed: int = 42) -> DataFrame:
    """``docs`` with its text column replaced by long ``fingerprint``."""
    others = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            values = [fingerprint(t.as_py() or b"", shingle, seed) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(values, pa.int64())], [*others, "fingerprint"])

    asked = docs.select(F.col(text_col), *[F.col(c) for c in others])
    fields = [f for f in docs.select(*others).schema.fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                       + ["fingerprint bigint"])
    return asked.mapInArrow(run, schema)


def _masks(max_bits: int, blocks: int) -> list[int]:
    """Bit masks of the block combinations one of which a link must share."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in itertools.combinations(parts, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _packed(value: Column, pivots: list[int]) -> Column:
    """Distances to eight pivots, one byte each, in a long."""
    out = F.lit(0).cast("bigint")
    for i, p in enumerate(pivots):
        dist = F.bit_count(value.bitwiseXOR(F.lit(p))).cast("bigint")
        out = out.bitwiseOR(F.shiftleft(dist, 8 * i))
    return out


def _pairs_by_lag(group: np.ndarray, fp: np.ndarray, table: np.ndarray, bits: int):
    """Verified index pairs inside runs of equal ``group`` (sorted)."""
    lag = 1
    alive = np.arange(len(fp) - 1)
    while alive.size:
        alive = alive[alive + lag < len(fp)]
        alive = alive[group[alive] == group[alive + lag]]
        if not alive.size:
            return
        gap = np.abs(table[alive] - table[alive + lag]).max(axis=1)
        near = alive[gap <= bits]
        near = near[np.bitwise_count(fp[near] ^ fp[near + lag]) <= bits]
        if near.size:
            yield near, near + lag
        lag += 1


def _forest(fp: np.ndarray, table: np.ndarray, bits: int):
    """Links of one large group, reduced to a star per component."""
    close = np.ones((len(fp), len(fp)), bool)
    for p in range(table.shape[1]):
        close &= np.abs(table[:, None, p] - table[None, :, p]) <= bits
    left, right = np.nonzero(close)
    good = np.bitwise_count(fp[left] ^ fp[right]) <= bits
    left, right = left[good], right[good]
    label = np.arange(len(fp))
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return moved, label[moved]


def _link_groups(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b"]

        def links(tab: np.ndarray, fp: np.ndarray, pivots: np.ndarray):
            starts = np.flatnonzero(np.r_[True, tab[1:] != tab[:-1]])
            sizes = np.diff(np.r_[starts, len(tab)])
            big = np.flatnonzero(sizes > 64)
            small = np.ones(len(tab), bool)
            for g in big.tolist():
                at = slice(starts[g], starts[g] + sizes[g])
                small[at] = False
                left, right = _forest(fp[at], pivots[at], bits)
                yield fp[at][left], fp[at][right]
            tab, fp, pivots = tab[small], fp[small], pivots[small]
            for left, right in _pairs_by_lag(tab, fp, pivots, bits):
                yield fp[left], fp[right]

        def flush(parts):
            tab, fp, pivots = (np.concatenate(x) for x in zip(*parts))
            for left, right in links(tab, fp, pivots):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], names)

        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            tab, fp, p0, p1 = (batch.column(i).to_numpy() for i in range(4))
            pivots = np.stack([p0, p1], axis=1).view(np.uint8).reshape(len(tab), -1).astype(np.int16)
            fp = fp.view(np.uint64)
            # the last group of a batch may go on in the next one
            cut = int(np.flatnonzero(tab == tab[-1])[0])
            if cut:
                held.append((tab[:cut], fp[:cut], pivots[:cut]))
                yield from flush(held)
                held = []
            held.append((tab[cut:], fp[cut:], pivots[cut:]))
        if held:
            yield from flush(held)
    return run


def similar_classes(classes: DataFrame, max_bits: int = 4, blocks: int = BLOCKS,
                    tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect all classes within ``max_bits``; ``classes``
    has one row per distinct long ``fingerprint``."""
    if not max_bits < blocks:
        raise ValueError("blocks must exceed max_bits")
    pivots = _pivots()
    fp = F.col("fingerprint")
    known = classes.select(fp, _packed(fp, pivots[:8]).alias("p0"),
                           _packed(fp, pivots[8:]).alias("p1"))
    masks = _masks(max_bits, blocks)
    keyed = known.select("*", F.posexplode(F.array(
        *[fp.bitwiseAND(F.lit(m)) for m in masks])).alias("tab", "key"))
    crowd = (keyed.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > 1))
    members = keyed.join(crowd, ["tab", "key"])
    tiles = F.ceil(F.col("n") / tile).cast("int")
    members = members.withColumn("tiles", tiles).withColumn(
        "own", F.pmod(F.xxhash64("fingerprint"), F.col("tiles")).cast("int"))
    members = members.withColumn("other", F.explode(
        F.sequence(F.lit(0), F.col("tiles") - 1)))
    # one group per bucket and pair of tiles
    group = F.xxhash64("tab", "key", F.least("own", "other"), F.greatest("own", "other"))
    dealt = (members.select(group.alias("grp"), "fingerprint", "p0", "p1")
             .repartition("grp").sortWithinPartitions("grp"))
    return dealt.mapInArrow(_link_groups(max_bits), "a bigint, b bigint")


def _grouped(marked: DataFrame, text_col: str, shingle: int, max_bits: int, seed: int,
             blocks: int, tile: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``marked`` with ``fingerprint`` for the text, and (fingerprint,
    group) of every class."""
    rows = stored(fingerprints(marked, text_col, shingle, seed), "fingerprints")
    classes = stored(rows.select("fingerprint").distinct(), "classes")
    links = stored(similar_classes(classes, max_bits, blocks, tile), "links")
    roots = connected_components(links)
    named = classes.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("group"))
    return rows, stored(named, "groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_bits: int = 4, seed: int = 42,
                    blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id of every row."""
    prepare(docs.sparkSession)
    rows, named = _grouped(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")),
                           "__text", shingle, max_bits, seed, blocks, tile)
    first = rows.groupBy("fingerprint").agg(F.min("__id").alias("first")).join(named, "fingerprint")
    least = first.groupBy("group").agg(F.min("first").alias("component_id"))
    label = stored(named.join(least, "group").select("fingerprint", "component_id"), "labels")
    return rows.join(label, "fingerprint").select(
        F.col("__id").alias(id_col),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 4, max_bits: int = 4, seed: int = 42,
                         blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """One row of each component: the smallest id (null last), of equal ids the
    smallest row key, of equal texts too the smallest digest of all columns.  Rows of
    one id are judged each for itself; of rows that repeat in all columns one stays."""
    prepare(docs.sparkSession)
    key = free_prefix(docs, "__keep")
    same = f"{key}_same"
    marked = docs.withColumns({key: row_key(id_col, text_col), same: F.xxhash64(F.to_json(
        F.struct(*quoted(docs))))})
    own = marked.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text"),
                        F.col(key).alias("rk"), F.col(same).alias("same"))
    rows, named = _grouped(own, "__text", shingle, max_bits, seed, blocks, tile)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "rk", "same")
    first = rows.groupBy("fingerprint").agg(F.min(place).alias("first")).join(named, "fingerprint")
    chosen = first.groupBy("group").agg(F.min("first").alias("first")).select(
        F.col("first.rk").alias(key), F.col("first.same").alias(same))
    return (marked.join(chosen, [key, same], "left_semi").dropDuplicates([key, same])
            .select(*quoted(docs)))
