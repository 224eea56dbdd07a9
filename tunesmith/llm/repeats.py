"""Exact removal of repeated strings with suffix arrays (Lyndon grouping).

A byte goes when it lies in a ``length``-byte string that also starts
earlier (smaller id, or earlier in the same row).  No pass sees the
corpus as one text; equal strings are brought together by their content:

1. Every window of ``length`` bytes selects an anchor, the leftmost ``GRAM``
   bytes of it with the least hash; equal windows select the same place.
   Consecutive windows with one anchor form a run.  A run is described by the
   anchor's hash and a digest of all its bytes.  Batches drop what repeats
   inside them before the shuffle.
2. Runs meet by anchor hash, sorted, and are read as a stream.  A run whose
   digest stands earlier is a repeat as a whole.  First runs that share an
   anchor with different first runs may repeat in part; only these are cut
   from the texts, once.
3. Their windows fall into those that share the 66 bytes from the anchor on
   and those that share 35 bytes before and 32 from it, so a frequent
   anchor is split by more of its content.  Inside a task the parts right of
   the anchor, and the parts left of it read backwards, become sequences of
   16-byte blocks, whose suffix array (see ``gsaca``) sorts the members; byte
   prefixes shared by neighbours give, for every window offset, the members
   with equal windows.  All but the earliest are repeats.
   Of an anchor with more than ``crowd`` runs no members are made, so that no
   key holds more: every window of these runs is met by its own 128-bit digest
   as in step 2, batch by batch before the shuffle, then as a sorted stream.
4. Repeats are gathered per row and their bytes cut out.

Equal content is compared by 128 bits of hash in step 2 and for crowded
anchors, and by the bytes themselves in the rest of step 3.

Defined results: null and empty texts have no bytes; null ids come first in
the order; rows with equal id and text are the same occurrence, so neither is
a repeat of the other; rows with equal id (or none) and other texts are told
apart and ordered by ``row_key`` (its halves as signed integers); texts shorter
than ``length`` lose nothing; an empty table gives an empty result; clashing
input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import prepare, row_key, stored
from tunesmith.llm.gsaca import suffix_array

GRAM = 32
LENGTH = 100
_BLOCK = 16
_FIRST = -(1 << 63)
#: members whose suffix array is built at once, and one key more
_MEMBERS = 8192
#: runs of one anchor up to which they become members; no key has more members
CROWD = 8192


def _byte_table() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)


def _gram_hashes(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place, by doubling."""
    out, span = table[data], 1
    while span < GRAM:
        out = (out[:-span] * np.uint64(3)) + (out[span:] ^ np.uint64(span * 7919 + 1))
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        span *= 2
    return out


def window_runs(data: np.ndarray, table: np.ndarray, length: int):
    """(anchor hash, anchor, first window, last window) of every run."""
    width = length - GRAM + 1
    hashes = _gram_hashes(data, table)
    low, span = hashes, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    begin = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    stop = np.r_[begin[1:], len(low)]
    values = low[begin]
    kinds, rank = np.unique(values, return_inverse=True)
    near = np.minimum(np.searchsorted(kinds, hashes), len(kinds) - 1)
    at = np.flatnonzero(kinds[near] == hashes)
    n = len(data)
    codes = near[at] * n + at
    codes.sort()
    anchor = codes[np.searchsorted(codes, rank * n + begin)] % n
    # the anchor value stands more than once in few runs: cut those
    again = np.flatnonzero(anchor < stop - 1)
    if not len(again):
        return values, anchor, begin, stop - 1
    rows = []
    for i in again.tolist():
        lo, hi = int(anchor[i]) + 1, int(stop[i])
        stop[i] = lo
        while lo < hi:
            a = int(codes[np.searchsorted(codes, rank[i] * n + lo)] % n)
            rows.append((values[i], a, lo, min(a + 1, hi)))
            lo = min(a + 1, hi)
    extra = [np.array(x) for x in zip(*rows)]
    return (np.r_[values, extra[0].astype(np.uint64)], np.r_[anchor, extra[1]],
            np.r_[begin, extra[2]], np.r_[stop, extra[3]] - 1)


#: kind 0: a run; kind 1: windows ``lo`` to ``hi`` of ``doc`` are repeats
_ROWS = ("kind int, part bigint, digest bigint, doc bigint, r1 bigint, r2 bigint, "
         "anchor int, lo int, hi int")
_NAMES = ["kind", "part", "digest", "doc", "r1", "r2", "anchor", "lo", "hi"]
_TYPES = [pa.int32(), *[pa.int64()] * 5, *[pa.int32()] * 3]
_ORDER = ["part", "digest", "doc", "r1", "r2", "anchor"]


def _batch(columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c), t)
                                       for c, t in zip(columns, _TYPES)], _NAMES)


def _split(part, digest, doc, r1, r2, anchor, lo, hi):
    """Masks over rows sorted by ``_ORDER``: the first of every digest, and
    the repeats (later in order than the first)."""
    n = len(part)
    first = np.r_[True, (part[1:] != part[:-1]) | (digest[1:] != digest[:-1])]
    head = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    return first, ((doc != doc[head]) | (r1 != r1[head]) | (r2 != r2[head])
                   | (anchor != anchor[head]))


def _reduced(held) -> Iterator[pa.RecordBatch]:
    """Rows that are the first of their digest (kind 0) and, already known to
    be repeats, the others (kind 1)."""
    cols = [np.concatenate([h[i] for h in held]) for i in range(8)]
    order = np.lexsort(cols[5::-1])
    cols = [c[order] for c in cols]
    first, repeat = _split(*cols)
    yield _batch([np.zeros(first.sum()), *[c[first] for c in cols]])
    k = int(repeat.sum())
    if k:
        yield _batch([np.ones(k), cols[2][repeat], np.zeros(k), *[c[repeat] for c in cols[2:]]])


def _find_runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _byte_table()
        digest_of = xxhash.xxh64_intdigest

        for batch in batches:
            held, size = [], 0
            texts = batch.column(3).cast(pa.large_binary())
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for row, text in zip(rows, texts):
                raw = text.as_py()
                if raw is None or len(raw) < length:
                    continue
                hashes, anchor, lo, hi = window_runs(np.frombuffer(raw, np.uint8), table, length)
                digests = np.fromiter((digest_of(raw[a:b]) for a, b in zip(
                    lo.tolist(), (hi + length).tolist())), np.uint64, len(lo))
                # the anchor's place in the run tells runs of equal bytes apart
                digests += (anchor - lo).astype(np.uint64)
                held.append((hashes.view(np.int64), digests.view(np.int64),
                             *(np.full(len(lo), v, np.int64) for v in row), anchor, lo, hi))
                size += len(lo)
                if size > 1 << 18:
                    yield from _reduced(held)
                    held, size = [], 0
            if held:
                yield from _reduced(held)
    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows -> repeats (kind 1) and first runs that share their anchor
    with other first runs (kind 2)."""
    tail = None          # the last row of a digest's first run, and its anchor's state
    for batch in batches:
        if not batch.num_rows:
            continue
        kind, *cols = (batch.column(i).to_numpy() for i in range(9))
        marks = kind == 1
        if marks.any():
            yield _batch([kind[marks], *[c[marks] for c in cols]])
        cols = [c[~marks] for c in cols]
        if not len(cols[0]):
            continue
        if tail is not None:
            cols = [np.r_[t, c] for t, c in zip(tail["row"], cols)]
        part, digest = cols[0], cols[1]
        first, repeat = _split(*cols)
        skip = np.zeros(len(part), bool)
        several = np.zeros(len(part), bool)
        starts = np.flatnonzero(first)
        same = part[starts][1:] == part[starts][:-1]
        shared = np.r_[same, False] | np.r_[False, same]
        several[starts] = shared
        if tail is not None:
            # carried row: already given if it was known to share its anchor
            skip[0] = tail["given"]
            if tail["shares"]:
                several[0] = True
                several[starts[1:2]] |= part[starts[1:2]] == part[0]
        # the last first run waits for the next batch
        last = int(starts[-1])
        ready = several & first & ~skip
        given = bool(ready[last]) or bool(skip[last])
        if repeat.any():
            k = int(repeat.sum())
            yield _batch([np.ones(k), *[c[repeat] for c in cols]])
        if ready.any():
            k = int(ready.sum())
            yield _batch([np.full(k, 2), *[c[ready] for c in cols]])
        tail = {"row": [c[last:last + 1] for c in cols], "given": given,
                "shares": bool(several[last])}


def _wanted_rows(batch: pa.RecordBatch):
    """(row, bytes, runs) of a batch; copies of a row (equal id and text, so
    the same occurrences) are passed over."""
    rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
    texts = batch.column(3).cast(pa.large_binary())
    seen = set()
    for row, text, runs in zip(rows, texts, batch.column(4)):
        if row not in seen:
            seen.add(row)
            yield row, text.as_py(), runs.as_py()


def _cut_windows(length: int):
    """(row, text, wanted runs) -> every window of the runs as a run of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest_of = xxhash.xxh3_128_digest
        held, size = [], 0
        for batch in batches:
            for row, raw, runs in _wanted_rows(batch):
                at = np.array([w for r in runs for w in range(r["lo"], r["hi"] + 1)], np.int64)
                digests = np.frombuffer(b"".join(digest_of(raw[a:a + length])
                                                 for a in at.tolist()), np.int64).reshape(-1, 2)
                held.append((digests[:, 0], digests[:, 1],
                             *(np.full(len(at), v, np.int64) for v in row), at, at, at))
                size += len(at)
                if size > 1 << 18:
                    yield from _reduced(held)
                    held, size = [], 0
        if held:
            yield from _reduced(held)
    return run


def _cut_members(length: int):
    """(row, text, wanted runs) -> member rows: key, row, anchor, window offsets
    and the bytes around the anchor."""
    before = length - GRAM
    half = before // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "doc", "r1", "r2", "anchor", "least", "most", "left", "right"]
        for batch in batches:
            out = [[] for _ in names]
            for row, raw, runs in _wanted_rows(batch):
                for r in runs:
                    a = r["anchor"]
                    least, most = a - r["hi"], a - r["lo"]      # offsets of its windows
                    # offsets up to ``half`` share at least length - half bytes on the right
                    for low, high, kind in ((least, min(most, half), 0),
                                            (max(least, half + 1), most, 1)):
                        if low > high:
                            continue
                        shared = raw[a:a + length - half] if kind == 0 \
                            else raw[a - half - 1:a + GRAM]
                        key = xxhash.xxh64_intdigest(shared, kind)
                        for col, v in zip(out, (key - (1 << 64) if key >> 63 else key, *row, a,
                                                low, high, raw[a - high:a][::-1],
                                                raw[a:a + length - low])):
                            col.append(v)
                if len(out[0]) >= 1 << 15:
                    yield _members(out, names)
                    out = [[] for _ in names]
            if out[0]:
                yield _members(out, names)
    return run


def _members(out, names) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 4, *[pa.int32()] * 3, pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)


def content_order(key: np.ndarray, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Members in the order of their bytes inside each key, from the suffix
    array of their block sequences, and the bytes shared with the next one
    (0 between keys)."""
    n = len(parts)
    blocks = -(-max(map(len, parts)) // _BLOCK)
    padded = np.zeros((n, blocks * _BLOCK), np.uint8)
    for i, p in enumerate(parts):
        padded[i, :len(p)] = np.frombuffer(p, np.uint8)
    sizes = np.array([len(p) for p in parts])
    used = np.maximum(-(-sizes // _BLOCK), 1)
    names = np.unique(padded.reshape(-1, _BLOCK).view(f"S{_BLOCK}").ravel(),
                      return_inverse=True)[1].reshape(n, blocks) + 1
    # each sequence, then an end mark smaller than every block
    keep = np.arange(blocks + 1)[None, :] <= used[:, None]
    marked = np.concatenate([names, np.zeros((n, 1), np.int64)], axis=1)
    marked[np.arange(n), used] = 0
    symbols = marked[keep]
    starts = np.r_[0, np.cumsum(used + 1)[:-1]]
    owner = np.full(len(symbols), -1)
    owner[starts] = np.arange(n)
    ranked = owner[np.array(suffix_array(symbols.tolist()))]
    ranked = ranked[ranked >= 0]
    order = ranked[np.argsort(key[ranked], kind="stable")]
    x, k = padded[order], key[order]
    differ = x[1:] != x[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
    shared = np.minimum(shared, np.minimum(sizes[order][1:], sizes[order][:-1]))
    return order, np.where(k[1:] == k[:-1], shared, 0)


def repeated_offsets(key, doc, r1, r2, anchor, least, most, left, right, length: int):
    """(member, offset) of every window that also starts earlier."""
    n = len(key)
    sides = []
    for parts in (right, left):
        order, shared = content_order(key, parts)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        new = np.r_[True, key[order][1:] != key[order][:-1]]
        sides.append((order, shared, place, new))
    rank = np.empty(n, np.int64)
    place = (doc, r1, r2, anchor)
    when = np.lexsort(place[::-1])
    changed = np.r_[True, np.any([c[when][1:] != c[when][:-1] for c in place], axis=0)]
    rank[when] = np.cumsum(changed)
    out_m, out_r = [], []
    for r in range(int(least.min()), int(most.max()) + 1):
        has = np.flatnonzero((least <= r) & (r <= most))
        if len(has) < 2:
            continue
        ids = []
        for (_, shared, place, new), need in zip(sides, (length - r, r)):
            # a new class begins where fewer bytes than needed are shared
            cls = np.cumsum(np.r_[True, shared < need] | new)
            ids.append(cls[place[has]])
        code = ids[0] * (n + 1) + ids[1]
        order = np.lexsort((rank[has], code))
        code, members = code[order], has[order]
        head = np.r_[True, code[1:] != code[:-1]]
        lead = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
        late = rank[members] != rank[members[lead]]
        out_m.append(members[late])
        out_r.append(np.full(int(late.sum()), r))
    if not out_m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_m), np.concatenate(out_r)


def _compare(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(held):
            key, doc, r1, r2, anchor, least, most = (
                np.concatenate([h[i] for h in held]) for i in range(7))
            left, right = (sum((h[i] for h in held), []) for i in (7, 8))
            # keys of one member have nothing to compare
            new = np.r_[True, key[1:] != key[:-1]]
            alone = new & np.r_[new[1:], True]
            pick = np.flatnonzero(~alone)
            if not len(pick):
                return
            member, offset = repeated_offsets(
                *(c[pick] for c in (key, doc, r1, r2, anchor, least, most)),
                [left[i] for i in pick.tolist()], [right[i] for i in pick.tolist()], length)
            if not len(member):
                return
            member = pick[member]
            at = anchor[member] - offset
            order = np.lexsort((at, member))
            member, at = member[order], at[order]
            cut = np.r_[True, (member[1:] != member[:-1]) | (at[1:] != at[:-1] + 1)]
            begin = np.flatnonzero(cut)
            end = np.r_[begin[1:], len(at)] - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(r1[member[begin]]), pa.array(r2[member[begin]]),
                 pa.array(at[begin], pa.int32()), pa.array(at[end], pa.int32())],
                ["r1", "r2", "lo", "hi"])

        held, size, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            # copies of a member, from copies of its row, stand next to it
            who = [batch.column(i).to_numpy() for i in range(5)]
            other = np.any([np.r_[last is None or last[i] != c[0], c[1:] != c[:-1]]
                            for i, c in enumerate(who)], axis=0)
            last = [c[-1] for c in who]
            batch = batch.filter(pa.array(other))
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(7)]
            cols[4:] = [c.astype(np.int64) for c in cols[4:]]
            left, right = (batch.column(i).to_pylist() for i in (7, 8))
            # cut at the start of the last key, which may go on
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            if cut:
                held.append([*[c[:cut] for c in cols], left[:cut], right[:cut]])
                size += cut
            if cut and size >= _MEMBERS:
                yield from solve(held)
                held, size = [], 0
            held.append([*[c[cut:] for c in cols], left[cut:], right[cut:]])
            size += len(cols[0]) - cut
        if held:
            yield from solve(held)
    return run


def _digest(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            texts = batch.column(1).cast(pa.large_binary())
            for text, marks in zip(texts, batch.column(2)):
                raw = text.as_py() or b""
                removed = spans = 0
                kept = raw
                if marks.is_valid and len(marks.values):
                    lo = marks.values.field("lo").to_numpy().astype(np.int64)
                    hi = marks.values.field("hi").to_numpy().astype(np.int64) + length
                    order = np.argsort(lo, kind="stable")
                    lo, hi = lo[order], np.maximum.accumulate(hi[order])
                    begin = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]])
                    end = hi[np.r_[begin[1:], len(lo)] - 1]
                    begin = lo[begin]
                    removed, spans = int((end - begin).sum()), len(begin)
                    kept = b"".join(raw[a:b] for a, b in zip(
                        [0, *end.tolist()], [*begin.tolist(), len(raw)]))
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(removed)
                out["n_spans"].append(spans)
                out["kept"].append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(out[c], pa.int64()) for c in list(out)[:3]],
                 pa.array(out["kept"], pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, r1, r2, text: the id decides the order of rows, the two halves of
    ``row_key`` tell rows of one id (or of none) apart."""
    digest = F.hex(row_key(id_col, text_col))
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_FIRST)).alias("doc"),
        *[F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint").alias(name)
          for at, name in ((1, "r1"), (17, "r2"))],
        F.col(text_col).alias("text"), F.col(id_col).alias("id"))


def partial_repeats(texts: DataFrame, met: DataFrame, length: int, crowd: int):
    """Members of the anchors with at most ``crowd`` runs, and the windows of
    the runs of all others."""
    runs = met.filter("kind = 2")
    crowded = runs.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > crowd).select("part", F.lit(True).alias("crowded"))
    # at most one anchor in ``crowd`` runs
    runs = runs.join(F.broadcast(crowded), "part", "left")
    some = F.collect_set(F.struct("anchor", "lo", "hi"))
    own = texts.dropna(subset=["text"])

    def cut(chosen, fn, schema):
        wanted = runs.filter(chosen).groupBy("r1", "r2").agg(some.alias("runs"))
        return own.join(wanted, ["r1", "r2"]).select("doc", "r1", "r2", "text", "runs") \
            .mapInArrow(fn(length), schema)

    members = cut(F.col("crowded").isNull(), _cut_members,
                  "key bigint, doc bigint, r1 bigint, r2 bigint, anchor int, least int, "
                  "most int, left binary, right binary")
    return members, cut(F.col("crowded").isNotNull(), _cut_windows, _ROWS)


def _met(runs: DataFrame) -> DataFrame:
    return runs.repartition("part").sortWithinPartitions(*_ORDER).mapInArrow(_meet, _ROWS)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and the kept bytes of every row."""
    if length < GRAM + 2:
        raise ValueError(f"length must be at least {GRAM + 2}")
    prepare(docs.sparkSession)
    whole = _rows(docs, id_col, text_col)
    texts = whole.select("doc", "r1", "r2", "text")
    met = stored(_met(texts.mapInArrow(_find_runs(length), _ROWS)).select(
        "kind", F.when(F.col("kind") == 2, F.col("part")).alias("part"),
        "r1", "r2", "anchor", "lo", "hi"), "runs")
    members, windows = partial_repeats(texts, met, length, crowd)
    partial = members.repartition("key").sortWithinPartitions(
        "key", "doc", "r1", "r2", "anchor").mapInArrow(
        _compare(length), "r1 bigint, r2 bigint, lo int, hi int")
    again = _met(windows).filter("kind = 1")
    marks = [m.select("r1", "r2", "lo", "hi") for m in (met.filter("kind = 1"), partial, again)]
    # a set: copies of a row bring the same marks
    cuts = stored(marks[0].union(marks[1]).union(marks[2]).groupBy("r1", "r2").agg(
        F.collect_set(F.struct("lo", "hi")).alias("marks")), "cuts")
    kind = docs.schema[id_col].dataType.simpleString()
    return whole.join(cuts, ["r1", "r2"], "left").select("id", "text", "marks").mapInArrow(
        _digest(length),
        f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    ).withColumnRenamed("id", id_col)
