"""Byte-level BPE encoding and decoding.

A batch of documents becomes one row: the distinct matches of the public
pattern in it (as arrays of the pairs of adjacent pieces, with their ranks),
and per document the indexes of its matches.  Spark higher-order functions
then fold the ranked merges over every distinct match: the adjacent pair of
the lowest rank is joined, again and again, until no pair has a rank.  The
ranks of pairs are a table of one row, joined to the batches by broadcast and
addressed by the ids of the pair; neither strings nor maps are searched.  Ids
are put together per document from the indexes; decoding concatenates the
byte pieces of the ids.

The fold costs the square of a match's length, so matches of more than
``FOLD_BYTES`` bytes are merged with a heap in the same pass; the ids are the
same.  Texts are not shuffled: a row holds about ``batch_chars`` characters,
or one longer document, and a lost task is simply run again.

Words that many batches share would be folded in each of them, so at most
``head_words`` of them are folded beforehand and broadcast with their ids.
They are the most frequent of a bounded sample of documents (``head_docs``);
this is a cache only: ids do not depend on it.  Its size is bounded by
``head_words`` entries of at most ``FOLD_BYTES`` bytes and as many ids.

Defined results: null text encodes as the empty text (no ids, no bytes);
repeated rows are rows of their own; an empty table gives an empty result;
clashing input columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tunesmith.llm.chunks import split_chunks
from tunesmith.llm.common import prepare, stored

FOLD_BYTES = 32
#: of an id, rank or place.  An element of a state is a pair of adjacent pieces:
#: rank, place in the word and right id, from the upper bits down
_BITS = 20
_LOW = (1 << _BITS) - 1
_PLACE = _LOW << _BITS
#: the rank of no piece, above every rank
_NONE = _LOW << 2 * _BITS
_MEMO = 60_000
HEAD_DOCS = 1 << 15
HEAD_WORDS = 250_000
#: rows of texts that go to Python at once, as in ``build_session``
ARROW_ROWS = 1024


def load_ranks(path: str) -> list[bytes]:
    """Byte pieces in the order of their ranks, from a public rank file."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    pieces: list[bytes] = [b""] * (max(int(r) for _, r in pairs) + 1)
    for piece, rank in pairs:
        pieces[int(rank)] = base64.b64decode(piece)
    return pieces


def pair_table(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all pairs of pieces that make a piece, as two arrays.

    The pair (left, right) stands at ``shifts[left] + right`` of the second
    array, as rank, left and right of ``_BITS`` bits each; other places hold
    other pairs or -1.  The id after the last one stands for a word's end.
    """
    if len(pieces) >= 1 << _BITS:
        raise ValueError(f"more than {(1 << _BITS) - 1} ranks")
    ranks = {p: i for i, p in enumerate(pieces) if p}
    rights: dict[int, list[tuple[int, int]]] = {}
    for piece, rank in ranks.items():
        for at in range(1, len(piece)):
            left, right = ranks.get(piece[:at]), ranks.get(piece[at:])
            if left is not None and right is not None:
                rights.setdefault(left, []).append((right, rank))
    n, size, draw = len(pieces), 1 << 16, np.random.default_rng(42)
    while size < 5 * sum(map(len, rights.values())):
        size *= 2
    shifts, pairs = np.zeros(n + 1, np.int32), np.full(size + n + 1, -1, np.int64)
    # full rows first; a place is tried at random until the whole row is free there
    for left, row in sorted(rights.items(), key=lambda r: (-len(r[1]), r[0])):
        right, rank = np.array(row, np.int64).T
        fits, tries = np.zeros(0, np.int64), 8
        while not len(fits):
            tried, tries = draw.integers(0, size, tries), min(2 * tries, 1 << 10)
            for place in right:
                tried = tried[pairs[tried + place] < 0]
                if not len(tried):
                    break
            fits = tried
        shifts[left] = fits[0]
        pairs[fits[0] + right] = rank << 2 * _BITS | left << _BITS | right
    return shifts, pairs


def _starter(pieces: list[bytes]):
    """Function from words (bytes) to the states that ``merged`` starts from."""
    ranks = {p: i for i, p in enumerate(pieces) if p}
    single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
    double = np.full(1 << 16, _LOW, np.int64)
    for piece, rank in ranks.items():
        if len(piece) == 2:
            double[piece[0] << 8 | piece[1]] = rank

    def start(words: list[bytes]) -> pa.Array:
        # few at a time: the arrays in between are ten times as large as the words
        return pa.concat_arrays([some(words[i:i + 4096]) for i in range(0, len(words) or 1, 4096)])

    def some(words: list[bytes]) -> pa.Array:
        whole = np.array([ranks.get(w, -1) for w in words], np.int64)
        sizes = np.where(whole < 0, np.array([len(w) for w in words], np.int64), 1)
        data = np.frombuffer(b"".join([w if r < 0 else w[:1] for w, r in zip(words, whole.tolist())]),
                             np.uint8).astype(np.int64)
        ids, last = np.repeat(whole, sizes), np.cumsum(sizes) - 1
        ids = np.where(ids < 0, single[data], ids)
        if (ids < 0).any():
            raise ValueError("a byte has no rank")
        between = np.r_[double[data[:-1] << 8 | data[1:]], _LOW][:len(data)]
        between[last] = _LOW
        # the end before the word, its pieces, the end behind it, each as a pair's right side
        offsets = np.r_[0, np.cumsum(sizes + 2)]
        at = np.arange(len(ids)) + 2 * np.repeat(np.arange(len(words)), sizes) + 1
        right, rank = np.full(offsets[-1], len(pieces), np.int64), np.full(offsets[-1], _LOW, np.int64)
        right[at], rank[at + 1] = ids, between
        place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes + 2)
        state = rank << 2 * _BITS | place << _BITS | right
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(state))
    return start


def _word_ids(states: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words one after the other, and the number of ids of each."""
    values = states.flatten().to_numpy(zero_copy_only=False)
    sizes = np.asarray(states.value_lengths(), np.int64)
    ends = np.cumsum(sizes)
    inner = np.ones(len(values), bool)
    inner[ends - 1] = inner[ends - sizes] = False
    return (values[inner] & _LOW).astype(np.int32), sizes - 2


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_merges(start: Column, shifts: Column, pairs: Column) -> Column:
    """Pairs of adjacent pieces of one match after all its merges.

    The least element is the next merge: of the lowest rank, and the first in
    the word of those.  It goes, and its two neighbours meet the new piece, whose
    id is that rank.  Places are those of the first state, so no two elements
    are equal: neighbours are taken out by value, which costs less than slices.
    """
    def pair(left: Column, right: Column, old: Column) -> Column:
        both = F.shiftleft(left, _BITS).bitwiseOR(right)
        found = F.get(pairs, F.get(shifts, left.cast("int")) + right.cast("int"))
        # of another pair or none: no rank
        return F.when(found.bitwiseAND(_PLACE | _LOW) == both, found.bitwiseAND(_NONE | _LOW)).otherwise(
            right.bitwiseOR(_NONE)).bitwiseOR(old.bitwiseAND(_PLACE))

    def joined(known: Column, x: Column, k: Column) -> Column:
        left, right, new = F.get(known, k - 2), F.get(known, k), F.shiftright(x, 2 * _BITS)
        others = F.array_remove(F.array_remove(F.array_remove(known, x), left), right)
        before = pair(F.get(known, k - 3).bitwiseAND(_LOW), new, left)
        after = pair(new, right.bitwiseAND(_LOW), right)
        return F.array_insert(F.array_insert(others, k - 1, before), k, after)

    def merge(known: Column, _: Column) -> Column:
        return _let(F.array_position(known, F.array_min(known)).cast("int"), lambda k: F.when(
            F.get(known, k - 1) < _NONE, joined(known, F.get(known, k - 1), k)).otherwise(known))

    # one pair less at each step
    return F.aggregate(F.sequence(F.lit(4), F.size(start)), start, merge)


def merged(rows: DataFrame, shifts: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """``rows`` with the column ``states`` folded.  The ranks are a table of one
    row, joined to the rows of batches: nothing of them stands in the plan."""
    table = rows.sparkSession.createDataFrame(pa.table(
        {"shifts": pa.array([shifts], pa.list_(pa.int32())),
         "pairs": pa.array([pairs], pa.list_(pa.int64()))}))
    folded = F.transform("states", lambda s: fold_merges(s, F.col("shifts"), F.col("pairs")))
    return rows.crossJoin(F.broadcast(table)).select(
        *[folded.alias(c) if c == "states" else c for c in rows.columns])


def merge_long(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one long match: a heap of pair ranks over a linked list."""
    if data in ranks:
        return [ranks[data]]
    toks: list = [data[i:i + 1] for i in range(len(data))]
    after = list(range(1, len(toks) + 1))
    before = list(range(-1, len(toks) - 1))
    heap = [(ranks[toks[i] + toks[i + 1]], i, 2) for i in range(len(toks) - 1)
            if toks[i] + toks[i + 1] in ranks]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = after[i] if i >= 0 else len(toks)
        if i >= 0 and j < len(toks):
            rank = ranks.get(toks[i] + toks[j])
            if rank is not None:
                heapq.heappush(heap, (rank, i, len(toks[i]) + len(toks[j])))

    while heap:
        rank, i, size = heapq.heappop(heap)
        j = after[i] if toks[i] is not None else len(toks)
        # an entry is stale once either side has changed
        if j >= len(toks) or len(toks[i]) + len(toks[j]) != size \
                or ranks.get(toks[i] + toks[j]) != rank:
            continue
        toks[i], toks[j] = toks[i] + toks[j], None
        after[i] = after[j]
        if after[i] < len(toks):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [ranks[t] for t in toks if t is not None]


#: what ``_known`` gave last
_LAST: dict[tuple[bytes, str], tuple[dict[str, int], dict[str, bytes]]] = {}


def _known(words: bytes, pattern: str) -> tuple[dict[str, int], dict[str, bytes]]:
    """Places of the cache's words, and an empty memo of parts made of such
    words alone.  A Python worker keeps both for its next tasks, never two, and
    drops them when it turns to assembling."""
    if (words, pattern) not in _LAST:
        _LAST.clear()
        _LAST[words, pattern] = ({bytes.fromhex(w.group().decode()).decode(): i
                                  for i, w in enumerate(re.finditer(rb"[0-9a-f]+", words))}, {})
    return _LAST[words, pattern]


def _batcher(pattern: str, pieces: list[bytes], batch_chars: int, id_type: pa.DataType,
             head):
    schema = pa.schema([("ids", pa.list_(id_type)), ("index", pa.list_(pa.binary())),
                        ("states", pa.list_(pa.list_(pa.int64()))),
                        ("longer", pa.list_(pa.list_(pa.int32())))])

    def row(ids: pa.Array, texts: list, ranks: dict, start, common: dict,
            memo: dict) -> pa.RecordBatch:
        import regex

        find = regex.compile(pattern).findall
        # places of matches: frequent words, those to fold, longer ones from -1 down
        place: dict[str, int] = {}
        words, longer, n_common = [], [], len(common)

        def places(part: str) -> bytes:
            out = []
            for m in find(part):
                at = common.get(m)
                if at is None:
                    at = place.get(m)
                if at is None:
                    data = m.encode()
                    if len(data) <= FOLD_BYTES:
                        at = n_common + len(words)
                        words.append(data)
                    else:
                        longer.append(merge_long(data, ranks))
                        at = -len(longer)
                    place[m] = at
                out.append(at)
            data = array("i", out).tobytes()
            # places of frequent words are the same in every batch
            if len(memo) < _MEMO and 0 <= min(out) and max(out) < n_common:
                memo[part] = data
            return data

        known: dict[str, bytes] = {}

        def coded(text: str) -> bytes:
            first, *rest = split_chunks(text)
            out = [places(first)] if first else []
            for p in rest:
                data = known.get(p)
                if data is None:
                    data = known[p] = memo.get(" " + p) or places(" " + p)
                out.append(data)
            return b"".join(out)

        # one document after the other: only the batch's distinct parts are held
        index = [coded(t) for t in texts]
        known.clear()
        place.clear()
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays([0, len(ids)], ids), pa.array([index], schema.field(1).type),
             pa.ListArray.from_arrays([0, len(words)], start(words)),
             pa.array([longer], schema.field(3).type)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = {p: i for i, p in enumerate(pieces) if p}
        start = _starter(pieces)
        common, memo = _known(head[0].value, pattern)
        ids, texts, held = [], [], 0
        slices = (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512))
        for batch in slices:
            values = [t or "" for t in batch.column(1).to_pylist()]
            low = 0
            for i, text in enumerate(values):
                held += len(text)
                if held >= batch_chars:
                    ids.append(batch.column(0).slice(low, i + 1 - low))
                    yield row(pa.concat_arrays(ids), texts + values[low:i + 1], ranks, start, common,
                              memo)
                    ids, texts, held, low = [], [], 0, i + 1
            if low < len(values):
                ids.append(batch.column(0).slice(low))
                texts += values[low:]
        if texts:
            yield row(pa.concat_arrays(ids), texts, ranks, start, common, memo)
    return run


def _assembler(id_col: str, head, pieces: list[bytes] | None = None):
    """Ids per document; with ``pieces`` packed ids and decoded bytes instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _LAST.clear()
        head_sizes, head_flat = head[1].value
        table = None if pieces is None else pa.array(pieces, pa.large_binary())
        for batch in batches:
            for r in range(batch.num_rows):
                names, index, states, longer = (c[r].values for c in batch.columns)
                # a negative place counts from the end, where the longer ones are reversed
                longer = longer.take(pa.array(np.arange(len(longer))[::-1]))
                folded, folded_sizes = _word_ids(states)
                flat = np.r_[head_flat, folded, longer.flatten().to_numpy(zero_copy_only=False)]
                sizes = np.r_[head_sizes, folded_sizes, np.asarray(longer.value_lengths())].astype(
                    np.int64)
                starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
                for low in range(0, len(names), 256):
                    docs = index.slice(low, 256).to_pylist()
                    at = np.frombuffer(b"".join(docs), "<i4").astype(np.int64)
                    at = np.where(at < 0, at + len(sizes), at)
                    n = sizes[at]
                    ends = np.cumsum(n)
                    total = int(ends[-1]) if len(ends) else 0
                    where = np.repeat(starts[at] - (ends - n), n) + np.arange(total)
                    ids = flat[where].astype(np.int32)
                    words = np.cumsum([len(d) // 4 for d in docs])
                    offsets = np.r_[0, np.r_[0, ends][words]].astype(np.int32)
                    first = [names.slice(low, 256), pa.array(np.diff(offsets).astype(np.int64))]
                    if table is not None:
                        yield pa.RecordBatch.from_arrays(
                            [*first, *_unpacked(ids, offsets.astype(np.int64), table)],
                            [id_col, "n_tokens", "ids_bytes", "decoded"])
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [*first, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                        [id_col, "n_tokens", "input_ids"])
    return run


def _unpacked(ids: np.ndarray, bounds: np.ndarray, table: pa.Array) -> list[pa.Array]:
    """Packed ids and concatenated byte pieces of documents at ``bounds``."""
    taken = table.take(pa.array(ids))
    ends = np.r_[0, np.cumsum(np.asarray(pc.binary_length(taken), np.int64))]
    data = taken.buffers()[2].to_pybytes() if len(taken) else b""
    packed, at = ids.astype("<u4").tobytes(), ends[bounds]
    return [pa.array([packed[a * 4:b * 4] for a, b in zip(bounds, bounds[1:])], pa.binary()),
            pa.array([data[a:b] for a, b in zip(at, at[1:])], pa.binary())]


def _word_counts(pattern: str, chars: int = 1 << 22):
    """Matches and their counts, put out for about ``chars`` characters at a time."""
    def counted(parts: Counter, find) -> pa.RecordBatch:
        counts: Counter = Counter()
        for part, n in parts.items():
            for m in find(part):
                counts[m] += n
        kept = [(m.encode().hex(), n) for m, n in counts.items()
                if len(m.encode()) <= FOLD_BYTES]
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.string()),
             pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        parts: Counter = Counter()
        held = 0
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                for text in batch.column(0).slice(low, 512).to_pylist():
                    head, *rest = split_chunks(text or "")
                    parts[head] += 1
                    parts.update([" " + p for p in rest])
                    held += len(text or "")
                    if held >= chars:
                        yield counted(parts, find)
                        parts, held = Counter(), 0
        if parts:
            yield counted(parts, find)
    return run


def _head(docs: DataFrame, pattern: str, pieces: list[bytes], table: tuple, text_col: str,
          head_docs: int, head_words: int):
    """Broadcasts of the sample's most frequent words, and of their id counts and ids."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    # about head_docs rows: a Bernoulli sample with a fixed seed
    sample = docs.sample(fraction=min(1.0, head_docs / max(docs.count(), 1)), seed=7)
    counts = stored(sample.select(text_col).mapInArrow(_word_counts(pattern), "word string, n bigint")
                    .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    least, room = None, head_words
    # one row per count: there are at most some square root of the sample's size
    for row in counts.groupBy("n").count().orderBy(F.col("n").desc()).collect():
        if row["count"] > room:
            break
        room, least = room - row["count"], row["n"]
    if least is None:
        return share(b""), share((np.zeros(0, np.int64), np.zeros(0, np.int32)))
    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = _starter(pieces)
        for batch in batches:
            words = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " "),
                 pa.ListArray.from_arrays([0, len(words)], start(
                     [bytes.fromhex(w) for w in words.to_pylist()]))], ["words", "states"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, sizes = _word_ids(batch.column(1)[r].values)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(r, 1), pa.array([ids.tobytes()]),
                     pa.array([sizes.tobytes()])], ["words", "ids", "sizes"])

    rows = (counts.filter(F.col("n") >= least).select("word")
            .repartition(spark.sparkContext.defaultParallelism)
            .mapInArrow(states, "words string, states array<array<bigint>>"))
    # one row for thousands of words: no string object for each word on the driver
    done = merged(rows, *table).mapInArrow(
        packed, "words string, ids binary, sizes binary").toArrow()
    words, ids, sizes = (done[c].to_pylist() for c in done.column_names)
    # apart, as each of the two steps needs one of them only
    return share(" ".join(words).encode()), share((np.frombuffer(b"".join(sizes), np.int64),
                                                   np.frombuffer(b"".join(ids), np.int32)))


def _bound_batches(spark: SparkSession) -> None:
    """At most ``ARROW_ROWS`` rows in an Arrow batch of the session: the default,
    10,000 whole texts, is held in the JVM's buffers and twice in a Python worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def _folded(docs: DataFrame, pieces: list[bytes], pattern: str, id_col: str, text_col: str,
            batch_chars: int, head_docs: int, head_words: int):
    """Rows of batches with the ids of their distinct matches, and the cache."""
    prepare(docs.sparkSession)
    _bound_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    asked = docs.select(F.col(id_col), F.col(text_col))
    table = pair_table(pieces)
    head = _head(asked, pattern, pieces, table, text_col, head_docs, head_words)
    rows = asked.mapInArrow(
        _batcher(pattern, pieces, batch_chars, to_arrow_type(kind), head),
        f"ids array<{kind.simpleString()}>, index array<binary>, states array<array<bigint>>, "
        "longer array<array<int>>")
    return merged(rows, *table), head


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", batch_chars: int = 1 << 21, head_docs: int = HEAD_DOCS,
           head_words: int = HEAD_WORDS) -> DataFrame:
    """id, n_tokens and input_ids of every text."""
    folded, head = _folded(docs, load_ranks(ranks_path), pattern, id_col, text_col, batch_chars,
                           head_docs, head_words)
    name = docs.schema[id_col].dataType.simpleString()
    return folded.mapInArrow(
        _assembler(id_col, head), f"`{id_col}` {name}, n_tokens bigint, input_ids array<int>")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", batch_chars: int = 1 << 21, head_docs: int = HEAD_DOCS,
               head_words: int = HEAD_WORDS) -> DataFrame:
    """id, n_tokens, ids_bytes (32-bit little-endian ids) and the bytes that
    the ids decode to, in one pass."""
    pieces = load_ranks(ranks_path)
    folded, head = _folded(docs, pieces, pattern, id_col, text_col, batch_chars, head_docs,
                           head_words)
    name = docs.schema[id_col].dataType.simpleString()
    return folded.mapInArrow(
        _assembler(id_col, head, pieces),
        f"`{id_col}` {name}, n_tokens bigint, ids_bytes binary, decoded binary")


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "input_ids") -> DataFrame:
    """``encoded`` with ids_bytes (32-bit little-endian ids) and decoded
    (bytes) in place of the ids."""
    pieces = load_ranks(ranks_path)
    others = [c for c in encoded.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(pieces, pa.large_binary())
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids = part.column(0)
                bounds = np.r_[0, np.cumsum(np.asarray(ids.value_lengths().fill_null(0), np.int64))]
                flat = ids.flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], *_unpacked(flat, bounds, table)],
                    [*others, "ids_bytes", "decoded"])

    fields = encoded.select(*others).schema.fields
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                       + ["ids_bytes binary", "decoded binary"])
    return encoded.select(ids_col, *others).mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
            text_col: str = "text", **options) -> DataFrame:
    """id, n_tokens and SHA-256 of the packed ids and of the decoded bytes."""
    both = round_trip(docs, ranks_path, pattern, id_col, text_col, **options)
    return both.select(id_col, "n_tokens", F.sha2("ids_bytes", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
