"""Token ids as directly addressable codes (DAC).

Ids are cut into 8-bit chunks.  Level 0 holds the lowest chunk of every id;
a bitmap says which ids go on, and those have their next chunk in the next
level, in the same order.  A rank directory (ones before every 512th bit)
turns a position in one level into a position in the next, so any token is
read without decoding its block.

A file set is a Parquet folder written by Spark: one row per segment of at
most ``segment_tokens`` ids (plus the rest of a document that crosses the limit), with
the documents' ids and starts and one self-contained binary image.  Segments
are in ascending id order: documents are range-partitioned and sorted, and a
segment knows its place and the ids before it in its partition.  The offsets
of partitions are one small aggregate, one row per partition.

Encoding uses the public ``tokenizers`` file at a path that is a parameter;
its content travels with the tasks.  Texts are cut where the pattern cuts,
equal parts of a batch are encoded once, and a memo of bounded size keeps the
parts that recur for later batches.  Ids are those that the library gives with
``add_special_tokens=False``: text that spells a special token becomes its id.

Defined results: null and empty texts hold the end id alone; null document
ids come first; documents of one id are ordered by a digest of their texts;
repeated rows are stored each; an empty table gives an empty file set; clashing
input columns are ignored.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm.chunks import split_chunks
from tunesmith.llm.common import prepare

_MAGIC = b"DAC1"
_BLOCK = 512
#: parts and ids that the memo holds, at most
_MEMO = 600_000
_MEMO_IDS = 6_000_000
#: parts encoded together
_TOGETHER = 64
#: characters of the texts encoded at a time
_ENCODE_CHARS = 8 << 20
#: white space by str.isspace(): cuts beside any of it are left to split_chunks
_WHITE = "\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
SEGMENT_TOKENS = 1 << 20


def pack(ids: np.ndarray) -> bytes:
    """The image of an id array: header, then per level its chunks, bitmap
    and rank directory."""
    levels, values = [], ids.astype(np.uint32)
    while True:
        rest = values >> 8
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-max(len(more), 1) // _BLOCK) * (_BLOCK // 8), np.uint8)
        padded[:len(bits)] = bits
        ones = np.bitwise_count(padded).reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")
        levels.append((values.astype(np.uint8).tobytes(), padded.tobytes(), ranks.tobytes()))
        if not more.any():
            break
        values = rest[more]
    head = struct.pack("<4sI", _MAGIC, len(levels))
    sizes = b"".join(struct.pack("<QQQ", *map(len, level)) for level in levels)
    return head + sizes + b"".join(x for level in levels for x in level)


class Image:
    """Random access to a packed image without decoding it."""

    def __init__(self, data: bytes):
        magic, n = struct.unpack_from("<4sI", data)
        if magic != _MAGIC:
            raise ValueError("not a DAC image")
        at = 8 + 24 * n
        self.levels = []
        for i in range(n):
            parts = []
            for size, kind in zip(struct.unpack_from("<QQQ", data, 8 + 24 * i),
                                  (np.uint8, np.uint8, "<u4")):
                parts.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
                at += size
            self.levels.append(parts)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before each bit position."""
        block = at // _BLOCK
        whole = bits.reshape(-1, _BLOCK // 8)[block]
        inside = at % _BLOCK
        byte = np.arange(_BLOCK // 8)
        part = inside[:, None] - byte * 8
        mask = np.where(part >= 8, 255, np.where(part <= 0, 0, (1 << np.clip(part, 0, 7)) - 1))
        return ranks[block].astype(np.int64) + np.bitwise_count(
            whole & mask.astype(np.uint8)).sum(axis=1, dtype=np.int64)

    def at(self, positions) -> np.ndarray:
        """The ids at ``positions``."""
        at = np.asarray(positions, np.int64)
        out = np.zeros(len(at), np.uint32)
        alive = np.arange(len(at))
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out[alive] |= chunks[at].astype(np.uint32) << np.uint32(8 * level)
            more = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            alive, at = alive[more], at[more]
            if not len(at):
                break
            at = self._rank(bits, ranks, at)
        return out

    def between(self, start: int, stop: int) -> np.ndarray:
        """The ids of one contiguous range."""
        out = np.zeros(stop - start, np.uint32)
        alive = np.arange(stop - start)
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            if stop <= start:
                break
            out[alive] |= chunks[start:stop].astype(np.uint32) << np.uint32(8 * level)
            first = start >> 3
            more = np.unpackbits(bits[first:(stop + 7) >> 3], bitorder="little")[
                start - first * 8:stop - first * 8] == 1
            alive = alive[more]
            if not len(alive):
                break
            start = int(self._rank(bits, ranks, np.array([start]))[0])
            stop = start + len(alive)
        return out


class Encoder:
    """Ids of whole texts from a ``tokenizers`` file's content.

    The memo holds the ids of parts of texts: an Arrow array of the parts, and
    where their ids lie in ``bank``.  When it is full, the parts not used for the
    longest time go.
    """

    def __init__(self, content: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        # byte-level vocabularies write the space byte as U+0120
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)
        self.spaced[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True
        self.parts = pa.array([], pa.string())
        self.begin = self.size = self.used = np.zeros(0, np.int64)
        self.bank = np.zeros(0, "<u4")
        self.turn = 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _spaced(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of every part with a leading space; parts without a space of
        their own are encoded many at a time and cut where a space starts."""
        found: list = [None] * len(parts)
        alone = [k for k, p in enumerate(parts) if " " in p]
        plain = [k for k, p in enumerate(parts) if " " not in p]
        groups = [plain[i:i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        joined = [" " + " ".join([parts[k] for k in g]) for g in groups]
        for group, ids in zip(groups, self._ids(joined)):
            cuts = np.flatnonzero(self.spaced[ids])
            if len(cuts) != len(group) or cuts[0] != 0:
                alone += group
                continue
            cuts = [*cuts.tolist(), len(ids)]
            for k, low, high in zip(group, cuts, cuts[1:]):
                found[k] = ids[low:high]
        for k, ids in zip(alone, self._ids([" " + parts[k] for k in alone])):
            found[k] = ids
        return found

    def _known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bank, begin, size) of the ids of different ``words``, each with a
        leading space."""
        self.turn += 1
        at = pc.fill_null(pc.index_in(words, value_set=self.parts), -1).to_numpy().astype(np.int64)
        new = at < 0
        self.used[at[~new]] = self.turn
        fresh = words.filter(pa.array(new))
        ids = self._spaced(fresh.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        at[new] = len(self.parts) + np.arange(len(ids))
        self.parts = pa.concat_arrays([self.parts, fresh])
        self.begin = np.concatenate([self.begin, len(self.bank) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.used = np.concatenate([self.used, np.full(len(ids), self.turn)])
        self.bank = np.concatenate([self.bank, *ids])
        bank, begin, size = self.bank, self.begin[at], self.size[at]
        if len(self.parts) > _MEMO or len(self.bank) > _MEMO_IDS:
            self._forget()
        return bank, begin, size

    def _forget(self) -> None:
        """Keep the parts used last, half of what the memo may hold."""
        order = np.argsort(-self.used, kind="stable")
        keep = order[:_MEMO // 2]
        keep = keep[np.cumsum(self.size[keep]) <= _MEMO_IDS // 2]
        self.bank = self.bank[_ranges(self.begin[keep], self.size[keep])]
        self.size, self.used = self.size[keep], self.used[keep]
        self.begin = np.cumsum(self.size) - self.size
        self.parts = self.parts.take(pa.array(keep))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts`` (no nulls) one after the other, and where each
        text's ids end."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        # texts with white space beside a single space are cut with more care
        odd = pc.match_substring_regex(texts, f"(?:^| )(?:[{_WHITE}]|$)|[{_WHITE}] ")
        odd = odd.to_numpy(zero_copy_only=False)
        whole = np.zeros(len(texts), bool)
        for token in self.special:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(~odd & ~whole), np.flatnonzero(odd & ~whole)])
        plain = pc.split_pattern(texts.filter(pa.array(~odd & ~whole)), " ")
        careful = pa.array([split_chunks(t) for t in texts.filter(pa.array(odd & ~whole)).to_pylist()],
                           plain.type)
        cut = pa.concat_arrays([plain, careful])
        sizes = pc.list_value_length(cut).to_numpy()
        flat = cut.flatten()
        last = np.cumsum(sizes)
        first = last - sizes
        heads = flat.take(pa.array(first)).dictionary_encode()
        parts = flat.dictionary_encode()
        codes = parts.indices.to_numpy().astype(np.int64)
        codes[first] = len(parts.dictionary) + heads.indices.to_numpy()
        used = np.zeros(len(parts.dictionary), bool)
        used[codes[codes < len(used)]] = True
        bank, own, length = self._known(parts.dictionary.filter(pa.array(used)))
        begin, size = np.zeros((2, len(used)), np.int64)
        begin[used], size[used] = own, length
        # texts with special tokens come last, each one part
        rest = np.flatnonzero(whole)
        more = self._ids(heads.dictionary.to_pylist() + texts.take(pa.array(rest)).to_pylist())
        lengths = np.fromiter(map(len, more), np.int64, len(more))
        begin = np.concatenate([begin, len(bank) + np.cumsum(lengths) - lengths])
        length = np.concatenate([size, lengths])
        bank = np.concatenate([bank, *more])
        codes = np.concatenate([codes, np.arange(len(length) - len(rest), len(length))])
        last = np.concatenate([last, (last[-1] if len(last) else 0) + np.arange(1, len(rest) + 1)])
        order = np.concatenate([order, rest])
        # parts in the order of the texts
        first = np.concatenate([[0], last[:-1]])
        back = np.argsort(order)
        turn = _ranges(first[back], (last - first)[back])
        codes = codes[turn]
        ids = bank[_ranges(begin[codes], length[codes])]
        ends = np.cumsum(length[codes])[np.cumsum((last - first)[back]) - 1]
        return ids, ends


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


@lru_cache(maxsize=1)
def _encoder(content: str) -> Encoder:
    """A Python worker keeps the tokenizer and its memo for its next tasks."""
    return Encoder(content)


_SEGMENT = ("part int, seq int, part_start bigint, n_tokens bigint, doc_ids array<{id}>, "
            "doc_starts array<bigint>, image binary")


def _writer(content: str, end_id: int, segment_tokens: int, id_type: pa.DataType):
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("part_start", pa.int64()),
                        ("n_tokens", pa.int64()), ("doc_ids", pa.list_(id_type)),
                        ("doc_starts", pa.list_(pa.int64())), ("image", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, end = _encoder(content), np.array([end_id], "<u4")
        names, parts, starts, held, before, seq = [], [], [], 0, 0, 0

        def segment():
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "part_start": [before], "n_tokens": [len(ids)],
                 "doc_ids": [names], "doc_starts": [starts], "image": [pack(ids)]}, schema)

        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            chars = np.cumsum(pc.utf8_length(texts).to_numpy())
            low = 0
            while low < len(texts):
                # at least one text, else as many as the limit lets in
                limit = (chars[low - 1] if low else 0) + _ENCODE_CHARS
                high = max(low + 1, int(np.searchsorted(chars, limit, "right")))
                ids, ends = encoder.encode(texts.slice(low, high - low))
                begin = 0
                for key, stop in zip(batch.column(0).slice(low, high - low).to_pylist(), ends.tolist()):
                    names.append(key)
                    starts.append(held)
                    parts += [ids[begin:stop], end]
                    held += stop - begin + 1
                    begin = stop
                    if held >= segment_tokens:
                        yield segment()
                        names, parts, starts, before = [], [], [], before + held
                        held, seq = 0, seq + 1
                low = high
        if names:
            yield segment()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2,
                 id_col: str = "doc_id", text_col: str = "text",
                 segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode whole texts and write the DAC file set at ``path``."""
    spark = docs.sparkSession
    prepare(spark)
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    kind = docs.schema[id_col].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows of one id, also null, are divided by their texts, equal ones by place
    keys = ["id", "digest", "place"]
    ordered = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.xxhash64(text_col).alias("digest"),
                           F.monotonically_increasing_id().alias("place"))
               .repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("id", "text"))
    ordered.mapInArrow(_writer(content, end_id, segment_tokens, to_arrow_type(kind)),
                       _SEGMENT.format(id=kind.simpleString())
                       ).write.mode("errorifexists").parquet(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    from pyspark.sql import Window
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the writer
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(offsets), "part").withColumn(
        "start", F.col("base") + F.col("part_start"))


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document of a file set: id, start, n_tokens and ids (binary, 32-bit
    little-endian)."""
    rows = _segments(spark, path).select("start", "doc_ids", "doc_starts", "image")
    kind = rows.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                image = Image(batch.column(3)[i].as_py())
                starts = np.array(batch.column(2)[i].as_py(), np.int64)
                stops = np.append(starts[1:], len(image))
                ids = [image.between(a, b).astype("<u4").tobytes()
                       for a, b in zip(starts.tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[i].values, pa.array(starts + batch.column(0)[i].as_py()),
                     pa.array(stops - starts), pa.array(ids, pa.binary())],
                    [id_col, "start", "n_tokens", "ids"])

    return rows.mapInArrow(run, f"`{id_col}` {kind.simpleString()}, start bigint, "
                                "n_tokens bigint, ids binary")


def tokens_at(spark: SparkSession, path: str, positions: list[int]) -> DataFrame:
    """(position, token) at the given global positions; only segments that
    hold one are opened, and nothing but the asked tokens is decoded."""
    wanted = np.unique(np.asarray(positions, np.int64))
    low, high = (int(wanted[0]), int(wanted[-1])) if len(wanted) else (0, -1)
    rows = _segments(spark, path).select("start", "n_tokens", "image").filter(
        (F.col("start") <= high) & (F.col("start") + F.col("n_tokens") > low))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                mine = wanted[(wanted >= start) & (wanted < start + n)]
                if len(mine):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mine), pa.array(Image(data).at(mine - start).astype(np.int64))],
                        ["position", "token"])

    return rows.mapInArrow(run, "position bigint, token bigint")
