"""Edge rows (nulls, empty, long, repeated, clashing names) and brute force."""
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(row):
    return tuple((v is not None, v) for v in row)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def words(text):
    return WORD.findall(text or "")


# 1 -------------------------------------------------------------------------

def test_embeddings(spark):
    from tunesmith.llm.embed import near_duplicates
    rng = np.random.default_rng(5)
    data, centre = [], rng.normal(size=16)
    for i in range(300):
        v = centre + rng.normal(size=16) * 0.12 if i % 3 == 0 else rng.normal(size=16)
        data.append((i, [float(np.float32(x)) for x in v], i % 2))
    data += [(300, data[0][1], 0), (301, data[0][1], None), (302, None, 0), (303, [0.0] * 16, 0),
             (304, [float("nan")] + [1.0] * 15, 0), (305, [None] + [1.0] * 15, 0),
             (306, [float("inf")] + [1.0] * 15, 1), (None, data[0][1], 0), (307, [], 1)]
    table = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int")
    out = {r["vec_id"]: r for r in near_duplicates(table, tile=32).collect()}
    good = [(i, np.array(v, float), la) for i, v, la in data
            if i is not None and i <= 300 and la is not None]
    links = {i: set() for i, _, _ in good}
    for i, v, la in good:
        for j, w, lb in good:
            if i != j and la == lb and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= 0.98:
                links[i].add(j)
    total = sum(map(len, links.values()))
    found = sum(out[i]["n_links"] for i in links)
    assert total > 500 and 0.9 * total <= found <= total
    assert all(out[i]["n_links"] <= len(links[i]) for i in links)
    for i in (301, 302, 303, 304, 305, 306, 307):
        assert out[i]["n_links"] == 0 and out[i]["component_id"] == i and out[i]["kept"]
    assert out[None]["n_links"] == 0 and not out[None]["kept"]
    assert out[300]["component_id"] == 0 and not out[300]["kept"]
    assert near_duplicates(table.limit(0)).count() == 0


# 2 -------------------------------------------------------------------------

def test_line_dedup(docs, rows, empty):
    from tunesmith.llm.linededup import drop_recurring_lines, line_dedup
    out = {r["doc_id"]: r for r in line_dedup(docs).collect() if r["doc_id"] is not None}
    # "first line <*>" and "Copyright <*> ACME" stand in 9, 10 and 11
    assert out[9]["text"] == "first line 12\nsecond line\nCopyright 2001 ACME"
    assert out[10]["text"] == "other words here" and out[10]["n_dropped"] == 2
    assert out[11]["text"] == "" and out[4]["text"] is None and out[5]["text"] == ""
    assert out[2]["text"] == ""               # third document with the line of 1
    assert out[7]["n_dropped"] == 0
    cut = drop_recurring_lines(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert all(r["n_chars"] is None or r["n_chars"] == len(r["text"]) for r in cut.collect())
    assert line_dedup(empty).count() == 0


def test_leaf_template(spark):
    from tunesmith.llm.linededup import line_dedup
    data = [(i, f"user logged in from host {w} after a short wait") for i, w in enumerate(
        ["alpha", "beta", "gamma", "delta"])]
    data += [(9, "user logged in quite another way with other words here now")]
    out = {r["doc_id"]: r["n_dropped"] for r in line_dedup(
        spark.createDataFrame(data, "doc_id bigint, text string")).collect()}
    assert out == {0: 0, 1: 1, 2: 1, 3: 1, 9: 0}


def names(n):
    return ["".join(chr(97 + int(c)) for c in str(i)) for i in range(n)]


def test_leaf_with_several_templates(spark):
    from tunesmith.llm.linededup import line_dedup
    forms = ["posted by user {} in the general news section today",
             "posted by user {} on a forum for sports fans",
             "posted by user {} while reading about some old ships"]
    for sizes in ((30, 20, 0), (12, 12, 12), (25, 5, 4)):
        data = [(100 * k + i, forms[k].format(w)) for k, n in enumerate(sizes)
                for i, w in enumerate(names(n))]
        prose = [(900 + i, f"posted by user {w} {w}a {w}b {w}c {w}d {w}e {w}f") for i, w in
                 enumerate(names(20))]
        out = {r["doc_id"]: r["n_dropped"] for r in line_dedup(spark.createDataFrame(
            data + prose, "doc_id bigint, text string")).collect()}
        assert out == {**{i: int(i % 100 > 0) for i, _ in data}, **{i: 0 for i, _ in prose}}


def test_long_lines_recur_from_two_documents(spark):
    from tunesmith.llm.linededup import line_dedup
    passage = " ".join(f"word{w}" for w in names(52)) + " in 1999"
    short = "a line of six words here"
    table = " ".join(str(100 + i) for i in range(30))
    data = [(1, f"alpha beta\n{passage}\n{short}\n{table}"),
            (2, f"gamma\n {passage.replace(' ', '  ')}\n{short}\n{table[::-1]}"),
            (3, f"delta epsilon\n{passage[:-4]}2001")]
    out = {r["doc_id"]: tuple(r)[2:] for r in line_dedup(spark.createDataFrame(
        data[:2], "doc_id bigint, text string")).collect()}
    assert out == {1: (0, data[0][1]), 2: (1, f"gamma\n{short}\n{table[::-1]}")}
    # three of the generalised line: only the first stays
    out = {r["doc_id"]: r["text"] for r in line_dedup(spark.createDataFrame(
        data, "doc_id bigint, text string")).collect()}
    assert out[1] == data[0][1] and out[3] == "delta epsilon"
    assert out[2] == f"gamma\n{short}\n{table[::-1]}"


# 3 -------------------------------------------------------------------------

def test_sharding(docs, rows, empty):
    from tunesmith.llm.sharding import shard_documents
    out = shard_documents(docs, 4).collect()
    assert len(out) == len(rows)
    sizes = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                    for i, t, _, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == sizes
    for shard in range(4):
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 4) for r in out)
    assert shard_documents(empty).count() == 0


def test_weighted_shards(spark):
    from tunesmith.llm.sharding import rendezvous
    from pyspark.sql import functions as F
    n = spark.range(20000).select(rendezvous(F.col("id"), [1, 3]).alias("s"))
    share = n.agg({"s": "avg"}).first()[0]
    assert abs(share - 0.75) < 0.02


# 4 -------------------------------------------------------------------------

@pytest.mark.parametrize("options", [{}, {"batch_chars": 50, "head_words": 5}])
def test_bpe(docs, rows, empty, options):
    import base64

    import public_tokenizers as P
    import tiktoken

    from tunesmith.llm.bpe import decode, digests, encode
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, t, _, _ in rows:
        ids = lib.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
              hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in digests(docs, path, P.PATTERN, **options).collect()) == want
    if not options:
        back = decode(encode(docs, path, P.PATTERN), path).collect()
        assert sorted(bytes(r["decoded"]) for r in back) == sorted((t or "").encode()
                                                                    for _, t, _, _ in rows)
        assert digests(empty, path, P.PATTERN).count() == 0


def test_bpe_batch_memory():
    """A batch holds its distinct parts, not every part of every document."""
    import tracemalloc
    from types import SimpleNamespace

    import public_tokenizers as P
    import pyarrow as pa

    from tunesmith.llm.bpe import _batcher, load_ranks
    text = " ".join(f"w{i}x" for i in range(500))
    rows = pa.RecordBatch.from_arrays([pa.array(range(800), pa.int64()), pa.array([text] * 800)],
                                      ["doc_id", "text"])
    run = _batcher(P.PATTERN, load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), 1 << 22,
                   pa.int64(), (SimpleNamespace(value=b""), None))
    tracemalloc.start()
    try:
        (batch,) = run(iter([rows]))
        # 400,000 parts: 34 MB when all of them are held at once
        assert tracemalloc.get_traced_memory()[1] < 22e6
    finally:
        tracemalloc.stop()
    assert len(set(batch.column(1)[0].as_py())) == 1


def test_bpe_folds_by_pair_table(spark):
    """Folded states have the heap's ids, also where a whole word's rank is not
    what its merges give; the ranks stand in a joined row, not in the plan."""
    import random

    import pyarrow as pa

    from tunesmith.llm.bpe import _starter, _word_ids, merge_long, merged, pair_table
    dice = random.Random(3)
    pieces = [bytes([b]) for b in range(256)]
    while len(pieces) < 700:
        piece = bytes(dice.choice(b"abc") for _ in range(dice.randint(2, 6)))
        if piece not in pieces:
            pieces.append(piece)
    pieces[300:] = dice.sample(pieces[300:], 400)
    words = [bytes(dice.choice(b"abcd") for _ in range(dice.randint(1, 32))) for _ in range(400)]
    rows = spark.createDataFrame(pa.table({"states": pa.ListArray.from_arrays(
        [0, 150, 150, 400], _starter(pieces)(words))}))
    out = merged(rows, *pair_table(pieces))
    assert len(out._jdf.queryExecution().toString()) < 50_000
    ids, sizes = _word_ids(out.toArrow()["states"].combine_chunks().flatten())
    ranks = {p: i for i, p in enumerate(pieces)}
    want = [merge_long(w, ranks) for w in words]
    assert ids.tolist() == [i for w in want for i in w]
    assert sizes.tolist() == [len(w) for w in want]


def test_bpe_state_is_narrow(spark):
    """A state has one element for each piece and the two ends, before and after
    the fold, and the fold takes none out by slices; of equal ranks the first
    pair merges, also where two different pairs make one piece."""
    import pyarrow as pa

    from tunesmith.llm.bpe import _starter, _word_ids, merge_long, merged, pair_table
    pieces = [bytes([b]) for b in range(256)] + [b"ba", b"ab", b"aba", b"bab", b"abab"]
    words = [b"a", b"c", b"abaab", b"ababa", b"aababab", b"b" * 32, b"ab" * 16, b"babaabab"]
    states = _starter(pieces)(words)
    assert states.value_lengths().to_pylist() == [3 if w in pieces else len(w) + 2 for w in words]
    rows = spark.createDataFrame(pa.table({"states": pa.ListArray.from_arrays([0, 8], states)}))
    out = merged(rows, *pair_table(pieces))
    assert "slice(" not in out._jdf.queryExecution().toString()
    folded = out.toArrow()["states"].combine_chunks().flatten()
    ranks = {p: i for i, p in enumerate(pieces)}
    want = [merge_long(w, ranks) for w in words]
    ids, sizes = _word_ids(folded)
    assert ids.tolist() == [i for w in want for i in w]
    assert sizes.tolist() == [len(w) for w in want]
    assert folded.value_lengths().to_pylist() == [len(w) + 2 for w in want]


def test_bpe_memory_of_workers(spark, docs):
    """Texts go to Python in small batches whatever the session says, and a
    worker that assembles holds no word cache."""
    from types import SimpleNamespace

    import public_tokenizers as P

    from tunesmith.llm import bpe
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, path = spark.conf.get(name), P.path("byte_bpe_multi_50k.tiktoken")
    try:
        for own, want in (("10000", "1024"), ("0", "1024"), ("100", "100")):
            spark.conf.set(name, own)
            bpe.encode(docs, path, P.PATTERN)
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)
    bpe._known(b"61 62", P.PATTERN)
    head = (None, SimpleNamespace(value=(np.zeros(0, np.int64), np.zeros(0, np.int32))))
    assert bpe._LAST and not list(bpe._assembler("doc_id", head)(iter([]))) and not bpe._LAST


def test_bpe_plan_has_no_ranks(docs):
    import public_tokenizers as P

    from tunesmith.llm.bpe import digests
    out = digests(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    # the driver keeps plans as text: with the ranks in them some MB for each
    assert len(out._jdf.queryExecution().toString()) < 50_000


def test_bpe_word_counts_in_pieces():
    """Counts go out by characters, not by Arrow batch; their sums are the same."""
    import public_tokenizers as P
    import pyarrow as pa
    import regex

    from tunesmith.llm.bpe import _word_counts
    texts = [" ".join(f"{k % 7}y{i}" for i in range(100)) for k in range(60)] + [None, "", "  a "]
    rows = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    out = list(_word_counts(P.PATTERN, 4096)(iter([rows])))
    assert len(out) > 5 and max(b.num_rows for b in out) < 1500
    got = Counter()
    for batch in out:
        for word, n in zip(*(c.to_pylist() for c in batch.columns)):
            got[bytes.fromhex(word).decode()] += n
    assert got == Counter(m for t in texts for m in regex.findall(P.PATTERN, t or ""))


# 5 -------------------------------------------------------------------------

def test_mixing(docs, rows, empty):
    from tunesmith.llm.mixing import mix_documents, plan_mix
    out = plan_mix(docs, block=4).collect()
    size = Counter()
    for _, t, _, s in rows:
        size[s] += len(words(t))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, total = {}, 1.5 * sum(size.values())
    free = [s for s in names]
    while True:                                   # fill up, reshare the excess
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 2.0 * size[s]
            free.remove(s)
    by_size = {r["source_size"]: r["target"] for r in out}
    for s in names:
        assert by_size[size[s]] == pytest.approx(target[s])
    assert sum(r["taken"] for r in out) == pytest.approx(total, abs=4 * len(names))
    assert all(r["taken"] <= 2 * r["size"] for r in out)
    mixed = mix_documents(docs, block=4)
    assert mixed.columns == docs.columns
    assert sum(len(words(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in out)
    assert plan_mix(empty).count() == 0 and mix_documents(empty).count() == 0


def test_quotas_are_highest_quotients(spark):
    from tunesmith.llm.mixing import shard_quotas, source_quotas
    sizes = {"a": 5300, "b": 3100, "c": 900, "d": 450}
    table = spark.createDataFrame([(k, k, v) for k, v in sizes.items()],
                                  "source_key string, source string, size bigint")
    out = {r["source_key"]: r for r in source_quotas(table, block=100).collect()}
    target = {k: out[k]["target"] for k in sizes}
    seats = Counter()
    for _ in range(sum(out[k]["quota"] for k in sizes)):
        seats[max(sizes, key=lambda k: target[k] / (2 * seats[k] + 1))] += 1
    assert {k: out[k]["quota"] for k in sizes} == dict(seats)
    for n in (3, 16, 100):
        dealt = shard_quotas(source_quotas(table, block=100), n).collect()
        for k in sizes:
            mine = sorted((r for r in dealt if r["source_key"] == k), key=lambda r: r["shard"])
            quota, blocks = out[k]["quota"], out[k]["n_blocks"]
            assert sum(r["blocks"] for r in mine) == quota
            assert [r["first"] for r in mine] == [0, *[r["last"] for r in mine[:-1]]]
            assert mine[-1]["last"] == blocks
            for r in mine:
                own = r["last"] - r["first"]
                assert abs(r["blocks"] - quota * own / blocks) < 1 and r["blocks"] <= 2 * own
                assert r["blocks"] == r["passes"] * own + r["rest"] and 0 <= r["start"] < own


@pytest.mark.parametrize("shards,block", [(1, 5), (4, 3), (16, 8)])
def test_blocks_are_taken_shard_by_shard(spark, shards, block):
    """Every word's takes from the quotas, in plain Python."""
    import hashlib

    from tunesmith.llm.mixing import mix_documents, plan_mix, shard_quotas, source_quotas
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(rng.integers(0, 40))), "abc"[i % 3] if i % 7 else None)
            for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    plan = {r["doc_id"]: r for r in plan_mix(df, block=block, shards=shards).collect()}
    sized = spark.createDataFrame([(f'{{"s":"{s}"}}' if s else "{}", s, len(words(t))) for _, t, s in rows],
                                  "source_key string, source string, size bigint")
    quotas = source_quotas(sized, block=block)
    takes = Counter()
    for r in shard_quotas(quotas, shards).collect():
        key, own = r["source_key"], r["last"] - r["first"]
        start = int(hashlib.md5(f"17:start:{r['shard']}:{key}".encode()).hexdigest()[:12], 16) % own
        for i in range(r["blocks"]):
            turn = i - r["passes"] * own
            at = r["first"] + (i % own if turn < 0 else (start + turn) % own)
            takes.update((key, at * block + w) for w in range(block))
    want = Counter()
    for i, t, s in rows:
        key, ws = f'{{"s":"{s}"}}' if s else "{}", words(t)
        mine = [takes[(key, plan[i]["offset"] + k)] for k in range(len(ws))]
        assert plan[i]["taken"] == sum(mine) and max(mine, default=0) <= 2
        for c in range(1, max(mine, default=0) + 1):
            want[(i, t if min(mine) >= c else " ".join(w for w, n in zip(ws, mine) if n >= c), s)] += 1
    for n in (4, 1):                              # reruns agree, also dealt otherwise
        got = mix_documents(df.repartition(n), block=block, shards=shards).collect()
        assert Counter(tuple(r) for r in got) == want


# 6 -------------------------------------------------------------------------

def test_dac_files(spark, docs, rows, empty):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from tunesmith.llm.dac import read_documents, tokens_at, write_tokens
    from tunesmith.session import scratch_path
    path, model = scratch_path(spark, "dac"), P.path("byte_bpe_50k.json")
    write_tokens(docs, path, model, segment_tokens=700)
    lib = Tokenizer.from_file(model)
    want = Counter()
    for i, t, _, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        want[(i, np.array(ids, "<u4").tobytes())] += 1
    out = read_documents(spark, path).collect()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in out) == want
    out.sort(key=lambda r: r["start"])
    stream = np.frombuffer(b"".join(bytes(r["ids"]) for r in out), "<u4")
    assert [r["start"] for r in out] == np.cumsum([0] + [r["n_tokens"] for r in out])[:-1].tolist()
    assert [key([r["doc_id"]]) for r in out] == sorted(key([r["doc_id"]]) for r in out)
    ask = [0, 1, 511, 512, 513, 700, len(stream) // 2, len(stream) - 1]
    assert {r["position"]: r["token"] for r in tokens_at(spark, path, ask).collect()} == {
        p: int(stream[p]) for p in ask}
    none = scratch_path(spark, "dac")
    write_tokens(empty, none, model)
    assert read_documents(spark, none).count() == 0


def test_dac_ids_are_the_librarys_own(monkeypatch):
    """Special tokens spelled in texts, white space of all kinds, memos that
    overflow, and texts that share no batch."""
    import pyarrow as pa
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from tunesmith.llm import dac
    model = P.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(model)
    assert lib.encode("it <|endoftext|> ends", add_special_tokens=False).ids == [270, 220, 50256, 5645]
    rng = np.random.default_rng(9)
    pieces = ["it", "ends", "<|endoftext|>", "don't", "a1", "\u3000", "\xa0", "\n", "\n\n", " ", "  ", "\t",
              "\x1c", "\x85", "日本", "🙂", "x" * 90, "<|endof", "text|>", "Ünï", "\u2028", "'s", "!", "..."]
    texts = ["", " ", "<|endoftext|>", "it <|endoftext|> ends", "a  b", " lead", "trail "]
    texts += ["".join(p if rng.random() < 0.4 else p + " " for p in rng.choice(pieces, rng.integers(1, 30)))
              for _ in range(400)]
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    for memo in (dac._MEMO, 12):
        monkeypatch.setattr(dac, "_MEMO", memo)
        encoder = dac.Encoder(open(model, encoding="utf-8").read())
        for size in (1, 50, 400):
            got = []
            for low in range(0, len(texts), size):
                ids, ends = encoder.encode(pa.array(texts[low:low + size]))
                got += [x.tolist() for x in np.split(ids, ends[:-1])]
            assert got == want
        assert len(encoder.parts) <= max(memo, 12)
    assert encoder.encode(pa.array([], pa.string()))[0].size == 0


def test_dac_divides_rows_of_one_id(spark):
    import public_tokenizers as P

    from tunesmith.llm.dac import read_documents, write_tokens
    from tunesmith.session import scratch_path
    rows = [(None if i % 3 else i, f"text number {i}") for i in range(4000)] + [(None, "same text")] * 2000
    path = scratch_path(spark, "dac")
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    write_tokens(df, path, P.path("byte_bpe_50k.json"))
    parts = {r["part"]: r["n"] for r in spark.read.parquet(path).selectExpr(
        "part", "size(doc_ids) AS n").groupBy("part").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert sum(parts.values()) == 6000 and max(parts.values()) < 6000 / 3
    out = read_documents(spark, path).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(i for i, _ in rows)


def test_dac_image_random():
    from tunesmith.llm.dac import Image, pack
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 1 << rng.integers(1, 32, 5000)).astype(np.uint32)
    image, at = Image(pack(ids)), rng.integers(0, 5000, 800)
    assert (image.at(at) == ids[at]).all() and (image.between(0, 5000) == ids).all()
    assert (image.between(4097, 4100) == ids[4097:4100]).all() and len(image) == 5000
    assert len(Image(pack(ids[:0]))) == 0


# 7 -------------------------------------------------------------------------

def brute_repeats(rows, length):
    seen, out = {}, []
    for i, t, _, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            first = seen.setdefault(data[p:p + length], (i, p))
            if first != (i, p):
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for q in range(len(gone)) if gone[q] and (q == 0 or not gone[q - 1]))
        out.append((i, len(data), sum(gone), spans,
                    bytes(c for c, g in zip(data, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("batch", ["10000", "37"])
def test_repeats(spark, docs, rows, empty, batch):
    from tunesmith.llm.repeats import remove_repeats
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        # null ids first; two different rows without an id share none of their text
        out = Counter((*tuple(r)[:4], bytes(r[4])) for r in remove_repeats(docs).collect())
        assert out == brute_repeats(rows, 100)
        assert remove_repeats(empty).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_repeats_random(spark):
    from tunesmith.llm.repeats import remove_repeats
    rng = np.random.default_rng(11)
    pool = ["".join(rng.choice(list("ab cde"), 260)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(4):
            p = pool[rng.integers(6)]
            a = int(rng.integers(0, 120))
            parts.append(p[a:a + int(rng.integers(60, 200))] + "".join(rng.choice(list("xyz"), 5)))
        rows.append((i, "".join(parts), None, None))
    table = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    out = Counter((*tuple(r)[:4], bytes(r[4])) for r in remove_repeats(table).collect())
    assert out == brute_repeats(rows, 100)


def row_halves(i, text):
    digest = hashlib.md5(f"{'n' if i is None else f'i{i}'}|t{text}".encode()).digest()
    return np.frombuffer(digest, ">i8").tolist()


def brute_rows(rows, length):
    """As ``brute_repeats``; an occurrence is (id, row key, place)."""
    seen, gone = {}, {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, row_halves(*r))):
        data = t.encode()
        cut = gone[i, t] = bytearray(len(data))
        for p in range(len(data) - length + 1):
            first = seen.setdefault(data[p:p + length], (i, t, p))
            if first != (i, t, p):
                cut[p:p + length] = b"\1" * length
    return Counter((i, len(gone[i, t]), sum(gone[i, t]),
                    bytes(c for c, g in zip(t.encode(), gone[i, t]) if not g)) for i, t in rows)


def kept_rows(df):
    return Counter((r[0], r[1], r[2], bytes(r[4])) for r in df.collect())


def shared_passage(n, ident):
    rng = np.random.default_rng(3)
    passage = "".join(rng.choice(list("abcdefgh "), 300))
    return [(ident(i), "".join(rng.choice(list("mnopqrst"), rng.integers(5, 150))) + passage
             + "".join(rng.choice(list("mnopqrst"), 120))) for i in range(n)]


@pytest.mark.parametrize("crowd", [8192, 3])
def test_repeats_rows_of_one_id(spark, crowd):
    from tunesmith.llm.repeats import remove_repeats
    rows = shared_passage(24, lambda i: (None, 7, i)[i % 3])
    rows += [rows[0], rows[0], rows[1], (None, "clean " * 9), (7, "short")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert kept_rows(remove_repeats(table, crowd=crowd)) == brute_rows(rows, 100)


def test_repeats_crowded_passage(spark, monkeypatch):
    from tunesmith.llm import repeats as R
    rows = shared_passage(60, lambda i: i)
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    parts, sizes = R.partial_repeats, []

    def watched(*args):
        members, windows = parts(*args)
        sizes.append((members.groupBy("key").count().agg({"count": "max"}).first()[0] or 0,
                      windows.count()))
        return members, windows

    monkeypatch.setattr(R, "partial_repeats", watched)
    want = brute_rows(rows, 100)
    for crowd in (8192, 20, 1):
        assert kept_rows(R.remove_repeats(table, crowd=crowd)) == want
    # one group of all members, then none above the limit and windows instead
    assert sizes[0][0] > 20 and sizes[0][1] == 0
    assert sizes[1][0] <= 20 and sizes[2][0] <= 1 and sizes[1][1] > 0


def test_suffix_array():
    from tunesmith.llm.gsaca import suffix_array
    rng = np.random.default_rng(2)
    for _ in range(600):
        s = rng.integers(0, rng.integers(1, 6), rng.integers(0, 40)).tolist()
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


# 8 -------------------------------------------------------------------------

def simhash(text):
    ws = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    bits = np.zeros(64, int)
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        bits += np.array([h >> b & 1 for b in range(64)])
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams))


@pytest.mark.parametrize("tile", [1024, 3])
def test_simhash(spark, docs, rows, empty, tile):
    from tunesmith.llm import simhash as S
    near = [(100 + i, " ".join(f"tok{j}" for j in range(400) if j != 7 * i), "en", "z")
            for i in range(40)]
    both = [*rows, *near]
    table = spark.createDataFrame([(r[0], r[1]) for r in both], "doc_id bigint, text string")
    prints = [simhash(t) for _, t, _, _ in both]
    root = list(range(len(both)))
    for _ in both:
        for i, a in enumerate(prints):
            root[i] = min(root[j] for j, b in enumerate(prints) if (a ^ b).bit_count() <= 4)
    ids = {}
    for i, r in enumerate(both):
        if r[0] is not None:
            ids[root[i]] = min(ids.get(root[i], 1 << 60), r[0])
    want = Counter((r[0], f"{p:016x}", ids.get(root[i])) for i, (r, p) in enumerate(zip(both, prints)))
    out = Counter(tuple(r) for r in S.near_duplicates(table, tile=tile).collect())
    assert out == want
    if tile > 3:
        kept = S.keep_representatives(docs)
        assert kept.columns == docs.columns
        assert S.near_duplicates(empty).count() == 0


def test_representatives_by_row(spark):
    from tunesmith.llm.simhash import keep_representatives
    a, b, c, d = (" ".join(f"{x}{i * 7 % 83}{x}" for i in range(60)) for x in "abcd")
    schema = "doc_id bigint, text string, `__keep_same` string, `meta.lang` string, fingerprint string"
    rows = [(3, a, "k", "m", "f"), (7, a, "k", "m", "f"), (7, b, "k", "m", "f"), (9, c, "k", "m", "f"),
            (9, d, "k", "m", "f"), (None, d, "k", "m", "f"), (None, "alone here", "k", "m", "f"),
            (11, b, "k", "m", "f"), (7, b, "k", "m", "f")]
    for n in (1, 4):
        out = keep_representatives(spark.createDataFrame(rows, schema).repartition(n))
        assert out.columns == ["doc_id", "text", "__keep_same", "meta.lang", "fingerprint"]
        assert sorted(((r[0], r[1]) for r in out.collect()), key=str) == sorted(
            [(3, a), (7, b), (9, c), (9, d), (None, "alone here")], key=str)


# 9 -------------------------------------------------------------------------

def test_quality(spark, docs, rows, empty):
    from tunesmith.llm.quality import keep_good, quality_rules
    junk = [(200 + i, " ".join(f"word{i}x{j}$$$" for j in range(40)), "en", "a") for i in range(2)]
    rng = np.random.default_rng(1)
    clean = [(300 + i, " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9)))
                                for _ in range(60)), "en", "a") for i in range(40)]
    both = [*rows, *junk, *clean]
    table = spark.createDataFrame([r for r in both], "doc_id bigint, text string, lang string, "
                                                     "source string")
    out = quality_rules(table).collect()
    want = Counter()
    for i, t, _, _ in both:
        ws = words(t)
        seen = {}
        for j in range(len(ws) - 7):
            seen.setdefault(tuple(ws[j:j + 8]), []).append(j)
        covered = {k for v in seen.values() if len(v) > 1 for j in v for k in range(j, j + 8)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want[(i, len(ws), sum(map(len, ws)), sum((t or "").count(c) for c in "#*$%&|<>"),
              len(lines) - len(set(lines)), len(covered),
              len(ws) < 20 or 100 * len(covered) > 30 * len(ws))] += 1
    assert Counter(tuple(r)[:7] for r in out) == want
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert not kept[200] and not kept[201] and all(kept[i] for i, *_ in clean)
    good = keep_good(docs)
    assert good.columns == docs.columns and good.filter("doc_id = 1").count() == 2
    assert quality_rules(empty).count() == 0 and keep_good(empty).count() == 0


# 10 ------------------------------------------------------------------------

def test_secrets(spark, docs, rows, empty):
    from tunesmith.llm.blobscan import RULES, scan_secrets
    from tunesmith.session import scratch_path
    ledger = scratch_path(spark, "ledger")
    out = scan_secrets(docs, ledger=ledger)
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                        r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    want = Counter()
    for i, t, _, _ in rows:
        t = t or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t)
                  if len(m[0]) >= 20]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t)
                  if len(m[0]) >= 24]
        base = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        n = Counter(k for _, _, k, _ in spans)
        want[(i, n["assign"], n["access"], n["hex"],
              hashlib.sha256(base.encode()).hexdigest(), base)] += 1
    assert Counter(tuple(r) for r in out.collect()) == want
    # nothing is scanned again; a new rule version is, for every blob
    size = spark.read.parquet(ledger).count()
    assert Counter(tuple(r) for r in scan_secrets(docs, ledger=ledger).collect()) == want
    assert spark.read.parquet(ledger).count() == size
    newer = (*RULES[:-1], RULES[-1]._replace(version=2))
    scan_secrets(docs, ledger=ledger, rules=newer)
    blobs = spark.read.parquet(ledger).select("blob").distinct().count()
    assert spark.read.parquet(ledger).count() == size + blobs
    assert scan_secrets(empty).count() == 0


# pipeline ------------------------------------------------------------------

def test_pipeline(spark, docs, empty):
    import corpus_pipeline as cp

    from tunesmith.llm.common import stored
    for table in (docs, empty):
        now = table
        for name, stage in cp.STAGES:
            now = stored(stage(spark, now, ""), f"test-{name}")
            assert name == "bpe" or now.columns == table.columns
        assert (now.count() > 0) == (table is docs)
