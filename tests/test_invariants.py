"""Invariants: positions, splits, vocabulary paths, sources, streams."""

import pytest
from pyspark.sql import functions as F

from tunesmith.operators import position as PO
from tunesmith.operators import split as SP
from tunesmith.operators import vocab as VO
from tunesmith.plans import views as V
from tunesmith.sources import readers as R
from tunesmith.sources import sinks as S
from tunesmith.streaming import files as ST


def test_positions_do_not_depend_on_partitioning(spark, sf_dir):
    docs = V.documents(spark, sf_dir).select("doc_id")
    a = {r.doc_id: r.pos for r in PO.with_position(docs.repartition(1), "doc_id").collect()}
    b = {r.doc_id: r.pos for r in PO.with_position(docs.repartition(17), "doc_id",
                                                   num_partitions=5).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(len(a)))


def test_splits_disjoint_and_complete(spark, sf_dir):
    docs = V.documents(spark, sf_dir).select("doc_id")
    for exact in (False, True):
        s = SP.train_eval_split(docs, "doc_id", exact=exact)
        counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
        assert sum(counts.values()) == docs.count()
        assert s.select("doc_id").distinct().count() == docs.count()
    n = docs.count()
    exact = SP.train_eval_split(docs, "doc_id", exact=True)
    assert exact.filter(F.col("split") == "train").count() == -(-n * 4 // 5)


def test_hash_split_is_stable_under_repartition(spark, sf_dir):
    docs = V.documents(spark, sf_dir).select("doc_id")
    a = {r.doc_id: r.split for r in SP.train_eval_split(docs.repartition(3), "doc_id").collect()}
    b = {r.doc_id: r.split for r in SP.train_eval_split(docs.repartition(11), "doc_id").collect()}
    assert a == b


def test_encoding_does_not_depend_on_batches(spark, sf_dir, monkeypatch):
    from tunesmith.operators import lookup
    conv = V.conversations(spark, sf_dir).select("conv_id", "turn", "text")
    vocab = VO.build_vocab(conv, "text")
    spec = {"ids": ("text", None, True)}
    a = VO.encode(conv, ["conv_id", "turn"], spec, vocab, keep_input=False)
    for f, small in ((lookup.resolve, {"batch_rows": 7, "batch_bytes": 1 << 11}),):
        monkeypatch.setattr(VO, "resolve", lambda *x, **k: f(*x, **{**k, **small}))
        b = VO.encode(conv.repartition(5), ["conv_id", "turn"], spec, vocab)
        dec = VO.decode(b, ["conv_id", "turn"], "ids", vocab, out="back")
    assert {(r.conv_id, r.turn): r.ids for r in a.collect()} == {
        (r.conv_id, r.turn): r.ids for r in b.collect()}
    rows = dec.collect()
    assert len(rows) == conv.count() and all(r.back == " ".join(r.text.split()) for r in rows)


def test_scratch_folders_go_with_their_scope(spark, sf_dir):
    from pathlib import Path

    from tunesmith.session import scratch_path, scratch_scope
    base = Path(scratch_path(spark, "outside").replace("file:", "", 1)).parent
    before = set(base.iterdir())
    with scratch_scope(spark) as made:
        conv = V.conversations(spark, sf_dir).select("conv_id", "turn", "text")
        vocab = VO.build_vocab(conv, "text")
        enc = VO.encode(conv, ["conv_id", "turn"], {"ids": ("text", None, True)}, vocab)
        with scratch_scope(spark) as inner:
            assert VO.decode(enc, ["conv_id", "turn"], "ids", vocab).count() == conv.count()
        assert len(inner) == 1 and not set(base.iterdir()) & {Path(p.replace("file:", "", 1)) for p in inner}
        assert enc.count() == conv.count() and len(set(base.iterdir()) - before) >= 2
    assert made and set(base.iterdir()) == before


def test_rows_of_one_key_stay_apart(spark):
    rows = [(1, "a b"), (1, "b c"), (1, "b c"), (None, "zz"), (None, None), (2, ""), (2, " \n")]
    df = spark.createDataFrame(rows, "k bigint, text string")
    vocab = VO.build_vocab(df, "text", min_count=2)         # b and c; the others are unknown
    ids = {r.token: r.id for r in vocab.table.collect()}
    assert ids == {"b": 4, "c": 5}
    enc = VO.encode(df, "k", {"ids": ("text", None, True)}, vocab, keep_input=False)
    got = sorted(((r.k, r.ids) for r in enc.collect()), key=str)
    assert got == sorted([(1, [2, 3, 4]), (1, [2, 4, 5]), (1, [2, 4, 5]), (None, [2, 3]), (None, [2]),
                          (2, [2]), (2, [2])], key=str)
    dec = VO.decode(enc, "k", "ids", vocab, keep_input=False)
    assert sorted(((r.k, r.decoded) for r in dec.collect()), key=str) == sorted(
        [(1, "b"), (1, "b c"), (1, "b c"), (None, ""), (None, ""), (2, ""), (2, "")], key=str)
    assert VO.encode(df.limit(0), "k", {"ids": ("text", None, True)}, vocab).count() == 0


def test_long_turns_are_encoded_whole_and_agree_with_sql(spark, tmp_path):
    """The queries and their SQL on a turn of more than 1,023 words."""
    import duckdb

    from tunesmith.plans import registry
    long = " ".join(f"w{i % 700}" for i in range(1500))
    rows = [(0, 0, "user", long), (0, 1, "assistant", "w1 w2 w3"), (1, 0, "user", "w5"),
            (1, 1, "assistant", long + " end")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1) \
        .write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    for name in ("tok3_decode", "pos6_preview", "lay9_pad_to"):
        got = registry.queries()[name](spark, str(tmp_path))
        want = con.sql(registry.oracle_sql()[name])
        cols = sorted(got.columns)
        assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(
            want.select(*cols).fetchall()), name


def test_encode_decode_identity_and_truncation(spark):
    df = spark.createDataFrame([(1, "a b  c\nd"), (2, ""), (3, "b b b b")], "k int, text string")
    vocab = VO.build_vocab(df, "text")
    enc = VO.encode(df, "k", {"ids": ("text", 3, True)}, vocab)
    rows = {r.k: r.ids for r in enc.collect()}
    assert rows[2] == [2]
    assert all(len(v) <= 3 and v[0] == 2 for v in rows.values())
    ids = {r.token: r.id for r in vocab.table.collect()}
    assert ids["b"] == 4  # most frequent word gets the first word id
    dec = VO.decode(VO.encode(df, "k", {"ids": ("text", None, True)}, vocab), "k", "ids", vocab)
    assert {r.k: r.decoded for r in dec.collect()} == {1: "a b c d", 2: "", 3: "b b b b"}


def test_shard_sizes(spark, sf_dir, tmp_path):
    docs = V.documents(spark, sf_dir).select("doc_id", "text")
    out = str(tmp_path / "shards")
    S.write_shards(docs, out, "doc_id", rows=30)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"') \
        .schema("doc_id bigint, text string, shard bigint").csv(out)
    sizes = sorted((r.shard, r["count"]) for r in back.groupBy("shard").count().collect())
    n = docs.count()
    assert [c for _s, c in sizes[:-1]] == [30] * (len(sizes) - 1)
    assert sum(c for _s, c in sizes) == n


def test_one_file_for_each_shard(spark, sf_dir, tmp_path):
    docs = V.documents(spark, sf_dir).select("doc_id", "text")
    out = tmp_path / "shards"
    S.write_shards(docs, str(out), "doc_id", rows=30, folder_shards=3)
    n, per_folder = docs.count(), {}
    for f in out.glob("folder=*/*.csv"):
        per_folder.setdefault(int(f.parent.name.split("=")[1]), []).append(f)
    shards = -(-n // 30)
    assert {k: len(v) for k, v in per_folder.items()} == {
        k: min(3, shards - 3 * k) for k in range(-(-shards // 3))}
    schema = docs.schema
    back = S.read_shards(spark, str(out), schema, folder_shards=3)
    want = sorted(r.doc_id for r in docs.collect())
    got = sorted((r.doc_id, r.shard) for r in back.collect())
    assert got == [(d, i // 30) for i, d in enumerate(want)]
    # order is kept inside a file
    for files in per_folder.values():
        for f in files:
            ids = [r.doc_id for r in spark.read.schema(schema).option("header", True).option(
                "multiLine", True).option("escape", '"').csv(str(f)).collect()]
            assert ids == sorted(ids) and 0 < len(ids) <= 30
    one = S.read_shards(spark, str(out), schema, folders=[1], folder_shards=3)
    assert {r.shard for r in one.collect()} == {3, 4, 5}
    p = one._jdf.queryExecution().executedPlan().toString()
    assert "folder#" in p[p.index("PartitionFilters: "):p.index("PushedFilters: ")]


def test_null_messages_keep_their_place(spark):
    from tunesmith.operators import prompts as PM
    data = [(1, [("user", "hi"), ("assistant", None), ("user", "there"), (None, "x"), None])]
    df = spark.createDataFrame(data, "k int, messages array<struct<role:string,content:string>>")
    m = "<|im_start|>{}\n{}<|im_end|>\n".format
    want = m("user", "hi") + m("assistant", "") + m("user", "there") + m("", "x") + m("", "")
    assert PM.chatml(df).first().text == want
    pair = df.select(F.col("messages").alias("chosen"), F.col("messages").alias("rejected"))
    assert tuple(PM.chatml_pair(pair).first()) == (want, want)
    kto = df.select(F.col("messages").alias("prompt"), F.col("messages").alias("completion"))
    assert tuple(PM.chatml_kto(kto).first()) == (want, want)
    turns = spark.createDataFrame([(1, i, *r) for i, r in enumerate(data[0][1][:4])],
                                  "conv_id int, turn int, role string, text string")
    out = {r.turn: r.prompt for r in PM.history_prompt(turns, add_generation_prompt=False).collect()}
    assert out[3] == m("user", "hi") + m("assistant", "") + m("user", "there") + m("", "x")


def test_history_column(spark):
    from tunesmith.operators import prompts as PM
    ex = [("a b", "c"), ("d", None), (None, "e f g")]
    df = spark.createDataFrame([(1, ex, "now"), (2, None, "now"), (3, [], None)],
                               "k int, history array<struct<user:string,assistant:string>>, prompt string")
    m = "<|im_start|>{}\n{}<|im_end|>\n".format
    parts = [m("user", u or "") + m("assistant", a or "") for u, a in ex]
    now = m("user", "now") + "<|im_start|>assistant\n"
    out = {r.k: r.prompt for r in PM.history_column(df).collect()}
    assert out == {1: "".join(parts) + now, 2: now, 3: m("user", "") + "<|im_start|>assistant\n"}
    sizes = [len(p.split()) for p in parts]
    used = len(now.split())
    for limit in range(0, used + sum(sizes) + 2):
        keep = max((k for k in range(4) if k == 0 or used + sum(sizes[3 - k:]) <= limit))
        got = PM.history_column(df, max_tokens=limit).filter("k = 1").first().prompt
        assert got == "".join(parts[3 - keep:]) + now, limit


def test_metrics_store_replaces_a_phase(spark, tmp_path):
    store = str(tmp_path / "metrics")
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "split string, x double")
    S.save_metrics(S.run_metrics(df, "eval", metrics={"x": "x"}), store, "r1")
    S.save_metrics(S.run_metrics(df, "test", metrics={"x": "x"}), store, "r1")
    S.save_metrics(S.run_metrics(df.filter("split = 'a'"), "eval", metrics={"x": "x"}), store, "r1")
    got = sorted(tuple(r) for r in S.read_metrics(spark, store).collect())
    assert got == [("r1", "eval", "a", "eval_samples", 2.0), ("r1", "eval", "a", "eval_x", 2.0),
                   ("r1", "test", "a", "test_samples", 2.0), ("r1", "test", "a", "test_x", 2.0),
                   ("r1", "test", "b", "test_samples", 1.0), ("r1", "test", "b", "test_x", 5.0)]


def test_ngram_index_is_kept_and_probed(spark, tmp_path):
    import random

    from tunesmith.operators.ngram import NgramIndex
    rng = random.Random(5)
    seqs = [[rng.randrange(6) for _ in range(rng.randrange(0, 40))] for _ in range(60)]
    seqs += [seqs[3]] * 30 + [[1, 2, 3]] * 30 + [[], [9]]
    df = spark.createDataFrame(list(enumerate(seqs)), "k bigint, ids array<int>").repartition(4)
    first = {}
    for k, ids in enumerate(seqs):
        for at in range(len(ids)):
            for n in (1, 2, 3):
                if at + n + 10 <= len(ids):
                    first.setdefault(tuple(ids[at:at + n]), (k, at, ids[at + n:at + n + 10]))
    want = {}
    for k, ids in enumerate(seqs):
        hits = [first.get(tuple(ids[len(ids) - n:])) for n in (3, 2, 1) if len(ids) >= n]
        want[k] = next((h for h in hits if h), (None, None, []))
    index = NgramIndex.build(df, "k", "ids", path=str(tmp_path / "index"), buckets=4)
    again = NgramIndex.load(spark, str(tmp_path / "index"), {"k": "bigint"}, buckets=4)
    for ix in (index, again):
        out = ix.probe(df, "ids", place="place").collect()
        assert {r.k: (r.place and r.place.k, r.place and r.place.at, r.candidate) for r in out} == want
    assert index.table.count() == len(first)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = again.probe(df, "ids")._jdf.queryExecution().executedPlan().toString()
        # the index is read in its buckets, not shuffled
        scan = p[:p.index("Bucketed: true")]
        assert "Exchange" not in scan[scan.rindex("FileScan") - 300:]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        NgramIndex.build(df, "k", "ids", max_ngram=3, num_pred=3)
    index.drop()
    again.drop()


def test_pair_rows_cut_before_the_lookup(spark):
    from tunesmith.operators import layout as LA
    rows = [(1, "p " * 20, "c " * 30, "r " * 5), (2, "p q", "c", None), (3, None, "c c", "r"),
            (4, "p " * 9, "c " * 9, "r " * 30)]
    df = spark.createDataFrame(rows, "k int, prompt string, chosen string, rejected string")
    vocab = VO.build_vocab(df.select(F.concat_ws(" ", "prompt", "chosen", "rejected").alias("t")), "t")
    for limits in ((20, 6, None), (20, 6, 4), (512, 128, None), (12, 9, None), (11, 10, 8)):
        ids = VO.encode(df, "k", {"prompt_ids": ("prompt", None, True), "chosen_ids": ("chosen", None, False),
                                  "rejected_ids": ("rejected", None, False)}, vocab)
        a = {r.k: r for r in LA.limit_pair(ids, max_length=limits[0], max_prompt_length=limits[1],
                                           max_target_length=limits[2]).collect()}
        out = LA.pair_rows(df, "k", vocab, max_length=limits[0], max_prompt_length=limits[1],
                           max_target_length=limits[2])
        for r in out.collect():
            assert (r.prompt_ids, r.chosen_ids, r.rejected_ids, r.truncated) == (
                a[r.k].prompt_ids, a[r.k].chosen_ids, a[r.k].rejected_ids, a[r.k].truncated), (limits, r.k)
    share = LA.truncated_share(out).first()
    assert share.n_rows == 4 and share.truncated_share == share.n_truncated / 4


def test_csv_round_trip_quotes_newlines_null(spark, tmp_path):
    rows = [(1, 'say "hi"', "line1\nline2"), (2, "back\\slash", None), (3, "a,b", "")]
    df = spark.createDataFrame(rows, "id bigint, a string, b string")
    out = str(tmp_path / "csv")
    S.write_csv(df, out)
    back = {r.id: (r.a, r.b) for r in R.read_csv(spark, [out], df.schema).collect()}
    assert back[1] == ('say "hi"', "line1\nline2")
    assert back[2] == ("back\\slash", None)
    assert back[3][0] == "a,b" and back[3][1] in ("", None)  # empty -> null in CSV


def test_corrupt_json_file_is_skipped(spark, tmp_path):
    good = tmp_path / "good.json"
    good.write_text('[{"instruction": "a", "input": "", "output": "b"},\n'
                    ' {"instruction": "c", "input": "", "output": "d"}]')
    bad = tmp_path / "bad.json"
    bad.write_text('[{"instruction": "x", "input": "", "output": ')
    schema = "instruction string, input string, output string"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    df = R.read_json_glob(spark, [str(tmp_path / "*.json")], st)
    assert sorted(r.instruction for r in df.collect()) == ["a", "c"]
    assert df.count() == 2
    with pytest.raises(Exception):
        R.read_json_glob(spark, [str(tmp_path / "*.json")], st, on_error="raise").collect()
    ok = R.read_json_glob(spark, [str(good)], st, on_error="raise")
    assert ok.count() == 2


def test_mistyped_values_keep_their_rows(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string("k bigint, t string")
    (tmp_path / "a.json").write_text('[{"k":1,"t":"x"},{"k":"two","t":"y"},{"k":3}]')
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text('[{"k":4')
    glob = [str(tmp_path / "*.json")]
    df = R.read_json_glob(spark, glob, st)
    assert [(r.k, r.t) for r in df.orderBy(F.col("k").asc_nulls_last()).collect()] == [
        (1, "x"), (3, None), (None, "y")]
    assert df.count() == 3
    bad = R.json_glob_rejects(spark, glob, st).collect()
    assert sum(r.record is not None for r in bad) == 1


def test_malformed_lines(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string("k bigint, t string")
    path = tmp_path / "a.jsonl"
    path.write_text('{"k":1,"t":"x"}\n{"k":2,\n\n{"k":"z"}\n{"k":3}\n')
    with pytest.raises(Exception):
        R.read_jsonl(spark, str(path), st).count()
    kept = R.read_jsonl(spark, str(path), st, on_error="reject")
    assert kept.count() == 2 and sorted(r.k for r in kept.collect()) == [1, 3]
    assert R.jsonl_rejects(spark, str(path), st).count() == 2


BAD_LINES = ['{"k":3,', '{"k":4,"t":"d"} junk', '{"k":5,"t":"e"},{"k":6}', '{"k":"z"}', 'null', '[1]', '7']
GOOD_LINES = ['{"k":1,"t":"x"}', '  {"k":2}  ', '{}', '{"t":"a,b] [\\"{"}']


def test_lines_are_judged_alike_by_all_readers(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string("k bigint, t string")
    for n, part in enumerate((BAD_LINES[:3] + GOOD_LINES[:2], ["", "  "] + GOOD_LINES[2:] + BAD_LINES[3:])):
        (tmp_path / f"in-{n}.json").write_text("\n".join(part) + "\n")
    glob = str(tmp_path / "in-*.json")
    good = [(None, None), (None, 'a,b] ["{'), (1, "x"), (2, None)]

    def rows(df):
        return sorted((tuple(r)[:2] for r in df.collect()), key=str)

    def records(df):
        return sorted(r.record for r in df.collect())

    assert rows(R.read_jsonl(spark, glob, st, on_error="reject")) == sorted(good, key=str)
    assert records(R.jsonl_rejects(spark, glob, st)) == sorted(BAD_LINES)
    assert rows(R.read_json(spark, glob, st, on_error="reject")) == sorted(good, key=str)
    assert records(R.json_rejects(spark, glob, st)) == sorted(BAD_LINES)
    for bad in BAD_LINES:
        (tmp_path / "one.json").write_text(bad)
        for read in (R.read_jsonl, R.read_json):
            with pytest.raises(Exception, match="malformed JSON record"):
                read(spark, str(tmp_path / "one.json"), st).collect()
        (tmp_path / "one.json").unlink()
    # the stream keeps and rejects the same, also over a restart with more files
    src = tmp_path / "src"
    src.mkdir()
    out = [str(tmp_path / x) for x in ("kept", "bad", "ckpt")]
    for n in (0, 1):
        (src / f"{n}.json").write_text((tmp_path / f"in-{n}.json").read_text())
        ST.run_with_rejects(spark, str(src), st, *out, transform=lambda df: df.filter("k is null or k < 100"))
    assert rows(spark.read.parquet(out[0]).select("k", "t")) == sorted(good, key=str)
    assert records(spark.read.parquet(out[1])) == sorted(BAD_LINES)
    assert not list((tmp_path / "ckpt-parsed").glob("batch=*"))
    # a batch whose commit was lost runs again under its number
    last = max((tmp_path / "ckpt" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    ST.run_with_rejects(spark, str(src), st, *out)
    assert rows(spark.read.parquet(out[0]).select("k", "t")) == sorted(good, key=str)
    assert records(spark.read.parquet(out[1])) == sorted(BAD_LINES)


def test_array_files_with_null_elements_and_trailing_text(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string("k bigint, t string")
    (tmp_path / "a.json").write_text('[{"k":1},\n null, {"k":"x"}]\n')
    (tmp_path / "b.json").write_text('[{"k":2}] trailing')
    (tmp_path / "c.json").write_text('{"k":3}')
    (tmp_path / "d.json").write_text('[{"k":4}],[{"k":5}]')
    glob = [str(tmp_path / "*.json")]
    df = R.read_json_glob(spark, glob, st)
    assert sorted(((r.k, r.t) for r in df.collect()), key=str) == [(1, None), (None, None)]
    bad = [(r.file[-6:], r.record) for r in R.json_glob_rejects(spark, glob, st).collect()]
    assert sorted(bad, key=str) == sorted([("a.json", "null"), ("a.json", '{"k":"x"}'), ("b.json", None),
                                           ("c.json", None), ("d.json", None)], key=str)
    kept = R.read_json(spark, glob, st, multiline=True, on_error="reject")
    assert [tuple(r) for r in kept.collect()] == [(1, None, "train")]
    assert sorted(r.record for r in R.json_rejects(spark, glob, st, multiline=True).collect()) == sorted(
        ["null", '{"k":"x"}', '[{"k":2}] trailing', '{"k":3}', '[{"k":4}],[{"k":5}]'])


def test_unicode_strip(spark):
    from tunesmith.sources.sinks import strip_ws
    df = spark.createDataFrame([("\u3000\u4f60\u597d\u3000",), ("\xa0x\xa0",)], "t string")
    assert [r[0] for r in df.select(strip_ws("t")).collect()] == ["\u4f60\u597d", "x"]


def test_stream_equals_batch(spark, sf_dir):
    from tunesmith.operators import preference as PR
    from tunesmith.plans.q_io import COMPARISON_SCHEMA
    from tunesmith.session import scratch_path

    comp = V.comparison_view(spark, sf_dir)
    src = scratch_path(spark, "t-stream")
    comp.repartition(3).write.json(src)
    stream = ST.stream_jsonl(spark, src, COMPARISON_SCHEMA)
    sink = scratch_path(spark, "t-sink")
    ST.run_available(PR.parity_pick(stream), sink, scratch_path(spark, "t-ckpt"))
    got = sorted(tuple(r) for r in spark.read.parquet(sink)
                 .select("conv_id", "answer", "label").collect())
    want = sorted(tuple(r) for r in PR.parity_pick(comp).select("conv_id", "answer", "label").collect())
    assert got == want


def test_stateful_operators_reject_streams(spark, sf_dir):
    from tunesmith.plans.q_io import TURN_SCHEMA
    from tunesmith.session import scratch_path

    src = scratch_path(spark, "t-reject")
    V.conversations(spark, sf_dir).write.json(src)
    stream = ST.stream_jsonl(spark, src, TURN_SCHEMA)
    with pytest.raises(ValueError):
        PO.with_position(stream, "conv_id")
    with pytest.raises(ValueError):
        VO.build_vocab(stream, "text")


def test_source_spec_checks():
    from tunesmith.config import SourceSpec
    with pytest.raises(ValueError):
        SourceSpec()
    with pytest.raises(ValueError):
        SourceSpec(train_file="x.txt")
    s = SourceSpec(train_file="a.json", max_target_length=64)
    assert s.val_max_target_length == 64 and s.splits() == {"train": "a.json"}


def test_encode_and_collate_do_not_depend_on_partitioning(spark, sf_dir):
    from tunesmith.operators import layout as LA

    conv = V.conversations(spark, sf_dir).select("conv_id", "turn", "text")
    vocab = VO.build_vocab(conv, "text")

    def run(df):
        enc = VO.encode(df, ["conv_id", "turn"], {"input_ids": ("text", 64, True)}, vocab)
        rows = enc.withColumn("seq_len", F.least(F.size("input_ids"), F.lit(5)))
        pos = PO.with_batch_id(PO.with_position(rows, ["conv_id", "turn"]), 4)
        out = LA.collate(pos)
        return sorted((r.conv_id, r.turn, tuple(r.input_ids), tuple(r.labels), r.row_in_batch)
                      for r in out.collect())

    assert run(conv.repartition(1)) == run(conv.repartition(17))


def test_pad_generated_falls_back_to_eos(spark):
    from tunesmith.config import TokenSpec
    from tunesmith.operators import layout as LA

    df = spark.createDataFrame([([5, 6],)], "generated_ids array<int>")
    r = LA.pad_generated(df, max_new_tokens=3, spec=TokenSpec(pad=None)).first()
    assert r.generated_ids == [5, 6, 1, 1]
    with pytest.raises(ValueError):
        LA.pad_generated(df, max_length=4, spec=TokenSpec(pad=None, eos=None))


def test_vocabulary_save_and_load(spark, sf_dir):
    from tunesmith.session import scratch_path

    conv = V.conversations(spark, sf_dir).select("conv_id", "turn", "text")
    vocab = VO.build_vocab(conv, "text")
    path = scratch_path(spark, "t-vocab")
    vocab.save(path)
    loaded = VO.Vocabulary.load(spark, path)
    assert sorted(tuple(r) for r in loaded.table.collect()) == \
        sorted(tuple(r) for r in vocab.table.collect())
    spec = {"ids": ("text", None, True)}
    a = VO.encode(conv, ["conv_id", "turn"], spec, vocab, keep_input=False)
    b = VO.encode(conv, ["conv_id", "turn"], spec, loaded, keep_input=False)
    assert sorted((r.conv_id, r.turn, tuple(r.ids)) for r in a.collect()) == \
        sorted((r.conv_id, r.turn, tuple(r.ids)) for r in b.collect())
