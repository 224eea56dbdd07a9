"""Physical-plan properties the scale design relies on."""

from pyspark.sql import functions as F

from tunesmith.operators import evaluate as EV
from tunesmith.operators import filters as FL
from tunesmith.operators import vocab as VO
from tunesmith.operators import position as PO
from tunesmith.plans import views as V
from tunesmith.session import scratch_path, scratch_scope


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_comparison_limits_rows_before_the_shuffle(spark, sf_dir):
    p = plan(V.comparison_view(spark, sf_dir))
    assert "WindowGroupLimit" in p and "Partial" in p
    # the partial limit sits below the first exchange
    partial = p.index("Partial")
    assert p.index("Exchange hashpartitioning(conv_id", 0) < partial


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    p = plan(V.instruction_view(spark, sf_dir, False))
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)" in p
    p = plan(FL.reshape(V.documents(spark, sf_dir), ["doc_id", "lang", "n_chars"]))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>" in p


def shape(df) -> list[str]:
    """Operators and keys of the initial physical plan, without numbers."""
    import re

    names = re.sub(r"#\d+L?|\d+", "", plan(df))
    return [re.sub(r"\[.*", "", line.strip(" +-:*()")) for line in names.splitlines()]


def test_encoding_has_one_plan_at_every_size(spark, sf_dir):
    conv = V.conversations(spark, sf_dir).select("conv_id", "turn", "text")
    vocab = VO.build_vocab(conv, "text")
    seen = []
    for size in ("1k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            enc = VO.encode(conv, ["conv_id", "turn"], {"ids": ("text", None, True)}, vocab)
            seen.append((shape(enc), shape(VO.decode(enc, "conv_id", "ids", vocab))))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1]


def test_no_hot_key_when_words_are_looked_up(spark):
    """A word in every row is one entry for each batch; without broadcasts no
    join or group has more than a few percent of the entries of its key."""
    from tunesmith.operators import lookup

    rows = [(i, " ".join(["the"] * 40 + [f"w{i * 7 + j}" for j in range(20)])) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, text string").repartition(4)
    path = scratch_path(spark, "vocab")
    VO.build_vocab(df, "text").save(path)
    vocab = VO.Vocabulary.load(spark, path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen = {}
    try:
        real = lookup.scratch_table

        def keep(table, name):
            seen[name] = real(table, name)
            return seen[name]

        lookup.scratch_table = keep
        enc = VO.encode(df, "k", {"ids": ("text", None, True)}, vocab)
        assert "Broadcast" not in plan(enc)
        assert {r.k: len(r.ids) for r in enc.collect()} == {i: 61 for i in range(400)}
        entries = seen["coded"].select(F.explode("__dict").alias("w"))
        total, hot = entries.count(), entries.filter("w = 'the'").count()
        assert hot <= 0.03 * total
    finally:
        lookup.scratch_table = real
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bleu_counts_need_no_ngram_shuffle(spark, sf_dir):
    preds, refs = V.prediction_view(spark, sf_dir)
    pairs = EV.pair_predictions(preds, refs, ["conv_id", "turn"])
    p = plan(EV.bleu4(pairs, ["conv_id", "turn"]))
    assert "ArrowEvalPython" in p
    # no n-gram rows: nothing is exploded or aggregated
    assert "explode" not in p and "HashAggregate" not in p


def test_hash_split_is_narrow(spark, sf_dir):
    from tunesmith.operators import split as SP

    p = plan(SP.train_eval_split(V.documents(spark, sf_dir).select("doc_id"), "doc_id"))
    assert "Exchange" not in p and "md5" in p


def test_cap_has_one_plan_for_any_size(spark, sf_dir):
    from tunesmith.operators import split as SP

    docs = SP.train_eval_split(V.documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    plans = [FL.cap(docs, n, F.col("doc_id"), by="split") for n in (50, 1001, 50_000)]
    assert shape(plans[0]) == shape(plans[1]) == shape(plans[2])
    # only rows that have the last wanted key itself are numbered
    assert plan(plans[0]).count("Window ") == 1 and "TakeOrdered" not in plan(plans[0])
    assert [len(p.collect()) for p in plans] == [93, docs.count(), docs.count()]


def written_columns(spark, made):
    return {c for path in made for c in spark.read.parquet(path).columns}


def test_position_tables_hold_keys_only(spark, sf_dir):
    from tunesmith.operators import split as SP

    docs = V.documents(spark, sf_dir).select("doc_id", "text", F.split("text", " ").alias("words"))
    for make in (lambda: PO.with_position(docs, "doc_id"), lambda: SP.shuffle(docs, "doc_id"),
                 lambda: FL.cap(docs, 7, "doc_id"), lambda: SP.train_eval_split(docs, "doc_id", exact=True)):
        with scratch_scope(spark) as made:
            rows = make().collect()
            assert rows and "text" in rows[0].asDict()
            assert all(c.startswith("__") for c in written_columns(spark, made))


def test_positions_of_ties_nulls_and_orders(spark):
    rows = [(1, "b"), (1, "a"), (1, "a"), (None, "x"), (None, "x"), (2, None), (0, "z")] + [(7, "t")] * 50
    df = spark.createDataFrame(rows, "k int, t string").repartition(5)
    for order, want in ((["k", F.col("t").desc()], lambda r: (r[0] is not None, r[0] or 0)),
                        ([F.col("k").desc_nulls_first()], lambda r: (r[0] is not None, -(r[0] or 0))),
                        ([F.col("k").asc_nulls_last()], lambda r: (r[0] is None, r[0] or 0)),
                        ([F.col("k") % 2, "k"], lambda r: (r[0] is not None, (r[0] or 0) % 2, r[0] or 0))):
        for wide in (df, df.withColumn("more", F.lit("m"))):
            out = PO.with_position(wide, order, total="n", partition_bytes=64).orderBy("pos").collect()
            assert [r.pos for r in out] == list(range(len(rows))) and {r.n for r in out} == {len(rows)}
            assert [want(r) for r in out] == sorted(want(r) for r in rows)
    kept = FL.cap(df, 20, ["k"], by="t")
    assert {(r.t, r["count"]) for r in kept.groupBy("t").count().collect()} == {
        ("t", 20), ("a", 2), ("b", 1), ("x", 2), ("z", 1), (None, 1)}
    assert FL.cap(df, 3, [F.col("k").desc()]).collect() == [(7, "t")] * 3
    assert FL.cap(df, 0, ["k"]).count() == 0 and FL.cap(df.limit(0), 3, ["k"]).count() == 0


def test_ngram_index_shuffles_grams_once_in_few_numbers(spark, monkeypatch):
    from pyspark.sql import readwriter
    from tunesmith.operators import ngram as NG

    plans, save = [], readwriter.DataFrameWriter.saveAsTable

    def saved(self, *args, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return save(self, *args, **options)

    monkeypatch.setattr(readwriter.DataFrameWriter, "saveAsTable", saved)
    for low, high in ((0, 30), (-5, 2000), (0, 2 ** 31 - 1), (-2 ** 31, 2 ** 31 - 1)):
        seqs = [(k % 4, [None if low < 0 and (i + k) % 9 == 0 else
                         (low, high, low + 1, low + 2)[(i * i + k) % 4] for i in range(20 + k)])
                for k in range(6)]
        df = spark.createDataFrame(seqs, "k int, input_ids array<int>")
        index = NG.NgramIndex.build(df, "k", buckets=4)
        want = {}
        for k, ids in seqs:
            for n in (1, 2, 3):
                for p in range(len(ids) - n - 10 + 1):
                    gram = ",".join(str(x) for x in ids[p:p + n] if x is not None)
                    follow = ids[p + n:p + n + 10]
                    hit = (k, p, [(x is not None, x or 0) for x in follow])
                    if gram not in want or hit < want[gram][0]:
                        want[gram] = hit, follow
        got = {r.gram: r.hit for r in index.table.collect()}
        assert {g: (h.place.k, h.place.at, h.following) for g, h in got.items()} == {
            g: (hit[0], hit[1], follow) for g, (hit, follow) in want.items()}
        index.drop()
        assert plans[-1].count("Exchange hashpartitioning(gram") == 1
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
