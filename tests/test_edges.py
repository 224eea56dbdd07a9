"""Hand-written edge rows (FIXTURES §4)."""

import pytest
from pyspark.sql import functions as F

from tunesmith.operators import evaluate as EV
from tunesmith.operators import filters as FL
from tunesmith.operators import layout as LA
from tunesmith.operators import preference as PR
from tunesmith.operators import prompts as PM
from tunesmith.operators import vocab as VO


def test_blank_vs_null_filters(spark):
    rows = [(1, "p", "r"), (2, None, "r"), (3, "", "r"), (4, "p", None), (5, "p", "")]
    df = spark.createDataFrame(rows, "k int, prompt string, response string")
    assert sorted(r.k for r in FL.drop_blank(df).collect()) == [1]
    kept = FL.drop_null(df, ("prompt", "response"))
    assert sorted(r.k for r in kept.collect()) == [1, 3, 5]


def test_one_answer_comparison_goes_to_rejects(spark):
    rows = [(1, "q", ["a", "b"]), (2, "q", ["only"]), (3, "q", None), (4, "q", ["a", "b", "c"])]
    df = spark.createDataFrame(rows, "k int, instruction string, output array<string>")
    assert sorted(r.k for r in PR.split_pair(df).collect()) == [1, 4]
    assert sorted(r.k for r in PR.pair_rejects(df).collect()) == [2, 3]


@pytest.mark.parametrize("text", ["\U0001F600a", "\U0001F600", "ab", "a", "é\U0001F680x"])
def test_parity_counts_code_points(spark, text):
    df = spark.createDataFrame([(text, ["zero", "one"])], "instruction string, output array<string>")
    r = PR.parity_pick(df).first()
    assert r.answer == ["zero", "one"][len(text) % 2]
    assert r.label == (len(text) % 2 == 0)


def test_dialogue_prompt_marker_cases(spark):
    rows = [(1, "\n\nHuman: hi\n\nAssistant: yo\n\nHuman: again\n\nAssistant: ok"),
            (2, "\n\nHuman: no answer here"), (3, "\n\nAssistant:")]
    df = spark.createDataFrame(rows, "k int, text string")
    got = {r.k: (r.prompt, r.prompt_ok) for r in PM.dialogue_prompt(df).collect()}
    assert got[1] == ("\n\nHuman: hi\n\nAssistant: yo\n\nHuman: again\n\nAssistant:", True)
    assert got[2] == (None, False)
    assert got[3] == ("\n\nAssistant:", True)
    with pytest.raises(Exception):
        PM.dialogue_prompt(df, strict=True).collect()


def test_context_optional_input(spark):
    rows = [(1, "do", None, "t"), (2, "do", "", "t"), (3, "do", "x", "t")]
    df = spark.createDataFrame(rows, "k int, instruction string, input string, output string")
    got = {r.k: r.context for r in PM.context_target(df).collect()}
    assert got[1] == got[2] == "Instruction: do\nAnswer: "
    assert got[3] == "Instruction: do\nInput: x\nAnswer: "


def test_seq2seq_train_blank_and_whitespace_targets(spark):
    rows = [(1, "a b", "c"), (2, "a", ""), (3, "a", "   ")]
    df = spark.createDataFrame(rows, "k int, prompt string, response string")
    vocab = VO.build_vocab(df.select(F.concat_ws(" ", "prompt", "response").alias("text")), "text")
    out = {r.k: r for r in LA.seq2seq_train(df, "k", vocab, src=4, tgt=2).collect()}
    assert sorted(out) == [1, 3]          # '' is blank, '   ' is not
    r1, r3 = out[1], out[3]
    assert len(r1.input_ids) == len(r1.labels) == 4 + 2 + 1
    assert r1.labels[:3] == [-100, -100, -100] and r1.labels[4] == 1
    assert r3.input_ids[:3] == [2, r3.input_ids[1], 1]   # bos, 'a', eos: no target words


def test_metric_edges(spark):
    rows = [(1, "", "some words"), (2, "same words", "same words"), (3, "abc", "xyz")]
    df = spark.createDataFrame(rows, "k int, predict string, labels string")
    df = EV.rouge_n(EV.rouge_n(df, 1), 2)
    df = EV.bleu4(EV.rouge_l(df), "k")
    got = {r.k: r for r in df.collect()}
    assert (got[1].rouge_1, got[1].rouge_l, got[1].bleu_4) == (0.0, 0.0, 0.0)
    assert (got[2].rouge_1, got[2].rouge_2, got[2].rouge_l, got[2].bleu_4) == (100.0, 100.0, 100.0, 100.0)
    assert (got[3].rouge_1, got[3].bleu_4) == (0.0, 0.0)


def test_pad_equal_to_eos_warns(spark):
    from tunesmith.config import TokenSpec

    df = spark.createDataFrame([(1, "a", "b")], "k int, prompt string, response string")
    vocab = VO.build_vocab(df.select(F.lit("a b").alias("text")), "text")
    with pytest.warns(UserWarning):
        LA.seq2seq_train(df, "k", vocab, src=4, tgt=2, spec=TokenSpec().with_pad_as_eos())


def test_orphans(spark):
    preds = spark.createDataFrame([(1, "p"), (2, "q")], "k int, predict string")
    refs = spark.createDataFrame([(2, "r"), (3, "s")], "k int, labels string")
    assert [r.k for r in EV.pair_predictions(preds, refs, "k").collect()] == [2]
    got = sorted((r.k, r.side) for r in EV.orphans(preds, refs, "k").collect())
    assert got == [(1, "prediction"), (3, "reference")]


def test_map_rows(spark):
    from tunesmith.operators import udf as UD

    df = spark.createDataFrame([(1, "ab"), (2, "cde")], "k long, t string")
    out = UD.map_rows(df, lambda r: {"k": r["k"], "n": len(r["t"])}, "k long, n long")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2), (2, 3)]


def test_decode_specials_and_several_columns(spark):
    df = spark.createDataFrame([(1, "x y")], "k int, text string")
    vocab = VO.build_vocab(df, "text")
    ids = spark.createDataFrame([(1, [2, 4, 3, 5, 1, 0], [4, -100, 5])],
                                "k int, a array<int>, b array<int>")
    out = VO.decode(ids, "k", {"da": "a", "db": "b"}, vocab, keep_input=False).first()
    assert (out.da, out.db) == ("x y", "x y")
    named = VO.decode(ids, "k", "a", vocab, skip_special=False, out="d").first()
    assert named.d == "<s> x <unk> y </s> <pad>"


def test_preference_needs_two_answers(spark):
    rows = [(1, "ab", ["x", "y", "z"]), (2, "ab", ["x"]), (3, "ab", []), (4, "ab", None),
            (5, "ab", [None, "y"]), (6, "abc", ["x", "y"])]
    df = spark.createDataFrame(rows, "k int, instruction string, output array<string>")
    for op, copies in ((PR.split_pair, 1), (PR.parity_pick, 1), (PR.paired_lists, 1),
                       (PR.explode_unpaired, 2)):
        assert sorted(r.k for r in op(df).collect()) == sorted([1, 6] * copies)
    assert sorted(r.k for r in PR.pair_rejects(df).collect()) == [2, 3, 4, 5]


def test_long_turns_stay_whole(spark, tmp_path):
    """Decoding, preview and padding do not cut; only encoding (TOK2) does."""
    from tunesmith.plans.registry import queries
    named = queries()
    text = " ".join(f"w{i}" for i in range(1500))
    spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", "w1 w2")],
                          "conv_id bigint, turn bigint, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))

    def first(name):
        return named[name](spark, str(tmp_path)).filter("turn = 0").first()

    assert first("tok3_decode")["decoded"] == text
    preview = first("pos6_preview")
    assert preview["decoded"] == text and preview["input_ids"].count(",") == 1500
    assert first("lay9_pad_to")["padded"].count(",") == 1500
    assert first("tok2_encode")["n_ids"] == 1024
