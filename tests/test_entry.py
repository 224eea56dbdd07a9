import importlib


def test_entry_runs(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert sorted(df.columns) == ["avg_completion_chars", "avg_prompt_chars", "n_rows", "split"]
