"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is fully executed (``noop`` sink: every row computed, nothing
collected to the driver).  One warm-up run of the flagship query, then the
median of $BENCH_REPEAT runs per query.  Prints one JSON line.

BENCH_QUERIES=all runs every registered query instead of the headline set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tunesmith.plans import registry  # noqa: E402
from tunesmith.session import build_session, scratch_scope  # noqa: E402

HEADLINE = [
    "slice_preference_split",   # comparison view, pair, template, hash split
    "prm9_history_prompt",      # running ChatML per conversation (window)
    "prm12_dialogue_prompt",    # per-conversation dialogue text
    "spl1_exact_split",         # exact split by selection of the last training key
    "spl3_shard_holdout",       # shuffle, shards, broadcast semi join
    "tok1_document_vocab",      # corpus vocabulary over whole documents
    "tok2_encode_documents",    # whole documents -> ids (lookup by distinct words of a batch)
    "tok3_decode",              # ids -> words
    "lay1_seq2seq_train",       # seq2seq rows, padded to 1153
    "lay5_completion_only",     # marker search in id arrays
    "lay6_collate",             # batches of 4, longest-first, labels, positions
    "lay11_length_grouped",     # mega-batches sorted by length
    "evl3_rouge_n",             # ROUGE-1/2
    "evl4_rouge_l",             # ROUGE-L (Arrow UDF)
    "evl5_bleu4",               # char BLEU-4, one sort of a batch's n-grams
    "evl6_score_summary",       # all four metrics, corpus means
    "ngr1_continuation",        # prompt-lookup continuation
    "ngr2_accepted_prefix",
    "snk1_write_shards",        # 666-row CSV shards, one file each, round trip
    "str1_stream_jsonl",        # file stream, availableNow
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(
        f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
               # the test tables are one row group each: deal their rows to all cores
               "spark.tunesmith.read.partitions": str(cpus),
               "spark.checkpoint.dir": os.environ.get(
                   "BENCH_CHECKPOINT_DIR", tempfile.mkdtemp(prefix="run-", dir="/tmp"))})
    qs = registry.queries()
    names = list(qs) if os.environ.get("BENCH_QUERIES") == "all" else [
        n for n in HEADLINE if n in qs]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        with scratch_scope(spark):
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

    run("slice_preference_split")  # warm-up: JVM, code generation, file listing
    results = {}
    for name in names:
        results[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus,
                      "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
