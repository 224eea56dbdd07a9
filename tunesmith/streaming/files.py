"""Incremental file stream (STR1).

The iterable loader of the scripts becomes a file-source stream: new JSON
line files in a folder are picked up trigger by trigger and fed through any
row-local operator (prompt, preference, filter, projection).  Operators that
need the whole input (vocabulary, positions, shuffles, batches) refuse a
streaming DataFrame via :func:`require_static`.

Lines are parsed by the rules of the batch reader.  :func:`run_with_rejects`
keeps the bad ones too: kept rows and rejects of a batch are written under the
batch's number, which a restart repeats, so a batch that ran twice stands once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tunesmith.session import remove
from tunesmith.sources import readers as R


def _lines(spark: SparkSession, directory: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(directory)


def stream_jsonl(spark: SparkSession, directory: str, schema: StructType,
                 max_files_per_trigger: int | None = None, on_error: str = "raise") -> DataFrame:
    """A stream of the records in ``directory``; without a limit a trigger takes
    all new files.  Bad records as in SRC1."""
    lines = _lines(spark, directory, max_files_per_trigger)
    return R.good_records(R.parsed_lines(lines, schema), schema, on_error)


def run_with_rejects(spark: SparkSession, directory: str, schema: StructType, sink_dir: str,
                     reject_dir: str, checkpoint_dir: str,
                     transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
                     max_files_per_trigger: int | None = None) -> None:
    """Process every file present now, then stop.  Each trigger's lines are
    parsed once; ``transform`` of the kept rows goes to ``sink_dir``, the bad lines (as
    ``record``) to ``reject_dir``, both below ``batch=<number>``."""

    def write(lines: DataFrame, number: int) -> None:
        place = f"{checkpoint_dir.rstrip('/')}-parsed/batch={number}"
        R.parsed_lines(lines, schema).write.mode("overwrite").parquet(place)
        parsed = spark.read.parquet(place)
        transform(R.good_records(parsed, schema, "reject")).write.mode("overwrite").parquet(
            f"{sink_dir.rstrip('/')}/batch={number}")
        R.bad_records(parsed).write.mode("overwrite").parquet(
            f"{reject_dir.rstrip('/')}/batch={number}")
        remove(spark, place)

    q = (_lines(spark, directory, max_files_per_trigger).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()


def run_available(stream: DataFrame, sink_dir: str, checkpoint_dir: str,
                  fmt: str = "parquet") -> None:
    """Process every file present now, append to ``sink_dir``, then stop.
    The checkpoint makes a restart continue where it stopped."""
    q = (stream.writeStream.format(fmt).outputMode("append")
               .option("checkpointLocation", checkpoint_dir)
               .trigger(availableNow=True).start(sink_dir))
    q.awaitTermination()


def require_static(df: DataFrame, operator: str) -> None:
    if df.isStreaming:
        raise ValueError(f"{operator} needs the complete input and cannot run on a stream")
