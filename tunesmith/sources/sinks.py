"""Sinks (SNK1-SNK4): sharded CSV, overwrite, prediction JSON lines, run
metrics and their store.  Writers run in parallel tasks; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tunesmith.config import FOLDER_SHARDS, SHARD_ROWS
from tunesmith.operators.filters import cap as first_rows
from tunesmith.operators.position import with_position


def with_shards(df: DataFrame, order_by, rows: int = SHARD_ROWS,
                name: str = "shard") -> DataFrame:
    """Shard number ``floor(pos / rows)``: exactly ``rows`` rows per shard,
    the last one short."""
    pos = with_position(df, order_by, name="__pos")
    return pos.withColumn(name, F.floor(F.col("__pos") / rows).cast("bigint")).drop("__pos")


def write_csv(df: DataFrame, directory: str, partition_by=None,
              mode: str = "overwrite") -> None:
    """CSV with header, quotes doubled inside fields (RFC 4180 style)."""
    w = (df.write.mode(mode).option("header", True).option("escape", '"')
           .option("quote", '"'))
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(directory)


def write_shards(df: DataFrame, directory: str, order_by, rows: int = SHARD_ROWS,
                 mode: str = "overwrite", drop=(), folder_shards: int = FOLDER_SHARDS) -> None:
    """SNK1/SNK2: CSV shards of ``rows`` rows, one file each, with header and no
    row index; an existing folder is replaced.  ``drop`` names helper columns
    (e.g. sort keys) that are not written.

    Shards are grouped into ``folder=<n>`` folders of ``folder_shards``, so their number
    does not grow with the rows of a shard.  A folder is written by one task in
    ``order_by`` order, which closes a file after every ``rows`` rows: the k-th
    file of a folder is its k-th shard (:func:`read_shards`)."""
    pos = with_position(df, order_by, name="__pos")
    placed = pos.withColumn("folder", F.floor(F.col("__pos") / (rows * folder_shards)).cast("bigint"))
    dealt = placed.repartition("folder").sortWithinPartitions("folder", "__pos").drop("__pos", *drop)
    (dealt.write.mode(mode).option("header", True).option("escape", '"').option("quote", '"')
     .option("maxRecordsPerFile", rows).partitionBy("folder").csv(directory))


def read_shards(spark: SparkSession, directory: str, schema: StructType, folders=None,
                folder_shards: int = FOLDER_SHARDS) -> DataFrame:
    """Rows of the shards at ``directory`` with their ``shard`` number, from
    the folder and the file's place in it.  ``folders`` opens only these."""
    df = (spark.read.schema(StructType([*schema.fields, StructField("folder", LongType())]))
          .option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"')
          .csv(directory))
    if folders is not None:
        df = df.filter(F.col("folder").isin([int(f) for f in folders]))
    file = F.regexp_extract("_metadata.file_name", r"\.?-?c([0-9]+)\.csv$", 1).cast("bigint")
    return df.select(*[f.name for f in schema.fields], (F.col("folder") * folder_shards + file).alias("shard"))


# The Unicode white space that is stripped from both ends.
WHITE = (r"\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
         r"\x{202F}\x{205F}\x{3000}")


def strip_ws(col) -> F.Column:
    """Remove leading and trailing Unicode white space."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, rf"^[{WHITE}]+|[{WHITE}]+$", "")


def write_predictions(df: DataFrame, directory: str, labels: str = "labels",
                      predict: str = "predict", keys=(), mode: str = "overwrite") -> None:
    """SNK3: JSON lines ``{"labels", "predict"}`` (plus keys), whitespace
    stripped; non-ASCII text is written as is."""
    out = df.select(*keys, strip_ws(labels).alias("labels"),
                    strip_ws(predict).alias("predict"))
    out.write.mode(mode).json(directory)


def run_metrics(df: DataFrame, phase: str, cap: int | None = None,
                split: str = "split", metrics: dict | None = None, order_by=None) -> DataFrame:
    """SNK4: per split, the number of samples and the metric means, tagged
    with the phase name.  With ``cap`` both are over the first ``cap`` rows of
    each split in ``order_by`` order."""
    if cap is not None:
        if order_by is None:
            raise ValueError("a capped run needs order_by")
        df = first_rows(df, cap, order_by, by=split)
    aggs = [F.count(F.lit(1)).cast("bigint").alias(f"{phase}_samples")]
    for name, col in (metrics or {}).items():
        aggs.append(F.avg(col).alias(f"{phase}_{name}"))
    return df.groupBy(split).agg(*aggs).withColumn("phase", F.lit(phase))


def save_metrics(metrics: DataFrame, store: str, run: str, split: str = "split") -> None:
    """Append the result of :func:`run_metrics` to the metrics table at
    ``store``, one row for each run, phase, split and metric.  The rows of a run
    and phase that are there already are replaced, so a phase that ran again
    stands once."""
    names = [c for c in metrics.columns if c not in (split, "phase")]
    rows = metrics.select(
        F.lit(run).alias("run"), "phase", F.col(split).alias("split"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                            for c in names])).alias("m")).select("run", "phase", "split", "m.*")
    # each (run, phase) is a folder; only folders with new rows are replaced
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "phase").parquet(store))


def read_metrics(spark: SparkSession, store: str) -> DataFrame:
    """run, phase, split, metric and value; a filter on run or phase opens only
    their folders."""
    schema = "split string, metric string, value double, run string, phase string"
    return spark.read.schema(schema).parquet(store).select("run", "phase", "split", "metric", "value")
