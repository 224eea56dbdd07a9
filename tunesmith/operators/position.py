"""Row count, stable global positions, lookups, slices and fixed batches.

A DataFrame has no order, so every positional operator takes explicit sort
keys.  Positions are numbers of keys, in two passes and without a
single-partition window:

1. the keys alone are range-partitioned, sorted and written once, with
   partition number and index inside the partition, as a parquet table in the
   shared checkpoint folder (the lineage is cut, so positions stay fixed even
   if executors are lost);
2. rows per partition are counted -- a table with one row per partition --
   and running offsets broadcast back (its size is the partition count, a
   proven bound): position = offset + index inside the partition;
3. the rows themselves meet the number of their key when they are next read;
   rows of one key take consecutive numbers.

No column but the keys is ever written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.operators.order import SortKey, sort_keys
from tunesmith.session import scratch_table
from tunesmith.streaming.files import require_static

_PID = "__pid"
_LOCAL = "__local"


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """POS1: one row with the number of rows (partial + final count)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias(name))


def plan_bytes(df: DataFrame) -> int | None:
    """The optimizer's estimate of ``df``'s size, None where it has none;
    nothing is executed."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else None


def ranged_keys(df: DataFrame, keys: list[SortKey], names: list[str], num_partitions: int | None = None,
                partition_bytes: int | None = None) -> DataFrame:
    """The columns ``names`` of ``df``, that hold the values of ``keys``, in
    range partitions, sorted and written with their place (``__pid``,
    ``__local``)."""
    narrow = df.select(*names)
    if num_partitions is None and partition_bytes is not None:
        size = plan_bytes(narrow)
        num_partitions = None if size is None else max(1, -(-size // partition_bytes))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [k.column(name) for k, name in zip(keys, names)]
    pid = F.spark_partition_id()
    return scratch_table(narrow.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "*", pid.alias(_PID), (F.monotonically_increasing_id()
                               - F.shiftleft(pid.cast("bigint"), 33)).alias(_LOCAL)), "positions")


def with_position(df: DataFrame, order_by, name: str = "pos",
                  num_partitions: int | None = None, total: str | None = None,
                  partition_bytes: int | None = None) -> DataFrame:
    """POS2: add a 0-based position in ``order_by`` order.

    ``total`` optionally names a column that receives the row count.  The
    keys go to ``num_partitions`` range partitions, else to as many as their
    estimated size over ``partition_bytes``, else to the session's shuffle
    partitions.  Rows of one key are in no particular order.
    """
    require_static(df, "with_position")
    keys = sort_keys(order_by)
    names = [f"__k{i}" for i in range(len(keys))]
    keyed = df.select("*", *[k.value.alias(n) for k, n in zip(keys, names)])
    local = ranged_keys(keyed, keys, names, num_partitions, partition_bytes)
    counts = local.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: bounded by the partition count
    w = Window.orderBy(_PID)
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("__n").over(
            w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__offset"),
        F.sum("__n").over(Window.partitionBy(F.lit(1))).alias("__total"))
    number = (F.col("__offset") + F.col(_LOCAL)).cast("bigint")
    held = {k.name: n for k, n in zip(keys, names)}
    if set(df.columns) <= set(held):
        # the keys are the whole rows
        out = [F.col(held[c]).alias(c) for c in df.columns] + [number.alias(name)]
        return local.join(F.broadcast(offsets), _PID).select(
            *out, *([F.col("__total").cast("bigint").alias(total)] if total else []))
    key = F.struct(*names).alias("__key")
    first = local.join(F.broadcast(offsets), _PID).select(
        key, number.alias("__pos"), "__total").groupBy("__key").agg(
        F.min("__pos").alias("__pos"), F.first("__total").alias("__total"))
    rows = keyed.withColumn("__key", key).drop(*names).join(first, "__key")
    nth = F.row_number().over(Window.partitionBy("__key").orderBy("__key")) - 1
    extra = [(F.col("__pos") + nth).cast("bigint").alias(name)]
    if total:
        extra.append(F.col("__total").cast("bigint").alias(total))
    return rows.select(*df.columns, *extra)


def row_at(df: DataFrame, i: int, pos: str = "pos") -> DataFrame:
    """POS3: the row at position ``i``."""
    return df.filter(F.col(pos) == F.lit(i))


def slice_rows(df: DataFrame, start: int, n: int, pos: str = "pos") -> DataFrame:
    """POS4: rows at positions ``[start, start+n)``."""
    return df.filter((F.col(pos) >= start) & (F.col(pos) < start + n))


def with_batch_id(df: DataFrame, n: int, pos: str = "pos",
                  name: str = "batch_id") -> DataFrame:
    """Fixed-size consecutive batch number, ``floor(pos / n)``."""
    return df.withColumn(name, F.floor(F.col(pos) / F.lit(n)).cast("bigint"))


def batches(df: DataFrame, n: int, cols: list[str], pos: str = "pos",
            name: str = "batch_id") -> DataFrame:
    """POS5: one row per batch of ``n`` consecutive rows, order kept, the
    last batch short.  Each group holds at most ``n`` rows."""
    b = with_batch_id(df, n, pos, name)
    items = F.array_sort(F.collect_list(F.struct(F.col(pos), *[F.col(c) for c in cols])))
    return b.groupBy(name).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.min(pos).alias("first_pos"),
        items.alias("rows"))
