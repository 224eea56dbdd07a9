"""Lookup of array elements by the distinct values of each batch of rows.

Joining a table onto every element of long arrays makes a row per element, a
shuffle of all of them on a skewed key and a regroup by row.  Here each task cuts
its rows into batches, and writes a batch as codes into a dictionary of the
batch's distinct elements.  Only dictionary entries are shuffled and joined; an
element that every row holds is one entry for each batch, so no key is hot.
The resolved dictionary meets its batch again, one row each, and the arrays are
rebuilt in place by code.  Rows need no key and are never merged: repeated rows
stay.  The plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunesmith.session import scratch_table, ship_package

#: rows and bytes of a batch, at most (a single row may be larger)
BATCH_ROWS = 1024
BATCH_BYTES = 4 << 20


def _coded(arrays: list[str], batch_rows: int, batch_bytes: int):
    """Arrow batches with ``arrays`` as codes; a batch's first row carries the
    dictionary."""

    def code(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for whole in batches:
            if not whole.num_rows:
                continue
            parts = max(-(-whole.num_rows // batch_rows), -(-whole.nbytes // batch_bytes))
            step = max(1, whole.num_rows // parts)
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                flat = [batch.column(name).flatten() for name in arrays]
                codes = pa.concat_arrays(flat).dictionary_encode()
                columns, at = [], 0
                for name in batch.schema.names:
                    col = batch.column(name)
                    if name in arrays:
                        sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy()
                        ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                        own = codes.indices.slice(at, int(ends[-1]))
                        at += int(ends[-1])
                        col = pa.ListArray.from_arrays(pa.array(ends), own, mask=col.is_null())
                    columns.append(col)
                rows = batch.num_rows
                entries = codes.dictionary
                columns.append(pa.array([number] * rows, pa.int64()))
                columns.append(pa.ListArray.from_arrays(
                    pa.array([0, *[len(entries)] * rows], pa.int32()), entries,
                    mask=pa.array([False, *[True] * (rows - 1)])))
                number += 1
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "__batch", "__dict"])

    return code


def resolve(df: DataFrame, arrays, table: DataFrame, key: str, value: str,
            batch_rows: int = BATCH_ROWS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``df`` with every element of the array columns ``arrays`` (of one type)
    replaced by ``value`` of the row of ``table`` whose ``key`` it is, or null."""
    arrays = [arrays] if isinstance(arrays, str) else list(arrays)
    spark = df.sparkSession
    ship_package(spark)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    element = kinds[arrays[0]].elementType
    made = T.StructType([
        *[T.StructField(f.name, T.ArrayType(T.IntegerType())) if f.name in arrays else
          T.StructField(f.name, f.dataType) for f in df.schema.fields],
        T.StructField("__batch", T.LongType()), T.StructField("__dict", T.ArrayType(element))])
    coded = scratch_table(df.mapInArrow(_coded(arrays, batch_rows, batch_bytes), made), "coded")
    entries = coded.filter(F.col("__dict").isNotNull()).select(
        "__batch", F.posexplode("__dict").alias("__code", "__key"))
    known = table.select(F.col(key).cast(element).alias("__key"), F.col(value).alias("__value"))
    values = (entries.join(known, "__key", "left").groupBy("__batch")
              .agg(F.array_sort(F.collect_list(F.struct("__code", "__value"))).alias("__all"))
              .select("__batch", F.transform("__all", lambda x: x["__value"]).alias("__values")))
    rows = coded.groupBy("__batch").agg(
        F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("__rows"))
    both = rows.join(values, "__batch", "left")

    def rebuilt(row):
        return F.struct(*[
            F.transform(row[c], lambda k: F.get(F.col("__values"), k)).alias(c) if c in arrays
            else row[c].alias(c) for c in df.columns])

    return both.select(F.inline(F.transform("__rows", rebuilt)))
