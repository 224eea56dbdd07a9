"""Helpers shared by the training-data operators.

Rows are addressed by ``row_key``: a digest of id and text.  Repeated rows
share a key and get the same treatment; null ids and null texts have keys of
their own, so no row is lost or doubled in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunesmith.session import ensure_checkpoint_dir, scratch_path, ship_package

#: a word: a maximal run without ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> None:
    """Shared folder set, package shipped to the executors."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def stored(df: DataFrame, name: str, dictionary: bool = True) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back:
    later steps neither recompute it nor depend on the executors that made it.
    Columns of digests are written faster without ``dictionary`` pages."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("parquet.enable.dictionary", str(dictionary).lower()).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, the place in their ``group`` by ``order`` (nulls
    first), and ``n``, the group's size.  Range partitions divide large groups; they
    are written once, so places stay when executors are lost."""
    keys, pid = [group, *order], F.spark_partition_id()
    ranged = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        *rows.columns, pid.alias("pid"),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)).alias("at")), "placed")
    parts = ranged.groupBy(group, "pid").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    own = Window.partitionBy(group)
    before = F.sum("rows").over(own.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(group, "pid", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("rows").over(own).alias("n"))
    return ranged.join(parts, [group, "pid"]).select(
        *rows.columns, (F.col("at") + F.col("shift")).alias("idx"), "n")


def row_key(id_col: str, text_col: str) -> Column:
    """16-byte digest of (id, text), defined for nulls too."""
    ident = F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.lit("n"))
    text = F.coalesce(F.concat(F.lit("t"), F.col(text_col)), F.lit("n"))
    return F.unhex(F.md5(F.concat(ident, F.lit("|"), text)))


def word_array(text: Column) -> Column:
    """Words of a text as an array (null text: empty array)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words (null text: 0)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def free_prefix(df: DataFrame, name: str) -> str:
    """A prefix that no column of ``df`` begins with (case-insensitively)."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = f"_{name}"
    return name


def quoted(df: DataFrame) -> list[Column]:
    """The columns of ``df``, also those with dots or back-ticks in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
