"""File sources (SRC1-SRC6) and union by name (UNI1).

Schemas are always declared (no inference pass over the data).  One policy holds
for all JSON sources: a record that is not one JSON value of the schema's type
fails the job (``on_error="raise"``) or is left out (``"reject"``), and a second
function lists what was left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Readers chosen by file extension.
FORMATS = {"json": "json", "jsonl": "json", "csv": "csv", "parquet": "parquet"}


def _as_list(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_jsonl(spark: SparkSession, path, schema: StructType,
               on_error: str = "raise") -> DataFrame:
    """SRC1: JSON lines, one object per line, UTF-8.

    A line that does not parse, holds more than one value, or has a value of
    another type, fails the job (``on_error="raise"``) or is left out
    (``"reject"``); ``jsonl_rejects`` gives the lines left out.  Blank lines are
    no records.
    """
    return good_records(parsed_lines(spark.read.text(_as_list(path)), schema), schema, on_error)


def jsonl_rejects(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """Lines that ``read_jsonl`` leaves out, as ``record``."""
    return bad_records(parsed_lines(spark.read.text(_as_list(path)), schema))


def _with_bad(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("__bad", StringType())])


def _typed(item, schema: StructType):
    """A JSON text as a struct; its ``__bad`` is set where a value does not fit."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}
    return F.from_json(item, _with_bad(schema), options)


def parsed_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """``record``, ``__row`` and ``__ok`` of every line (column ``value``) that
    is not blank; also on a stream.

    In brackets a line is an array; text after its record makes that
    malformed, and a second record makes it longer."""
    items = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>")
    rows = lines.filter(F.trim("value") != "").select(F.col("value").alias("record"), items.alias("__items"))
    single = F.coalesce(F.size("__items") == 1, F.lit(False))
    rows = rows.withColumn("__row", _typed(F.when(single, F.get("__items", 0)), schema))
    ok = single & F.get("__items", 0).isNotNull() & F.col("__row.__bad").isNull()
    return rows.select("record", "__row", F.coalesce(ok, F.lit(False)).alias("__ok"))


def good_records(parsed: DataFrame, schema: StructType, on_error: str = "raise") -> DataFrame:
    """The rows of ``parsed`` records."""
    if on_error == "raise":
        # in a filter, so that no projection can prune the check
        parsed = parsed.filter(F.when(~F.col("__ok"), F.raise_error(F.concat(
            F.lit("malformed JSON record: "), F.col("record"))).isNull()).otherwise(True))
    elif on_error == "reject":
        parsed = parsed.filter("__ok")
    else:
        raise ValueError("on_error must be 'raise' or 'reject'")
    return parsed.select(*[F.col("__row")[f.name].alias(f.name) for f in schema.fields])


def bad_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter("not __ok").select("record")


def read_json(spark: SparkSession, files, schema: StructType, multiline: bool = False,
              split: str = "train", on_error: str = "raise") -> DataFrame:
    """SRC2: a JSON dataset from a file set, all rows in split ``split``;
    ``multiline`` when each file is one JSON array.  Bad records as in SRC1;
    a file that is no array is one bad record."""
    return good_records(_json_records(spark, files, schema, multiline), schema,
                        on_error).withColumn("split", F.lit(split))


def json_rejects(spark: SparkSession, files, schema: StructType, multiline: bool = False) -> DataFrame:
    """What ``read_json`` leaves out, as ``record``."""
    return bad_records(_json_records(spark, files, schema, multiline))


def _json_records(spark: SparkSession, files, schema: StructType, multiline: bool) -> DataFrame:
    if not multiline:
        return parsed_lines(spark.read.text(_as_list(files)), schema)
    found = _array_files(spark, files)
    broken = found.filter(F.col("items").isNull()).select(
        F.col("text").alias("record"), F.lit(None).cast(_with_bad(schema)).alias("__row"),
        F.lit(False).alias("__ok"))
    return _elements(found, schema).select(
        F.coalesce("item", F.lit("null")).alias("record"), "__row", "__ok").unionByName(broken)


def extension(path: str) -> str:
    tail = path.rstrip("/").rsplit("/", 1)[-1]
    return tail.rsplit(".", 1)[-1].lower() if "." in tail else ""


def read_any(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read one path with the reader its extension names."""
    fmt = FORMATS.get(extension(path))
    if fmt is None:
        raise ValueError(f"unsupported extension for {path!r}; use {sorted(FORMATS)}")
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    return read_jsonl(spark, path, schema)


def read_splits(spark: SparkSession, splits: dict, schema: StructType) -> DataFrame:
    """SRC3: named splits (train/validation/test), reader per file extension,
    one DataFrame with a ``split`` column."""
    parts = [read_any(spark, p, schema).withColumn("split", F.lit(name))
             for name, p in splits.items()]
    return union_all(*parts)


def read_json_glob(spark: SparkSession, globs, schema: StructType,
                   on_error: str = "skip") -> DataFrame:
    """SRC4: files that each hold one JSON array, one task per file.

    Only a file that is not one array (also if text follows it) is left out
    (``skip``) or fails the job (``raise``).  In a parsed file every element but
    null is a row; a value of another type becomes null (see
    ``json_glob_rejects``).
    """
    if on_error not in ("skip", "raise"):
        raise ValueError("on_error must be 'skip' or 'raise'")
    files = _array_files(spark, globs)
    if on_error == "raise":
        files = files.filter(F.when(F.col("items").isNull(), F.raise_error(
            F.lit("a file does not hold a JSON array")).isNull()).otherwise(True))
    rows = _elements(files, schema).filter(F.col("item").isNotNull())
    return rows.select(*[F.col("__row")[f.name].alias(f.name) for f in schema.fields])


def json_glob_rejects(spark: SparkSession, globs, schema: StructType) -> DataFrame:
    """(file, record): files that do not parse (record null), null elements and
    elements with a value of another type."""
    files = _array_files(spark, globs)
    broken = files.filter(F.col("items").isNull()).select("file", F.lit(None).cast("string")
                                                          .alias("record"))
    return broken.union(_elements(files, schema).filter("not __ok").select(
        "file", F.coalesce("item", F.lit("null")).alias("record")))


def _array_files(spark: SparkSession, globs) -> DataFrame:
    """(file, text, items): the elements' JSON texts; null where the file is not
    one array.  In brackets, text after the array makes the file malformed."""
    text = spark.read.text(_as_list(globs), wholetext=True)
    arrays = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<array<string>>")
    return text.select(F.input_file_name().alias("file"), F.col("value").alias("text"), arrays.alias("arrays")
                       ).select("file", "text", F.when(F.size("arrays") == 1, F.get("arrays", 0)).alias("items"))


def _elements(files: DataFrame, schema: StructType) -> DataFrame:
    rows = files.select("file", F.explode("items").alias("item")).withColumn("__row", _typed("item", schema))
    ok = F.col("item").isNotNull() & F.col("__row.__bad").isNull()
    return rows.withColumn("__ok", F.coalesce(ok, F.lit(False)))


def read_csv(spark: SparkSession, files, schema: StructType) -> DataFrame:
    """SRC5: CSV with header; quotes doubled inside fields, newlines allowed."""
    return (spark.read.schema(schema).option("header", True)
                 .option("multiLine", True).option("escape", '"')
                 .option("quote", '"').csv(_as_list(files)))


def read_dataset(spark: SparkSession, directory: str) -> DataFrame:
    """SRC6: a dataset folder with ready splits as ``split=…`` partitions;
    a filter on ``split`` prunes whole folders."""
    return spark.read.parquet(directory)


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNI1: concatenate by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
