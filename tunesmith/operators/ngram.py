"""N-gram lookup over token sequences (NGR1-NGR3).

The prompt-lookup step of speculative decoding, re-aimed as data work:
the candidate continuation of every sequence, how much of a candidate a
stored continuation accepts, and token counts of run logs.  Per-row
expressions are built-in array functions (no shuffle).

Over a whole corpus the lookup is an index: for every n-gram that ``num_pred``
ids follow, the continuation at its earliest place.  It is a table bucketed by
n-gram, so probes are shuffled to it and it is never shuffled again.  Probes go
through :mod:`tunesmith.operators.lookup`: a suffix that many sequences share is
one probe for each batch of them.
"""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.functions import arrays as A
from tunesmith.operators.lookup import resolve
from tunesmith.session import scratch_path, scratch_table
from tunesmith.streaming.files import require_static

#: buckets of an index
BUCKETS = 64
#: n-grams that a task sorts before it sends them on, about
TASK_GRAMS = 1 << 21


def continuation(df: DataFrame, ids="input_ids", max_ngram: int = 3,
                 num_pred: int = 10, out: str = "candidate") -> DataFrame:
    """NGR1: candidate ids that followed an earlier copy of the last n ids
    (n = max_ngram..1, first valid match); empty when nothing matches."""
    ns = range(1, max_ngram + 1)
    rows = df.withColumn("__size", F.size(ids))
    rows = rows.withColumns({f"__last{n}": F.when(F.col("__size") >= n, A.keep_last(ids, n)) for n in ns})
    found = A.continuation(ids, max_ngram, num_pred, F.col("__size"), {n: F.col(f"__last{n}") for n in ns})
    return rows.withColumn(out, found).drop("__size", *[f"__last{n}" for n in ns])


def _packing(least, most, count: int):
    """How ``count`` ids from ``least`` to ``most`` go into few 64-bit numbers
    that sort as the ids do (null first): functions that give the numbers of an
    array and the array of such numbers; None if numbers would save nothing."""
    if not isinstance(least, int) or (bits := (most - least + 1).bit_length()) > 31:
        return None
    per = 63 // bits
    groups = [range(i, min(i + per, count)) for i in range(0, count, per)]

    def pack(ids) -> list:
        codes = [F.coalesce(F.get(ids, i).cast("bigint") - (least - 1), F.lit(0).cast("bigint"))
                 for i in range(count)]
        return [reduce(lambda a, b: F.shiftleft(a, bits).bitwiseOR(b), [codes[i] for i in group])
                for group in groups]

    def unpack(numbers: list):
        codes = [F.shiftright(n, bits * (group[-1] - i)).bitwiseAND((1 << bits) - 1)
                 for n, group in zip(numbers, groups) for i in group]
        return F.array(*[F.when(c > 0, c + (least - 1)) for c in codes])

    return pack, unpack


@contextmanager
def _shuffle_partitions(spark: SparkSession, n: int):
    """Groups of what runs inside are dealt to ``n`` partitions."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class NgramIndex:
    """``table``: gram (its ids, joined by commas), hit (struct of place, that is
    the keys and the 0-based position ``at``, and the ids following); one row
    per n-gram, bucketed by it."""

    table: DataFrame
    name: str
    path: str
    keys: tuple[str, ...]
    max_ngram: int
    num_pred: int

    @classmethod
    def build(cls, df: DataFrame, key, ids: str = "input_ids", max_ngram: int = 3,
              num_pred: int = 10, path: str | None = None, buckets: int = BUCKETS) -> "NgramIndex":
        """Index all sequences of ``df``.  "Earliest" goes by ``key`` (nulls
        first), then by position; of sequences with one key the smaller
        continuation counts.  Grams are reduced before they are shuffled, so a
        gram that all sequences hold is one row for each task.  They are shuffled
        once, with the ids that follow packed into few numbers, from tasks small
        enough to sort in memory.  ``path`` keeps the index for later sessions
        (:meth:`load`)."""
        require_static(df, "NgramIndex.build")
        if num_pred <= max_ngram:
            raise ValueError("num_pred must exceed max_ngram, or a suffix could continue itself")
        keys = (key,) if isinstance(key, str) else tuple(key)
        spark = df.sparkSession
        sized = scratch_table(df.select(*keys, F.col(ids).alias("__ids"), F.size(ids).alias("__size")),
                              "ngram-sequences")
        least, most, total = sized.agg(F.min(F.array_min("__ids")), F.max(F.array_max("__ids")),
                                       F.sum("__size")).first()
        packing = _packing(least, most, num_pred)
        tasks = max(spark.sparkContext.defaultParallelism, -(-(total or 0) * max_ngram // TASK_GRAMS))
        starts = F.when(F.col("__size") > num_pred, F.sequence(
            F.lit(0), F.col("__size") - num_pred - 1)).otherwise(A.empty_ints())
        at = sized.repartition(tasks).select("*", F.explode(starts).alias("at"))
        grams = at.select(*keys, "at", "__ids", F.explode(F.sequence(
            F.lit(1), F.least(F.lit(max_ngram), F.col("__size") - num_pred - F.col("at")))).alias("__n"))
        grams = grams.select(*keys, "at", A.ids_text(F.slice("__ids", F.col("at") + 1, F.col("__n"))).alias("gram"),
                             F.slice("__ids", F.col("at") + F.col("__n") + 1, num_pred).alias("following"))
        rest = [n.alias(f"__f{i}") for i, n in enumerate(packing[0]("following"))] if packing else [
            F.col("following")]
        first = grams.select("gram", F.struct(*keys, "at", *rest).alias("first")).groupBy("gram").agg(
            F.min("first").alias("first"))
        following = packing[1]([F.col(f"first.__f{i}") for i in range(len(rest))]).cast(
            sized.schema["__ids"].dataType) if packing else F.col("first.following")
        first = first.select("gram", F.struct(
            F.struct(*[F.col("first")[c].alias(c) for c in (*keys, "at")]).alias("place"),
            following.alias("following")).alias("hit"))
        path = path or scratch_path(spark, "ngram-index")
        name = f"ngrams_{uuid.uuid4().hex[:12]}"
        # grouped into as many partitions as buckets, so what is grouped need not be dealt again
        with _shuffle_partitions(spark, buckets):
            (first.repartition(buckets, "gram").write.bucketBy(buckets, "gram").sortBy("gram")
             .option("path", path).mode("overwrite").saveAsTable(name))
        return cls(spark.table(name), name, path, keys, max_ngram, num_pred)

    @classmethod
    def load(cls, spark: SparkSession, path: str, keys: dict, max_ngram: int = 3,
             num_pred: int = 10, buckets: int = BUCKETS) -> "NgramIndex":
        """An index kept at ``path``; ``keys``: name -> SQL type of the keys."""
        name = f"ngrams_{uuid.uuid4().hex[:12]}"
        place = ", ".join(f"`{k}`: {t}" for k, t in {**keys, "at": "int"}.items())
        where = re.sub(r"(['\\])", r"\\\1", path)
        spark.sql(f"CREATE TABLE {name} (gram string, "
                  f"hit struct<place: struct<{place}>, following: array<int>>) USING parquet "
                  f"CLUSTERED BY (gram) SORTED BY (gram) INTO {buckets} BUCKETS LOCATION '{where}'")
        return cls(spark.table(name), name, path, tuple(keys), max_ngram, num_pred)

    def probe(self, df: DataFrame, ids: str = "input_ids", out: str = "candidate",
              place: str | None = None) -> DataFrame:
        """``df`` with the ids that followed the earliest copy in the corpus of
        a row's last n ids, for the largest n that has one; empty if none has.
        ``place`` names a column for where that copy stands."""
        suffixes = F.filter(F.array(*[F.when(F.size(ids) >= n, A.ids_text(A.keep_last(ids, n)))
                                      for n in range(self.max_ngram, 0, -1)]), lambda g: g.isNotNull())
        hits = resolve(df.withColumn("__hits", suffixes), "__hits", self.table, "gram", "hit")
        hits = hits.withColumn("__hit", F.get(F.filter("__hits", lambda h: h.isNotNull()), 0))
        extra = [F.col("__hit.place").alias(place)] if place else []
        return hits.select(*[c for c in df.columns if c not in (out, place)], F.coalesce(
            "__hit.following", A.empty_ints()).alias(out), *extra)

    def drop(self) -> None:
        """Forget the table's name; the files at ``path`` stay."""
        self.table.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def accepted_prefix(df: DataFrame, candidate="candidate", truth="truth",
                    cap="cap", out: str = "accepted") -> DataFrame:
    """NGR2: number of leading candidate ids that equal the truth, at most
    ``cap`` (``max_len - cur_len - 1`` in the decoding loop)."""
    return df.withColumn(out, A.accepted_prefix(candidate, truth, cap))


def run_summary(runs: DataFrame, prompt="prompt_ids", output="output_ids",
                seconds: str | None = None, by=None) -> DataFrame:
    """NGR3: runs and generated tokens (output minus prompt).  Where the log has
    measured ``seconds``, also their sum and tokens per second."""
    gen = F.size(output) - F.size(prompt)
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_runs"),
            F.sum(gen).cast("bigint").alias("generated")]
    if seconds:
        aggs += [F.sum(seconds).cast("double").alias("seconds"),
                 (F.sum(gen) / F.sum(seconds)).alias("tokens_per_second")]
    grouped = runs.groupBy(by) if by else runs
    return grouped.agg(*aggs)
