"""First rows of an order by distributed selection (FLT5, SPL1).

To keep the first n rows nobody has to number, or write, all of them: the n-th
key is enough.  It is found from counts.  Keys alone are range-partitioned;
rows per group and partition are counted, and running sums say which
partition holds each group's n-th key; only those partitions are ranked.  Then
one narrow comparison with the key decides about a row, whatever its width.  Rows
that have the n-th key itself are numbered, so that n is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.operators.order import SortKey, precedes, sort_keys
from tunesmith.operators.position import ranged_keys
from tunesmith.session import scratch_table
from tunesmith.streaming.files import require_static


def cut_keys(keyed: DataFrame, keys: list[SortKey], names: list[str], wanted) -> DataFrame:
    """(names..., keep) with the key of each group's last wanted row, and how
    many of the rows with that key are wanted; the group is the first of
    ``names``.  ``wanted`` gives the number of rows from the group's size."""
    group, rest = names[0], names[1:]
    local = ranged_keys(keyed, keys, names)
    counts = local.groupBy(group, "__pid").agg(F.count(F.lit(1)).alias("__n"))
    own = Window.partitionBy(group)
    before = F.sum("__n").over(own.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(group, "__pid", "__n", F.coalesce(before, F.lit(0)).alias("__before"),
                           F.sum("__n").over(own).alias("__all"))
    counts = counts.withColumn("__nth", F.least(wanted(F.col("__all")), "__all") - F.col("__before"))
    where = counts.filter((F.col("__nth") > 0) & (F.col("__nth") <= F.col("__n"))).select(
        F.struct(group).alias("__group"), F.col("__pid").alias("__at"), "__nth")
    rows = local.join(where, (F.struct(group) == F.col("__group")) & (F.col("__pid") == F.col("__at")))
    order = Window.partitionBy("__group").orderBy(*[k.column(n) for k, n in zip(keys[1:], rest)])
    rows = rows.select(*names, "__nth", F.row_number().over(order).alias("__row"),
                       F.rank().over(order).alias("__rank"))
    cuts = rows.filter(F.col("__row") == F.col("__nth")).select(
        *names, (F.col("__nth") - F.col("__rank") + 1).alias("__keep"))
    return scratch_table(cuts, "cuts")


def divided(df: DataFrame, order_by, wanted, by: str | None = None) -> DataFrame:
    """``df`` with ``__in``, whether a row is one of the wanted first rows of
    its group."""
    require_static(df, "selection")
    keys = sort_keys([F.lit(0) if by is None else by]) + sort_keys(order_by)
    names = [f"__k{i}" for i in range(len(keys))]
    keyed = df.select("*", *[k.value.alias(n) for k, n in zip(keys, names)])
    cuts = cut_keys(keyed, keys, names, wanted)
    cuts = cuts.select(F.struct(names[0]).alias("__group"), "__keep",
                       *[F.col(n).alias(f"__c{i}") for i, n in enumerate(names)])
    rows = keyed.withColumn("__group", F.struct(names[0])).join(cuts, "__group", "left")
    mine: list[Column] = [F.col(n) for n in names[1:]]
    cut = [F.col(f"__c{i}") for i in range(1, len(names))]
    same = F.col("__keep").isNotNull()
    for a, b in zip(mine, cut):
        same = same & a.eqNullSafe(b)
    inside = F.col("__keep").isNotNull() & precedes(keys[1:], mine, cut)
    clear = rows.filter(~same).select(*df.columns, inside.alias("__in"))
    nth = F.row_number().over(Window.partitionBy("__group").orderBy("__keep"))
    tied = rows.filter(same).select(*df.columns, (nth <= F.col("__keep")).alias("__in"))
    return clear.unionByName(tied)


def first_rows(df: DataFrame, n: int, order_by, by: str | None = None) -> DataFrame:
    """The first ``n`` rows in ``order_by`` order, of each ``by`` group (null is
    a group of its own)."""
    return divided(df, order_by, lambda size: F.lit(n).cast("bigint"), by).filter("__in").drop("__in")
