"""Sort orders as values: keys that can be stored, joined and compared."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SortKey:
    """One key of a sort order."""

    value: Column
    descending: bool = False
    nulls_first: bool = True
    #: the column's name, if the value is just a column
    name: str | None = None

    def column(self, name: str) -> Column:
        """The order by a column that holds the value."""
        c = F.col(name)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    def before(self, a: Column, b: Column) -> Column:
        """Whether value ``a`` comes before value ``b`` (never null)."""
        first, last = (a, b) if self.nulls_first else (b, a)
        missing = first.isNull() & last.isNotNull()
        return missing | F.coalesce(a > b if self.descending else a < b, F.lit(False))


def sort_keys(order_by) -> list[SortKey]:
    """Keys of names, columns and sorted columns (``F.col(x).desc()``)."""
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    return [_sort_key(c) for c in order_by]


def _sort_key(c) -> SortKey:
    if isinstance(c, str):
        return SortKey(F.col(c), name=c)
    node = c._jc.node()
    if not node.getClass().getSimpleName() == "SortOrder":
        return SortKey(c, name=_name(node))
    jvm = SparkSession.getActiveSession()._jvm
    value = Column(jvm.org.apache.spark.sql.Column(node.child()))
    return SortKey(value, "Descending" in node.sortDirection().toString(),
                   "NullsFirst" in node.nullOrdering().toString(), _name(node.child()))


def _name(node) -> str | None:
    return node.sql().strip("`") if node.getClass().getSimpleName() == "UnresolvedAttribute" else None


def precedes(keys: list[SortKey], a: list[Column], b: list[Column]) -> Column:
    """Whether the row with values ``a`` comes before that with ``b``."""
    out = F.lit(False)
    for key, x, y in reversed(list(zip(keys, a, b))):
        out = key.before(x, y) | (x.eqNullSafe(y) & out)
    return out
