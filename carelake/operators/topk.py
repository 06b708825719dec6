"""Ordering helpers with a total order (ties broken by key columns).

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: every partition
keeps its own top n and only those rows reach the final merge, so a top-k
never moves the whole input to one task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, n: int, by: Sequence[Column], tie_break: Sequence[str]) -> DataFrame:
    return df.orderBy(*by, *[F.col(c).asc_nulls_first() for c in tie_break]).limit(n)


def ordered(df: DataFrame, by: Sequence[Column], tie_break: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*by, *[F.col(c).asc_nulls_first() for c in tie_break])
