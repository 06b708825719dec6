"""Foreign-key filters as semi / anti joins.

Both only need the dimension's key column; Catalyst prunes the rest, and a
dimension under the broadcast threshold is broadcast by size statistics.
"""

from pyspark.sql import DataFrame


def fk_valid(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose ``key`` exists in ``dim`` (left semi join)."""
    return fact.join(dim.select(key), key, "left_semi")


def fk_orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose ``key`` is missing from ``dim`` (left anti join)."""
    return fact.join(dim.select(key), key, "left_anti")
