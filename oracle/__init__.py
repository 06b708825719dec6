"""Independent DuckDB SQL oracle for every registered query.

Written directly in SQL against the driver tables (region, nation, customer,
supplier, part, orders, lineitem, events): RAW recipe -> rules -> QUALIFY
dedup -> star schema -> query.  Results are presented like the Spark side
(``carelake.functions.present``): dates as ISO text, money as DOUBLE, counts
as BIGINT.  Rounded rates and averages are computed in exact integer
arithmetic, HALF_UP, so they do not depend on binary floating point.
"""

from oracle.queries import oracle_queries

__all__ = ["oracle_queries"]
