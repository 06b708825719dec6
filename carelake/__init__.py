"""carelake: a PySpark-native medallion warehouse for healthcare operations data.

RAW (all-string landed CSV) -> CORE (typed, validated, deduplicated, upserted)
-> MART (star schema, refreshed aggregates, analytical views), with rejected
records kept per broken rule and role-based column masking.  Everything is
expressed with DataFrame/SQL built-ins so Catalyst plans it end to end.
"""

from carelake.warehouse import Warehouse

__all__ = ["Warehouse"]
