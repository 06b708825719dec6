"""K4: masking policies attached to table columns, applied at resolution.

Every role that is not exempt sees masked values, and so does a caller
without a role; refresh jobs read ``Warehouse.resolve``.  A set of policies is
immutable and bound to a :class:`Warehouse` when it is made, so two callers in
one process may work under different sets, and plans made under one never show
another's.  ``attach`` and ``detach`` put a new set in place of the default that
later warehouses take.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.masking import mask_email, mask_name, mask_phone

Policy = Callable  # (column, role, exempt roles) -> masked column


@dataclass(frozen=True)
class PolicySet:
    """Policies by table and column; ``version`` counts the changes since the first set."""

    tables: Mapping[str, Mapping[str, Policy]]
    version: int = 0

    def with_policy(self, table: str, column: str, policy: Policy) -> PolicySet:
        return self._replaced(table, {**self.tables.get(table, {}), column: policy})

    def without_policy(self, table: str, column: str) -> PolicySet:
        return self._replaced(table, {c: p for c, p in self.tables.get(table, {}).items() if c != column})

    def _replaced(self, table: str, columns: dict[str, Policy]) -> PolicySet:
        return PolicySet(MappingProxyType({**self.tables, table: MappingProxyType(columns)}), self.version + 1)


_PATIENT = MappingProxyType({"phone": mask_phone, "email": mask_email, "full_name": mask_name})
# Both the CORE table and the patient dimension.
_default = PolicySet(MappingProxyType({"core_patients": _PATIENT, "dim_patient": _PATIENT}))


def default_policies() -> PolicySet:
    return _default


def apply_policies(wh, name: str, df: DataFrame) -> DataFrame:
    policies = wh.policies.tables.get(name)
    if not policies or not wh.masked:
        return df
    cols = [
        policies[c](F.col(c), wh.role, wh.exempt_roles).alias(c) if c in policies else F.col(c)
        for c in df.columns
    ]
    return df.select(*cols)


def attach(table: str, column: str, policy: Policy) -> None:
    """ALTER ... SET MASKING POLICY, for warehouses made from now on."""
    global _default
    _default = _default.with_policy(table, column, policy)


def detach(table: str, column: str) -> None:
    """ALTER ... UNSET MASKING POLICY, for warehouses made from now on."""
    global _default
    _default = _default.without_policy(table, column)
