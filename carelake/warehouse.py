"""Name resolution RAW -> CORE -> MART over lazy DataFrames.

A :class:`Warehouse` maps table names to DataFrames.  Names it holds
explicitly (RAW inputs, or tables read back from storage) win; every other
name is derived by its builder in :mod:`carelake.plans.registry`.  Plans are
memoised per instance, so a query that reads ``fact_billing`` twice shares one
logical subtree (Catalyst reuses the exchange).

Masking (K4) happens here, when a table is resolved for a caller with a
role: every downstream view, group-by and join sees masked values, just like
a column policy evaluated at read time.  Without a role everything a
policy covers is masked.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from carelake.constants import AS_OF_DEFAULT, EXEMPT_ROLES_DEFAULT


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None,
        *,
        role: str | None = None,
        exempt_roles: Sequence[str] = EXEMPT_ROLES_DEFAULT,
        as_of: datetime.date = AS_OF_DEFAULT,
        masked: bool = True,
        policies=None,
    ) -> None:
        from carelake.plans.masking import default_policies

        self.spark = spark
        self._own_policies = policies
        self.policies = policies or default_policies()  # an immutable set: this warehouse's for good
        self.role = role
        self.exempt_roles = tuple(exempt_roles)
        self.as_of = as_of
        self.masked = masked  # False only for the jobs that write tables
        self._given = dict(tables or {})
        self._memo: dict[str, DataFrame] = {}

    # ------------------------------------------------------------ factories
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> Warehouse:
        """RAW tables derived from the driver parquet tables under ``sf_dir``.

        Each RAW table is built on first use, so a query touching one domain
        never lists or reads the files of the others.
        """
        from carelake.sources.fixtures import RAW_BUILDERS

        lazy = {f"raw_{d}": (lambda b=b: b(spark, sf_dir)) for d, b in RAW_BUILDERS.items()}
        return cls(spark, lazy, **kw)

    @classmethod
    def from_landing(cls, spark: SparkSession, landing: str, **kw) -> Warehouse:
        """RAW tables scanned directly from a CSV landing directory."""
        from carelake.constants import DOMAINS
        from carelake.sources.csv import read_landing

        lazy = {f"raw_{d}": (lambda d=d: read_landing(spark, landing, d)) for d in DOMAINS}
        return cls(spark, lazy, **kw)

    @classmethod
    def from_storage(cls, spark: SparkSession, root: str, names: Sequence[str] | None = None, **kw) -> Warehouse:
        """Tables previously written by :mod:`carelake.pipeline` under ``root``."""
        from carelake.sources.sinks import read_stored_tables

        return cls(spark, read_stored_tables(spark, root, names), **kw)

    def with_role(self, role: str | None, exempt_roles: Sequence[str] | None = None) -> Warehouse:
        """Same tables seen by another role (plans are not shared)."""
        return Warehouse(
            self.spark,
            self._given,
            role=role,
            exempt_roles=self.exempt_roles if exempt_roles is None else exempt_roles,
            as_of=self.as_of,
            masked=self.masked,
            policies=self._own_policies,
        )

    def with_policies(self, policies) -> Warehouse:
        """Same tables and role under another set of masking policies (``plans.masking.PolicySet``)."""
        return Warehouse(self.spark, self._given, role=self.role, exempt_roles=self.exempt_roles, as_of=self.as_of,
                         masked=self.masked, policies=policies)

    # ----------------------------------------------------------- resolution
    def resolve(self, name: str) -> DataFrame:
        """Unmasked table (what the refresh jobs themselves read)."""
        if name in self._given:
            given = self._given[name]
            if callable(given) and not isinstance(given, DataFrame):
                given = self._given[name] = given()
            return given
        if name not in self._memo:
            from carelake.plans.registry import BUILDERS

            if name not in BUILDERS:
                raise KeyError(f"unknown table {name!r}")
            self._memo[name] = BUILDERS[name](self)
        return self._memo[name]

    def holds(self, name: str) -> bool:
        """Whether ``name`` was given (stored), rather than derived."""
        return name in self._given

    def table(self, name: str) -> DataFrame:
        """Table as seen by this warehouse's role (masking policies applied)."""
        from carelake.plans.masking import apply_policies

        return apply_policies(self, name, self.resolve(name))

    def register_views(self, names: Sequence[str] | None = None, prefix: str = "") -> list[str]:
        """Expose tables as temp views so SQL strings run unchanged.

        Views are lazy (no data is read) and carry this warehouse's masking,
        so ``SELECT ... FROM DIM_PATIENT`` sees what the role may see.
        """
        done = []
        for n in names or self.names():
            if n.startswith("prepared_"):
                continue
            self.table(n).createOrReplaceTempView(prefix + n)
            done.append(prefix + n)
        return done

    def sql(self, query: str) -> DataFrame:
        """Run a SQL string over this warehouse's tables (registered on first use)."""
        if not getattr(self, "_registered", False):
            self.register_views()
            self._registered = True
        return self.spark.sql(query)

    def names(self) -> list[str]:
        from carelake.plans.registry import BUILDERS

        return sorted(set(self._given) | set(BUILDERS))


TableBuilder = Callable[[Warehouse], DataFrame]
