"""Column masking policies (K1-K3) as native Column expressions.

A policy takes the column, the caller's role and the list of exempt roles.
The role is an explicit argument because Spark has no session role.
"""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.constants import (
    EMAIL_MASK_PREFIX,
    EXEMPT_ROLES_DEFAULT,
    NAME_MASK,
    PHONE_MASK_PREFIX,
)


def _exempt(role: str | None, exempt_roles: Sequence[str]) -> bool:
    return role is not None and role in set(exempt_roles)


def mask_phone(c: Column, role: str | None, exempt_roles: Sequence[str] = EXEMPT_ROLES_DEFAULT) -> Column:
    """Exempt role -> value; NULL -> NULL; otherwise six stars + last 4 characters."""
    if _exempt(role, exempt_roles):
        return c
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(PHONE_MASK_PREFIX), F.right(c, F.lit(4)))
    )


def mask_email(c: Column, role: str | None, exempt_roles: Sequence[str] = EXEMPT_ROLES_DEFAULT) -> Column:
    """Exempt role -> value; NULL -> NULL; stars + text from the first '@'; else stars."""
    if _exempt(role, exempt_roles):
        return c
    at = F.instr(c, "@")
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(at > 0, F.concat(F.lit(EMAIL_MASK_PREFIX), F.substr(c, at)))
        .otherwise(F.lit(EMAIL_MASK_PREFIX))
    )


def mask_name(c: Column, role: str | None, exempt_roles: Sequence[str] = EXEMPT_ROLES_DEFAULT) -> Column:
    """Exempt role -> value; everything else (NULL included) -> stars."""
    if _exempt(role, exempt_roles):
        return c
    return F.lit(NAME_MASK)
