"""The CORE tables of a root."""

from carelake.schemas import KEYS
from carelake.sources.versioned import Table

#: Columns that the files of a CORE table are ordered by.
CORE_SORT = {"patients": [], "appointments": ["appt_date", "department"], "billing": ["bill_date", "department"]}


def core_table(root: str, domain: str) -> Table:
    return Table(f"{root}/core/{domain}", KEYS[domain], tuple(CORE_SORT[domain]))
