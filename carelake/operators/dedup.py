"""Keep the first row per key under an explicit total order.

Written as an aggregate, not a window: ``min(struct(order..., payload...))``
is combined map-side (partial aggregation), so a key that holds a third of
all rows is reduced inside every map task before the shuffle instead of being
sorted by one reducer.  The window form (``row_number() = 1``) cannot do that.
"""

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)


@dataclass(frozen=True)
class Order:
    """One sort term: ``column ASC|DESC NULLS FIRST|LAST``."""

    column: str
    descending: bool = False
    nulls_first: bool = True

    def sql(self) -> str:
        d = "DESC" if self.descending else "ASC"
        n = "NULLS FIRST" if self.nulls_first else "NULLS LAST"
        return f"{self.column} {d} {n}"


def asc(column: str, nulls_first: bool = True) -> Order:
    return Order(column, False, nulls_first)


def desc(column: str, nulls_first: bool = False) -> Order:
    return Order(column, True, nulls_first)


def _ascending_image(df: DataFrame, o: Order) -> Column:
    """A value whose ascending order equals the requested order of ``o``."""
    c = F.col(o.column)
    if not o.descending:
        return c
    t = df.schema[o.column].dataType
    if isinstance(t, DateType):
        return -F.unix_date(c)
    if isinstance(t, TimestampType):
        return -F.unix_micros(c)
    if isinstance(t, TimestampNTZType):
        # micros from the value back to the epoch: zone independent
        return F.timestamp_diff("MICROSECOND", c, F.lit(datetime.datetime(1970, 1, 1)).cast("timestamp_ntz"))
    if isinstance(t, (DecimalType, NumericType)):
        return -c
    raise TypeError(f"descending order on {t} is not supported for {o.column}")


def _original_from_image(df: DataFrame, o: Order, image: Column) -> Column | None:
    """The ordered column recovered from its ascending image, when exact."""
    if not o.descending:
        return image
    t = df.schema[o.column].dataType
    if isinstance(t, DateType):
        return F.date_from_unix_date(-image)
    if isinstance(t, (DecimalType, ByteType, ShortType, IntegerType, LongType)):
        return (-image).cast(t)
    return None  # floating point / timestamps: carry the original value


def first_per_key(df: DataFrame, key: str, order: Sequence[Order]) -> DataFrame:
    """Rows of ``df`` reduced to one per ``key``: the first under ``order``.

    Ties on every ordering term fall back to the remaining columns in schema
    order, so the result is deterministic whatever the input partitioning.

    The struct is kept narrow because it is what the shuffle carries: a
    NULL field sorts first under ``min``, so a null-placement flag is added
    only for NULLS LAST terms, and the original value is carried only when it
    cannot be recovered exactly from its ascending image.
    """
    ordered = {o.column for o in order}
    payload = [c for c in df.columns if c != key and c not in ordered]
    fields = []
    restore: dict[str, Column] = {}
    for i, o in enumerate(order):
        if not o.nulls_first:
            fields.append(F.col(o.column).isNull().alias(f"_n{i}"))
        fields.append(_ascending_image(df, o).alias(f"_o{i}"))
        back = _original_from_image(df, o, F.col(f"_best._o{i}"))
        if back is None:
            fields.append(F.col(o.column).alias(f"_v{i}"))
            back = F.col(f"_best._v{i}")
        restore[o.column] = back
    fields += [F.col(c).alias(c) for c in payload]
    best = df.groupBy(key).agg(F.min(F.struct(*fields)).alias("_best"))
    out = [F.col(key)]
    for c in df.columns:
        if c != key:
            out.append((restore[c] if c in ordered else F.col(f"_best.{c}")).alias(c))
    return best.select(*out)


def order_sql(order: Sequence[Order]) -> str:
    return ", ".join(o.sql() for o in order)
