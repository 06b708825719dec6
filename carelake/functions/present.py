"""Result presentation for callers that convert to pandas.

Spark's ``toPandas`` and DuckDB's ``df()`` disagree on DATE (``datetime.date``
objects vs ``datetime64``) and DECIMAL (``Decimal`` objects vs ``float64``).
Query results handed to clients are therefore presented as:
DATE -> ISO ``yyyy-MM-dd`` text, DECIMAL -> DOUBLE, small integers -> BIGINT.
The stored tables keep their exact types; this is applied only at the edge.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DecimalType, IntegerType, ShortType


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, DecimalType):
            c = c.cast("double")
        elif isinstance(t, (ByteType, ShortType, IntegerType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
