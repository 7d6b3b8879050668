"""Engine-neutral output types for cross-engine comparison.

Instants become epoch seconds (bigint), narrow integers become bigint and
decimals become double, so a result compares equal to another engine's result
without depending on how either engine renders timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.TimestampType):
            c = F.unix_seconds(c)
        elif isinstance(t, T.TimestampNTZType):
            c = F.unix_timestamp(c)
        elif isinstance(t, T.DateType):
            c = F.unix_date(c).cast("bigint") * 86400
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
