"""Result normalisation shared by every registered query: timestamps as
'yyyy-MM-dd HH:mm:ss' text, doubles rounded to 6 decimals, integers as
bigint -- the same normalisation the DuckDB oracle texts apply."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               TimestampNTZType, TimestampType, DecimalType)


def finalize(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        elif isinstance(t, (DoubleType, FloatType, DecimalType)):
            cols.append(F.round(c.cast("double"), digits).alias(f.name))
        elif isinstance(t, (ByteType, ShortType, IntegerType)):
            cols.append(c.cast("bigint").alias(f.name))
        else:
            cols.append(c.alias(f.name))
    return df.select(*cols)
