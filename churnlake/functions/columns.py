"""Column-expression helpers (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def ts_lit(value: dt.datetime | str) -> Column:
    """Timestamp literal read in the session zone (UTC): built from text, so
    the driver process's own time zone never enters."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(value).cast("timestamp")


def floor_days(later, earlier) -> Column:
    """Whole days of elapsed time, floored (the pandas ``Timedelta.days``
    meaning).  ``datediff`` counts calendar boundaries instead and differs
    when times are not midnight."""
    later = F.col(later) if isinstance(later, str) else later
    earlier = F.col(earlier) if isinstance(earlier, str) else earlier
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(float(MICROS_PER_DAY)))


def age_group_code(age, edges=(0, 25, 35, 50, 100)) -> Column:
    """Right-closed bins (e0,e1] -> 0, (e1,e2] -> 1, ...; outside or NULL -> 0."""
    age = F.col(age) if isinstance(age, str) else age
    expr = None
    for i in range(len(edges) - 1):
        cond = (age > edges[i]) & (age <= edges[i + 1])
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return F.coalesce(expr.otherwise(F.lit(0)), F.lit(0)).cast("bigint")


def round_half_even(c, digits: int = 4) -> Column:
    """Python's ``round`` (banker's rounding on the decimal value)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(c, digits)
