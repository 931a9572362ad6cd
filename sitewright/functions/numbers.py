"""Column expressions over numbers and flags."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: str | Column, whole: str | Column) -> Column:
    """part / whole as a double; null when whole is 0."""
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: str | Column, whole: str | Column, digits: int | None = 2) -> Column:
    value = ratio(part, whole) * 100
    return value if digits is None else F.round(value, digits)


def rows_where(condition: Column) -> Column:
    return F.count_if(condition)


def flagged(column: str) -> Column:
    """Rows whose flag is set, as a sum: null over no rows at all, unlike a count."""
    return F.sum(F.when(F.col(column).cast("boolean"), 1).otherwise(0))
