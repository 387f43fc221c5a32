"""Calendar helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

SECONDS_PER_DAY = 86400
# Epoch seconds of the first and the last second of the years 1 to 9999.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799


def epoch_year(seconds: Column) -> Column:
    """UTC year of an epoch-seconds value (text or number); null if it cannot be one."""
    whole = seconds.try_cast("bigint")
    days = F.floor(whole / F.lit(float(SECONDS_PER_DAY))).cast("int")
    epoch = F.lit("1970-01-01").cast("date")
    return F.when(whole.between(FIRST_SECOND, LAST_SECOND), F.year(F.date_add(epoch, days)))


def year_range(moment: Column, dtype: DataType, year: int) -> Column:
    """`year(moment) = year` as a half-open range, which reaches the file scan as a filter."""
    first = F.lit(f"{year:04d}-01-01").cast(dtype)
    after = F.lit(f"{year + 1:04d}-01-01").cast(dtype)
    return (moment >= first) & (moment < after)
