"""Calendar columns from text time stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRIP_FORMAT = "M/d/yyyy H:mm:ss"


def parse_time(col: Column, pattern: str = TRIP_FORMAT) -> Column:
    """NULL for text that does not fit the pattern."""
    return F.try_to_timestamp(col, F.lit(pattern))


def parse_day(col: Column, pattern: str = TRIP_FORMAT) -> Column:
    """The date of a date-time text: the whole text is parsed, then the time is dropped."""
    return F.to_date(parse_time(col, pattern))


def with_calendar(df: DataFrame, source: str, pattern: str | None = TRIP_FORMAT) -> DataFrame:
    """Add ``time, day, year, month, dayofmonth, weekday, hour, minute, second``; Sunday is weekday 1."""
    time = parse_time(F.col(source), pattern) if pattern else F.col(source)
    parsed = df.withColumn("time", time)
    t = F.col("time")
    return parsed.withColumns(
        {
            "day": F.to_date(t),
            "year": F.year(t),
            "month": F.month(t),
            "dayofmonth": F.dayofmonth(t),
            "weekday": F.dayofweek(t),
            "hour": F.hour(t),
            "minute": F.minute(t),
            "second": F.second(t),
        }
    )
