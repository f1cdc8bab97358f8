"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """``yyyyMMdd`` as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_columns(day: Column) -> dict[str, Column]:
    """Attributes of the date dimension; weeks and weekdays follow ISO (Monday = 1)."""
    weekday = F.weekday(day) + 1
    return {
        "DateSK": date_key(day).cast("bigint"),
        "CalendarDate": F.date_format(day, "yyyy-MM-dd"),
        "Year": F.year(day).cast("bigint"),
        "Quarter": F.quarter(day).cast("bigint"),
        "Month": F.month(day).cast("bigint"),
        "MonthName": F.date_format(day, "MMMM"),
        "Day": F.dayofmonth(day).cast("bigint"),
        "DayOfWeek": weekday.cast("bigint"),
        "DayName": F.date_format(day, "EEEE"),
        "IsWeekend": weekday >= 6,
        "WeekOfYear": F.weekofyear(day).cast("bigint"),
    }
