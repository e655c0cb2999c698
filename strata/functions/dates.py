"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(day: Column) -> list[Column]:
    """The 18 attributes of one calendar day. Weeks are ISO weeks; day 1 is Sunday."""
    quarter_name = F.concat(F.lit("Q"), F.quarter(day).cast("string"))
    weekday = F.dayofweek(day)

    def formatted(pattern: str) -> Column:
        return F.date_format(day, pattern)

    attributes = {
        "date_key": formatted("yyyyMMdd").cast("int"),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "quarter_name": quarter_name,
        "month": F.month(day),
        "month_name": formatted("MMMM"),
        "month_short": formatted("MMM"),
        "day": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name": formatted("EEEE"),
        "day_short": formatted("EEE"),
        "week_of_year": F.weekofyear(day),
        "is_weekend": (weekday == 1) | (weekday == 7),
        "is_month_start": F.dayofmonth(day) == 1,
        "is_month_end": F.last_day(day) == day,
        "year_month_key": formatted("yyyyMM").cast("int"),
        "year_quarter": F.concat_ws("-", F.year(day).cast("string"), quarter_name),
    }
    return [value.alias(name) for name, value in attributes.items()]
