"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import calendar_columns

FIRST_DAY, LAST_DAY = date(1999, 1, 1), date(2030, 12, 31)  # fixed values: default range


def calendar(spark: SparkSession, start: date = FIRST_DAY, end: date = LAST_DAY) -> DataFrame:
    """One row per day from start to end, both included."""
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar_between(bounds)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """The same for a frame of ``start`` and ``end`` dates, such as the range found in a table."""
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("_day"))
    return days.select(*calendar_columns(F.col("_day")))
