"""Extracts from source tables and the date-partitioned raw layer. Day folders are days in UTC."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions import hash_expr
from strata.operators.shape import merged_schema, require_columns
from strata.sources.metadata import NO_WATERMARK

_DAY_FOLDERS = {"year": "yyyy", "month": "MM", "day": "dd"}
RESCUED = "rescued_values"  # texts that did not convert; stays in the raw layer
# Names with an underscore are no data to Spark.
_SCHEMA_FILE = "_schema.json"


def extract_full(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The configured columns of all rows."""
    require_columns(source, columns, "source")
    return source.select(*columns)


def extract_delta(
    source: DataFrame, columns: Sequence[str], watermark_column: str, low: object, high: object, *, unmarked: bool = True
) -> DataFrame:
    """Rows with ``low < watermark <= high``; the bounds are literals, so they reach the source scan.

    Without ``low``, on a first load, there is no lower bound. Rows without a watermark can't be told to be old, so
    every extract takes them (later layers drop what did not change), unless ``unmarked=False``.
    """
    mark = F.col(watermark_column)
    wanted = F.lit(False) if high is None else mark <= F.lit(high)
    if low is not None:
        wanted = (mark > F.lit(low)) & wanted
    if unmarked:
        wanted = mark.isNull() | wanted
    return extract_full(source.filter(wanted), columns)


def not_copied(rows: DataFrame, raw: DataFrame, watermark_column: str) -> DataFrame:
    """Rows without a watermark that the raw layer does not hold yet, compared by all their columns.

    Only raw rows without a watermark are read. Rows that are equal in every column count as one.
    """
    known = raw.filter(F.col(watermark_column).isNull()).select(hash_expr(rows.columns, safe=True).alias("_copy"))
    hashed = rows.withColumn("_copy", hash_expr(rows.columns, safe=True))
    return hashed.join(known, "_copy", "left_anti").select(*rows.columns)


def source_high_water(source: DataFrame, watermark_column: str, default: datetime = NO_WATERMARK) -> DataFrame:
    """One row: the greatest watermark, or the default for an empty source."""
    mark = F.max(watermark_column).cast("timestamp")
    return source.agg(F.coalesce(mark, F.lit(default)).alias("high_water"))


def add_lineage(df: DataFrame, source_id: str, audit_ts: datetime) -> DataFrame:
    """Source system and copy time, the same for all rows of one copy."""
    return df.withColumns({"source_id": F.lit(source_id), "audit_ts": F.lit(audit_ts).cast("timestamp")})


def bronze_path(root: str, source_system: str, source_object: str) -> str:
    return f"{root.rstrip('/')}/Bronze/{source_system}/{source_object}"


def write_bronze(df: DataFrame, path: str, load_ts: datetime | None = None) -> None:
    """Append one copy to the folder of its load day.

    Without ``load_ts`` each row goes to the day of its ``audit_ts``, for a history of copies. The columns and
    types of all copies are recorded beside them; a column whose new type can't hold its
    earlier values is an error before anything is written.
    """
    record_schema(df.sparkSession, path, df.schema)
    if load_ts is not None:
        folder = load_ts.astimezone(timezone.utc).strftime("year=%Y/month=%m/day=%d")
        df.write.mode("append").option("compression", "snappy").parquet(f"{path}/{folder}")
        return
    day = {name: F.date_format("audit_ts", pattern) for name, pattern in _DAY_FOLDERS.items()}
    # Few files per day, while a day with many rows still spreads over several tasks.
    dated = df.withColumns(day).hint("rebalance", *day)
    dated.write.mode("append").option("compression", "snappy").partitionBy(*day).parquet(path)


def read_bronze(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """The raw layer; with ``since``, only day folders from that day on are listed and read.

    Copies made before a column was configured read as NULL there, and those made before its type widened
    read as the wider type. The recorded schema spares reading the footers of all files.
    """
    schema = recorded_schema(spark, path)
    df = (spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")).parquet(path)
    return df if since is None else since_day(df, since)


def recorded_schema(spark: SparkSession, path: str) -> StructType | None:
    file, files = _schema_file(spark, path)
    if not files.exists(file):
        return None
    stream = files.open(file)
    try:
        return StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def record_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """Merge the schema of a new copy into that of all copies."""
    file, files = _schema_file(spark, path)
    known = recorded_schema(spark, path)
    if known is None and files.exists(file.getParent()):  # copies from before schemas were recorded
        found = spark.read.option("mergeSchema", "true").parquet(path).schema
        known = StructType([f for f in found if f.name not in _DAY_FOLDERS])
    plain = StructType.fromJson(json.loads(schema.json()))
    for f in plain:
        f.nullable, f.metadata = True, {}
    merged = merged_schema(known, plain) if known else plain
    if merged != known or not files.exists(file):
        stream = files.create(file, True)
        stream.write(bytearray(merged.json(), "utf-8"))
        stream.close()
    return merged


def _schema_file(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(path, _SCHEMA_FILE)
    return file, file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def since_day(df: DataFrame, since: datetime) -> DataFrame:
    """Rows in day partitions at or after the day of ``since`` (a partition filter)."""
    year, month, day = F.col("year"), F.col("month"), F.col("day")
    first = since.astimezone(timezone.utc)
    later_month = (year == first.year) & (month > first.month)
    same_month = (year == first.year) & (month == first.month) & (day >= first.day)
    return df.filter((year > first.year) | later_month | same_month)


def newer_than(df: DataFrame, ts: str, since: datetime | None) -> DataFrame:
    """Rows strictly newer than ``since``; all rows when there is no mark yet."""
    return df if since is None else df.filter(F.col(ts) > F.lit(since))
