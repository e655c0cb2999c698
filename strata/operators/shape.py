"""Cleaning and column shaping. Each operator is one projection over its input."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from strata.errors import IncompatibleTypes, MissingColumns
from strata.functions import blank_to_null

PARTITION_COLUMNS = ("year", "month", "day")
# Integer types by the number of decimal digits that hold all their values.
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
_MOST_DIGITS = 38


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    """Schema check; starts no Spark job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"{what} lacks columns {missing}")


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and turn blank strings into NULL."""
    return df.withColumns(
        {f.name: blank_to_null(_quoted(f.name)) for f in df.schema if isinstance(f.dataType, StringType)}
    )


def dates_to_timestamp(df: DataFrame) -> DataFrame:
    """Turn date and timestamp columns (with or without time zone) into ``timestamp``."""
    temporal = (DateType, TimestampType, TimestampNTZType)
    return df.withColumns(
        {f.name: F.to_timestamp(_quoted(f.name)) for f in df.schema if isinstance(f.dataType, temporal)}
    )


def drop_columns(df: DataFrame, names: Iterable[str], partition_columns: Iterable[str] = PARTITION_COLUMNS) -> DataFrame:
    """Drop the named columns (upper or lower case) and the file-partition columns."""
    unwanted = {n.lower() for n in (*names, *partition_columns)}
    return df.drop(*[c for c in df.columns if c.lower() in unwanted])


def select_configured(df: DataFrame, keys: Sequence[str], columns: Sequence[str], extra: Sequence[str] = ("audit_ts",)) -> DataFrame:
    """Keys, then configured columns, then extras: each once, and all must exist."""
    wanted = list(dict.fromkeys([*keys, *columns, *extra]))
    require_columns(df, wanted)
    return df.select(*[_quoted(c) for c in wanted])


def align_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Shape ``df`` like ``schema``: same order and types, absent columns NULL, others dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (_quoted(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def widest_type(a: DataType, b: DataType) -> DataType | None:
    """The type that holds all values of both, where one of them or a longer decimal does; else None."""
    if a == b:
        return a
    if type(a) in _DIGITS and type(b) in _DIGITS:
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    if {type(a), type(b)} == {FloatType, DoubleType}:
        return DoubleType()
    if {type(a), type(b)} <= {DecimalType, *_DIGITS}:
        decimals = [t if isinstance(t, DecimalType) else DecimalType(_DIGITS[type(t)], 0) for t in (a, b)]
        scale = max(t.scale for t in decimals)
        digits = max(t.precision - t.scale for t in decimals) + scale
        return DecimalType(digits, scale) if digits <= _MOST_DIGITS else None
    return None


def wider_types(stored: StructType, new: StructType) -> dict[str, DataType]:
    """Columns of ``stored`` that need another type to hold the values of ``new`` as well."""
    types = {f.name: f.dataType for f in new}
    widest = {f.name: widest_type(f.dataType, types[f.name]) for f in stored if f.name in types}
    return {f.name: widest[f.name] for f in stored if widest.get(f.name) not in (None, f.dataType)}


def with_types(df: DataFrame, types: Mapping[str, DataType]) -> DataFrame:
    return df.withColumns({name: _quoted(name).cast(type_) for name, type_ in types.items()}) if types else df


def merged_schema(old: StructType, new: StructType) -> StructType:
    """All columns of both, each with a type for the values of both; an error where there is none."""
    types = {f.name: f.dataType for f in new}
    fields = []
    for f in old:
        type_ = widest_type(f.dataType, types.get(f.name, f.dataType))
        if type_ is None:
            raise IncompatibleTypes(f"column {f.name}: {types[f.name].simpleString()} after {f.dataType.simpleString()}")
        fields.append(StructField(f.name, type_))
    return StructType([*fields, *[f for f in new if f.name not in old.names]])


def conform(df: DataFrame, schema: StructType, *, strict: bool = True, rescued: str | None = None) -> DataFrame:
    """Convert a source extract to declared types; digits and time of day may be cut off.

    Values that do not convert are an error, or NULL with ``strict=False``. With ``rescued``, a column of that
    name maps the columns of a row whose values became NULL to the text that they had, so
    that nothing is lost and ``rescued_counts`` can report it. Booleans are left as booleans: converting one
    to a number is an error, not a 0 or 1.
    """
    require_columns(df, schema.fieldNames())
    for f in schema:
        pair = (df.schema[f.name].dataType, f.dataType)
        if any(isinstance(t, BooleanType) for t in pair) and any(isinstance(t, NumericType) for t in pair):
            raise TypeError(f"column {f.name}: a boolean is not a number")
    strict = strict and rescued is None
    columns = [
        (_quoted(f.name).cast(f.dataType) if strict else _quoted(f.name).try_cast(f.dataType)).alias(f.name)
        for f in schema
    ]
    if rescued is None:
        return df.select(*columns)
    changed = [f for f in schema if df.schema[f.name].dataType != f.dataType]
    lost = F.create_map(
        *[part for f in changed for part in (F.lit(f.name), _unconverted(f))]
    ) if changed else F.create_map().cast("map<string,string>")
    return df.select(*columns, F.map_filter(lost, lambda _, text: text.isNotNull()).alias(rescued))


def _unconverted(field: StructField) -> Column:
    source = _quoted(field.name)
    return F.when(source.isNotNull() & source.try_cast(field.dataType).isNull(), source.cast("string"))


def rescued_counts(schema: StructType, rescued: str) -> dict[str, Column]:
    """Metrics: how many values of each column did not convert."""
    return {
        f"rescued {f.name}": F.count_if(F.map_contains_key(rescued, f.name))
        for f in schema
    }


def move_first(df: DataFrame, column: str) -> DataFrame:
    """The given column first, the others in their old order."""
    return df.select(_quoted(column), *[_quoted(c) for c in df.columns if c != column])


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema; costs no scan of ``df``."""
    return df.sparkSession.createDataFrame([], df.schema)


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")
