"""Catalog tables that can be replaced while they are read.

A table ``t`` is a view over one of two stored tables, ``t__a`` and ``t__b``. A replacement
is written to the idle one, then the view is pointed at it: one catalog change, no file is
moved or copied, readers of the old version finish undisturbed, and a load that fails half
way leaves ``t`` as it was.

A table may be kept in buckets of a key: partitions by a hash of it, which the view hides. Then an
update of some keys rewrites their buckets only. Where buckets are the only partitions, each of them is also a
bucket that Spark's planner knows, so joins and rankings by the key do not shuffle the stored side.
Where they divide other partitions, such as months, an update rewrites (month, bucket) pairs.

A table can have Bloom filters on columns by which later loads look rows up, and a register: the largest
surrogate key and the number of rows, kept as properties of the view.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import groupby
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.errors import MissingTable, UnknownColumns
from strata.functions import packed, unpacked
from strata.operators.shape import align_to, wider_types, with_types

_SIDES = ("a", "b")
_SIDE_PROPERTY = "strata.side"
_BUCKET_PROPERTY = "strata.buckets"
_PARTITION_PROPERTY = "strata.partitions"
_INDEX_PROPERTY = "strata.indexed"
_REGISTER_PROPERTY = "strata.register"
_OPEN = "open"
BUCKET = "key_bucket"


@dataclass(frozen=True)
class Layout:
    """How the rows of a table are stored: partition columns, buckets (key and number), columns with Bloom filters."""

    partition_by: tuple[str, ...] = ()
    buckets: tuple[str, int] | None = None
    indexed: tuple[str, ...] = ()

    @property
    def partitions(self) -> tuple[str, ...]:
        return (*self.partition_by, BUCKET) if self.buckets else self.partition_by


@dataclass
class Register:
    """Largest surrogate key that was given out and number of rows of a table, and whether they had to be counted anew."""

    high: int = 0
    rows: int = 0
    counted: bool = field(default=False, compare=False)


class Tables:
    """Tables of one database."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark = spark
        self.database = database
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")

    @classmethod
    def temporary(cls, spark: SparkSession, folder: str) -> Tables:
        """A database of its own under ``folder``; ``drop_database`` removes it."""
        name = f"strata_{uuid4().hex}"
        return cls(spark, name, f"{folder}/{name}")

    def drop_database(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        if not self.exists(table):
            raise MissingTable(f"table {self.name(table)} does not exist")
        return self.spark.table(self.name(table))

    def stored(self, table: str) -> DataFrame:
        """The rows with the columns that the view hides, for pruning."""
        return self.spark.table(self._stored(table))

    def create(
        self,
        df: DataFrame,
        table: str,
        partition_by: Sequence[str] = (),
        *,
        buckets: tuple[str, int] | None = None,
        indexed: Sequence[str] = (),
    ) -> None:
        """First version of a table; ``buckets`` names the key and the number of its buckets."""
        self._publish(df, table, "a", Layout(tuple(partition_by), buckets, tuple(indexed)))

    def replace(self, df: DataFrame, table: str, partition_by: Sequence[str] | None = None) -> None:
        """New content for a table, which ``df`` may be reading; creates it if needed. The layout stays."""
        if not self.exists(table):
            return self.create(df, table, partition_by or ())
        layout = self.layout(table)
        if partition_by is not None:
            layout = Layout(tuple(partition_by), layout.buckets, layout.indexed)
        self._publish(df, table, self._idle(table), layout)

    def redeal(self, table: str, number: int) -> None:
        """Deal the rows of a table anew to another number of buckets; one copy of the table."""
        layout = self.layout(table)
        key, _ = layout.buckets
        self._publish(self.read(table), table, self._idle(table), Layout(layout.partition_by, (key, number), layout.indexed))

    def update_keys(self, table: str, keys: DataFrame, build: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the buckets that hold ``keys`` by what ``build`` makes of their rows.

        ``build`` must keep every row in its bucket. A table without buckets is replaced as a whole.
        """
        buckets = self.layout(table).buckets
        if buckets is None:
            return self.replace(build(self.read(table)), table)
        bucket = bucket_of(buckets)
        # At most as many rows as there are buckets.
        touched = sorted(row[0] for row in keys.select(bucket.alias(BUCKET)).distinct().collect())
        held = self.stored(table).filter(F.col(BUCKET).isin(*touched)).drop(BUCKET)
        self.replace_partitions(build(held).withColumn(BUCKET, bucket), table, BUCKET, touched, evolve=True)

    def append(self, df: DataFrame, table: str, *, evolve: bool = False) -> None:
        """Add rows, shaped like the table: columns that they lack are NULL.

        Columns that only ``df`` has are an error, or with ``evolve`` are added to the table. That is a
        catalog change; older files read as NULL there. With ``evolve``, a column whose type is wider in
        ``df`` gets that type, for which the table is copied once.
        """
        stored = self._widened(df, table, evolve)
        if buckets := self.layout(table).buckets:
            df = df.withColumn(BUCKET, bucket_of(buckets))
        align_to(df, self.spark.table(stored).schema).write.mode("append").insertInto(stored)

    def replace_partitions(
        self, df: DataFrame, table: str, partition: str | Sequence[str], touched: Sequence[object], *, evolve: bool = False
    ) -> None:
        """New content for the touched partitions only; ``df`` holds all their rows. New columns as in ``append``.

        ``partition`` is a column, or all partition columns, then ``touched`` has tuples. Those left
        without rows are dropped. Files are staged and exchanged when all tasks
        have finished, so ``df`` may read the table. Needs the setting
        ``spark.sql.sources.partitionOverwriteMode=dynamic``.
        """
        names = [partition] if isinstance(partition, str) else list(partition)
        places = {value if isinstance(value, tuple) else (value,) for value in touched}
        stored = self._widened(df, table, evolve)
        written = Observation()
        # At most one value per touched partition.
        rows = df.observe(written, F.collect_set(F.struct(*names)).alias("places"))
        rows = _dealt(align_to(rows, self.spark.table(stored).schema), names)
        rows.write.mode("overwrite").insertInto(stored)
        empty = places - {tuple(place) for place in written.get["places"]}
        specs = [", ".join(f"{name}={value!r}" for name, value in zip(names, place, strict=True)) for place in sorted(empty)]
        if specs:
            self.spark.sql(f"ALTER TABLE {stored} DROP IF EXISTS " + ", ".join(f"PARTITION ({spec})" for spec in specs))

    @contextmanager
    def registered(self, table: str, skey: str | None = None) -> Iterator[Register]:
        """The register of a table. What the block sets it to is kept if it ends without an error.

        While the block runs, the register is open. A load that fails leaves it so, and the next one counts
        the rows anew, as for a table without one. A table that does not exist yet has an empty one, and one
        without a surrogate key registers its rows only.
        """
        register = Register()
        if self.exists(table):
            register = self._register(table) or self._counted(table, skey)
            self._set(table, {_REGISTER_PROPERTY: _OPEN})
        yield register
        if self.exists(table):
            self._set(table, {_REGISTER_PROPERTY: f"{register.high} {register.rows}"})

    def _register(self, table: str) -> Register | None:
        kept = self._properties(table).get(_REGISTER_PROPERTY, _OPEN)
        return None if kept == _OPEN else Register(*map(int, kept.split()))

    def _counted(self, table: str, skey: str | None) -> Register:
        high = F.coalesce(F.max(skey), F.lit(0)) if skey else F.lit(0)
        return Register(*self.read(table).agg(high.cast("long"), F.count(F.lit(1))).first(), counted=True)

    def _set(self, table: str, properties: dict[str, str]) -> None:
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        self.spark.sql(f"ALTER VIEW {self.name(table)} SET TBLPROPERTIES ({listed})")

    def partition_count(self, table: str) -> int:
        """Partitions that hold rows."""
        return self.spark.sql(f"SHOW PARTITIONS {self._stored(table)}").count()

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name(table)}")
        for side in _SIDES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}__{side}")

    def _widened(self, df: DataFrame, table: str, evolve: bool) -> str:
        """The stored table, with the columns of ``df`` that it lacked and the wider types of ``df``."""
        stored = self._stored(table)
        known = {c.lower() for c in self.spark.table(stored).columns}
        added = [f for f in df.schema if f.name.lower() not in known and f.name != BUCKET]
        if added and not evolve:
            raise UnknownColumns(f"table {self.name(table)} lacks columns {[f.name for f in added]}")
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {stored} ADD COLUMNS ({columns})")
            self._point(table, self._side(table), self.layout(table))
        if evolve and (types := wider_types(self.spark.table(stored).schema, df.schema)):
            # Stored files can't change their types; the copy leaves the side that ``df`` may be reading.
            self.replace(with_types(self.read(table), types), table)
        return self._stored(table)

    def _publish(self, df: DataFrame, table: str, side: str, layout: Layout) -> None:
        if layout.buckets:
            df = df.withColumn(BUCKET, bucket_of(layout.buckets))
        writer = df.write
        if layout.partitions:
            # Few files per partition value, and a value with many rows still spreads over tasks.
            writer = _dealt(df, layout.partitions).write.partitionBy(*layout.partitions)
        if layout.buckets and not layout.partition_by:
            key, number = layout.buckets
            writer = writer.bucketBy(number, key)
        if layout.indexed:
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        for column in layout.indexed:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        # The idle side may have been laid out differently; a plain drop keeps this a full overwrite.
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}__{side}")
        writer.mode("overwrite").format("parquet").saveAsTable(f"{self.name(table)}__{side}")
        self._point(table, side, layout)

    def _point(self, table: str, side: str, layout: Layout) -> None:
        stored = f"{self.name(table)}__{side}"
        properties = {_SIDE_PROPERTY: side}
        if layout.buckets:
            properties[_BUCKET_PROPERTY] = f"{layout.buckets[1]} {layout.buckets[0]}"
        for name, columns in ((_PARTITION_PROPERTY, layout.partition_by), (_INDEX_PROPERTY, layout.indexed)):
            if columns:
                properties[name] = ",".join(columns)
        if self.exists(table) and (kept := self._properties(table).get(_REGISTER_PROPERTY)):
            properties[_REGISTER_PROPERTY] = kept
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        hidden = BUCKET if layout.buckets else None
        columns = ", ".join(f"`{c}`" for c in self.spark.table(stored).columns if c != hidden)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} TBLPROPERTIES ({listed}) AS SELECT {columns} FROM {stored}")

    def layout(self, table: str) -> Layout:
        properties = self._properties(table)
        number, _, key = properties.get(_BUCKET_PROPERTY, "").partition(" ")
        listed = (properties.get(name, "") for name in (_PARTITION_PROPERTY, _INDEX_PROPERTY))
        partition_by, indexed = (tuple(filter(None, names.split(","))) for names in listed)
        return Layout(partition_by, (key, int(number)) if key else None, indexed)

    def _properties(self, table: str) -> dict[str, str]:
        return {row["key"]: row["value"] for row in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()}

    def _side(self, table: str) -> str:
        return self._properties(table)[_SIDE_PROPERTY]

    def _idle(self, table: str) -> str:
        return next(side for side in _SIDES if side != self._side(table))

    def _stored(self, table: str) -> str:
        if not self.exists(table):
            raise MissingTable(f"table {self.name(table)} does not exist")
        return f"{self.name(table)}__{self._side(table)}"


def _dealt(df: DataFrame, places: Sequence[str]) -> DataFrame:
    """Rows dealt to tasks by their partition; the hashes go there as bytes."""
    hashes = [f.name for f in df.schema if f.name in ("hash_key", "row_hash") and isinstance(f.dataType, StringType)]
    dealt = df.withColumns({c: packed(c) for c in hashes}).hint("rebalance", *places)
    return dealt.withColumns({c: unpacked(c) for c in hashes})


def bucket_of(buckets: tuple[str, int]) -> Column:
    """The bucket of a row, the same that Spark gives it in a table bucketed by the key."""
    key, number = buckets
    return F.pmod(F.hash(F.col(key)), F.lit(number)).cast("int")


def in_places(names: Sequence[str], places: Sequence[tuple]) -> Column:
    """Whether a row is in one of the partitions (of one or two columns); a filter that prunes by both."""
    chosen = F.lit(False)
    for first, group in groupby(sorted(places), key=lambda place: place[0]):
        rest = list(zip(*(place[1:] for place in group), strict=True))
        inner = F.col(names[0]) == F.lit(first)
        for name, values in zip(names[1:], rest, strict=True):
            inner = inner & F.col(name).isin(*set(values))
        chosen = chosen | inner
    return chosen
