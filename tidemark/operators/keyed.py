"""Tables with one row per key, where a later write of a key replaces the earlier one.

A write adds only its own rows, as one ``put=<writer>-<batch id>`` directory; reading keeps the greatest row
of each key by (ordering columns, batch id, writer). A greatest row does not depend on how often or in what
order rows were added, so replaying any batch, old or new, changes nothing, and no write ever
rewrites the table. The cost of a write follows the batch, not the table. Writers whose batch ids are counted
apart, such as two streams, need names of their own: the same name and batch id replaces that put.

``compact`` writes the newest rows as a fresh table elsewhere, by ranges of the key, and leaves the old one as it is; the
caller points readers and writers to the fresh one. Where a catalog holds a table format with row-level writes,
``merge_into`` does the same by ``MERGE``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException, UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import names_in, scratch_dir

# The two column catalogs.
USER_PROFILE_CATALOG = """{
  "table": {"namespace": "default", "name": "user_profile"},
  "rowkey": "user_id",
  "columns": {
    "user_id": {"cf": "rowkey", "col": "user_id", "type": "string"},
    "user_fname": {"cf": "cf", "col": "user_fname", "type": "string"},
    "user_lname": {"cf": "cf", "col": "user_lname", "type": "string"}
  }
}"""
LOG_AGG_CATALOG = """{
  "table": {"namespace": "default", "name": "log_agg"},
  "rowkey": "key",
  "columns": {
    "key": {"cf": "rowkey", "col": "key", "type": "long"},
    "application": {"cf": "cf", "col": "application", "type": "string"},
    "module": {"cf": "cf", "col": "module", "type": "string"},
    "message": {"cf": "cf", "col": "message", "type": "string"}
  }
}"""

KEY_FAMILY = "rowkey"


@dataclass(frozen=True)
class Catalog:
    """Logical columns mapped to stored columns and types, one of them the row key."""

    name: str
    key: str
    columns: tuple[tuple[str, str, str], ...]  # (logical name, stored name, type)

    @classmethod
    def parse(cls, text: str, family_prefix: bool = False) -> Catalog:
        """Read a JSON catalog. With ``family_prefix`` the stored name is ``family_column``."""
        document = json.loads(text)
        columns, key = [], None
        for logical, cell in document["columns"].items():
            is_key = cell["cf"] == KEY_FAMILY
            stored = f"{cell['cf']}_{cell['col']}" if family_prefix and not is_key else cell["col"]
            columns.append((logical, stored, cell["type"]))
            if is_key and cell["col"] == document["rowkey"]:
                key = stored
        if key is None:
            raise ValueError(f"no column of family {KEY_FAMILY!r} is named {document['rowkey']!r}")
        return cls(document["table"]["name"], key, tuple(columns))

    @property
    def stored(self) -> list[str]:
        return [stored for _, stored, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(stored, T.DataType.fromDDL(kind)) for _, stored, kind in self.columns])

    def project(self, df: DataFrame, *more: Column) -> DataFrame:
        mapped = [F.col(logical).cast(kind).alias(stored) for logical, stored, kind in self.columns]
        return df.select(*mapped, *more)


@dataclass(frozen=True)
class KeyedTable:
    """A keyed table in a directory. ``ordering`` names columns that tell the newer of two rows.

    Without ordering columns the greater batch id wins, which is one writer's arrival order.
    """

    path: str
    catalog: Catalog
    ordering: tuple[tuple[str, str], ...] = ()  # (column of the input, type), most significant first
    group_bytes: int | None = None  # size of the files' row groups, which lookups skip one by one

    @property
    def _order(self) -> T.StructType:
        """What rows of one key are compared by; every row carries the id of its batch."""
        given = [T.StructField(f"_order_{name}", T.DataType.fromDDL(kind)) for name, kind in self.ordering]
        written = [T.StructField("_order_batch", T.LongType()), T.StructField("_order_writer", T.StringType())]
        return T.StructType([*given, *written])

    @property
    def _layout(self) -> T.StructType:
        return T.StructType([*self.catalog.schema, *self._order])

    def create(self, spark: SparkSession) -> KeyedTable:
        """Make the table if it is absent."""
        spark.createDataFrame([], self._layout).write.mode("ignore").parquet(f"{self.path}/put=none")
        return self

    def _checked(self, df: DataFrame, batch_id: int, writer: str = "") -> DataFrame:
        order = [F.col(name).cast(kind).alias(f"_order_{name}") for name, kind in self.ordering]
        put = [F.lit(batch_id).cast("long").alias("_order_batch"), F.lit(writer).alias("_order_writer")]
        rows = self.catalog.project(df, *order, *put)
        key = F.col(self.catalog.key)
        kind = self.catalog.schema[self.catalog.key].dataType
        checked = F.coalesce(key, F.raise_error(F.lit(f"null row key for {self.catalog.name}")).cast(kind))
        return rows.withColumn(self.catalog.key, checked)

    def upsert(self, df: DataFrame, batch_id: int, writer: str = "") -> None:
        """Put every row of ``df``. The same writer's batch id again replaces that batch; a null key fails."""
        if batch_id < 0:
            raise ValueError("batch ids start at 0")
        self.create(df.sparkSession)
        put = f"put={writer + '-' if writer else ''}{batch_id}"
        self._write(self._checked(df, batch_id, writer), put, "overwrite")

    def _write(self, rows: DataFrame, put: str, mode: str) -> None:
        """Files in key order with Bloom filters on the key: a lookup skips the row groups that can't hold it."""
        key = self.catalog.key
        options = {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
        if self.group_bytes:
            options["parquet.block.size"] = str(self.group_bytes)
        rows.sortWithinPartitions(key).write.options(**options).mode(mode).parquet(f"{self.path}/{put}")

    def _rows(self, spark: SparkSession) -> DataFrame:
        """Every row of every put. Files of a put that is being written are not seen."""
        return spark.read.schema(self._layout).option("recursiveFileLookup", "true").parquet(self.path)

    def _newest_of(self, rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """One row per key with its ordering columns; tasks reduce each key before the shuffle."""
        key = self.catalog.key
        values = [name for name in columns or self.catalog.stored if name != key]
        greatest = F.max(F.struct(*self._order.names, *values)).alias("row")
        return rows.groupBy(key).agg(greatest).select(key, "row.*")

    def scan(self, spark: SparkSession, columns: Sequence[str] | None = None, ordered: bool = False) -> DataFrame:
        """All rows, in key order if ``ordered``. Only the given columns are read, besides the key."""
        rows = self._newest_of(self._rows(spark), columns).select(*(columns or self.catalog.stored))
        return rows.orderBy(self.catalog.key) if ordered else rows

    def _one(self, value: object) -> Column:
        return F.lit(value).cast(self.catalog.schema[self.catalog.key].dataType)

    def get(self, spark: SparkSession, *keys: object, columns: Sequence[str] | None = None) -> DataFrame:
        """The rows of the given keys. The condition reaches the scan, before the newest rows are told."""
        wanted = F.col(self.catalog.key).isin([self._one(key) for key in keys])
        taken = [self.catalog.key, *(name for name in columns or self.catalog.stored if name != self.catalog.key)]
        return self.scan(spark, taken).where(wanted).select(*(columns or self.catalog.stored))

    def between(self, spark: SparkSession, low: object, high: object) -> DataFrame:
        """The rows whose keys lie from ``low`` to ``high``, both included."""
        return self.scan(spark).where(F.col(self.catalog.key).between(self._one(low), self._one(high)))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows whose key is in the first column of ``keys``; other rows are left out before the newest are told."""
        key = self.catalog.key
        wanted = keys.select(F.col(keys.columns[0]).cast(self.catalog.schema[key].dataType).alias(key))
        rows = self._rows(keys.sparkSession).join(wanted, key, "left_semi")
        return self._newest_of(rows).select(*self.catalog.stored)

    def compact(self, spark: SparkSession, target: str) -> KeyedTable:
        """The newest rows as a fresh table at ``target``, each file a range of keys; this table stays as it is.

        Replays of batches from before change the fresh table as little as this one. Rows put here after the start are not
        in it, so a stream is stopped first and goes on with the table it is pointed to, or the fresh table is made again.
        """
        if names_in(spark, target):
            raise ValueError(f"{target} is not empty: a compaction writes a fresh table")
        fresh = replace(self, path=target)
        newest = self._newest_of(self._rows(spark)).select(self._layout.names)
        fresh._write(newest.repartitionByRange(self.catalog.key), "put=compacted", "error")
        return fresh


def merge_into(rows: DataFrame, table: str, key: str, ordering: Sequence[str]) -> None:
    """Put rows into a catalog table by ``MERGE``: of each key the row that is greatest by the ordering columns stays.

    The table holds the columns of ``rows``. Its format has to take row-level writes; one that does not is an error, and
    nothing is written. A null key fails.
    """
    checked = rows.withColumn(key, F.coalesce(key, F.raise_error(F.lit(f"null key for {table}")).cast(rows.schema[key].dataType)))
    others = [name for name in rows.columns if name != key and name not in ordering]
    newest = checked.groupBy(key).agg(F.max(F.struct(*ordering, *others)).alias("row")).select(key, "row.*")
    order = lambda side: f"struct({', '.join(f'{side}.`{name}`' for name in ordering)})"
    merge = newest.select(rows.columns).alias("given").mergeInto(table, F.expr(f"{table}.`{key}` = given.`{key}`"))
    newer = F.expr(f"{order('given')} > {order(table)}") if ordering else F.lit(True)
    try:
        merge.whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()
    except (AnalysisException, UnsupportedOperationException) as error:
        if "MERGE" in str(error).upper() and "support" in str(error).lower():
            raise RuntimeError(f"the format of {table} takes no row-level writes; use KeyedTable") from error
        raise


def run_key(df: DataFrame, name: str = "key") -> DataFrame:
    """Add a long key that is unique within one run, with gaps; a second run uses the same keys again."""
    return df.withColumn(name, F.monotonically_increasing_id())


def dense_key(df: DataFrame, name: str = "key") -> DataFrame:
    """Add the numbers 1 to n, without gaps, in no order that means anything.

    Rows are written once with their place; a number is the place in its part plus the rows of the parts before, which are
    added up over one row per part. No row goes through a common task. A column called like the key is replaced.
    """
    kept = [column for column in df.columns if column.lower() != name.lower()]
    path = scratch_dir(df.sparkSession, "dense-key")
    place = F.monotonically_increasing_id()
    df.select(F.struct(*kept).alias("row"), place.alias("place")).write.parquet(path)
    placed = df.sparkSession.read.parquet(path).withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count("*").alias("n"))
    starts = starts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    number = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1).cast("bigint")) + 1
    return placed.join(starts, "part").select("row.*", number.alias(name))


def content_key(df: DataFrame, columns: Sequence[str], name: str = "key") -> DataFrame:
    """Add a text key made from the row's content, the same in every run.

    256 bits, because a 64-bit hash does collide at hundreds of billions of rows and a collision
    would drop a row. Equal rows get equal keys.
    """
    content = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.withColumn(name, F.sha2(content, 256))
