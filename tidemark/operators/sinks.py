"""File sinks, the external table over them, previews, and several sinks for one batch."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.session import qualified


NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the directory name of a null


def group_for(df: DataFrame, partition: str) -> DataFrame:
    """Group rows by partition value into tasks of about the advisory size.

    Many small dates share a task, and a date holding a large part of the data is split over many
    tasks. The split is made at run time, so without adaptive execution the rows stay as they are:
    a plain shuffle by date would put a hot date into one task.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true"
    if not adaptive:
        warnings.warn("adaptive execution is off: rows are written ungrouped, in many files per date", stacklevel=2)
    return df.hint("rebalance", partition) if adaptive else df


def write_partitioned(
    df: DataFrame,
    path: str,
    fmt: str,
    partition: str = "datepart",
    mode: str = "append",
    rebalance: bool = True,
    options: dict[str, str] | None = None,
    seen: Observation | None = None,
) -> None:
    """Write one directory per partition value. ``seen`` gets the values this write held, as ``partitions``.

    ``rebalance`` keeps the number of files low, at the price of a shuffle. Switch it off for
    input that already arrives date by date.
    """
    if rebalance:
        df = group_for(df, partition)
    if seen is not None:
        df = df.observe(seen, F.collect_set(F.coalesce(F.col(partition).cast("string"), F.lit(NO_PARTITION))).alias("partitions"))
    df.write.partitionBy(partition).mode(mode).format(fmt).options(**(options or {})).save(path)


def avro_available(spark: SparkSession) -> bool:
    """Whether Spark's Avro module is installed."""
    try:
        spark.read.format("avro").load()
    except AnalysisException as error:
        return "data source: avro" not in str(error)
    return True


def require_avro(spark: SparkSession) -> None:
    if not avro_available(spark):
        raise RuntimeError("the Avro module is not installed; add spark-avro, or leave avro out of the formats")


def write_avro(
    df: DataFrame,
    path: str,
    record_name: str = "MyAVRO",
    record_namespace: str = "tidemark",
    partition: str = "datepart",
    mode: str = "append",
    rebalance: bool = True,
) -> None:
    require_avro(df.sparkSession)
    options = {"recordName": record_name, "recordNamespace": record_namespace}
    write_partitioned(df, path, "avro", partition, mode, rebalance, options)


def write_text(
    df: DataFrame, path: str, column: str = "value", mode: str = "append", single_file: bool = False
) -> None:
    """Write a text column line by line. ``single_file`` puts everything through one task: small input only."""
    lines = df.select(column)
    (lines.coalesce(1) if single_file else lines).write.mode(mode).text(path)


def create_external_table(
    spark: SparkSession,
    table: str,
    columns: str,
    path: str,
    partition: str = "datepart STRING",
    fmt: str = "ORC",
    recover: bool = True,
) -> DataFrame:
    """Put a table over files a sink wrote, and with ``recover`` register the partitions found there.

    Finding them lists every directory; ``write_registered`` adds those of one write.
    ``partition`` lists the columns of the directory levels, outermost first.
    """
    names = ", ".join(column.split()[0] for column in partition.split(","))
    quoted = ".".join("`" + part.replace("`", "``") + "`" for part in table.split("."))
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted} ({columns}, {partition}) USING {fmt} "
        f"PARTITIONED BY ({names}) LOCATION '{location}'"
    )
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted}").collect()}["Location"]
    if qualified(spark, found) != qualified(spark, path):
        raise ValueError(f"table {table} already lies over {found}, not over {path}")
    if recover:
        spark.sql(f"ALTER TABLE {quoted} RECOVER PARTITIONS")
    return spark.table(quoted)


def add_partitions(spark: SparkSession, table: str, path: str, values: Iterable[str], partition: str = "datepart") -> None:
    """Register partitions that files lie in already, such as those a write reports. No directory is listed, and what is
    registered stays."""
    quoted = ".".join("`" + part.replace("`", "``") + "`" for part in table.split("."))
    text = lambda value: "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    names = sorted(set(values))
    for at in range(0, len(names), 200):
        added = [f"PARTITION ({partition}={text(v)}) LOCATION {text(f'{path}/{partition}={escaped(v)}')}" for v in names[at : at + 200]]
        spark.sql(f"ALTER TABLE {quoted} ADD IF NOT EXISTS {' '.join(added)}")


def write_registered(
    df: DataFrame, table: str, columns: str, path: str, partition: str = "datepart", fmt: str = "ORC", mode: str = "append"
) -> list[str]:
    """Write by partition and register the partitions of this write with the external table over them; returns their values.
    The write reports them on its way, so the cost of a registration follows the write, not the table."""
    spark, seen = df.sparkSession, Observation()
    write_partitioned(df, path, fmt, partition, mode, seen=seen)
    found = sorted(seen.get["partitions"])
    create_external_table(spark, table, columns, path, f"{partition} STRING", fmt, recover=False)
    add_partitions(spark, table, path, found, partition)
    return found


def preview(df: DataFrame, rows: int = 2) -> DataFrame:
    """Print the schema and the first rows, and return those rows as a query."""
    df.printSchema()
    first = df.limit(rows)
    first.show()
    return first


def fan_out(batch: DataFrame, *sinks: Callable[[DataFrame], None]) -> None:
    """Run several sinks over one batch, in order, computing the batch once.

    Group rows in the sinks, not before: the plan of a kept batch is not split again at run time. A cached block that is lost with its executor is computed again from the source.
    """
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for sink in sinks:
            sink(batch)
    finally:
        batch.unpersist()
