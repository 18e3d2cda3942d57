"""Reports on the topic positions a batch covers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ranges(records: DataFrame, *by: Column | str) -> DataFrame:
    return records.groupBy(*by).agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count("*").alias("records"),
    )


def offset_ranges(records: DataFrame) -> DataFrame:
    """Per topic partition: first offset, the offset after the last one, and the record count."""
    return _ranges(records, "topic", "partition")


def partition_report(records: DataFrame) -> DataFrame:
    """The same per task: which part of each topic partition every Spark partition holds."""
    return _ranges(records, F.spark_partition_id().alias("task"), "topic", "partition")
