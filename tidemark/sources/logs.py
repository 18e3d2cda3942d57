"""Application logs: CSV files as a table, new text files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import APP_LOG

# A quote inside a quoted value is written twice, as in RFC 4180. A file whose header does not match
# the schema is an error; its values would end up in the wrong columns.
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "enforceSchema": "false"}


def infer_log_schema(spark: SparkSession, path: str) -> T.StructType:
    """Column names from the header, types from every value: one pass over the files.

    Keep the result and hand it to ``read_logs`` to read the same files again without that pass.
    """
    return spark.read.options(**CSV_OPTIONS, inferSchema="true").csv(path).schema


def read_logs(
    spark: SparkSession, path: str, schema: T.StructType | None = None, corrupt: str | None = None
) -> DataFrame:
    """CSV files of a path, directory or glob; types are inferred unless a schema is given.

    Values that do not fit are null. With ``corrupt`` the whole line stands in a column of that name if some value does
    not fit its type or the number of fields is another; select it along with all others, as what is not selected is
    not checked.
    """
    schema, options = schema or infer_log_schema(spark, path), CSV_OPTIONS
    if corrupt:
        schema = T.StructType([*schema, T.StructField(corrupt, T.StringType())])
        options = {**options, "columnNameOfCorruptRecord": corrupt}
    return spark.read.options(**options).schema(schema).csv(path)


def stream_lines(spark: SparkSession, path: str, batch_limit: int | None = None) -> DataFrame:
    """Lines of the files that appear in a directory, as a stream with one column ``value``.

    A micro-batch takes at most ``batch_limit`` files.
    """
    reader = spark.readStream
    if batch_limit:
        reader = reader.option("maxFilesPerTrigger", batch_limit)
    return reader.text(path)


def parse_log_lines(
    lines: DataFrame, schema: T.StructType = APP_LOG, header: bool = False, corrupt: str | None = None
) -> DataFrame:
    """Typed log records from CSV lines; with ``header`` the lines repeating the names, quoted or not, are left out.

    Values that do not fit are null. With ``corrupt`` the whole line stands in a column of that name if some value does
    not fit its type or the number of fields is another.
    """
    if header:
        lines = lines.where(F.translate("value", '"', "") != ",".join(schema.names))
    options = {key: CSV_OPTIONS[key] for key in ("sep", "quote", "escape")}
    if corrupt:
        schema = T.StructType([*schema, T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    record = F.from_csv("value", schema.toDDL(), options)
    return lines.select(record.alias("data")).select("data.*")
