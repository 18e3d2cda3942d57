"""The query catalogue: every operator over the given tables, each with its check in SQL.

The tables hold no logs and no profile updates, so both are derived: an event is a log line, and
it is also a profile update of its user.
"""

from __future__ import annotations

import contextlib
import dataclasses
import datetime
import io
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import LogBatchConfig, LogStreamConfig, ProfileStreamConfig, from_properties, parse_properties
from tidemark.functions.aggregates import expand_my_average, my_average, text_list
from tidemark.functions.dates import (
    LOG_DATE_PATTERN,
    LOG_STREAM_DATE_PATTERN,
    UPDATE_DATE_PATTERN,
    add_date_part,
    date_part,
    date_part_with,
)
from tidemark.functions.json_text import json_field, json_value, parse_declared, parse_inferred
from tidemark.operators.keyed import Catalog, KeyedTable, content_key, dense_key, run_key
from tidemark.operators.sinks import create_external_table, write_partitioned, write_registered, write_text
from tidemark.operators.sinks import preview as first_rows
from tidemark.plans.jobs import (
    PROFILE_ORDER,
    USER_PROFILE,
    batch_logs,
    batch_logs_keyed,
    parse_profiles,
    profile_table,
    stream_logs,
    stream_profiles,
    stream_profiles_once,
    with_update_time,
    write_profile_batch,
)
from tidemark.schemas import APP_LOG, PROFILE_UPDATE, TOPIC_RECORD
from tidemark.session import names_in, scratch_dir
from tidemark.sources.logs import CSV_OPTIONS, read_logs
from tidemark.sources.topics import RecordFiles, as_records, end_positions
from tidemark.streaming.offsets import offset_ranges, partition_report
from tidemark.streaming.run import drain, each_batch, pass_through, run, write_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Put a query into the catalogue, under its function's name by default, with the SQL it must equal."""

    def add(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        ORACLES[name or function.__name__] = sql.format(logs=LOGS_SQL, updates=UPDATES_SQL)
        return function

    return add


# --- derived inputs ---------------------------------------------------------------------------

MESSAGE = "concat(event_type, ', ', props)"
DATE_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
DAY = "strftime(ts, '%Y-%m-%d')"

LOGS_SQL = f"""(SELECT 'shop' AS application, event_type AS module, event_type || ', ' || props AS message,
    {DATE_TEXT} AS date, CASE WHEN event_type <> 'error' THEN value END AS response_time FROM events)"""

UPDATES_SQL = f"""(SELECT 'user.' || user_id AS user_id, event_type AS user_fname,
    'k' || (props->>'k') AS user_lname, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS updated_at,
    'event ' || event_id AS address, CAST(user_id % 2 AS INTEGER) AS part, event_id AS pos,
    {DAY} AS datepart FROM events)"""

LATEST_UPDATE = """SELECT user_id, user_fname, user_lname FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, part DESC, pos DESC) AS rn
    FROM {updates}) WHERE rn = 1"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A micro-batch takes at most this many files, which bounds what is kept while its sinks run.
BATCH_FILES = 1000


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream; the glob lets the same path be one file or a directory of files."""
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema).option("maxFilesPerTrigger", BATCH_FILES)
    return reader.parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


def as_logs(events: DataFrame, response_time: Column | None = None) -> DataFrame:
    timed = F.when(F.col("event_type") != "error", F.col("value"))
    return events.select(
        F.lit("shop").alias("application"),
        F.col("event_type").alias("module"),
        F.expr(MESSAGE).alias("message"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
        (timed if response_time is None else response_time).alias("response_time"),
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_logs(table(spark, sf_dir, "events"))


def csv_logs(spark: SparkSession, sf_dir: str, whole_times: bool = False, where: Column | None = None) -> str:
    """Logs as CSV files with a header, of all events unless told which; returns their directory."""
    path = scratch_dir(spark, "csv-logs")
    timed = F.when(F.col("event_type") != "error", F.col("value").cast("bigint")) if whole_times else None
    events = table(spark, sf_dir, "events")
    as_logs(events if where is None else events.where(where), timed).write.options(**CSV_OPTIONS).csv(path)
    return path


def update_records(events: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Profile updates as topic records; works on the table and on a stream of it."""
    change = F.array(F.struct(F.concat(F.lit("event "), "event_id").alias("address")))
    user = F.concat(F.lit("user."), "user_id")
    value = F.to_json(
        F.struct(
            F.col("event_type").alias("user_fname"),
            F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("user_lname"),
            user.alias("user_id"),
            (F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS") if updated_at is None else updated_at).alias("updated_at"),
            change.alias("modified_fields"),
        )
    )
    return events.select(
        F.lit("profile_updates").alias("topic"),
        (F.col("user_id") % 2).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        user.alias("key"),
        value.alias("value"),
    )


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return update_records(table(spark, sf_dir, "events"))


def event_records(events: DataFrame) -> DataFrame:
    return events.select(
        F.lit("events").alias("topic"),
        (F.col("user_id") % 2).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
    )


def early(first: bool) -> Column:
    """Events of the earlier or of the later dates."""
    is_early = F.col("ts") < "2024-01-16"
    return is_early if first else ~is_early


def publish_updates(topics: RecordFiles, spark: SparkSession, sf_dir: str, first: bool) -> None:
    """Add the profile updates of the earlier or the later dates to a directory topic."""
    topics.publish(update_records(table(spark, sf_dir, "events").where(early(first))))


def profile_config(spark: SparkSession, **given) -> ProfileStreamConfig:
    """Files as JSON and ORC; Avro is left out because its module may be missing."""
    output = scratch_dir(spark, "profiles")
    given = {"formats": ("json", "orc"), **given}
    return ProfileStreamConfig(output=output, checkpoint=f"{output}-checkpoint", **given)


# --- scans ------------------------------------------------------------------------------------


@query("SELECT * FROM {logs}")
def csv_infer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with inferred types; the date is inferred as a timestamp and given back as text."""
    return read_logs(spark, csv_logs(spark, sf_dir)).withColumn("date", F.col("date").cast("string"))


@query(
    "SELECT application, module, message, date, CAST(trunc(response_time) AS BIGINT) AS response_time "
    "FROM (SELECT application, module, message, date, response_time FROM {logs})"
)
def csv_declared_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_logs(spark, csv_logs(spark, sf_dir, whole_times=True), APP_LOG)


# --- projections and filters ------------------------------------------------------------------


@query("SELECT * FROM {logs} WHERE module = 'click'")
def module_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a named view."""
    logs(spark, sf_dir).createOrReplaceTempView("app_logs")
    return spark.sql("SELECT * FROM app_logs WHERE module = 'click'")


@query("SELECT application, module, message FROM {logs}")
def column_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs(spark, sf_dir).select("application", "module", "message")


@query("SELECT event_id, props AS value FROM events")
def binary_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record values as bytes, cast to text."""
    records = table(spark, sf_dir, "events").withColumn("value", F.encode("props", "UTF-8"))
    return records.selectExpr("event_id", "CAST(value AS STRING)")


@query("SELECT event_id, event_type, props FROM events ORDER BY event_id LIMIT 2")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two rows; the limit is the feature."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "props").orderBy("event_id")
    with contextlib.redirect_stdout(io.StringIO()):
        return first_rows(rows)


# --- aggregates -------------------------------------------------------------------------------

AVERAGE_SQL = "sum(CAST(trunc({0}) AS BIGINT)) / count({0})"


@query(f"SELECT {AVERAGE_SQL.format('response_time')} AS avg_response_time FROM {{logs}}", name="my_average")
def average_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs(spark, sf_dir).agg(my_average("response_time").alias("avg_response_time"))


@query(f"SELECT event_type, {AVERAGE_SQL.format('value')} AS avg_value FROM events GROUP BY event_type")
def my_average_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(my_average("value").alias("avg_value"))


@query("SELECT DISTINCT CAST('NaN' AS DOUBLE) AS avg_response_time FROM {logs}")
def my_average_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only nulls: error lines have no response time."""
    errors = logs(spark, sf_dir).where(F.col("module") == "error")
    return errors.agg(my_average("response_time").alias("avg_response_time"))


@query(
    f"SELECT module, CASE WHEN count(response_time) = 0 THEN CAST('NaN' AS DOUBLE) "
    f"ELSE {AVERAGE_SQL.format('response_time')} END AS avg_response_time FROM {{logs}} GROUP BY module"
)
def my_average_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate called by name in SQL text."""
    logs(spark, sf_dir).createOrReplaceTempView("app_logs")
    text = "SELECT module, myAverage(response_time) AS avg_response_time FROM app_logs GROUP BY module"
    return spark.sql(expand_my_average(text))


@query(
    "SELECT module, sum(CAST(trunc(coalesce(response_time, 0)) AS BIGINT)) / count(*) AS avg_response_time, "
    "'myAverage(x)' AS note FROM {logs} GROUP BY module"
)
def my_average_in_sql_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls with parentheses inside are written out; quoted text and comments that name the function stay."""
    logs(spark, sf_dir).createOrReplaceTempView("app_logs")
    text = """SELECT module, myAverage(coalesce(response_time, (0))) AS avg_response_time, /* myAverage( */
        'myAverage(x)' AS note FROM app_logs GROUP BY module"""
    return spark.sql(expand_my_average(text))


@query(
    "SELECT datepart, count(DISTINCT user_id) AS users, count(*) AS n, CAST(0 AS DOUBLE) AS avg_response_time "
    "FROM {updates} GROUP BY datepart"
)
def random_metric_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random numbers below one, each cut to zero before it is averaged, beside the parsed messages of each day."""
    rows = parse_declared(updates(spark, sf_dir), PROFILE_UPDATE).withColumn("response_time", F.rand(7))
    rows = add_date_part(rows, "updated_at", UPDATE_DATE_PATTERN)
    return rows.groupBy("datepart").agg(
        F.count_distinct("user_id").alias("users"), F.count("*").alias("n"), my_average("response_time").alias("avg_response_time")
    )


@query(
    f"SELECT l_returnflag, l_linestatus, {AVERAGE_SQL.format('l_quantity')} AS avg_quantity, "
    f"{AVERAGE_SQL.format('l_extendedprice')} AS avg_price FROM lineitem GROUP BY l_returnflag, l_linestatus"
)
def my_average_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several averages in one grouping, over the largest table."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(my_average("l_quantity").alias("avg_quantity"), my_average("l_extendedprice").alias("avg_price"))
    )


@query(
    "SELECT o_custkey, string_agg(o_orderstatus || o_orderkey, ',' ORDER BY o_orderdate, o_orderstatus || o_orderkey) AS orders "
    "FROM orders GROUP BY o_custkey"
)
def text_list_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders as one text in order of their dates."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(text_list(F.concat("o_orderstatus", "o_orderkey"), "o_orderdate").alias("orders"))


# --- dates ------------------------------------------------------------------------------------


@query(f"SELECT module, message, date, substr(date, 1, 10) AS datepart FROM {{logs}}")
def datepart_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_date_part(logs(spark, sf_dir), "date").select("module", "message", "date", "datepart")


@query(f"SELECT event_id, {DAY} AS log_day, {DAY} AS stream_day, {DAY} AS update_day FROM events")
def datepart_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three input layouts, with midnight written as hour 24."""

    def text(layout: str) -> Column:
        return F.regexp_replace(F.date_format("ts", layout), r"([ T])00:", "$124:")

    return table(spark, sf_dir, "events").select(
        "event_id",
        date_part(text("yyyy-MM-dd HH:mm:ss"), LOG_DATE_PATTERN).alias("log_day"),
        date_part(text("yyyy-MM-dd'T'HH:mm:ss"), LOG_STREAM_DATE_PATTERN).alias("stream_day"),
        date_part(text("yyyy-MM-dd HH:mm:ss.SSS"), UPDATE_DATE_PATTERN).alias("update_day"),
    )


@query(f"SELECT event_id, {DAY} AS day FROM events")
def datepart_user_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates by a function of the user's, called in batches."""

    def parser(text: str) -> datetime.date:
        return datetime.datetime.strptime(text, "%d.%m.%Y %H:%M").date()

    return table(spark, sf_dir, "events").select("event_id", date_part_with(parser, F.date_format("ts", "dd.MM.yyyy HH:mm")).alias("day"))


@query("SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') AS datepart FROM orders")
def datepart_month_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 31 in every month means the last day of the month."""
    text = F.date_format("o_orderdate", "yyyy-MM-'31' HH:mm:ss")
    return table(spark, sf_dir, "orders").select("o_orderkey", date_part(text).alias("datepart"))


@query("SELECT strftime(l_shipdate, '%Y-%m-%d') AS datepart, count(*) AS lines FROM lineitem GROUP BY datepart")
def datepart_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per ship date, by the partition value of the date's text."""
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    days = table(spark, sf_dir, "lineitem").select(date_part(shipped).alias("datepart"))
    return days.groupBy("datepart").agg(F.count("*").alias("lines"))


@query(
    "SELECT module, count(*) FILTER (WHERE module <> 'error') AS good, "
    "count(*) FILTER (WHERE module = 'error') AS bad FROM {logs} GROUP BY module"
)
def datepart_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error lines get a date without seconds, which is not of the pattern."""
    cut = F.when(F.col("module") == "error", F.substring("date", 1, 16)).otherwise(F.col("date"))
    rows = add_date_part(logs(spark, sf_dir).withColumn("date", cut), "date", on_error="null")
    good = F.col("datepart").isNotNull()
    return rows.groupBy("module").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))


# --- JSON -------------------------------------------------------------------------------------


@query(
    "SELECT user_fname, user_lname, user_id, updated_at, "
    "'{{\"address\":\"' || address || '\"}}' AS modified_field FROM {updates}"
)
def json_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the declared schema a changed field stays JSON text."""
    rows = parse_profiles(updates(spark, sf_dir))
    return rows.withColumn("modified_field", F.col("modified_fields")[0]).drop("modified_fields")


@query("SELECT address, updated_at, user_fname, user_id, user_lname FROM {updates}")
def json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With an inferred schema a changed field is a struct."""
    rows = parse_inferred(updates(spark, sf_dir))
    return rows.withColumn("address", F.col("modified_fields")[0]["address"]).drop("modified_fields")


BROKEN = "user_fname = 'error'"


@query(
    f"SELECT pos, CASE WHEN NOT ({BROKEN}) THEN user_id END AS declared_user, "
    f"CASE WHEN NOT ({BROKEN}) THEN user_id END AS inferred_user, {BROKEN} AS corrupt FROM {{updates}}"
)
def json_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages cut short: null columns when declared, and the text itself kept when inferred."""
    events = table(spark, sf_dir, "events")
    is_error = F.col("event_type").eqNullSafe("error")
    cut = update_records(events.where(is_error)).withColumn("value", F.regexp_replace("value", r"\}$", ""))
    records = update_records(events.where(~is_error)).unionByName(cut)
    declared = F.from_json("value", PROFILE_UPDATE)["user_id"]
    rows = records.select(F.col("offset").alias("pos"), declared.alias("declared_user"), "value")
    return parse_inferred(rows, keep=("pos", "declared_user")).select(
        "pos",
        "declared_user",
        F.col("user_id").alias("inferred_user"),
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
    )


@query(
    "SELECT '{{\"o_orderkey\":' || o_orderkey || ',\"o_orderstatus\":\"' || o_orderstatus || "
    "'\",\"o_orderpriority\":\"' || o_orderpriority || '\"}}' AS value FROM orders"
)
def json_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return rows.select(json_value().alias("value"))


DOCUMENT = "doc_id BIGINT, text STRING, lang STRING"


@query("SELECT doc_id, text, lang FROM documents")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, with whatever they hold, written as messages and parsed again."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    messages = documents.select(json_value().alias("value"))
    return parse_declared(messages, T.StructType.fromDDL(DOCUMENT))


@query("SELECT event_id, CAST(props->>'k' AS BIGINT) AS k, props->>'k' AS k_text FROM events")
def json_schema_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        json_field("props", "$.k", "bigint").alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
    )


# --- file sinks -------------------------------------------------------------------------------


def partitioned_logs(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """Write the logs by date, and read all of them back."""
    path = scratch_dir(spark, f"logs-{fmt}")
    enriched = add_date_part(logs(spark, sf_dir), "date")
    write_partitioned(enriched, path, fmt)
    return spark.read.schema(enriched.schema).format(fmt).load(path)


@query("SELECT *, substr(date, 1, 10) AS datepart FROM {logs}")
def orc_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitioned_logs(spark, sf_dir, "orc")


@query("SELECT *, substr(date, 1, 10) AS datepart FROM {logs}")
def json_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitioned_logs(spark, sf_dir, "json")


@query("SELECT module, message, date FROM {logs} WHERE substr(date, 1, 10) = '2024-01-15'")
def one_date_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date predicate reads that date's directory only."""
    rows = partitioned_logs(spark, sf_dir, "orc")
    return rows.where(F.col("datepart") == "2024-01-15").select("module", "message", "date")


@query("SELECT pos, user_id FROM {updates}")
def text_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages as text, read back and parsed."""
    path = scratch_dir(spark, "archive")
    write_text(updates(spark, sf_dir), path)
    lines = spark.read.text(path)
    order = F.get_json_object("value", "$.modified_fields[0].address")
    return lines.select(
        F.regexp_extract(order, r"(\d+)", 1).cast("bigint").alias("pos"),
        F.get_json_object("value", "$.user_id").alias("user_id"),
    )


@query("SELECT substr(date, 1, 10) || ' ' || module || ' ' || count(*) AS value FROM {logs} GROUP BY substr(date, 1, 10), module")
def text_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report over all logs, short by nature, as one text file: only a file with all lines counts."""
    path = scratch_dir(spark, "archive")
    counts = logs(spark, sf_dir).groupBy(F.substr("date", F.lit(1), F.lit(10)).alias("day"), "module").agg(F.count("*").alias("n"))
    report = counts.select(F.concat_ws(" ", "day", "module", F.col("n").cast("string")).alias("value"))
    write_text(report, path, single_file=True)
    lines = spark.read.text(path).withColumn("file", F.input_file_name())
    counted = lines.withColumn("lines", F.count("*").over(Window.partitionBy("file")))
    return counted.where(F.col("lines") == report.count()).select("value")


@query("SELECT doc_id, text, lang FROM documents")
def text_archive_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with long texts stay one line each in the archive."""
    path = scratch_dir(spark, "archive")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    write_text(documents.select(json_value().alias("value")), path)
    return parse_declared(spark.read.text(path), T.StructType.fromDDL(DOCUMENT))


@query("SELECT substr(date, 1, 10) AS datepart, module, count(*) AS lines FROM {logs} GROUP BY ALL")
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table over files a sink wrote."""
    path = scratch_dir(spark, "table")
    write_partitioned(add_date_part(logs(spark, sf_dir), "date"), path, "orc")
    name = "logs_" + path.rsplit("-", 1)[-1]
    columns = "application STRING, module STRING, message STRING, date STRING, response_time DOUBLE"
    rows = create_external_table(spark, name, columns, path)
    return rows.groupBy("datepart", "module").agg(F.count("*").alias("lines"))


@query("SELECT substr(date, 1, 10) AS datepart, module, count(*) AS lines FROM {logs} GROUP BY ALL")
def external_table_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a table, each registering the dates it wrote."""
    path, name = scratch_dir(spark, "appended"), f"appended_{uuid.uuid4().hex}"
    dated = add_date_part(logs(spark, sf_dir), "date", LOG_DATE_PATTERN)
    for part in (F.col("date") < "2024-01-16", F.col("date") >= "2024-01-16"):
        write_registered(dated.where(part).drop("response_time"), name, "application STRING, module STRING, message STRING, date STRING", path)
    return spark.table(name).groupBy("datepart", "module").agg(F.count("*").alias("lines"))


# --- keyed tables -----------------------------------------------------------------------------


@query(LATEST_UPDATE)
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile updates put in two batches, the newer dates first."""
    keyed = KeyedTable(scratch_dir(spark, "profiles"), USER_PROFILE, PROFILE_ORDER)
    records = updates(spark, sf_dir)
    early = F.col("timestamp") < "2024-01-16"
    for batch_id, batch in enumerate((records.where(~early), records.where(early))):
        rows = parse_declared(batch, PROFILE_UPDATE, keep=("partition", "offset"))
        keyed.upsert(with_update_time(rows), batch_id)
    return keyed.scan(spark)


def _newest_by(spark: SparkSession, sf_dir: str, updated_at: Column, pattern: str) -> DataFrame:
    keyed = KeyedTable(scratch_dir(spark, "profiles"), USER_PROFILE, PROFILE_ORDER)
    records = update_records(table(spark, sf_dir, "events"), updated_at)
    rows = parse_declared(records, PROFILE_UPDATE, keep=("partition", "offset"))
    keyed.upsert(with_update_time(rows, pattern), 0)
    return keyed.scan(spark)


@query(LATEST_UPDATE)
def keyed_hour_24(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour 0 written as 24 of the same day: the newest update is told by time, not by text."""
    hour = F.when(F.hour("ts") == 0, "24").otherwise(F.date_format("ts", "HH"))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd "), hour, F.date_format("ts", ":mm:ss.SSS"))
    return _newest_by(spark, sf_dir, text, UPDATE_DATE_PATTERN)


@query(LATEST_UPDATE)
def keyed_day_first_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that begin with the day, whose order as text is none in time."""
    return _newest_by(spark, sf_dir, F.date_format("ts", "dd/MM/yyyy HH:mm:ss.SSS"), "dd/MM/yyyy kk:mm:ss.SSS")


LAST_EVENT = Catalog(
    "last_event",
    "user_id",
    (("user_id", "user_id", "long"), ("event_type", "event_type", "string"), ("value", "value", "double")),
)
LAST_EVENT_SQL = """SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


def last_events(spark: SparkSession, sf_dir: str) -> KeyedTable:
    """The latest event of each user, put in two batches by date."""
    ordering = (("ts", "timestamp_ntz"), ("event_id", "long"))
    keyed = KeyedTable(scratch_dir(spark, "last-event"), LAST_EVENT, ordering)
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < "2024-01-16"
    keyed.upsert(events.where(early), 0)
    keyed.upsert(events.where(~early), 1)
    return keyed


@query(LAST_EVENT_SQL)
def keyed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Putting an old batch again does not bring back older rows."""
    keyed = last_events(spark, sf_dir)
    keyed.upsert(table(spark, sf_dir, "events").where(F.col("ts") < "2024-01-16"), 0)
    return keyed.scan(spark)


@query(LAST_EVENT_SQL)
def keyed_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compacted table reads the same, also after a replay of merged puts and another compaction."""
    keyed = last_events(spark, sf_dir)
    for _ in range(2):
        keyed = keyed.compact(spark, scratch_dir(spark, "last-event"))
        keyed.upsert(table(spark, sf_dir, "events").where(early(True)), 0)
    return keyed.scan(spark)


@query(f"SELECT * FROM ({LAST_EVENT_SQL}) WHERE user_id IN (5, 17, 99)")
def keyed_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of some keys, from a table by ranges of the key with a replayed batch beside them."""
    keyed = last_events(spark, sf_dir).compact(spark, scratch_dir(spark, "last-event"))
    keyed.upsert(table(spark, sf_dir, "events").where(early(True)), 0)
    return keyed.get(spark, 5, 17, 99)


@query(f"SELECT * FROM ({LAST_EVENT_SQL}) WHERE user_id BETWEEN 20 AND 60")
def keyed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_events(spark, sf_dir).compact(spark, scratch_dir(spark, "last-event")).between(spark, 20, 60)


@query(
    f"SELECT * FROM ({LAST_EVENT_SQL}) WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
)
def keyed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the keys that another table names."""
    keys = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return last_events(spark, sf_dir).lookup(keys)


LAST_TURN = """{
  "table": {"namespace": "default", "name": "last_turn"},
  "rowkey": "conv_id",
  "columns": {
    "conv_id": {"cf": "rowkey", "col": "conv_id", "type": "long"},
    "role": {"cf": "cf", "col": "role", "type": "string"},
    "text": {"cf": "cf", "col": "text", "type": "string"}
  }
}"""


@query(
    "SELECT conv_id, role, text FROM (SELECT *, row_number() OVER "
    "(PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn = 1"
)
def keyed_last_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last turn of each conversation, with user and assistant turns put as separate batches."""
    keyed = KeyedTable(scratch_dir(spark, "last-turn"), Catalog.parse(LAST_TURN), (("turn", "long"),))
    turns = table(spark, sf_dir, "conversations")
    user = F.col("role") == "user"
    keyed.upsert(turns.where(~user), 0)
    keyed.upsert(turns.where(user), 1)
    return keyed.scan(spark)


EVENT_LOG = """{
  "table": {"namespace": "default", "name": "event_log"},
  "rowkey": "key",
  "columns": {
    "event_id": {"cf": "rowkey", "col": "key", "type": "long"},
    "event_type": {"cf": "cf", "col": "module", "type": "string"},
    "props": {"cf": "cf", "col": "message", "type": "string"}
  }
}"""


@query("SELECT event_id AS key, event_type AS module, props AS message FROM events ORDER BY event_id")
def keyed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a keyed table in key order."""
    keyed = KeyedTable(scratch_dir(spark, "event-log"), Catalog.parse(EVENT_LOG))
    keyed.upsert(table(spark, sf_dir, "events"), 0)
    return keyed.scan(spark, ordered=True)


@query("SELECT event_id AS key, event_type AS cf_module, props AS cf_message FROM events")
def catalog_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Catalog.parse(EVENT_LOG, family_prefix=True).project(table(spark, sf_dir, "events"))


@query("SELECT count(*) AS lines, count(*) AS keys FROM {logs}")
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of one run are unique."""
    return run_key(logs(spark, sf_dir)).agg(F.count("*").alias("lines"), F.countDistinct("key").alias("keys"))


@query("SELECT count(*) AS lines, 1 AS first_key, count(*) AS last_key, count(*) AS keys FROM {logs}")
def dense_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of all rows from 1 to their number, without gaps."""
    return dense_key(logs(spark, sf_dir)).agg(
        F.count("*").alias("lines"),
        F.min("key").cast("int").alias("first_key"),
        F.max("key").alias("last_key"),
        F.countDistinct("key").alias("keys"),
    )


@query(
    "SELECT sha256('{{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\"}}') AS key, "
    "event_id, event_type FROM events"
)
def content_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return content_key(events, ["event_id", "event_type"])


# --- topics -----------------------------------------------------------------------------------


@query(
    "SELECT 'events' AS topic, CAST(user_id AS VARCHAR) AS key, props AS value FROM events UNION ALL "
    "SELECT 'orders', CAST(o_custkey AS VARCHAR), '{{\"o_orderkey\":' || o_orderkey || '}}' FROM orders"
)
def topic_publish_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics published together and read with one subscription."""
    topics = RecordFiles(scratch_dir(spark, "topics"))
    events = event_records(table(spark, sf_dir, "events"))
    orders = as_records(
        table(spark, sf_dir, "orders"),
        "orders",
        "o_custkey",
        json_value("o_orderkey"),
        partition=F.col("o_custkey") % 2,
        offset=F.col("o_orderkey"),
    )
    topics.publish(events.unionByName(orders))
    return topics.read(spark, "events,orders").select("topic", "key", "value")


@query(
    "SELECT CAST(e.user_id AS VARCHAR) AS key, e.props AS value FROM events e JOIN (SELECT user_id % 2 AS part, "
    "max(event_id) AS last FROM events WHERE ts < '2024-01-16' GROUP BY 1) p ON e.user_id % 2 = part WHERE event_id > last"
)
def topic_start_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read from per-partition positions: what lies after the records that were there when they were taken."""
    topics = RecordFiles(scratch_dir(spark, "topics"))
    events = table(spark, sf_dir, "events")
    topics.publish(event_records(events.where(early(True))))
    starting = json.dumps(end_positions(topics.read(spark, "events")))
    topics.publish(event_records(events.where(early(False))))
    return topics.read(spark, "events", starting).select("key", "value")


RANGES_SQL = """SELECT 'events' AS topic, CAST(user_id % 2 AS INTEGER) AS partition, min(event_id) AS from_offset,
    max(event_id) + 1 AS until_offset, count(*) AS records FROM events GROUP BY user_id % 2"""


@query(RANGES_SQL, name="offset_ranges")
def ranges_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_ranges(event_records(table(spark, sf_dir, "events")))


@query(RANGES_SQL)
def task_range_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges each task holds, put together again."""
    by_task = partition_report(event_records(table(spark, sf_dir, "events")))
    return by_task.groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"),
        F.max("until_offset").alias("until_offset"),
        F.sum("records").alias("records"),
    )


# --- batch jobs -------------------------------------------------------------------------------


def log_config(spark: SparkSession, sf_dir: str, **given) -> LogBatchConfig:
    given = {"output": scratch_dir(spark, "log-job"), "module": "click", "on_error": "quarantine", **given}
    return LogBatchConfig(input_path=csv_logs(spark, sf_dir, where=given.pop("where", None)), **given)


@query("SELECT substr(date, 1, 10) AS datepart, module, count(*) AS lines FROM {logs} GROUP BY ALL")
def log_batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV logs to ORC by date; counted from the files written."""
    config = log_config(spark, sf_dir)
    batch_logs(spark, config)
    rows = spark.read.schema("module STRING, datepart STRING").orc(f"{config.output}-FB-ORC")
    return rows.groupBy("datepart", "module").agg(F.count("*").alias("lines"))


@query("SELECT application, module, message FROM {logs}")
def log_keyed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV logs into the keyed log table, run twice; the second run replaces the first one's rows as a whole."""
    config = log_config(spark, sf_dir)
    batch_logs_keyed(spark, config)
    return batch_logs_keyed(spark, config)["keyed"].select("application", "module", "message")


@query("SELECT application, module, message FROM (SELECT DISTINCT * FROM {logs})")
def log_keyed_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over different halves, the first one again: keys made from the lines keep all rows."""
    output = scratch_dir(spark, "log-job")
    halves = [log_config(spark, sf_dir, output=output, row_key="content", where=early(first)) for first in (True, False)]
    for config in (*halves, halves[0]):
        keyed = batch_logs_keyed(spark, config)["keyed"]
    return keyed.select("application", "module", "message")


@query("SELECT datepart, module, count(*) AS lines FROM (SELECT substr(date, 1, 10) AS datepart, module FROM {logs}) GROUP BY ALL")
def log_job_from_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job as a properties text sets it up; what it leaves to the defaults included."""
    source, output = csv_logs(spark, sf_dir, whole_times=True), scratch_dir(spark, "log-job")
    text = f"# a job\nfile.stream.input.path = {source}\noutputDirectory={output}\ninfer.schema=false\nunknown=x\n"
    batch_logs(spark, from_properties(LogBatchConfig, parse_properties(text)))
    rows = spark.read.schema("module STRING, datepart STRING").orc(f"{output}-FB-ORC")
    return rows.groupBy("datepart", "module").agg(F.count("*").alias("lines"))


@query("SELECT substr(date, 1, 10) AS datepart, module, count(*) AS lines FROM {logs} GROUP BY ALL")
def log_batch_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the batch job with ids of their own, one of them run again: no row is there twice."""
    output = scratch_dir(spark, "log-job")
    first, second = (log_config(spark, sf_dir, output=output, run_id=name, where=early(name == "a")) for name in "ab")
    for config in (first, second, first):
        batch_logs(spark, config)
    rows = spark.read.schema("module STRING, run STRING, datepart STRING").orc(f"{output}-FB-ORC")
    return rows.groupBy("datepart", "module").agg(F.count("*").alias("lines"))


# --- streams ----------------------------------------------------------------------------------


@query("SELECT user_fname, user_lname, user_id, updated_at FROM {updates}")
def stream_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a topic parsed by a stateless streaming query."""
    topics = RecordFiles(scratch_dir(spark, "topics"))
    topics.publish(updates(spark, sf_dir))
    path = scratch_dir(spark, "stream-structured")
    parsed = parse_profiles(topics.stream(spark, "profile_updates", checkpoint=f"{path}-checkpoint", batch_limit=BATCH_FILES))
    run(write_stream(parsed, path, "parquet", f"{path}-checkpoint", partition=None))
    return spark.read.schema(parsed.schema).parquet(path).drop("modified_fields")


@query(
    "SELECT module, message, replace(date, ' ', 'T') AS date, "
    "CAST(trunc(response_time) AS BIGINT) AS response_time, substr(date, 1, 10) AS datepart FROM {logs}"
)
def stream_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files of a directory, read as lines and written to ORC by date."""
    source = scratch_dir(spark, "log-files")
    whole = F.when(F.col("event_type") != "error", F.col("value").cast("bigint"))
    lines = as_logs(table(spark, sf_dir, "events"), whole).withColumn("date", F.translate("date", " ", "T"))
    lines.write.options(**CSV_OPTIONS).csv(source)
    output = scratch_dir(spark, "log-stream")
    config = LogStreamConfig(
        input_path=source,
        output=output,
        checkpoint=f"{output}-checkpoint",
        header=True,
        batch_limit=BATCH_FILES,
    )
    run(stream_logs(spark, config))
    layout = T.StructType([*APP_LOG, T.StructField("datepart", T.StringType())])
    return spark.read.schema(layout).orc(f"{output}-FS-ORC").drop("application")


@query(
    "SELECT substr(date, 1, 10) AS datepart, module, replace(date, ' ', 'T') AS date, NULL AS line FROM {logs} "
    "WHERE module NOT IN ('error', 'view') UNION ALL "
    "SELECT NULL, NULL, NULL, 'shop,error' FROM {logs} WHERE module = 'error' UNION ALL "
    "SELECT NULL, NULL, NULL, 'shop,view,x,' || replace(date, ' ', 'T') || ',12ms' FROM {logs} WHERE module = 'view'"
)
def log_lines_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with too few fields or a number that is none are kept whole, apart from the good ones."""
    source, output = scratch_dir(spark, "log-files"), scratch_dir(spark, "log-stream")
    date = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_type")
    line = (
        F.when(kind == "error", "shop,error")
        .when(kind == "view", F.concat(F.lit("shop,view,x,"), date, F.lit(",12ms")))
        .otherwise(F.concat(F.lit("shop,"), kind, F.lit(",x,"), date, F.lit(",12")))
    )
    write_text(table(spark, sf_dir, "events").select(line.alias("value")), source)
    config = LogStreamConfig(
        input_path=source, output=output, checkpoint=f"{output}-checkpoint", on_error="quarantine", batch_limit=BATCH_FILES
    )
    run(stream_logs(spark, config))
    rows = spark.read.schema("module STRING, date STRING, _corrupt_record STRING, datepart STRING").orc(f"{output}-FS-ORC")
    good = F.col("_corrupt_record").isNull()
    return rows.select("datepart", *[F.when(good, F.col(name)).alias(name) for name in ("module", "date")], F.col("_corrupt_record").alias("line"))


@query(
    "SELECT sink, datepart, user_id, updated_at AS detail FROM {updates}, (VALUES ('json'), ('orc')) v(sink) UNION ALL "
    "SELECT 'text', NULL, user_id, address FROM {updates} UNION ALL "
    "SELECT 'average', NULL, NULL, '0.0 of ' || count(*) FROM {updates} UNION ALL "
    "SELECT 'keyed', NULL, user_id, user_fname FROM (" + LATEST_UPDATE + ")"
)
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parsed batch to a raw archive, files, the average and the profile table: the rows of each sink."""
    config = profile_config(spark)
    run(stream_profiles(update_records(stream_table(spark, sf_dir, "events")), config))
    layout, null = "user_id STRING, updated_at STRING, datepart STRING", F.lit(None).cast("string")

    def rows(df: DataFrame, sink: str, detail: Column, user: Column | None = None, day: Column = null) -> DataFrame:
        user = F.col("user_id") if user is None else user
        return df.select(F.lit(sink).alias("sink"), day.alias("datepart"), user.alias("user_id"), detail.alias("detail"))

    written, day = F.col("updated_at"), F.col("datepart")
    message = lambda path: F.get_json_object("value", path)
    average = spark.read.schema("avg_response_time DOUBLE, n BIGINT").parquet(f"{config.output}-AVERAGE")
    total = average.agg(F.max("avg_response_time").alias("average"), F.sum("n").alias("n"))
    return (
        rows(spark.read.schema(layout).json(f"{config.output}-JSON"), "json", written, day=day)
        .unionByName(rows(spark.read.schema(layout).orc(f"{config.output}-ORC"), "orc", written, day=day))
        .unionByName(rows(spark.read.text(f"{config.output}-TEXT"), "text", message("$.modified_fields[0].address"), message("$.user_id")))
        .unionByName(rows(total, "average", F.concat_ws(" of ", F.col("average").cast("string"), "n"), null))
        .unionByName(rows(profile_table(config).scan(spark), "keyed", F.col("user_fname")))
    )


@query(LATEST_UPDATE)
def stream_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile table a stream leaves behind."""
    config = profile_config(spark, formats=())
    run(stream_profiles(update_records(stream_table(spark, sf_dir, "events")), config))
    return profile_table(config).scan(spark)


@query(
    "SELECT CASE WHEN datepart < '2024-01-16' THEN 0 ELSE 2 END AS batch, CAST(0 AS DOUBLE) AS avg_response_time, "
    "count(*) AS n FROM {updates} GROUP BY 1"
)
def stream_batch_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The average of a random metric, once per micro-batch and without state between them; a batch without records,
    between the two, runs no sink."""
    config = profile_config(spark, formats=())
    topics = RecordFiles(scratch_dir(spark, "topics")).create(spark)
    records = topics.stream(spark, "profile_updates")
    for first in (True, None, False):
        if first is None:
            topics.publish(event_records(table(spark, sf_dir, "events")))  # of another topic
        else:
            publish_updates(topics, spark, sf_dir, first)
        run(stream_profiles(records, config))
    rows = spark.read.schema("avg_response_time DOUBLE, n BIGINT, batch STRING").parquet(f"{config.output}-AVERAGE")
    return rows.select(F.substring_index("batch", "-", -1).cast("int").alias("batch"), "avg_response_time", "n")


@query("SELECT address, updated_at, user_fname, user_id, user_lname, datepart FROM {updates}")
def stream_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with checkpoints of their own write to one output, each its half of the messages."""
    config = profile_config(spark, formats=("json",))
    for half in (0, 1):
        events = stream_table(spark, sf_dir, "events").where(F.col("user_id") % 2 == half)
        own = dataclasses.replace(config, checkpoint=f"{config.checkpoint}-{half}")
        run(stream_profiles_once(update_records(events), own))
    kind = T.StructType([*PROFILE_UPDATE.fields[:4], T.StructField("modified_fields", T.ArrayType(T.StructType([T.StructField("address", T.StringType())])))])
    rows = spark.read.schema(T.StructType([*kind.fields, T.StructField("datepart", T.StringType())])).json(f"{config.output}-JSON")
    return rows.select(F.col("modified_fields")[0]["address"].alias("address"), "updated_at", "user_fname", "user_id", "user_lname", "datepart")


@query("SELECT address, updated_at, user_fname, user_id, user_lname, datepart FROM {updates}")
def stream_replay_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch fails after its sinks wrote, more messages come in, and the stream is restarted:
    every message is there once."""
    config = profile_config(spark)
    topics = RecordFiles(scratch_dir(spark, "topics")).create(spark)
    publish_updates(topics, spark, sf_dir, first=True)

    def fail_late(batch: DataFrame, batch_id: int) -> None:
        write_profile_batch(batch, batch_id, config, replay_safe=True, inferred=True)
        raise RuntimeError("lost after the sinks and before the commit")

    records = topics.stream(spark, "profile_updates", batch_limit=BATCH_FILES)
    failing = each_batch(records, fail_late, config.checkpoint)
    while failing.isActive:
        try:
            failing.awaitTermination()
        except Exception as error:
            if "lost after the sinks" not in str(error):
                raise
    publish_updates(topics, spark, sf_dir, first=False)
    run(stream_profiles_once(records, config))
    layout = (
        "modified_fields ARRAY<STRUCT<address: STRING>>, updated_at STRING, user_fname STRING, "
        "user_id STRING, user_lname STRING, datepart STRING"
    )
    rows = spark.read.schema(layout).orc(f"{config.output}-ORC").drop("batch")
    return rows.withColumn("address", F.col("modified_fields")[0]["address"]).drop("modified_fields")


@query(
    "SELECT 'user.' || user_id AS user_id, CASE WHEN ts < '2024-01-16' THEN event_type END AS channel, "
    "CASE WHEN ts >= '2024-01-16' THEN CAST(event_id AS DOUBLE) ELSE 0.5 END AS score FROM events"
)
def stream_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages lose a field and turn a fraction into a whole number; over a restart, the last batch's files still have every
    column, and their layout reads all batches."""
    config = profile_config(spark, formats=("orc",))
    topics = RecordFiles(scratch_dir(spark, "topics")).create(spark)
    events = table(spark, sf_dir, "events").withColumn("user", F.concat(F.lit("user."), "user_id"))
    own = {True: (F.col("event_type").alias("channel"), F.lit(0.5).alias("score")), False: (F.col("event_id").alias("score"),)}
    for first in (True, False):
        given = F.col("user").alias("user_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("updated_at")
        value = F.to_json(F.struct(*given, *own[first]))
        rows = events.where(early(first))
        topics.publish(as_records(rows, "drift", "user", value, partition=F.col("user_id") % 2, offset=F.col("event_id")))
        run(stream_profiles_once(topics.stream(spark, "drift"), config))
    path = f"{config.output}-ORC"
    last = max(names_in(spark, path), key=lambda name: int(name.rsplit("-", 1)[1]))
    return spark.read.schema(spark.read.orc(f"{path}/{last}").schema).orc(path).select("user_id", "channel", "score")


@query(
    "SELECT 'profile_updates' AS topic, part AS partition, min(pos) AS from_offset, "
    "max(pos) + 1 AS until_offset, count(*) AS records FROM {updates} GROUP BY part"
)
def stream_offset_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions each batch covered, as reported before its other sinks."""
    config = profile_config(spark, formats=())
    run(stream_profiles_once(update_records(stream_table(spark, sf_dir, "events")), config))
    layout = "topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT, records BIGINT"
    reports = spark.read.schema(layout).json(f"{config.output}-OFFSETS")
    return reports.groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"),
        F.max("until_offset").alias("until_offset"),
        F.sum("records").alias("records"),
    )


@query("SELECT event_id AS position, CAST(user_id AS VARCHAR) AS key, props AS value FROM events")
def topic_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source topic copied to a sink topic."""
    sink = RecordFiles(scratch_dir(spark, "sink-topic"))
    records = event_records(stream_table(spark, sf_dir, "events")).select(TOPIC_RECORD.names)
    run(pass_through(records, sink, "SinkTopic", f"{sink.path}-checkpoint"))
    return sink.read(spark, "SinkTopic").select(F.col("offset").alias("position"), "key", "value")


@query("SELECT event_id AS position, CAST(user_id AS VARCHAR) AS key, props AS value FROM events")
def topic_passthrough_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy that stops, finds more records when it starts again, and goes on where it was."""
    source, sink = RecordFiles(scratch_dir(spark, "topics")), RecordFiles(scratch_dir(spark, "sink-topic"))
    for first in (True, False):
        source.publish(event_records(table(spark, sf_dir, "events").where(early(first))))
        run(pass_through(source.stream(spark, "events"), sink, "SinkTopic", f"{sink.path}-checkpoint"))
    return sink.read(spark, "SinkTopic").select(F.col("offset").alias("position"), "key", "value")


@query("SELECT 'user.' || user_id AS key, upper(props) AS value FROM events")
def topic_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source topic copied with a new key and a changed value."""
    sink = RecordFiles(scratch_dir(spark, "sink-topic"))
    records = event_records(stream_table(spark, sf_dir, "events"))
    mapped = {"key": F.concat(F.lit("user."), "key"), "value": F.upper("value")}
    run(pass_through(records, sink, "SinkTopic", f"{sink.path}-checkpoint", **mapped))
    return sink.read(spark, "SinkTopic").select("key", "value")


@query(
    "SELECT CAST(e.user_id AS VARCHAR) AS key, e.props AS value FROM events e JOIN (SELECT user_id % 2 AS part, "
    "max(event_id) AS last FROM events WHERE ts < '2024-01-16' GROUP BY 1) p ON e.user_id % 2 = part WHERE event_id > last"
)
def stream_latest_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream from the latest records: what was there stays out, what comes before and after a restart arrives."""
    topics = RecordFiles(scratch_dir(spark, "topics"))
    out = scratch_dir(spark, "latest")
    events = table(spark, sf_dir, "events")
    for part in (early(True), early(False) & (F.col("event_id") % 3 == 0), early(False) & (F.col("event_id") % 3 != 0)):
        topics.publish(event_records(events.where(part)))
        rows = topics.stream(spark, "events", "latest", f"{out}-checkpoint", BATCH_FILES).select("key", "value")
        run(write_stream(rows, out, "parquet", f"{out}-checkpoint", partition=None))
    return spark.read.schema("key STRING, value STRING").parquet(out)


@query("SELECT CAST(user_id AS VARCHAR) AS key, props AS value, true AS several FROM events")
def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that looks for files every second, stopped when it has them all; its batches come from several triggers."""
    topics = RecordFiles(scratch_dir(spark, "topics"))
    out = scratch_dir(spark, "interval")
    for first in (True, False):
        topics.publish(event_records(table(spark, sf_dir, "events").where(early(first))))
    rows = topics.stream(spark, "events", batch_limit=1).select("key", "value")
    batches = drain(lambda: write_stream(rows, out, "parquet", f"{out}-checkpoint", 1, partition=None), spark)
    found = spark.read.schema("key STRING, value STRING").parquet(out)
    return found.withColumn("several", F.lit(len({batch for batch, _ in batches}) > 1))
