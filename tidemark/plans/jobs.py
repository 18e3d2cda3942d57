"""The batch and streaming jobs."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import LogBatchConfig, LogStreamConfig, ProfileStreamConfig
from tidemark.functions.aggregates import my_average
from tidemark.functions.dates import UPDATE_DATE_PATTERN, date_part, date_time
from tidemark.functions.json_text import CORRUPT_RECORD, has_text, infer_json_schema, parse_declared, parse_inferred
from tidemark.operators.keyed import LOG_AGG_CATALOG, USER_PROFILE_CATALOG, Catalog, KeyedTable, content_key, run_key
from tidemark.operators.sinks import fan_out, group_for, require_avro, write_avro, write_partitioned, write_text
from tidemark.schemas import APP_LOG, PROFILE_UPDATE
from tidemark.sources.logs import parse_log_lines, read_logs, stream_lines
from tidemark.streaming.columns import columns_so_far
from tidemark.streaming.offsets import offset_ranges
from tidemark.streaming.run import console, each_batch, write_stream, writer_of

QUARANTINE = "quarantine"

LOG_AGG = Catalog.parse(LOG_AGG_CATALOG)
# The same columns under a text key.
LOG_BY_CONTENT = Catalog("log_agg_content", LOG_AGG.key, (("key", "key", "string"), *LOG_AGG.columns[1:]))
USER_PROFILE = Catalog.parse(USER_PROFILE_CATALOG)

# The endings of output directories (-FB-ORC, -FS-ORC, -JSON, ...) are those existing users have.

# The newer of two updates of a user: by the time its text means, then by the text and the topic position.
UPDATE_TIME = "_update_time"
PROFILE_ORDER = ((UPDATE_TIME, "timestamp_ntz"), ("updated_at", "string"), ("partition", "int"), ("offset", "long"))


def with_update_time(updates: DataFrame, pattern: str = UPDATE_DATE_PATTERN) -> DataFrame:
    return updates.withColumn(UPDATE_TIME, date_time("updated_at", pattern))


def _date_errors(on_error: str) -> str:
    if on_error not in ("fail", QUARANTINE):
        raise ValueError(f"on_error must be 'fail' or {QUARANTINE!r}, got {on_error!r}")
    return "fail" if on_error == "fail" else "null"


def _table_path(config: LogBatchConfig | ProfileStreamConfig, catalog: Catalog) -> str:
    return f"{config.tables or config.output + '-KEYED'}/{catalog.name}"


# --- batch logs -------------------------------------------------------------------------------


def read_app_logs(spark: SparkSession, config: LogBatchConfig) -> DataFrame:
    """The logs, also as the view ``app_logs``, with the text of misfit lines beside them in ``_corrupt_record``."""
    checked = read_logs(spark, config.input_path, None if config.infer_schema else APP_LOG, CORRUPT_RECORD)
    checked.drop(CORRUPT_RECORD).createOrReplaceTempView("app_logs")
    return checked


def _dated(logs: DataFrame, pattern: str, on_error: str) -> DataFrame:
    """The logs with their date partition. A line that does not fit stops the job, or has no partition."""
    day, broken = date_part("date", pattern, _date_errors(on_error)), F.col(CORRUPT_RECORD)
    if on_error == QUARANTINE:
        return logs.withColumn("datepart", F.when(broken.isNull(), day))
    problem = F.raise_error(F.concat(F.lit("not a log line: "), broken)).cast("string")
    return logs.withColumn("datepart", F.when(broken.isNull(), day).otherwise(problem)).drop(CORRUPT_RECORD)


def batch_logs(spark: SparkSession, config: LogBatchConfig) -> dict[str, DataFrame]:
    """Logs to date-partitioned ORC; the rows of one module and the average response time as queries.

    A line whose fields do not fit the schema or whose date does not parse stops the job. With ``on_error=quarantine``
    such lines go to their own dataset, the misfits with their text in ``_corrupt_record``. The main
    write counts them on the way, so the input is read a second time only if there are any.

    A run adds its rows to the output. With a ``run_id`` they go to ``run=<run_id>`` below it, and the same run again
    replaces them instead of adding them twice.
    """
    checked = read_app_logs(spark, config)
    logs = spark.table("app_logs")
    own, mode = (f"/run={config.run_id}", "overwrite") if config.run_id else ("", "append")
    target = f"{config.output}-FB-ORC{own}"
    enriched = _dated(checked, config.date_pattern, config.on_error)
    if config.on_error == QUARANTINE:
        seen, is_good = Observation(), F.col("datepart").isNotNull()
        counted = enriched.observe(seen, F.count_if(~is_good).alias("bad"))
        bad, enriched = enriched.where(~is_good).drop("datepart"), enriched.where(is_good).drop(CORRUPT_RECORD)
        write_partitioned(counted.where(is_good).drop(CORRUPT_RECORD), target, "orc", mode=mode, rebalance=config.rebalance)
        if seen.get["bad"] or config.run_id:
            bad.write.mode(mode).orc(f"{config.output}-FB-BAD{own}")
    else:
        write_partitioned(enriched, target, "orc", mode=mode, rebalance=config.rebalance)
    return {
        "module": logs.where(F.col("module") == config.module),
        "average": logs.agg(my_average("response_time").alias("avg_response_time")),
        "enriched": enriched,
    }


def batch_logs_keyed(spark: SparkSession, config: LogBatchConfig) -> dict[str, DataFrame]:
    """``batch_logs``, and the log lines under a generated key into the keyed log table.

    With ``row_key=run`` the keys are numbers that the next run uses again, so each run puts its rows in the place of the
    last one's; readers that must not see a run at work give each run a ``table.directory`` of its own.
    With ``row_key=content`` the key is made from all columns of the line: runs add their lines, and lines that are equal
    in every column are one row.
    """
    if config.row_key not in ("run", "content"):
        raise ValueError(f"row_key must be 'run' or 'content', got {config.row_key!r}")
    written = batch_logs(spark, config)
    lines, cells = written["enriched"].drop("datepart"), ("application", "module", "message")
    if config.row_key == "run":
        table = KeyedTable(_table_path(config, LOG_AGG), LOG_AGG)
        table.upsert(run_key(lines.select(*cells)), 0, "run")
    else:
        table = KeyedTable(_table_path(config, LOG_BY_CONTENT), LOG_BY_CONTENT)
        table.upsert(content_key(lines, lines.columns).select("key", *cells), 0, config.run_id or uuid.uuid4().hex)
    return {**written, "keyed": table.scan(spark)}


# --- log stream -------------------------------------------------------------------------------


def stream_logs(spark: SparkSession, config: LogStreamConfig, interval: int | None = None) -> StreamingQuery:
    """New log files to date-partitioned ORC, each line exactly once.

    A line that does not fit the schema (a number that is none, too few or too many fields) or whose date does not
    parse stops the job. With ``on_error=quarantine`` it is kept under the null date, with its text in ``_corrupt_record``
    if it is the fields that do not fit.
    """
    lines = stream_lines(spark, config.input_path, config.batch_limit)
    logs = parse_log_lines(lines, header=config.header, corrupt=CORRUPT_RECORD)
    enriched = _dated(logs, config.date_pattern, config.on_error)
    if config.rebalance:
        enriched = group_for(enriched, "datepart")
    return write_stream(enriched, f"{config.output}-FS-ORC", "orc", config.checkpoint, interval)


# --- profile streams --------------------------------------------------------------------------


def profile_table(config: ProfileStreamConfig) -> KeyedTable:
    return KeyedTable(_table_path(config, USER_PROFILE), USER_PROFILE, PROFILE_ORDER)


def write_profile_batch(
    batch: DataFrame,
    batch_id: int,
    config: ProfileStreamConfig,
    replay_safe: bool,
    inferred: bool,
    schema: T.StructType | None = None,
) -> None:
    """Parse one micro-batch and write it to all sinks.

    What is needed of the topic record travels along as one struct, so that message fields of any
    name fit beside it. ``replay_safe`` gives each batch its own directory per sink and overwrites it on a replay;
    the directory is named by the stream's id and the batch's, so another stream or a new checkpoint adds to the output.
    With ``inferred`` a record without text is no message, as for the JSON reader; its position
    is still reported.
    """
    writer = writer_of(batch)
    batch_name = f"{writer}-{batch_id}" if writer else str(batch_id)
    wanted = ["topic", "partition", "offset"]
    if not replay_safe or config.on_error == QUARANTINE:
        wanted.append("value")  # some sink writes the text itself
    filled = has_text("value") if inferred else F.lit(True)
    packed = batch.select(F.struct(*wanted, filled.alias("is_message")).alias("_record"), "value")
    if inferred:
        if schema is None and writer:
            schema = columns_so_far(batch.sparkSession, config.checkpoint, batch_id, infer_json_schema(packed))
        rows = parse_inferred(packed, keep=("_record",), schema=schema, skip_blank=False)
        missing = [name for name in PROFILE_UPDATE.names if name not in rows.columns]
        rows = rows.withColumns({name: F.lit(None).cast(PROFILE_UPDATE[name].dataType) for name in missing})
    else:
        rows = parse_declared(packed, PROFILE_UPDATE, keep=("_record",))
    is_message = F.col("_record.is_message")
    day = date_part("updated_at", config.date_pattern, _date_errors(config.on_error))
    enriched = rows.withColumn("datepart", F.when(is_message, day))
    usable = is_message
    if config.on_error == QUARANTINE:
        usable = is_message & F.col("datepart").isNotNull() & F.col("user_id").isNotNull()

    mode = "overwrite" if replay_safe else "append"

    def target(kind: str, own_directory: bool = replay_safe) -> str:
        return f"{config.output}-{kind}" + (f"/batch={batch_name}" if own_directory else "")

    def archive(df: DataFrame) -> None:
        raw = df.select("_record.value")
        write_text(raw, target("TEXT", True), mode="overwrite", single_file=config.single_text_file)

    def positions(df: DataFrame) -> None:
        offset_ranges(df.select("_record.*")).write.mode("overwrite").json(target("OFFSETS", True))

    def average(df: DataFrame) -> None:
        timed = df.where(usable).withColumn("response_time", F.rand(config.seed))
        result = timed.agg(my_average("response_time").alias("avg_response_time"), F.count("*").alias("n"))
        result.write.mode("overwrite").parquet(target("AVERAGE", True))

    def quarantine(df: DataFrame) -> None:
        bad = df.where(is_message & ~usable).select("_record.value")
        write_text(bad, target("BAD", True), mode="overwrite")

    def files(df: DataFrame, fmt: str) -> None:
        rows = df.where(usable).drop("_record", CORRUPT_RECORD)
        if fmt == "avro":
            write_avro(rows, target("AVRO"), config.record_name, config.record_namespace, mode=mode)
        else:
            write_partitioned(rows, target(fmt.upper()), fmt, mode=mode)

    def keyed(df: DataFrame) -> None:
        position = {name: F.col(f"_record.{name}") for name in ("partition", "offset")}
        rows = with_update_time(df.where(usable).withColumns(position), config.date_pattern)
        profile_table(config).upsert(rows, batch_id, writer)

    sinks = [positions] if replay_safe else [archive]
    sinks.append(average)
    sinks += [partial(files, fmt=fmt) for fmt in config.formats]
    sinks.append(keyed)
    if config.on_error == QUARANTINE:
        sinks.append(quarantine)
    fan_out(enriched, *sinks)  # each file sink groups by date for itself, which splits a hot date


def _start_profiles(
    records: DataFrame, config: ProfileStreamConfig, interval: int | None, **how: object
) -> StreamingQuery:
    if "avro" in config.formats:
        require_avro(records.sparkSession)  # before any batch has written half of its sinks
    return each_batch(records, partial(write_profile_batch, config=config, **how), config.checkpoint, interval)


def stream_profiles(records: DataFrame, config: ProfileStreamConfig, interval: int | None = None) -> StreamingQuery:
    """Messages with the declared schema to a raw archive, files and the profile table.

    Files are appended to, so a batch replayed after a failure may add its rows again; use
    ``stream_profiles_once`` where that matters.
    """
    return _start_profiles(records, config, interval, replay_safe=False, inferred=False)


def stream_profiles_once(
    records: DataFrame,
    config: ProfileStreamConfig,
    interval: int | None = None,
    schema: T.StructType | None = None,
) -> StreamingQuery:
    """Messages with a schema inferred per batch, to files and the profile table, without duplicates.

    Positions are reported per batch and count as read only once every sink is done. A batch has its own columns and those
    of all batches before it, which the checkpoint keeps. A ``schema`` inferred earlier, or named in the config, keeps the
    columns the same in every batch, and saves the inference.
    """
    if schema is None and config.message_schema:
        schema = T.StructType.fromDDL(config.message_schema)
    return _start_profiles(records, config, interval, replay_safe=True, inferred=True, schema=schema)


def parse_profiles(records: DataFrame) -> DataFrame:
    """Messages of a topic as typed columns, in one stateless projection."""
    return parse_declared(records.selectExpr("CAST(value AS STRING)"), PROFILE_UPDATE)


def show_profiles(records: DataFrame, checkpoint: str, interval: int | None = None) -> StreamingQuery:
    """Messages of a topic, parsed, to the console."""
    return console(parse_profiles(records), checkpoint, interval)
