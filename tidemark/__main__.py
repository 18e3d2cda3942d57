"""Run a job: ``spark-submit … -m tidemark JOB PROPERTIES-FILE``, or ``python -m tidemark …``."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.config import (
    LogBatchConfig,
    LogStreamConfig,
    ProfileStreamConfig,
    TopicConfig,
    from_properties,
    parse_properties,
)
from tidemark.operators.sinks import preview
from tidemark.plans.jobs import (
    batch_logs,
    batch_logs_keyed,
    show_profiles,
    stream_logs,
    stream_profiles,
    stream_profiles_once,
)
from tidemark.session import get_spark, scratch_dir
from tidemark.sources.topics import RecordFiles, as_records, open_topics
from tidemark.streaming.run import console, pass_through, run

Properties = dict[str, str]


def _checkpoint(spark: SparkSession, properties: Properties, purpose: str) -> str:
    return properties.get("checkpointDirectory") or scratch_dir(spark, purpose)


# What a micro-batch takes unless batch.limit says otherwise, so that a backlog is not kept in one batch.
FILES_PER_BATCH, RECORDS_PER_BATCH = 1_000, 10_000_000


def _records(spark: SparkSession, properties: Properties, checkpoint: str, topic: str | None = None):
    config = from_properties(TopicConfig, properties)
    topics = open_topics(config)
    limit = config.batch_limit or (FILES_PER_BATCH if config.directory else RECORDS_PER_BATCH)
    return topics.stream(spark, topic or config.topics, config.starting, checkpoint, limit)


def file_batch(spark: SparkSession, properties: Properties) -> None:
    for result in batch_logs(spark, from_properties(LogBatchConfig, properties)).values():
        preview(result)


def file_batch_keyed(spark: SparkSession, properties: Properties) -> None:
    for result in batch_logs_keyed(spark, from_properties(LogBatchConfig, properties)).values():
        preview(result)


def file_stream(spark: SparkSession, properties: Properties) -> None:
    config = from_properties(LogStreamConfig, properties)
    run(stream_logs(spark, config, config.interval))


def profile_stream(spark: SparkSession, properties: Properties) -> None:
    config = from_properties(ProfileStreamConfig, properties)
    run(stream_profiles(_records(spark, properties, config.checkpoint), config, config.interval))


def profile_stream_once(spark: SparkSession, properties: Properties) -> None:
    config = from_properties(ProfileStreamConfig, properties)
    run(stream_profiles_once(_records(spark, properties, config.checkpoint), config, config.interval))


def profile_show(spark: SparkSession, properties: Properties) -> None:
    checkpoint = _checkpoint(spark, properties, "profile-show")
    interval = int(properties.get("micro.batch.interval", 5))
    run(show_profiles(_records(spark, properties, checkpoint), checkpoint, interval))


def topic_copy(spark: SparkSession, properties: Properties) -> None:
    """Source topic to sink topic. A sink topic in a directory gets ``topic.directory`` + ``-sink``."""
    config = from_properties(TopicConfig, properties)
    checkpoint = properties.get("checkpointDirectory")
    if not checkpoint:
        raise ValueError("topic-copy needs the property 'checkpointDirectory': a copy goes on where the last one ended")
    sink = RecordFiles(f"{config.directory}-sink") if config.directory else open_topics(config)
    records = _records(spark, properties, checkpoint, config.source_topic)
    run(pass_through(records, sink, config.sink_topic, checkpoint, int(properties.get("micro.batch.interval", 5))))


def produce(spark: SparkSession, properties: Properties) -> None:
    """Send the configured message. In a directory it gets partition 0 and the time as its offset."""
    config = from_properties(TopicConfig, properties)
    rows = spark.createDataFrame([(config.key, config.message)], "key STRING, value STRING")
    position = {"partition": F.lit(0), "offset": F.unix_micros(F.current_timestamp())} if config.directory else {}
    open_topics(config).publish(as_records(rows, config.topics[0], "key", F.col("value"), **position))


def consume(spark: SparkSession, properties: Properties) -> None:
    """Print the value of every record, from the start and as they arrive."""
    checkpoint = _checkpoint(spark, properties, "consume")
    run(console(_records(spark, properties, checkpoint).select("value"), checkpoint, 1))


JOBS: dict[str, Callable[[SparkSession, Properties], None]] = {
    "file-batch": file_batch,
    "file-batch-keyed": file_batch_keyed,
    "file-stream": file_stream,
    "profile-stream": profile_stream,
    "profile-stream-once": profile_stream_once,
    "profile-show": profile_show,
    "topic-copy": topic_copy,
    "produce": produce,
    "consume": consume,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("properties", type=Path)
    given = parser.parse_args(arguments)
    properties = parse_properties(given.properties.read_text())
    JOBS[given.job](get_spark(properties.get("app.name", given.job)), properties)


if __name__ == "__main__":
    main()
