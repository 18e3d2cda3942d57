"""Job parameters: one dataclass per job, read from a ``key=value`` properties text."""

from __future__ import annotations

import re
from dataclasses import MISSING, dataclass, field, fields
from typing import Any, TypeVar

from tidemark.functions.dates import LOG_DATE_PATTERN, LOG_STREAM_DATE_PATTERN, UPDATE_DATE_PATTERN

_LINE = re.compile(r"\s*([^=:\s]+)\s*[=:]?\s*(.*)", re.DOTALL)

Config = TypeVar("Config")


def parse_properties(text: str) -> dict[str, str]:
    """Properties text to a dict. A repeated key keeps its last value; ``\\`` at a line end joins lines."""
    found: dict[str, str] = {}
    for line in re.sub(r"\\\n\s*", "", text).splitlines():
        if line.strip() and not line.lstrip().startswith(("#", "!")):
            key, value = _LINE.fullmatch(line).groups()
            found[key] = value
    return found


def _flag(text: str) -> bool:
    return text.strip().lower() == "true"


def _set(key: str, default: Any = MISSING, read=str):
    """A field filled from the property ``key``."""
    return field(default=default, metadata={"key": key, "read": read}, kw_only=True)


def _topics(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(name.strip() for name in text.split(",") if name.strip()))


def from_properties(kind: type[Config], properties: dict[str, str]) -> Config:
    """Fill ``kind`` from the keys it knows; unknown keys are ignored, missing ones take the default."""
    given = {}
    for spec in fields(kind):
        key = spec.metadata["key"]
        if properties.get(key, "").strip():
            given[spec.name] = spec.metadata["read"](properties[key])
        elif spec.default is MISSING:
            raise ValueError(f"{kind.__name__} needs the property {key!r}")
    return kind(**given)


# The property names and topic names below are fixed values: existing properties files keep working.


@dataclass(frozen=True)
class LogBatchConfig:
    """CSV logs to a date-partitioned ORC dataset, and to the keyed log table."""

    app_name: str = _set("app.name", "log-batch")
    input_path: str = _set("file.stream.input.path")
    output: str = _set("outputDirectory")
    date_pattern: str = _set("input.date.format", LOG_DATE_PATTERN)
    module: str = _set("module", "ModuleA")
    on_error: str = _set("on.error", "fail")
    infer_schema: bool = _set("infer.schema", True, _flag)
    rebalance: bool = _set("rebalance", True, _flag)
    tables: str | None = _set("table.directory", None)  # beside the output unless given
    row_key: str = _set("row.key", "run")  # run: a run replaces the table; content: runs add to it
    run_id: str | None = _set("run.id", None)  # the same run again replaces what it wrote


@dataclass(frozen=True)
class LogStreamConfig:
    """New log files of a directory to a date-partitioned ORC dataset."""

    app_name: str = _set("app.name", "log-stream")
    input_path: str = _set("file.stream.input.path")
    output: str = _set("outputDirectory")
    checkpoint: str = _set("checkpointDirectory")
    interval: int = _set("micro.batch.interval", 5, int)
    date_pattern: str = _set("stream.date.format", LOG_STREAM_DATE_PATTERN)
    on_error: str = _set("on.error", "fail")
    header: bool = _set("header", False, _flag)
    batch_limit: int | None = _set("batch.limit", None, int)  # files
    rebalance: bool = _set("rebalance", True, _flag)


# What is sent when no message is configured.
DEFAULT_MESSAGE = (
    '{"user_fname":"first", "user_lname":"last", "user_id":"user.1", '
    '"updated_at":"2020-03-22 14:15:16.000", "modified_fields":[{"address":"new value"}]} '
)


@dataclass(frozen=True)
class TopicConfig:
    """Where topics live: a Kafka cluster, or a shared directory when ``topic.directory`` is set."""

    app_name: str = _set("app.name", "topics")
    topics: tuple[str, ...] = _set("topic.name", ("tp_in_profileupdates",), _topics)
    directory: str | None = _set("topic.directory", None)
    servers: str = _set("bootstrap.servers", "localhost:6667")
    security_protocol: str = _set("security.protocol", "PLAINTEXT")
    group_id: str | None = _set("group.id", None)
    client_id: str | None = _set("client.id", None)
    starting: str = _set("auto.offset.reset", "earliest")
    batch_limit: int | None = _set("batch.limit", None, int)  # files of a directory, records of Kafka
    key: str | None = _set("topic.key", None)
    message: str = _set("message", DEFAULT_MESSAGE)
    source_topic: str = _set("source.topic", "SourceTopic")
    sink_topic: str = _set("sink.topic", "SinkTopic")


@dataclass(frozen=True)
class ProfileStreamConfig:
    """Profile updates of a topic to date-partitioned files and the keyed profile table."""

    app_name: str = _set("app.name", "profile-stream")
    output: str = _set("outputDirectory")
    checkpoint: str = _set("checkpointDirectory")
    interval: int = _set("micro.batch.interval", 5, int)
    date_pattern: str = _set("update.date.format", UPDATE_DATE_PATTERN)
    on_error: str = _set("on.error", "fail")
    formats: tuple[str, ...] = _set("output.formats", ("json", "orc", "avro"), _topics)
    tables: str | None = _set("table.directory", None)  # beside the output unless given
    message_schema: str | None = _set("message.schema", None)  # DDL, instead of inferring each batch's
    single_text_file: bool = _set("single.text.file", False, _flag)
    seed: int = _set("random.seed", 0, int)
    record_name: str = _set("avro.record.name", "MyAVRO")
    record_namespace: str = _set("avro.record.namespace", "tidemark")
