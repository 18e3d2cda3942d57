"""Topics of keyed text records, held by Kafka or by a shared directory of record files.

Both kinds give the columns of ``TOPIC_RECORD`` and the same calls, so everything downstream is
written once. The directory form needs no connector: its Parquet files hold whole records, whose
partition and offset come with the data, and the file source turns new files into stream input.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import TopicConfig
from tidemark.functions.json_text import json_value
from tidemark.schemas import TOPIC_RECORD
from tidemark.session import names_in

Positions = dict[str, dict[int, int]]  # topic -> partition -> offset

# The two special positions of a per-partition offset document.
LATEST, EARLIEST = -1, -2  # every offset is past EARLIEST: as a start it needs no rule


def as_records(
    df: DataFrame,
    topic: Column | str,
    key: Column | str | None = None,
    value: Column | None = None,
    timestamp: Column | None = None,
    **position: Column,
) -> DataFrame:
    """Rows as ``(topic, key, value, timestamp)``; the value is the whole row as JSON by default.

    ``partition`` and ``offset``, both given, make them whole records for a directory.
    """
    return df.select(
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        (F.lit(None) if key is None else F.col(key) if isinstance(key, str) else key).cast("string").alias("key"),
        (json_value() if value is None else value).cast("string").alias("value"),
        (F.current_timestamp() if timestamp is None else timestamp).cast("timestamp").alias("timestamp"),
        *[column.cast(TOPIC_RECORD[name].dataType).alias(name) for name, column in position.items()],
    )


def _names(topics: str | Iterable[str]) -> list[str]:
    parts = topics.split(",") if isinstance(topics, str) else topics
    return sorted({part.strip() for part in parts if part.strip()})


def end_positions(records: DataFrame) -> Positions:
    """Per topic partition the offset after the last record: one number for each partition there is."""
    ends = records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("position"))
    found: Positions = {}
    for row in ends.collect():
        found.setdefault(row["topic"], {})[row["partition"]] = row["position"]
    return found


@dataclass(frozen=True)
class RecordFiles:
    """Records in a shared directory, ``topic=<name>`` below it. Whoever writes them gives partitions and offsets."""

    path: str

    def create(self, spark: SparkSession) -> RecordFiles:
        """Make the directory, so that a stream may start before the first records."""
        empty = spark.createDataFrame([], TOPIC_RECORD)
        empty.drop("topic").write.mode("ignore").parquet(f"{self.path}/topic=__HIVE_DEFAULT_PARTITION__")
        return self

    def publish(self, records: DataFrame) -> None:
        """Add whole records as new files; nothing that is there is read."""
        lacking = set(TOPIC_RECORD.names) - set(records.columns)
        if lacking:
            raise ValueError(f"records of a directory come with {', '.join(sorted(lacking))}")
        typed = [F.col(kind.name).cast(kind.dataType) for kind in TOPIC_RECORD]
        records.select(*typed).write.partitionBy("topic").mode("append").parquet(self.path)

    def read(
        self, spark: SparkSession, topics: str | Iterable[str], starting: str = "earliest", ending: str = "latest"
    ) -> DataFrame:
        """Records from ``starting`` (inclusive) to ``ending`` (exclusive).

        Each is a document ``{"topic": {"partition": offset}}``, or the directory's first or last record.
        """
        records = self._subscribed(spark.read.schema(TOPIC_RECORD).parquet(self.path), topics)
        return records.where(_from(topics, starting)).where(_until(topics, ending))

    def stream(
        self,
        spark: SparkSession,
        topics: str | Iterable[str],
        starting: str = "earliest",
        checkpoint: str | None = None,
        batch_limit: int | None = None,
    ) -> DataFrame:
        """The records as a stream, at most ``batch_limit`` files per micro-batch.

        A start is a filter and stays the same over restarts. ``latest``, or the position -1, is the end of each partition
        when the stream starts for the first time; the checkpoint keeps these positions for restarts. A partition that
        appears later is read whole.
        """
        if _is_open(starting):
            if not checkpoint:
                raise ValueError("a start at the latest records needs a checkpoint, which keeps where that was")
            starting = self._first_start(spark, topics, starting, checkpoint)
        reader = spark.readStream.schema(TOPIC_RECORD)
        if batch_limit:
            reader = reader.option("maxFilesPerTrigger", batch_limit)
        return self._subscribed(reader.parquet(self.path), topics).where(_from(topics, starting))

    def _first_start(self, spark: SparkSession, topics: str | Iterable[str], starting: str, checkpoint: str) -> str:
        """The start as it was resolved when this checkpoint's stream began."""
        path = f"{checkpoint}/start-positions"
        if "_SUCCESS" not in names_in(spark, path):
            given = {} if starting == "latest" else json.loads(starting)
            ends = end_positions(self._subscribed(spark.read.schema(TOPIC_RECORD).parquet(self.path), topics))
            named = {name: ends.get(name, {}) for name in _names(topics)} if starting == "latest" else {
                name: {n: ends.get(name, {}).get(int(n), 0) if at == LATEST else at for n, at in by.items()} for name, by in given.items()
            }
            text = spark.createDataFrame([(json.dumps(named),)], "value STRING").coalesce(1)
            text.write.mode("overwrite").text(path)
        return spark.read.text(path).first()["value"]

    def _subscribed(self, records: DataFrame, topics: str | Iterable[str]) -> DataFrame:
        return records.where(F.col("topic").isin(_names(topics))).select(TOPIC_RECORD.names)


def _bounded(topics: str | Iterable[str], positions: Positions, within: Callable[[Column, int], Column], loosest) -> Column:
    """Whether a record is within the position of its partition; partitions that are not named stay whole.

    No join and no shuffle: one comparison per topic partition, and for each partition that all topics name one that is
    free of the topic, which the scan can use to skip row groups.
    """
    names, offset, partition = _names(topics), F.col("offset"), F.col("partition")
    kept = F.lit(True)
    for name in names:
        for number, position in positions.get(name, {}).items():
            kept &= (F.col("topic") != name) | (partition != int(number)) | within(offset, position)
    shared = set.intersection(*[set(positions.get(name, {})) for name in names]) if names else set()
    for number in sorted(shared, key=int):
        kept &= (partition != int(number)) | within(offset, loosest(positions[name][number] for name in names))
    return kept


def _is_open(starting: str) -> bool:
    """Whether a start depends on what there is when it is taken."""
    if starting in ("earliest", "latest"):
        return starting == "latest"
    return any(position == LATEST for by in json.loads(starting).values() for position in by.values())


def _from(topics: str | Iterable[str], starting: str) -> Column:
    if starting == "earliest":
        return F.lit(True)
    if _is_open(starting):
        raise ValueError("a directory is read from its earliest record or from given offsets; see end_positions")
    positions = json.loads(starting)
    return _bounded(topics, positions, lambda offset, position: offset >= position, min)


def _until(topics: str | Iterable[str], ending: str) -> Column:
    if ending == "latest":
        return F.lit(True)
    named = {
        topic: {number: position for number, position in by.items() if position != LATEST}
        for topic, by in json.loads(ending).items()
    }
    return _bounded(topics, named, lambda offset, position: offset < position, max)


@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a Kafka cluster, through Spark's connector."""

    servers: str
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self, topics: str | Iterable[str], starting: str, ending: str | None = None) -> dict[str, str]:
        given = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": ",".join(_names(topics)),
            "startingOffsets": starting,
            **self.options,
        }
        return {**given, "endingOffsets": ending} if ending else given

    def read(
        self, spark: SparkSession, topics: str | Iterable[str], starting: str = "earliest", ending: str = "latest"
    ) -> DataFrame:
        return _envelope(_load(spark.read.format("kafka").options(**self.reader_options(topics, starting, ending))))

    def stream(
        self,
        spark: SparkSession,
        topics: str | Iterable[str],
        starting: str = "earliest",
        checkpoint: str | None = None,
        batch_limit: int | None = None,
    ) -> DataFrame:
        """The records as a stream, at most ``batch_limit`` of them per micro-batch. The connector
        keeps its start in the checkpoint by itself."""
        reader = spark.readStream.format("kafka").options(**self.reader_options(topics, starting))
        return _envelope(_load(reader.option("maxOffsetsPerTrigger", batch_limit) if batch_limit else reader))

    def publish(self, records: DataFrame) -> None:
        out = records.select("topic", "key", "value").write.format("kafka")
        _with_connector(out.option("kafka.bootstrap.servers", self.servers).options(**self.options).save)


def _with_connector(action):
    try:
        return action()
    except AnalysisException as error:
        if "data source: kafka" in str(error):
            raise RuntimeError(
                "the Kafka connector is not installed; add spark-sql-kafka-0-10, or set topic.directory"
            ) from error
        raise


def _load(reader) -> DataFrame:
    return _with_connector(reader.load)


def _envelope(records: DataFrame) -> DataFrame:
    return records.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def open_topics(config: TopicConfig) -> RecordFiles | KafkaTopics:
    if config.directory:
        return RecordFiles(config.directory)
    options = {"kafka.security.protocol": config.security_protocol}
    if config.group_id:
        options["kafka.group.id"] = config.group_id
    if config.client_id:
        options["kafka.client.id"] = config.client_id
    return KafkaTopics(config.servers, options)
