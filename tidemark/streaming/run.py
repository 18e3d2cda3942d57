"""Starting and running streaming queries. Every query has a checkpoint."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tidemark.schemas import TOPIC_RECORD
from tidemark.session import last_batch
from tidemark.sources.topics import KafkaTopics, RecordFiles


def _start(writer: DataStreamWriter, checkpoint: str, interval: int | None) -> StreamingQuery:
    """Every ``interval`` seconds; without an interval, take what is there now and stop."""
    trigger = {"processingTime": f"{interval} seconds"} if interval else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def writer_of(batch: DataFrame) -> str:
    """The id of the running query, which its checkpoint keeps over restarts; empty outside a stream."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def each_batch(
    stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str, interval: int | None = None
) -> StreamingQuery:
    """Call ``action(batch, batch_id)`` on every non-empty micro-batch.

    The batch counts as done only when the action returns; a restart after a failure runs the
    same batch id over the same input again.
    """

    def guarded(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            action(batch, batch_id)

    return _start(stream.writeStream.foreachBatch(guarded), checkpoint, interval)


def write_stream(
    stream: DataFrame,
    path: str,
    fmt: str,
    checkpoint: str,
    interval: int | None = None,
    partition: str | None = "datepart",
) -> StreamingQuery:
    """Append to one file dataset; the sink's log keeps each row exactly once.

    That log counts the batches of one query. Under another checkpoint the counting starts over, and batches the log
    already has would be skipped without a word, so such a start is refused.
    """
    spark = stream.sparkSession
    if last_batch(spark, f"{path}/_spark_metadata") > last_batch(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{path} belongs to a query with another checkpoint than {checkpoint}")
    writer = stream.writeStream.outputMode("append").format(fmt).option("path", path)
    return _start(writer.partitionBy(partition) if partition else writer, checkpoint, interval)


def console(stream: DataFrame, checkpoint: str, interval: int | None = None) -> StreamingQuery:
    """Show the rows of every micro-batch on the console."""
    return _start(stream.writeStream.outputMode("append").format("console"), checkpoint, interval)


def pass_through(
    records: DataFrame,
    sink: KafkaTopics | RecordFiles,
    topic: str,
    checkpoint: str,
    interval: int | None = None,
    key: Column | None = None,
    value: Column | None = None,
) -> StreamingQuery:
    """Move the records of one source topic to a sink topic, each mapped to ``(key, value)``.

    The map is the identity by default. In a directory topic a record keeps its partition and
    offset, which no other record of the source has, so nothing is renumbered or shuffled and the
    file sink's log makes the copy exactly once. Such a topic has its directory to itself.
    """
    mapped = records.select(
        F.lit(topic).alias("topic"),
        "partition",
        "offset",
        "timestamp",
        (F.col("key") if key is None else key).cast("string").alias("key"),
        (F.col("value") if value is None else value).cast("string").alias("value"),
    ).select(TOPIC_RECORD.names)
    if isinstance(sink, RecordFiles):
        return write_stream(mapped, sink.path, "parquet", checkpoint, interval, partition="topic")
    writer = mapped.select("topic", "key", "value").writeStream.outputMode("append").format("kafka")
    writer = writer.option("kafka.bootstrap.servers", sink.servers).options(**sink.options)
    return _start(writer, checkpoint, interval)


class Progress(StreamingQueryListener):
    """The progress of one query's micro-batches that took rows, as (batch id, rows), the last ``most`` of them."""

    def __init__(self, most: int = 1000) -> None:
        self.batches: deque[tuple[int, int]] = deque(maxlen=most)
        self.of: str | None = None
        self._early: list[tuple[str, int, int]] = []

    def follow(self, query: StreamingQuery) -> None:
        self.of = str(query.runId)
        for run_id, batch_id, rows in self._early:
            self._add(run_id, batch_id, rows)
        self._early.clear()

    def _add(self, run_id: str, batch_id: int, rows: int) -> None:
        if self.of is None:
            self._early.append((run_id, batch_id, rows))
        elif run_id == self.of and rows:
            self.batches.append((batch_id, rows))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._add(str(event.progress.runId), event.progress.batchId, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def drain(start: Callable[[], StreamingQuery], spark: SparkSession) -> list[tuple[int, int]]:
    """Run a query that has an interval until all its input there is now is taken, then stop it; returns (batch id, rows) of
    its micro-batches. A query that fails raises its error."""
    progress = Progress()
    spark.streams.addListener(progress)
    try:
        query = start()
        progress.follow(query)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(progress)
    return list(progress.batches)


def run(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait until the query ends, or stop it after ``timeout`` seconds."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
    return query
