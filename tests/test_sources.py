from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.config import (
    LogBatchConfig,
    LogStreamConfig,
    ProfileStreamConfig,
    TopicConfig,
    from_properties,
    parse_properties,
)
from tidemark.schemas import APP_LOG, TOPIC_RECORD
from tidemark.session import scratch_dir
from tidemark.sources import (
    KafkaTopics,
    RecordFiles,
    as_records,
    infer_log_schema,
    open_topics,
    parse_log_lines,
    read_logs,
    stream_lines,
)
from tidemark.sources.topics import end_positions
from tidemark.streaming import each_batch, run, write_stream

HEADER = "application,module,message,date,response_time"


def write_csv(path: str, *lines: str, header: str = HEADER) -> str:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text("\n".join([header, *lines]) + "\n")
    return path


# --- logs


def test_csv_types_are_inferred(spark, out):
    path = write_csv(f"{out}/a.csv", 'web,ModuleA,"one, two",2020-03-27 05:05:05,12', "web,ModuleB,x,2020-03-28 00:00:01,")
    rows = read_logs(spark, path)
    assert [kind for _, kind in rows.dtypes] == ["string", "string", "string", "timestamp", "int"]
    assert rows.where(F.col("module") == "ModuleA").first()["message"] == "one, two"
    assert rows.where(F.col("response_time").isNull()).count() == 1


def test_csv_glob_and_declared_schema(spark, out):
    write_csv(f"{out}/day=1/a.csv", 'web,A,"say ""hi""",2020-03-27 05:05:05,12')
    write_csv(f"{out}/day=2/b.csv", "web,B,x,2020-03-28 05:05:05,13")
    rows = read_logs(spark, f"{out}/day=*/*.csv", APP_LOG)
    assert {(row["message"], row["date"], row["response_time"]) for row in rows.collect()} == {
        ('say "hi"', "2020-03-27 05:05:05", 12),
        ("x", "2020-03-28 05:05:05", 13),
    }


def test_csv_with_other_columns_is_an_error(spark, out):
    path = write_csv(f"{out}/a.csv", "A,web,x,2020-03-27 05:05:05,12", header="module,application,message,date,response_time")
    with pytest.raises(Exception, match="(?i)header"):
        read_logs(spark, path, APP_LOG).collect()


def test_inferred_schema_can_be_kept(spark, out):
    path = write_csv(f"{out}/a.csv", "web,A,x,2020-03-27 05:05:05,12")
    schema = infer_log_schema(spark, path)
    assert read_logs(spark, path, schema).schema == schema


def test_lines_become_records(spark, out):
    lines = spark.createDataFrame(
        [(HEADER,), ('web,A,"one, ""two""",2020-03-27T05:05:05,12',), ("web,A,x,2020-03-27T05:05:05,",)], "value STRING"
    )
    rows = parse_log_lines(lines, header=True).collect()
    assert [(row["message"], row["response_time"]) for row in rows] == [('one, "two"', 12), ("x", None)]


def test_line_stream_takes_new_files(spark, out):
    Path(out, "in").mkdir(parents=True)
    for batch in ("first", "second"):
        Path(out, "in", f"{batch}.txt").write_text(f"{batch}\n")
        lines = stream_lines(spark, f"{out}/in", batch_limit=1)
        run(write_stream(lines, f"{out}/seen", "parquet", f"{out}/checkpoint", partition=None))
    assert {row["value"] for row in spark.read.parquet(f"{out}/seen").collect()} == {"first", "second"}


# --- topics


def publish(spark, topics, topic, *records):
    """Add records (partition, offset, value)."""
    rows = spark.createDataFrame(list(records), "p INT, o BIGINT, v STRING")
    topics.publish(as_records(rows, topic, value=F.col("v"), partition=F.col("p"), offset=F.col("o")))


def values(df):
    return sorted(row["value"] for row in df.select("value").collect())


def test_records_keep_their_positions(spark, out):
    topics = RecordFiles(out)
    publish(spark, topics, "t", (0, 7, "a"), (1, 7, "b"))
    publish(spark, topics, "t", (0, 8, "c"))
    rows = topics.read(spark, "t")
    assert rows.columns == TOPIC_RECORD.names
    assert {(row["partition"], row["offset"], row["value"]) for row in rows.collect()} == {(0, 7, "a"), (1, 7, "b"), (0, 8, "c")}


def test_records_without_positions_are_refused(spark, out):
    rows = spark.createDataFrame([("k", "v")], "k STRING, v STRING")
    with pytest.raises(ValueError, match="offset, partition"):
        RecordFiles(out).publish(as_records(rows, "t", "k", F.col("v")))


def test_subscription_is_a_set_of_topics(spark, out):
    topics = RecordFiles(out).create(spark)
    for i in "123":
        publish(spark, topics, f"t{i}", (0, 0, i))
    assert values(topics.read(spark, "t1, t3,t1")) == ["1", "3"]
    assert values(topics.read(spark, ["t2"])) == ["2"]


def test_read_between_positions(spark, out):
    topics = RecordFiles(out)
    publish(spark, topics, "t", *[(i % 2, i, f"a{i}") for i in range(10)])
    middle = json.dumps(end_positions(topics.read(spark, "t")))
    publish(spark, topics, "t", *[(i % 2, i, f"b{i}") for i in range(10, 20)])
    assert values(topics.read(spark, "t", starting=middle)) == [f"b{i}" for i in range(10, 20)]
    assert values(topics.read(spark, "t", ending=middle)) == [f"a{i}" for i in range(10)]
    assert len(topics.read(spark, "t", starting='{"t": {"0": -2, "1": 19}}').collect()) == 11
    assert len(topics.read(spark, "t", starting='{"t": {"1": 19}}').collect()) == 11  # partition 0 isn't named
    assert len(topics.read(spark, "t", ending='{"t": {"0": -1, "1": 1}}').collect()) == 10
    assert len(topics.read(spark, "t", starting='{"other": {"0": 99}}').collect()) == 20
    for given in ("latest", '{"t": {"0": -1}}'):
        with pytest.raises(ValueError, match="end_positions"):
            topics.read(spark, "t", starting=given)


def test_a_stream_from_the_latest_records_keeps_its_start(spark, out):
    topics = RecordFiles(f"{out}/topic").create(spark)
    arrived = []

    def taken(starting, checkpoint):
        arrived.clear()
        rows = topics.stream(spark, "t", starting, f"{out}/{checkpoint}")
        run(each_batch(rows, lambda batch, _: arrived.extend(r["value"] for r in batch.collect()), f"{out}/{checkpoint}"))
        return sorted(arrived)

    publish(spark, topics, "t", (0, 0, "a"), (1, 4, "b"))
    assert taken("latest", "c") == []
    assert taken('{"t": {"0": -1, "1": -2}}', "d") == ["b"]
    publish(spark, topics, "t", (0, 1, "c"), (1, 5, "d"), (2, 0, "new partition"))
    assert taken("latest", "c") == ["c", "d", "new partition"]
    assert taken('{"t": {"0": -1, "1": -2}}', "d") == ["c", "d", "new partition"]
    publish(spark, topics, "t", (0, 2, "e"))
    assert taken("latest", "c") == ["e"]
    assert taken("latest", "first start") == []
    with pytest.raises(ValueError, match="needs a checkpoint"):
        topics.stream(spark, "t", "latest")


def test_positions_reach_the_scan(spark, out):
    topics = RecordFiles(out)
    publish(spark, topics, "t", (0, 1, "1"))
    rows = topics.read(spark, "t", starting='{"t": {"0": 5, "1": 7}}')
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,5)" in plan.split("PushedFilters")[1]
    assert "Join" not in plan


def test_stream_from_a_position_survives_a_restart(spark, out):
    topics = RecordFiles(f"{out}/topics").create(spark)
    publish(spark, topics, "t", (0, 1, "old"))

    def drain():
        records = topics.stream(spark, "t", '{"t": {"0": 2}}')
        run(write_stream(records, f"{out}/seen", "parquet", f"{out}/checkpoint", partition=None))
        return values(spark.read.schema(TOPIC_RECORD).parquet(f"{out}/seen"))

    assert drain() == []
    publish(spark, topics, "t", (0, 2, "while stopped"))
    assert drain() == ["while stopped"]
    publish(spark, topics, "t", (0, 3, "new"))
    assert drain() == ["new", "while stopped"]


def test_kafka_options():
    topics = open_topics(TopicConfig(topics=("b", "a"), servers="h:1", group_id="g", client_id="c"))
    assert isinstance(topics, KafkaTopics)
    assert topics.reader_options(["b", "a"], "earliest", "latest") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        "kafka.security.protocol": "PLAINTEXT",
        "kafka.group.id": "g",
        "kafka.client.id": "c",
    }


def test_stream_batches_are_limited(spark, out):
    topics = RecordFiles(f"{out}/topics").create(spark)
    for offset, value in enumerate("abc"):
        publish(spark, topics, "t", (0, offset, value))
    records = topics.stream(spark, "t", batch_limit=1)
    query = run(write_stream(records, f"{out}/seen", "parquet", f"{out}/checkpoint", partition=None))
    assert max(progress["numInputRows"] for progress in query.recentProgress) == 1
    assert values(spark.read.schema(TOPIC_RECORD).parquet(f"{out}/seen")) == ["a", "b", "c"]


def test_missing_kafka_connector_is_named(spark):
    topics = KafkaTopics("localhost:1")
    try:
        spark.read.format("kafka").options(**topics.reader_options("t", "earliest")).load()
    except Exception as error:
        if "data source: kafka" not in str(error):
            pytest.skip("the connector is installed")
    for action in (lambda: topics.read(spark, "t"), lambda: topics.stream(spark, "t")):
        with pytest.raises(RuntimeError, match="spark-sql-kafka"):
            action()
    rows = spark.createDataFrame([("t", "k", "v")], "topic STRING, key STRING, value STRING")
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        topics.publish(rows)


# --- settings


def test_properties_text():
    text = "stray.line\n# note\n! note\na=1\na = 2\nmessage={\"x\":\"y=z\"} \nlong=one \\\n  two\n"
    assert parse_properties(text) == {"stray.line": "", "a": "2", "message": '{"x":"y=z"} ', "long": "one two"}


def test_configs_from_properties():
    properties = {
        "outputDirectory": "/data/out",
        "file.stream.input.path": "/data/in/*",
        "micro.batch.interval": "10",
        "checkpointDirectory": "/data/cp",
        "topic.name": "t1,t2,t1",
        "output.formats": "json,orc",
        "unknown": "x",
    }
    batch = from_properties(LogBatchConfig, properties)
    assert (batch.input_path, batch.date_pattern, batch.on_error) == ("/data/in/*", "yyyy-MM-dd kk:mm:ss", "fail")
    assert from_properties(LogStreamConfig, properties).interval == 10
    assert from_properties(ProfileStreamConfig, properties).formats == ("json", "orc")
    assert from_properties(TopicConfig, properties).topics == ("t1", "t2")
    assert from_properties(TopicConfig, {}).starting == "earliest"


def test_missing_property_is_named():
    with pytest.raises(ValueError, match="outputDirectory"):
        from_properties(LogBatchConfig, {"file.stream.input.path": "/in"})


def test_scratch_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(f"{root}/x-")
    assert first != second
