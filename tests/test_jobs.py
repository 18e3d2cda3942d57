from __future__ import annotations

import dataclasses
import itertools
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.__main__ import JOBS, main
from tidemark.config import LogBatchConfig, LogStreamConfig, ProfileStreamConfig
from tidemark.functions import infer_json_schema
from tidemark.operators import avro_available, create_external_table
from tidemark.plans.jobs import (
    batch_logs,
    batch_logs_keyed,
    parse_profiles,
    profile_table,
    show_profiles,
    stream_logs,
    stream_profiles,
    stream_profiles_once,
    write_profile_batch,
)
from tidemark.schemas import TOPIC_RECORD
from tidemark.sources import RecordFiles, as_records
from tidemark.streaming import each_batch, offset_ranges, partition_report, pass_through, run
from tidemark.streaming.columns import columns_so_far

HEADER = "application,module,message,date,response_time"


def message(user, updated="2020-03-30 14:15:16.000", **more):
    given = {"user_fname": "f", "user_lname": "l", "user_id": user, "updated_at": updated}
    return json.dumps({**given, "modified_fields": [{"address": "new value"}], **more})


OFFSETS = itertools.count()


def send(spark, topics, *messages):
    """Add messages after those sent before, in partition 0."""
    rows = spark.createDataFrame([("user.id", text, next(OFFSETS)) for text in messages], "k STRING, v STRING, o BIGINT")
    topics.publish(as_records(rows, "updates", "k", F.col("v"), partition=F.lit(0), offset=F.col("o")))


@pytest.fixture
def topics(spark, out):
    return RecordFiles(f"{out}/topics").create(spark)


@pytest.fixture
def config(out):
    return ProfileStreamConfig(output=f"{out}/Output", checkpoint=f"{out}/checkpoint", formats=("json", "orc"))


def sink(spark, config, fmt, columns="user_id STRING, datepart STRING"):
    names = [column.split()[0] for column in columns.split(", ")]
    rows = spark.read.schema(columns).format(fmt).load(f"{config.output}-{fmt.upper()}").select(names)
    return sorted(tuple(row) for row in rows.collect())


# --- batch logs


@pytest.fixture
def log_config(out):
    Path(out, "in").mkdir(parents=True)
    lines = [
        HEADER,
        "web,ModuleA,one,2020-03-27 05:05:05,10",
        "web,ModuleB,two,2020-03-27 24:05:05,",
        "app,ModuleA,three,2020-03-28 00:05:05,13",
    ]
    Path(out, "in", "logs.csv").write_text("\n".join(lines) + "\n")
    return LogBatchConfig(input_path=f"{out}/in", output=f"{out}/Output")


def test_batch_logs(spark, log_config):
    results = batch_logs(spark, log_config)
    assert sorted(row["message"] for row in results["module"].collect()) == ["one", "three"]
    assert results["average"].first()["avg_response_time"] == 11.5
    back = spark.read.schema("message STRING, datepart STRING").orc(f"{log_config.output}-FB-ORC")
    assert sorted(tuple(row) for row in back.collect()) == [
        ("one", "2020-03-27"),
        ("three", "2020-03-28"),
        ("two", "2020-03-27"),
    ]
    assert spark.sql("SELECT count(*) FROM app_logs WHERE module = 'ModuleA'").first()[0] == 2


def with_bad_date(config, **given):
    Path(config.input_path, "bad.csv").write_text(f"{HEADER}\nweb,ModuleA,bad,27.03.2020,1\n")
    return LogBatchConfig(input_path=config.input_path, output=config.output, **given)


def test_batch_logs_stop_at_a_bad_date(spark, log_config):
    with pytest.raises(Exception, match="not a date of pattern"):
        batch_logs(spark, with_bad_date(log_config))


def test_batch_logs_set_bad_dates_aside(spark, log_config):
    config = with_bad_date(log_config, on_error="quarantine", infer_schema=False)
    batch_logs(spark, config)
    assert spark.read.schema("message STRING").orc(f"{config.output}-FB-ORC").count() == 3
    assert [row["message"] for row in spark.read.orc(f"{config.output}-FB-BAD").collect()] == ["bad"]


@pytest.mark.parametrize("infer", [True, False])
def test_batch_lines_that_do_not_fit(spark, log_config, infer):
    """Too few and too many fields; with a declared schema also a number that is none."""
    bad = ["web,short", "web,ModuleA,long,2020-03-27 05:05:05,1,2"] + ([] if infer else ["web,ModuleA,x,2020-03-27 05:05:05,12ms"])
    Path(log_config.input_path, "bad.csv").write_text("\n".join([HEADER, *bad]) + "\n")
    config = dataclasses.replace(log_config, infer_schema=infer, date_pattern="yyyy-MM-dd kk:mm:ss")
    with pytest.raises(Exception, match="not a log line"):
        batch_logs(spark, config)
    output = f"{config.output}2"
    keyed = batch_logs_keyed(spark, dataclasses.replace(config, output=output, on_error="quarantine", row_key="content"))
    assert keyed["enriched"].columns == [*HEADER.split(","), "datepart"]
    assert keyed["module"].columns == HEADER.split(",")
    assert keyed["keyed"].count() == 3
    assert spark.read.orc(f"{output}-FB-ORC").count() == 3
    assert sorted(row["_corrupt_record"] for row in spark.read.orc(f"{output}-FB-BAD").collect()) == sorted(bad)


def test_nothing_is_set_aside_without_bad_dates(spark, log_config):
    config = LogBatchConfig(input_path=log_config.input_path, output=log_config.output, on_error="quarantine")
    batch_logs(spark, config)
    assert not Path(f"{config.output}-FB-BAD").exists()


def test_unknown_error_mode(spark, log_config):
    with pytest.raises(ValueError, match="quarantine"):
        batch_logs(spark, LogBatchConfig(input_path=log_config.input_path, output=log_config.output, on_error="skip"))


def test_batch_logs_keyed(spark, log_config):
    for _ in range(2):
        keyed = batch_logs_keyed(spark, log_config)["keyed"]
    assert keyed.columns == ["key", "application", "module", "message"]
    assert sorted(row["message"] for row in keyed.collect()) == ["one", "three", "two"]
    assert len({row["key"] for row in keyed.collect()}) == 3


# --- log stream


def test_stream_logs(spark, out):
    Path(out, "in").mkdir(parents=True)
    config = LogStreamConfig(input_path=f"{out}/in", output=f"{out}/Output", checkpoint=f"{out}/checkpoint", header=True)
    for day in ("27", "28"):
        Path(out, "in", f"{day}.csv").write_text(f"{HEADER}\nweb,A,x{day},2020-03-{day}T24:00:00,5\n")
        run(stream_logs(spark, config))
    back = spark.read.schema("message STRING, response_time BIGINT, datepart STRING").orc(f"{out}/Output-FS-ORC")
    assert sorted(tuple(row) for row in back.collect()) == [("x27", 5, "2020-03-27"), ("x28", 5, "2020-03-28")]


# --- profile streams


@pytest.mark.parametrize("rebalance", [True, False])
def test_a_batch_of_many_files_writes_few(spark, out, rebalance):
    Path(out, "in").mkdir(parents=True)
    for i in range(8):
        Path(out, "in", f"{i}.csv").write_text("".join(f"web,A,{i},2020-03-2{day}T00:00:00,5\n" for day in range(4)))
    given = {"input_path": f"{out}/in", "output": f"{out}/Output", "checkpoint": f"{out}/checkpoint"}
    run(stream_logs(spark, LogStreamConfig(**given, rebalance=rebalance)))
    files = list(Path(f"{out}/Output-FS-ORC").glob("datepart=*/*.orc"))
    assert (len(files) == 4) if rebalance else (len(files) > 4)
    assert spark.read.schema("message STRING").orc(f"{out}/Output-FS-ORC").count() == 32


def test_bad_log_lines_are_kept_without_a_date(spark, out):
    Path(out, "in").mkdir(parents=True)
    Path(out, "in", "a.csv").write_text("web,A,good,2020-03-27T00:00:00,5\nweb,A,bad,27.3.2020,5\n")
    given = {"input_path": f"{out}/in", "output": f"{out}/Output", "checkpoint": f"{out}/checkpoint"}
    with pytest.raises(Exception, match="not a date of pattern"):
        run(stream_logs(spark, LogStreamConfig(**{**given, "checkpoint": f"{out}/other"})))
    run(stream_logs(spark, LogStreamConfig(**given, on_error="quarantine")))
    back = spark.read.schema("message STRING, datepart STRING").orc(f"{out}/Output-FS-ORC")
    assert {tuple(row) for row in back.collect()} == {("good", "2020-03-27"), ("bad", None)}


def test_lines_that_do_not_fit_are_kept_whole(spark, out):
    lines = ["web,A,good,2020-03-27T00:00:00,5", "web,A,bad,2020-03-27T00:00:00,12ms", "web,A", "web,A,x,2020-03-27T00:00:00,5,6"]
    Path(out, "in").mkdir(parents=True)
    Path(out, "in", "a.csv").write_text("\n".join(lines) + "\n")
    given = {"input_path": f"{out}/in", "output": f"{out}/Output"}
    with pytest.raises(Exception, match="not a log line"):
        run(stream_logs(spark, LogStreamConfig(**given, checkpoint=f"{out}/first")))
    run(stream_logs(spark, LogStreamConfig(**given, checkpoint=f"{out}/checkpoint", on_error="quarantine")))
    back = spark.read.schema("_corrupt_record STRING, datepart STRING").orc(f"{out}/Output-FS-ORC")
    assert {tuple(row) for row in back.collect()} == {(None, "2020-03-27"), *((line, None) for line in lines[1:])}
    Path(out, "in", "b.csv").write_text(lines[0] + "\n")
    with pytest.raises(ValueError, match="another checkpoint"):
        stream_logs(spark, LogStreamConfig(**given, checkpoint=f"{out}/third", on_error="quarantine"))


def test_two_streams_share_an_output(spark, topics, config, out):
    send(spark, topics, message("a"))
    run(stream_profiles_once(topics.stream(spark, "updates"), config))
    send(spark, topics, message("b"))
    other = dataclasses.replace(config, checkpoint=f"{out}/other")
    for _ in range(2):
        run(stream_profiles_once(topics.stream(spark, "updates"), other))
    assert sorted(sink(spark, config, "json")) == [("a", "2020-03-30"), ("a", "2020-03-30"), ("b", "2020-03-30")]
    assert sorted(row["user_id"] for row in profile_table(config).scan(spark).collect()) == ["a", "b"]


def test_a_hot_date_is_split_inside_the_fan_out(spark, topics, config):
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    send(spark, topics, *[message(f"user-{i}-{i * 7919 % 100003}") for i in range(4000)])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        run(stream_profiles_once(topics.stream(spark, "updates"), config))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(list(Path(f"{config.output}-ORC").glob("batch=*/datepart=2020-03-30/*.orc"))) > 1


def test_golden_message(spark, topics, config):
    send(spark, topics, message("ada.king", user_fname="ada", user_lname="king") + " ")
    run(stream_profiles(topics.stream(spark, "updates"), config))
    for fmt in ("json", "orc"):
        assert sink(spark, config, fmt) == [("ada.king", "2020-03-30")]
    assert [tuple(row) for row in profile_table(config).scan(spark).collect()] == [("ada.king", "ada", "king")]
    assert spark.read.parquet(f"{config.output}-AVERAGE").first()["avg_response_time"] == 0.0
    assert spark.read.text(f"{config.output}-TEXT").first()["value"].startswith('{"user_fname": "ada"')


def test_stream_goes_on_after_a_restart(spark, topics, config):
    for batch, user in enumerate(["a", "b", "a"]):
        send(spark, topics, message(user, f"2020-03-0{batch + 1} 00:00:00.000", user_fname=f"f{batch}"))
        run(stream_profiles(topics.stream(spark, "updates"), config))
    assert sink(spark, config, "orc") == [("a", "2020-03-01"), ("a", "2020-03-03"), ("b", "2020-03-02")]
    assert sorted(tuple(row) for row in profile_table(config).scan(spark).collect()) == [
        ("a", "f2", "l"),
        ("b", "f1", "l"),
    ]
    assert len(list(Path(f"{config.output}-TEXT").glob("batch=*"))) == 3


def test_out_of_order_update_does_not_win(spark, topics, config):
    send(spark, topics, message("u", "2020-03-30 14:15:16.000", user_fname="new"))
    run(stream_profiles(topics.stream(spark, "updates"), config))
    send(spark, topics, message("u", "2020-03-30 14:15:15.999", user_fname="old"))
    run(stream_profiles(topics.stream(spark, "updates"), config))
    assert profile_table(config).scan(spark).first()["user_fname"] == "new"


@pytest.mark.parametrize("bad", ["{broken", '{"user_id":"u"}', '{"user_id":"u","updated_at":"yesterday"}'])
def test_bad_message_stops_the_stream(spark, topics, config, bad):
    send(spark, topics, message("u"), bad)
    with pytest.raises(Exception, match="not a date of pattern"):
        run(stream_profiles(topics.stream(spark, "updates"), config))


@pytest.mark.parametrize("start", [stream_profiles, stream_profiles_once])
def test_bad_messages_are_set_aside(spark, topics, config, start):
    lenient = ProfileStreamConfig(
        output=config.output, checkpoint=config.checkpoint, formats=("json",), on_error="quarantine"
    )
    no_user = json.dumps({"updated_at": "2020-03-30 14:15:16.000"})
    send(spark, topics, message("u"), "{broken", no_user)
    run(start(topics.stream(spark, "updates"), lenient))
    assert sink(spark, lenient, "json") == [("u", "2020-03-30")]
    assert sorted(row["value"] for row in spark.read.text(f"{config.output}-BAD").select("value").collect()) == sorted(
        ["{broken", no_user]
    )
    assert profile_table(lenient).scan(spark).count() == 1


SINKS = ("positions", "average", "json", "orc", "keyed")


@pytest.mark.parametrize("failures", [1, 2])
def test_replayed_batches_leave_no_duplicates(spark, topics, config, failures):
    """The stream fails after its sinks wrote, on each of the first runs; then it finishes."""
    for user in ("a", "b"):
        send(spark, topics, message(user), message(f"{user}2"))
    records = topics.stream(spark, "updates", batch_limit=1)
    ids = []

    def fail_late(batch, batch_id):
        ids.append(batch_id)
        write_profile_batch(batch, batch_id, config, replay_safe=True, inferred=True)
        raise RuntimeError("late")

    for _ in range(failures):
        with pytest.raises(Exception, match="late"):
            run(each_batch(records, fail_late, config.checkpoint))
    assert len(set(ids)) == 1
    for _ in range(2):
        run(stream_profiles_once(records, config))
    for fmt in ("json", "orc"):
        assert [user for user, _ in sink(spark, config, fmt)] == ["a", "a2", "b", "b2"]
    assert profile_table(config).scan(spark).count() == 4
    reports = spark.read.json(f"{config.output}-OFFSETS")
    assert reports.agg(F.sum("records")).first()[0] == 4


def test_a_batch_that_failed_between_sinks_is_completed(spark, topics, config, monkeypatch):
    from tidemark.plans import jobs

    send(spark, topics, message("a"), message("b"))
    original, calls = jobs.write_partitioned, itertools.count()

    def second_call_fails(*arguments, **named):
        if next(calls) == 1:
            raise RuntimeError("lost executor")
        original(*arguments, **named)

    monkeypatch.setattr(jobs, "write_partitioned", second_call_fails)
    records = topics.stream(spark, "updates")
    with pytest.raises(Exception, match="lost executor"):
        run(stream_profiles_once(records, config))
    assert [user for user, _ in sink(spark, config, "json")] == ["a", "b"]
    run(stream_profiles_once(records, config))
    for fmt in ("json", "orc"):
        assert [user for user, _ in sink(spark, config, fmt)] == ["a", "b"]


def test_inferred_batches_may_differ_in_schema(spark, topics, config):
    send(spark, topics, message("a", extra=1, topic="own field"))
    run(stream_profiles_once(topics.stream(spark, "updates"), config))
    send(spark, topics, json.dumps({"user_id": "b", "updated_at": "2020-03-30 14:15:16.000"}))
    run(stream_profiles_once(topics.stream(spark, "updates"), config))
    columns = "user_id STRING, user_lname STRING, extra BIGINT, topic STRING"
    assert sink(spark, config, "json", columns) == [("a", "l", 1, "own field"), ("b", None, None, None)]


def test_later_batches_keep_earlier_columns(spark, topics, config):
    def last_columns(number):
        (path,) = Path(f"{config.output}-ORC").glob(f"batch=*-{number}")
        return dict(spark.read.orc(str(path)).dtypes)

    for texts in ([message("a", x=1, o={"p": True})], [message("b", x=1.5, y="t")], [message("c", o={"q": "r"}), ""]):
        send(spark, topics, *texts)
        run(stream_profiles_once(topics.stream(spark, "updates"), config))
    assert last_columns(0)["x"] == "bigint"
    assert "o" in last_columns(1) and last_columns(1)["x"] == "double"
    last = last_columns(2)
    assert (last["x"], last["y"], last["o"]) == ("double", "string", "struct<p:boolean,q:string>")
    # A batch run again knows what was known before it, not what came later.
    kept = columns_so_far(spark, config.checkpoint, 1, T.StructType([T.StructField("x", T.StringType())]))
    assert kept["x"].dataType == T.StringType() and "y" not in kept.names


def test_a_pinned_schema_keeps_the_columns(spark, topics, config):
    send(spark, topics, message("a", extra=1))
    schema = infer_json_schema(topics.read(spark, "updates"))
    send(spark, topics, message("b", extra="text", other=2))
    run(stream_profiles_once(topics.stream(spark, "updates", batch_limit=1), config, schema=schema))
    rows = spark.read.orc(f"{config.output}-ORC")
    assert dict(rows.dtypes)["extra"] == "bigint"
    assert "other" not in rows.columns
    assert {(row["user_id"], row["extra"]) for row in rows.collect()} == {("a", 1), ("b", None)}


def test_a_blank_record_is_no_message_but_has_a_position(spark, topics, config):
    send(spark, topics, message("a"), "  ", None)
    run(stream_profiles_once(topics.stream(spark, "updates"), config))
    assert sink(spark, config, "orc") == [("a", "2020-03-30")]
    assert spark.read.json(f"{config.output}-OFFSETS").agg(F.sum("records")).first()[0] == 3


def test_external_table_over_replay_safe_output(spark, topics, config):
    for user in ("a", "b"):
        send(spark, topics, message(user))
        run(stream_profiles_once(topics.stream(spark, "updates"), config))
    path, columns = f"{config.output}-ORC", "user_id STRING, updated_at STRING"
    table = create_external_table(spark, "once_test", columns, path, "batch STRING, datepart STRING")
    found = sorted((row["user_id"], int(row["batch"].rsplit("-", 1)[1]), row["datepart"]) for row in table.collect())
    assert found == [("a", 0, "2020-03-30"), ("b", 1, "2020-03-30")]


def test_show_profiles(spark, topics, out):
    send(spark, topics, message("shown"))
    query = run(show_profiles(topics.stream(spark, "updates"), f"{out}/show"))
    assert "ConsoleTable" in query.recentProgress[0]["sink"]["description"]
    assert query.recentProgress[0]["numInputRows"] == 1
    assert parse_profiles(topics.read(spark, "updates")).first()["user_id"] == "shown"


def test_missing_avro_module_is_found_before_the_first_batch(spark, topics, config):
    if avro_available(spark):
        pytest.skip("the Avro module is installed")
    send(spark, topics, message("a"))
    default = ProfileStreamConfig(output=config.output, checkpoint=config.checkpoint)
    with pytest.raises(RuntimeError, match="spark-avro"):
        stream_profiles(topics.stream(spark, "updates"), default)
    assert not list(Path(config.output).parent.glob("Output-*"))


def test_no_batch_without_records(spark, topics, config):
    run(stream_profiles(topics.stream(spark, "updates"), config))
    assert not Path(f"{config.output}-AVERAGE").exists()


# --- positions and copies


def test_offset_ranges(spark):
    rows = spark.createDataFrame([("t", 0, 108), ("t", 1, 5), ("t", 1, 9)], "topic STRING, partition INT, offset BIGINT")
    found = {tuple(row) for row in offset_ranges(rows).collect()}
    assert found == {("t", 0, 108, 109, 1), ("t", 1, 5, 10, 2)}
    by_task = partition_report(rows.repartition(2)).collect()
    assert sum(row["records"] for row in by_task) == 3


def test_pass_through_is_the_identity_and_takes_a_map(spark, topics, out):
    send(spark, topics, "one", "two")
    records = topics.stream(spark, "updates")
    same, mapped = RecordFiles(f"{out}/same"), RecordFiles(f"{out}/mapped")
    for _ in range(2):
        run(pass_through(records, same, "Sink", f"{out}/c1"))
    run(pass_through(records, mapped, "Sink", f"{out}/c2", key=F.lit("k"), value=F.upper("value")))
    copied = same.read(spark, "Sink")
    assert copied.columns == TOPIC_RECORD.names
    assert copied.select("key", "value", "offset").exceptAll(
        topics.read(spark, "updates").select("key", "value", "offset")
    ).isEmpty()
    assert copied.count() == 2
    assert sorted((row["key"], row["value"]) for row in mapped.read(spark, "Sink").collect()) == [("k", "ONE"), ("k", "TWO")]


def test_a_query_with_an_interval_runs_until_stopped(spark, topics, out):
    query = pass_through(topics.stream(spark, "updates"), RecordFiles(f"{out}/sink"), "Sink", f"{out}/c", interval=1)
    assert not run(query, timeout=2).isActive


# --- command line


def properties(out, **more):
    path = Path(out, "job.properties")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{key}={value}\n" for key, value in more.items()))
    return str(path)


def test_command_line_batch(spark, log_config, out, capsys):
    given = {"file.stream.input.path": log_config.input_path, "outputDirectory": log_config.output}
    main(["file-batch-keyed", properties(out, **given)])
    assert "avg_response_time" in capsys.readouterr().out
    assert Path(f"{log_config.output}-KEYED/log_agg").is_dir()


def test_command_line_produce(spark, out):
    given = {"topic.directory": f"{out}/topics", "topic.name": "updates", "topic.key": "user.id", "message": message("cli")}
    main(["produce", properties(out, **given)])
    row = RecordFiles(f"{out}/topics").read(spark, "updates").first()
    assert (row["key"], row["value"]) == ("user.id", message("cli"))


def test_command_line_streams(spark, out, config, monkeypatch):
    """Each streaming command is started as configured and drained instead of awaited."""
    from tidemark import __main__ as commands

    def drain(query, timeout=None):
        query.processAllAvailable()
        query.stop()

    monkeypatch.setattr(commands, "run", drain)
    given = {
        "topic.directory": f"{out}/topics",
        "topic.name": "updates",
        "source.topic": "updates",
        "topic.key": "user.id",
        "message": message("cli"),
        "outputDirectory": config.output,
        "output.formats": "json",
        "micro.batch.interval": "1",
    }
    main(["produce", properties(out, **given)])
    for job in ("profile-stream", "profile-show", "topic-copy", "consume"):
        main([job, properties(out, **given, checkpointDirectory=f"{out}/checkpoint-{job}")])
    once = {**given, "outputDirectory": f"{out}/Once", "checkpointDirectory": f"{out}/checkpoint-once"}
    main(["profile-stream-once", properties(out, **once)])
    assert sink(spark, config, "json") == [("cli", "2020-03-30")]
    assert Path(f"{out}/Once-OFFSETS").is_dir()
    assert RecordFiles(f"{out}/topics-sink").read(spark, "SinkTopic").count() == 1
    Path(out, "in").mkdir()
    Path(out, "in", "a.csv").write_text("web,A,x,2020-03-27T05:05:05,5\n")
    logs = {"file.stream.input.path": f"{out}/in", "outputDirectory": f"{out}/Logs", "checkpointDirectory": f"{out}/cl"}
    main(["file-stream", properties(out, **logs)])
    assert Path(f"{out}/Logs-FS-ORC/datepart=2020-03-27").is_dir()


def test_every_command_is_covered():
    assert JOBS.keys() == {
        "file-batch",
        "file-batch-keyed",
        "file-stream",
        "profile-stream",
        "profile-stream-once",
        "profile-show",
        "topic-copy",
        "produce",
        "consume",
    }
