from __future__ import annotations

import itertools
import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import (
    LOG_AGG_CATALOG,
    USER_PROFILE_CATALOG,
    Catalog,
    KeyedTable,
    avro_available,
    content_key,
    create_external_table,
    dense_key,
    fan_out,
    merge_into,
    preview,
    run_key,
    write_avro,
    write_partitioned,
    write_registered,
    write_text,
)

PROFILE = Catalog.parse(USER_PROFILE_CATALOG)
ORDER = (("updated_at", "string"), ("partition", "int"), ("offset", "long"))
INPUT = "user_id STRING, user_fname STRING, user_lname STRING, updated_at STRING, partition INT, offset BIGINT"


def profiles(spark, *rows):
    return spark.createDataFrame(list(rows), INPUT)


def contents(spark, table):
    return sorted(tuple(row) for row in table.scan(spark).collect())


# --- catalogs


def test_catalogs(spark):
    assert (PROFILE.name, PROFILE.key) == ("user_profile", "user_id")
    log = Catalog.parse(LOG_AGG_CATALOG)
    assert log.schema.simpleString() == "struct<key:bigint,application:string,module:string,message:string>"
    assert Catalog.parse(LOG_AGG_CATALOG, family_prefix=True).stored == ["key", "cf_application", "cf_module", "cf_message"]


def test_catalog_without_its_key_column():
    with pytest.raises(ValueError, match="rowkey"):
        Catalog.parse('{"table": {"name": "t"}, "rowkey": "k", "columns": {"a": {"cf": "c", "col": "a", "type": "int"}}}')


def test_catalog_maps_and_casts(spark):
    text = (
        '{"table": {"name": "t"}, "rowkey": "id", "columns": {"n": {"cf": "rowkey", "col": "id", "type": "long"},'
        '"s": {"cf": "c", "col": "text", "type": "string"}}}'
    )
    rows = Catalog.parse(text).project(spark.createDataFrame([("7", 8)], "n STRING, s INT"))
    assert rows.dtypes == [("id", "bigint"), ("text", "string")]
    assert rows.first() == (7, "8")


# --- keyed tables


def test_absent_table_is_created_once(spark, out):
    table = KeyedTable(out, PROFILE, ORDER).create(spark)
    assert contents(spark, table) == []
    assert table.scan(spark).columns == ["user_id", "user_fname", "user_lname"]
    table.upsert(profiles(spark, ("u", "a", "b", "2020", 0, 1)), 0)
    table.create(spark)
    assert contents(spark, table) == [("u", "a", "b")]


def test_newest_row_wins_within_and_across_batches(spark, out):
    table = KeyedTable(out, PROFILE, ORDER)
    table.upsert(
        profiles(
            spark,
            ("u", "time", "2", "2020-03-02", 0, 1),
            ("u", "time", "1", "2020-03-01", 0, 9),
            ("v", "partition", "1", "2020-03-01", 1, 1),
            ("v", "partition", "0", "2020-03-01", 0, 9),
            ("w", "offset", "5", "2020-03-01", 0, 5),
            ("w", "offset", "4", "2020-03-01", 0, 4),
            ("x", "no time", "-", None, 0, 9),
            ("x", "some time", "-", "2019", 0, 1),
        ),
        0,
    )
    table.upsert(profiles(spark, ("u", "late", "1", "2020-03-01", 0, 99), ("v", "new", "-", "2020-03-05", 0, 10)), 1)
    assert contents(spark, table) == [
        ("u", "time", "2"),
        ("v", "new", "-"),
        ("w", "offset", "5"),
        ("x", "some time", "-"),
    ]


UPDATES = st.lists(
    st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.integers(0, 1), st.integers(0, 50)),
    min_size=1,
    max_size=12,
    unique_by=lambda update: update[2:],
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(UPDATES, st.lists(st.integers(0, 2), min_size=3, max_size=6))
def test_any_replay_gives_the_same_table(spark, tmp_path_factory, updates, replays):
    """Batches added in any order and any number of times equal one pass over all updates."""
    rows = [(user, f"f{time}", f"l{offset}", f"{time}", part, offset) for user, time, part, offset in updates]
    batches = [rows[i::3] for i in range(3)]
    table = KeyedTable(str(tmp_path_factory.mktemp("keyed") / "t"), PROFILE, ORDER)
    for batch_id in [*replays, 0, 1, 2]:
        table.upsert(profiles(spark, *batches[batch_id]), batch_id)
    expected = {}
    for row in sorted(rows, key=lambda row: row[3:]):
        expected[row[0]] = row[:3]
    assert contents(spark, table) == sorted(expected.values())


def test_arrival_order_without_ordering_columns(spark, out):
    table = KeyedTable(f"{out}/t", PROFILE)
    first, second = profiles(spark, ("u", "1", "", None, 0, 0)), profiles(spark, ("u", "2", "", None, 0, 0))
    table.upsert(first, 0)
    table.upsert(second, 1)
    table.upsert(first, 0)
    assert contents(spark, table) == [("u", "2", "")]
    table = table.compact(spark, f"{out}/compacted")
    table.upsert(first, 0)
    assert contents(spark, table) == [("u", "2", "")]


def test_compaction_keeps_what_any_order_of_puts_and_replays_gives(spark, out):
    table = KeyedTable(f"{out}/0", PROFILE, ORDER)
    early, late = profiles(spark, ("u", "old", "", "2020", 0, 1)), profiles(spark, ("u", "new", "", "2021", 0, 2))
    table.upsert(late, 0, "s1")
    table.upsert(early, 0, "s2")
    for n in range(1, 4):
        table = table.compact(spark, f"{out}/{n}")
        assert {path.name for path in Path(out, str(n)).iterdir()} == {"put=compacted"}
        table.upsert(early, 0, "s2")  # a replay of what the fresh table holds
        table.upsert(profiles(spark, ("v", "more", "", "2020", 0, 3)), 1, "s2")
        assert contents(spark, table) == [("u", "new", ""), ("v", "more", "")]
    assert contents(spark, KeyedTable(f"{out}/0", PROFILE, ORDER)) == [("u", "new", "")]
    with pytest.raises(ValueError, match="fresh table"):
        table.compact(spark, f"{out}/1")


def test_compactions_at_once_lose_no_row(spark, out, monkeypatch):
    """A second compaction, with a newer put, begins and ends while the first one is at work."""
    table = KeyedTable(f"{out}/t", PROFILE, ORDER)
    table.upsert(profiles(spark, ("a", "1", "", "2020", 0, 1)), 0)
    read, made = KeyedTable._rows, []

    def meanwhile(self, session):
        rows = read(self, session)
        if not made:
            made.append(None)
            table.upsert(profiles(spark, ("b", "1", "", "2020", 0, 2)), 1)
            made[0] = table.compact(spark, f"{out}/second")
        return rows

    monkeypatch.setattr(KeyedTable, "_rows", meanwhile)
    first = table.compact(spark, f"{out}/first")
    both = [("a", "1", ""), ("b", "1", "")]
    assert contents(spark, table) == contents(spark, made[0]) == both
    assert contents(spark, first)[0] == both[0]
    first.upsert(profiles(spark, ("b", "1", "", "2020", 0, 2)), 1)  # the stream goes on with the table it is pointed to
    assert contents(spark, first) == both


def test_unfinished_puts_are_not_read(spark, out):
    table = KeyedTable(out, PROFILE, ORDER)
    table.upsert(profiles(spark, ("u", "a", "", "2020", 0, 1)), 0)
    written = next(Path(out, "put=0").glob("*.parquet"))
    unfinished = Path(out, "put=1", "_temporary", "0")
    unfinished.mkdir(parents=True)
    (unfinished / "part-0.parquet").write_bytes(written.read_bytes()[:-9])
    assert contents(spark, table) == [("u", "a", "")]


def test_the_same_put_takes_its_earlier_rows_away(spark, out):
    table = KeyedTable(out, PROFILE)
    for name in "12":
        table.upsert(profiles(spark, ("u" + name, name, "", None, 0, 0)), 0, "run")
        assert contents(spark, table) == [("u" + name, name, "")]


def test_lookups_skip_row_groups(spark, out):
    rows = spark.range(200_000).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("user_id"), F.lit("f").alias("user_fname"), F.sha2(F.col("id").cast("string"), 256).alias("user_lname"))
    table = KeyedTable(f"{out}/t", PROFILE, group_bytes=1 << 20)
    table.upsert(rows, 0)
    table = table.compact(spark, f"{out}/ranges")
    files = list(Path(out, "ranges", "put=compacted").glob("*.parquet"))
    groups = [pq.ParquetFile(f).metadata.row_group(g) for f in files for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    key = groups[0].to_dict()["columns"][0]
    assert key["path_in_schema"] == "user_id"
    spans = sorted((g.column(0).statistics.min, g.column(0).statistics.max) for g in groups)
    assert len(spans) > 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert contents(spark, KeyedTable(f"{out}/ranges", PROFILE)) == contents(spark, KeyedTable(f"{out}/t", PROFILE))
    one = table.get(spark, "000123456")
    assert [r["user_id"] for r in one.collect()] == ["000123456"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,000123456)" in plan
    assert plan.index("Aggregate") < plan.index("PushedFilters")  # the scan is below: it filters before rows are told
    assert scanned(one) < 200_000 / len(spans) * 2
    few = table.between(spark, "000000010", "000000019")
    assert few.count() == 10
    assert scanned(few) < 200_000 / len(spans) * 2
    named = table.lookup(spark.createDataFrame([("000000007",), ("000000007",), ("none",), (None,)], "k STRING"))
    assert [r["user_id"] for r in named.collect()] == ["000000007"]


def scanned(df):
    """The rows that the scans of a query put out."""
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_format_without_row_level_writes_takes_no_merge(spark):
    name = f"merged_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (k STRING, t INT, v STRING) USING parquet")
    rows = spark.createDataFrame([("a", 1, "x")], "k STRING, t INT, v STRING")
    with pytest.raises(RuntimeError, match="no row-level writes"):
        merge_into(rows, name, "k", ["t"])
    assert spark.table(name).count() == 0


def test_only_partitions_of_a_write_are_registered(spark, out):
    name, columns = f"registered_{uuid.uuid4().hex}", "v INT"
    rows = lambda *days: spark.createDataFrame([(i, day) for i, day in enumerate(days)], "v INT, datepart STRING")
    assert write_registered(rows("2024-01-01", "2024-01-01", None), name, columns, out) == ["2024-01-01", "__HIVE_DEFAULT_PARTITION__"]
    rows("unseen").write.partitionBy("datepart").mode("append").orc(out)  # by someone else
    assert write_registered(rows("2024-01-01", "it's 1/2"), name, columns, out) == ["2024-01-01", "it's 1/2"]
    found = [(r["datepart"], r["v"]) for r in spark.table(name).collect()]
    expected = [("2024-01-01", 0), ("2024-01-01", 0), ("2024-01-01", 1), ("it's 1/2", 1), (None, 2)]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert len(spark.sql(f"SHOW PARTITIONS {name}").collect()) == 3


def test_dense_keys(spark):
    rows = spark.range(0, 1000, 1, 7).where("id % 7 <> 3").withColumns({"row": F.lit("r"), "part": F.lit(1), "place": F.lit(2), "KEY": F.lit(0)})
    found = dense_key(rows)
    assert found.columns == ["id", "row", "part", "place", "key"]
    taken = found.collect()
    assert sorted(r["key"] for r in taken) == list(range(1, rows.count() + 1))
    assert sorted(r["id"] for r in taken) == sorted(r["id"] for r in rows.collect())
    assert dense_key(rows.limit(0)).count() == 0


def test_key_order(spark, out):
    table = KeyedTable(out, PROFILE)
    table.upsert(profiles(spark, *[(user, "", "", None, 0, 0) for user in "dbca"]), 0)
    assert [row["user_id"] for row in table.scan(spark, ordered=True).collect()] == list("abcd")


def test_scan_reads_only_what_is_asked_for(spark, out):
    table = KeyedTable(out, PROFILE, ORDER)
    table.upsert(profiles(spark, ("u", "a", "b", "2020", 0, 1), ("v", "c", "d", "2020", 0, 2)), 0)
    rows = table.scan(spark, ["user_lname"]).where("user_lname = 'd'")
    assert rows.columns == ["user_lname"]
    assert [tuple(row) for row in rows.collect()] == [("d",)]
    assert "user_fname" not in rows._jdf.queryExecution().executedPlan().toString()
    one = table.scan(spark).where("user_id = 'u'")
    assert [row["user_fname"] for row in one.collect()] == ["a"]
    assert "EqualTo(user_id,u)" in one._jdf.queryExecution().executedPlan().toString()


def test_null_key_is_an_error(spark, out):
    with pytest.raises(Exception, match="null row key for user_profile"):
        KeyedTable(out, PROFILE).upsert(profiles(spark, (None, "a", "b", None, 0, 0)), 0)


def test_negative_batch_is_refused(spark, out):
    with pytest.raises(ValueError, match="start at 0"):
        KeyedTable(out, PROFILE).upsert(profiles(spark), -1)


def test_hot_key_is_reduced_before_the_shuffle(spark, out):
    table = KeyedTable(out, PROFILE, ORDER)
    table.upsert(profiles(spark, ("u", "a", "b", "2020", 0, 1)), 0)
    plan = table.scan(spark)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert plan.count("Exchange") == 1


def test_run_keys_are_unique_and_repeat(spark):
    def keys():
        return [row["key"] for row in run_key(spark.range(0, 100, 1, 4)).collect()]

    assert len(set(keys())) == 100
    assert keys() == keys()


def test_content_keys(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x STRING, y STRING")
    keys = [row["key"] for row in content_key(rows, ["x", "y"]).collect()]
    assert keys[0] == keys[2] != keys[1]


# --- files


def dated(spark, rows=2000, hot="2020-01-01"):
    day = F.when(F.col("id") % 3 > 0, hot).otherwise(F.concat(F.lit("2020-02-"), F.lpad(F.col("id") % 28 + 1, 2, "0")))
    return spark.range(0, rows, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), day.alias("datepart"))


@pytest.mark.parametrize("fmt", ["orc", "json"])
@pytest.mark.parametrize("rebalance", [True, False])
def test_partitioned_write_appends(spark, out, fmt, rebalance):
    rows = dated(spark, 100)
    write_partitioned(rows, out, fmt, rebalance=rebalance)
    write_partitioned(rows, out, fmt, rebalance=rebalance)
    assert Path(out, "datepart=2020-01-01").is_dir()
    back = spark.read.schema(rows.schema).format(fmt).load(out)
    assert back.count() == 200
    assert back.exceptAll(rows.union(rows)).isEmpty()


def test_rebalance_shares_files_and_splits_a_hot_date(spark, out):
    """Two thirds of the rows have one date. That date gets several files, the others one each,
    but for those few that hash to the same shuffle partition as the hot date."""
    chosen = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB", "spark.sql.shuffle.partitions": "64"}
    before = {key: spark.conf.get(key) for key in chosen}
    for key, value in chosen.items():
        spark.conf.set(key, value)
    try:
        write_partitioned(dated(spark, 6000), out, "orc")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = {day.name: len(list(day.glob("*.orc"))) for day in Path(out).glob("datepart=*")}
    assert files.pop("datepart=2020-01-01") > 3
    assert len(files) == 28
    assert sum(count == 1 for count in files.values()) > 20


def test_text_archive(spark, out):
    rows = spark.createDataFrame([("a",), ("b,c",)], "value STRING").repartition(2)
    write_text(rows, f"{out}/many")
    write_text(rows, f"{out}/one", single_file=True)
    assert len(list(Path(out, "one").glob("part-*"))) == 1
    for kind in ("many", "one"):
        assert sorted(row["value"] for row in spark.read.text(f"{out}/{kind}").collect()) == ["a", "b,c"]


def test_avro(spark, out):
    rows = dated(spark, 10)
    if avro_available(spark):
        write_avro(rows, out, "Record", "space")
        assert spark.read.format("avro").load(out).count() == 10
    else:
        with pytest.raises(RuntimeError, match="spark-avro"):
            write_avro(rows, out)
        pytest.skip("the Avro module is not installed")


def test_external_table_sees_later_partitions(spark, out):
    columns = "id BIGINT, text STRING"
    write_partitioned(dated(spark, 30), out, "orc")
    table = create_external_table(spark, "external_test", columns, out)
    assert (table.count(), dict(table.dtypes)["datepart"]) == (30, "string")
    write_partitioned(dated(spark, 30, hot="2021-05-05"), out, "orc")
    table = create_external_table(spark, "external_test", columns, out)
    assert table.where("datepart = '2021-05-05'").count() == 20


def test_preview(spark, capsys):
    rows = preview(spark.createDataFrame([(1,), (2,), (3,)], "n INT").orderBy("n"))
    assert [row["n"] for row in rows.collect()] == [1, 2]
    printed = capsys.readouterr().out
    assert "n: integer" in printed
    assert "only showing" not in printed


def test_fan_out_computes_the_batch_once(spark):
    computed = spark.sparkContext.accumulator(0)

    def seen(parts):
        for part in parts:
            computed.add(len(part))
            yield part

    batch = spark.range(10).mapInPandas(seen, "id BIGINT")
    counts = []
    fan_out(batch, *itertools.repeat(lambda df: counts.append(df.count()), 3))
    assert counts == [10, 10, 10]
    assert computed.value == 10
    assert not batch.is_cached


def test_fan_out_releases_the_batch_after_a_failure(spark):
    batch = spark.range(10)

    def broken(_):
        raise RuntimeError("sink")

    with pytest.raises(RuntimeError, match="sink"):
        fan_out(batch, broken)
    assert not batch.is_cached
