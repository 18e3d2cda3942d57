from __future__ import annotations

import datetime
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import (
    LOG_DATE_PATTERN,
    LOG_STREAM_DATE_PATTERN,
    UPDATE_DATE_PATTERN,
    add_date_part,
    date_part,
    date_part_with,
    expand_my_average,
    infer_json_schema,
    json_field,
    json_value,
    merge_types,
    my_average,
    my_average_sql,
    parse_declared,
    parse_inferred,
    text_list,
)
from tidemark.schemas import PROFILE_UPDATE

GOLDEN = (
    '{"user_fname":"ada", "user_lname":"lovelace", "user_id":"ada.lovelace", '
    '"updated_at":"2020-03-22 14:15:16.000", "modified_fields":[{"address":"new value"}]} '
)


def texts(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value STRING")


# --- dates


def parsed(spark, text, pattern):
    return texts(spark, text).select(date_part("value", pattern, on_error="null")).first()[0]


@pytest.mark.parametrize(
    ("text", "pattern", "expected"),
    [
        ("2020-03-27 05:05:05", LOG_DATE_PATTERN, "2020-03-27"),
        ("2020-03-27 00:05:05", LOG_DATE_PATTERN, "2020-03-27"),
        ("2020-03-27 24:05:05", LOG_DATE_PATTERN, "2020-03-27"),
        ("2020-02-30 05:05:05", LOG_DATE_PATTERN, "2020-02-29"),
        ("2021-02-29 24:05:05", LOG_DATE_PATTERN, "2021-02-28"),
        ("2020-04-31 00:05:05", LOG_DATE_PATTERN, "2020-04-30"),
        ("2020-02-32 05:05:05", LOG_DATE_PATTERN, None),
        ("2020-13-31 05:05:05", LOG_DATE_PATTERN, None),
        ("2020-02-30 25:05:05", LOG_DATE_PATTERN, None),
        ("2020-03-27 5:05:05", LOG_DATE_PATTERN, None),
        ("2020-03-27 05:05:05.1", LOG_DATE_PATTERN, None),
        ("2020-03-27", LOG_DATE_PATTERN, None),
        ("junk", LOG_DATE_PATTERN, None),
        (None, LOG_DATE_PATTERN, None),
        ("2020-03-27T05:05:05", LOG_STREAM_DATE_PATTERN, "2020-03-27"),
        ("2020-02-31T24:05:05", LOG_STREAM_DATE_PATTERN, "2020-02-29"),
        ("2020-03-27 05:05:05", LOG_STREAM_DATE_PATTERN, None),
        ("2020-03-30 14:15:16.000", UPDATE_DATE_PATTERN, "2020-03-30"),
        ("2020-03-30 14:15:16.0", UPDATE_DATE_PATTERN, None),
        ("2020-03-30 24:15:16", "yyyy-MM-dd HH:mm:ss", None),
        ("27 Mar 2020 05:05", "dd MMM yyyy kk:mm", "2020-03-27"),
    ],
)
def test_date_part(spark, text, pattern, expected):
    assert parsed(spark, text, pattern) == expected


@pytest.mark.parametrize("text", ["junk", None])
def test_bad_date_stops_the_job(spark, text):
    rows = add_date_part(texts(spark, text), "value")
    with pytest.raises(Exception, match="not a date of pattern"):
        rows.collect()


def test_date_part_of_inferred_timestamp(spark):
    rows = spark.createDataFrame([(datetime.datetime(2020, 3, 27, 5, 5, 5),)], "date TIMESTAMP")
    assert add_date_part(rows, "date").first()["datepart"] == "2020-03-27"


def test_date_part_rejects_unknown_error_mode():
    with pytest.raises(ValueError, match="on_error"):
        date_part("value", on_error="ignore")


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Kolkata"])
def test_date_part_does_not_depend_on_the_time_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Midnight of this day did not exist in Sao Paulo.
        assert parsed(spark, "2018-11-04 00:00:00", LOG_DATE_PATTERN) == "2018-11-04"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# --- the average


def average(spark, values, kind="DOUBLE"):
    rows = spark.createDataFrame([(value,) for value in values], f"x {kind}")
    by_column = rows.agg(my_average("x").alias("a")).first()["a"]
    by_text = rows.selectExpr(f"{my_average_sql('x')} AS a").first()["a"]
    assert by_column == by_text or (math.isnan(by_column) and math.isnan(by_text))
    return by_column


def test_average_cuts_fractions(spark):
    assert average(spark, [0.9, 1.9, None, -1.9]) == 0.0


def test_average_skips_nulls(spark):
    assert average(spark, [1, None, 2], "INT") == 1.5


def test_average_of_nothing_is_nan(spark):
    assert math.isnan(average(spark, [], "BIGINT"))
    assert math.isnan(average(spark, [None, None], "BIGINT"))


def test_average_skips_what_is_no_number(spark):
    assert average(spark, [float("nan"), 4.0]) == 4.0


@pytest.mark.parametrize("value", [1e30, float("-inf")])
def test_average_of_a_number_past_the_longs_is_an_error(spark, value):
    with pytest.raises(Exception, match="overflow"):
        average(spark, [value, 4.0])


def test_average_of_text(spark):
    assert average(spark, ["12", "13.9", "abc", ""], "STRING") == 12.5


def test_average_overflow_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)overflow"):
        average(spark, [2**63 - 1, 1], "BIGINT")


def test_grouped_average_has_no_row_without_groups(spark):
    rows = spark.createDataFrame([], "k STRING, x BIGINT")
    assert rows.groupBy("k").agg(my_average("x")).collect() == []


def test_average_by_name_in_sql(spark):
    spark.createDataFrame([("a", 1.5), ("a", 4.0), ("b", None)], "k STRING, x DOUBLE").createOrReplaceTempView("xs")
    rows = spark.sql(expand_my_average("SELECT k, myAverage( x + 1 ) AS a FROM xs GROUP BY k")).collect()
    found = {row["k"]: row["a"] for row in rows}
    assert found["a"] == 3.5
    assert math.isnan(found["b"])
    nested = spark.sql(expand_my_average("SELECT myAverage(abs(-(x))) AS a, 'myAverage(x)' AS t FROM xs -- myAverage("))
    assert [tuple(row) for row in nested.collect()] == [(2.5, "myAverage(x)")]
    with pytest.raises(ValueError, match="parenthesis"):
        expand_my_average("SELECT myAverage(abs(x) FROM xs")


def test_average_is_partially_aggregated_without_python(spark):
    rows = spark.range(10).groupBy((F.col("id") % 2).alias("k")).agg(my_average("id"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    assert "Python" not in plan


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), max_size=20))
def test_average_matches_its_definition(spark, values):
    whole = [int(value) for value in values if value is not None]
    found = average(spark, values)
    if whole:
        assert found == pytest.approx(sum(whole) / len(whole))
    else:
        assert math.isnan(found)


# --- JSON


def test_declared_schema_keeps_nested_json_as_text(spark):
    row = parse_declared(texts(spark, GOLDEN), PROFILE_UPDATE).first()
    assert row["user_id"] == "ada.lovelace"
    assert row["modified_fields"] == ['{"address":"new value"}']


def test_declared_schema_over_binary(spark):
    rows = spark.createDataFrame([(bytearray(GOLDEN, "utf-8"),)], "value BINARY")
    assert parse_declared(rows, PROFILE_UPDATE).first()["user_lname"] == "lovelace"


@pytest.mark.parametrize(
    ("text", "user", "fields"),
    [
        ("{not json", None, None),
        ('{"user_id":"a","modified_fields":7}', "a", None),
        ('{"user_id":12}', "12", None),
        ("", None, None),
    ],
)
def test_declared_schema_is_lenient(spark, text, user, fields):
    row = parse_declared(texts(spark, text), PROFILE_UPDATE).first()
    assert (row["user_id"], row["modified_fields"]) == (user, fields)


def test_inferred_schema_of_the_message(spark):
    rows = parse_inferred(texts(spark, GOLDEN))
    assert rows.schema.simpleString() == (
        "struct<modified_fields:array<struct<address:string>>,updated_at:string,"
        "user_fname:string,user_id:string,user_lname:string>"
    )
    assert rows.first()["modified_fields"][0]["address"] == "new value"


DOCUMENTS = st.dictionaries(
    st.sampled_from(["a", "b", "B", "c d", "e`f"]),
    st.recursive(
        st.one_of(
            st.none(),
            st.booleans(),
            st.integers(-(10**20), 10**20),
            st.floats(-1e9, 1e9).map(lambda x: round(x, 3)),
            st.floats(allow_nan=False, allow_infinity=False),
            st.text("xyz", max_size=3),
        ),
        lambda inner: st.one_of(
            st.lists(inner, max_size=2), st.dictionaries(st.sampled_from(["p", "q"]), inner, max_size=2)
        ),
        max_leaves=4,
    ),
    max_size=4,
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(DOCUMENTS, min_size=1, max_size=5))
def test_inferred_schema_equals_the_json_reader(spark, documents):
    """The file reader infers the same schema and values, one JSON document per line."""
    values = [json.dumps(document) for document in documents]
    read = spark.read.json(spark.sparkContext.parallelize(values))
    schema = infer_json_schema(texts(spark, *values))
    assert schema.simpleString() == read.schema.simpleString()
    if schema.fields:
        found = parse_inferred(texts(spark, *values), schema=schema)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, read.collect()))


ODD = [
    '{"a":1,"a":"x"}',
    "{'a':1}",
    '{"a":NaN}',
    '{"a":-Infinity}',
    '{"a":1} trailing',
    '{"a":1}{"b":2}',
    '{"a":007}',
    '{"a":1e400}',
    '{"a":12345678901234567890123456789012345678901234567890}',
    '{"a":0.1234567890123456789012345678901234567890}',
    '{"a":{}}',
    '{"a":[{}]}',
    '{"a":[[]]}',
    '{"OBJECT<":{"DECIMAL(3,0)":1}}',
    "{}",
    "{",
    "null",
    "3",
    '"text"',
    ' \t{"a":true} ',
    '/* note */ {"a":1}',
]


@pytest.mark.parametrize("text", ODD)
@pytest.mark.parametrize("other", ['{"a":1}', '{"a":"s","b":[1]}', None])
def test_odd_text_is_inferred_as_by_the_json_reader(spark, text, other):
    values = [text] if other is None else [text, other]
    read = spark.read.json(spark.sparkContext.parallelize(values))
    schema = infer_json_schema(texts(spark, *values))
    if text in ("null", "{}") and other is None:
        assert not [name for name in schema.names if name != "_corrupt_record"]
    elif text == "null":
        assert [name for name in schema.names if name != "_corrupt_record"] == read.schema.names
    else:
        assert schema.simpleString() == read.schema.simpleString()
        found = parse_inferred(texts(spark, *values), schema=schema)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, read.collect()))


def test_schemas_are_inferred_without_python(spark, monkeypatch):
    """Also with fractions like 2.0 and broken text, for which the JSON reader is asked."""
    plain, fraction, broken = (texts(spark, GOLDEN, *more) for more in (['{"n":1.5}', '{"n":2}'], ['{"n":2.0}'], ["{broken"]))

    def refused(self):
        raise AssertionError("read through Python")

    monkeypatch.setattr(type(plain), "rdd", property(refused))
    assert infer_json_schema(plain).names[-1] == "user_lname"
    assert infer_json_schema(fraction)["n"].dataType == T.DoubleType()
    assert infer_json_schema(broken).names[0] == "_corrupt_record"


def test_inferred_schema_keeps_broken_text(spark):
    rows = parse_inferred(texts(spark, '{"a":1}', "{broken", "[1]", "   "))
    assert rows.columns == ["_corrupt_record", "a"]
    found = {(row["_corrupt_record"], row["a"]) for row in rows.collect()}
    assert found == {(None, 1), ("{broken", None), ("[1]", None)}


def test_inferred_schema_of_nothing(spark):
    assert infer_json_schema(texts(spark)) == T.StructType([])
    assert parse_inferred(texts(spark)).columns == []


def test_pinned_schema_is_used_as_given(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert parse_inferred(texts(spark, '{"a":1}'), schema=schema).first() == (1, None)


def test_json_write_and_schema_free_read(spark):
    rows = spark.createDataFrame([("x", 1)], "s STRING, n INT")
    text = rows.select(json_value().alias("value"))
    assert text.first()["value"] == '{"s":"x","n":1}'
    read = text.select(json_field("value", "$.n", "int"), json_field("value", "$.none"))
    assert read.first() == (1, None)
    assert texts(spark, "{broken").select(json_field("value", "$.n")).first()[0] is None


def test_text_list(spark):
    rows = spark.createDataFrame([("g", 2, "b"), ("g", 1, "c"), ("g", 2, "a"), ("g", 0, None), ("h", 1, None)], "g STRING, t INT, v STRING")
    found = rows.groupBy("g").agg(text_list("v", "t", "|").alias("v"), text_list("v").alias("sorted"))
    assert sorted(map(tuple, found.collect())) == [("g", "c|a|b", "a,b,c"), ("h", "", "")]


def test_date_part_with(spark):
    rows = spark.createDataFrame([("1-2-2024",), (None,), ("x",)], "d STRING")
    parsed = lambda t: datetime.datetime.strptime(t, "%d-%m-%Y") if t != "x" else None
    assert [r[0] for r in rows.select(date_part_with(parsed, "d")).collect()] == ["2024-02-01", None, None]


def test_merged_types_are_those_of_one_batch(spark):
    pairs = [('{"a": 1}', '{"a": 1.5, "b": [1]}'), ('{"a": {"x": 1}}', '{"a": {"y": true}}'), ('{"a": [1]}', '{"a": ["t"]}'), ('{"a": 1}', '{"a": {"x": 1}}'), ('{"a": true}', '{"a": 2}')]
    for pair in pairs:
        one, two = (infer_json_schema(spark.createDataFrame([(text,)], "value STRING")) for text in pair)
        both = infer_json_schema(spark.createDataFrame([(text,) for text in pair], "value STRING"))
        assert merge_types(one, two) == merge_types(two, one) == both
