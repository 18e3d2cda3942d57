"""Nulls, empty and long texts, repeated rows, empty tables and columns with clashing names, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import attention, backoff, common, decontam, langid, licenses, mixing, quality_rules, secrets, simhash, urls

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem ipsum dolor " * 60_000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (None, "orphan text without an id token=abcdefgh", "en", None, 5),
    (None, None, None, None, None),
    (4, LONG, "la", "b", len(LONG)),
    (5, "the quick brown fox jumps over the lazy dog again and again", "en", "b", 10),
]
CLASHING = (
    "key words hash hashes text_ lines size label labels component found rule rules verdict score rank bucket target "
    "source_size copies copy row plan item items n taken dual mean fingerprint component_id held_out quality "
    "_row_key _row _spans _cut number met cut spans order unnamed m low n_high run start nth rows"
).split()


def benchmark(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog again and"), (None, None), (2, "")], "item_id bigint, text string")


def labels(spark):
    return spark.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None), (4, 0)], "doc_id bigint, quality int")


OPERATORS = {
    "backoff": lambda d: backoff.score(d),
    "secrets": lambda d: secrets.scan(d),
    "simhash": lambda d: simhash.near_copies(d),
    "licenses": lambda d: licenses.scan(d),
    "urls": lambda d: urls.judged(d.withColumnsRenamed({"doc_id": "page_id", "text": "url"})),
    "decontam": lambda d: decontam.decontaminate(d, benchmark(d.sparkSession)),
    "langid": lambda d: langid.languages(d),
    "quality_rules": lambda d: quality_rules.quality_filter(d, labels(d.sparkSession)),
    "mixing": lambda d: mixing.mix(d),
    "attention": lambda d: attention.classified(d, labels(d.sparkSession)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_each_row_has_a_result(spark, name):
    plain = spark.createDataFrame(ROWS, SCHEMA)
    found = OPERATORS[name](plain)
    assert found.count() == len(ROWS)
    wider = OPERATORS[name](plain.select("*", *[F.lit("x").alias(c) for c in CLASHING]))
    assert wider.columns == found.columns
    key = lambda r: repr(tuple(r))
    assert sorted(wider.collect(), key=key) == sorted(found.collect(), key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows_give_no_rows(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, sf_dir, name, stage):
    plain = spark.createDataFrame(ROWS, SCHEMA)
    wider = plain.select("*", *[F.lit("x").alias(c) for c in CLASHING], F.create_map(F.lit("k"), F.col("source")).alias("map"))
    found = stage(spark, wider, sf_dir)
    # The mix puts its own size and target in the place of columns with these names.
    kept = [c for c in wider.columns if name != "mixed" or c not in corpus_pipeline.MIX_COLUMNS]
    assert found.columns[: len(kept)] == kept
    assert len(set(found.columns)) == len(found.columns)
    assert 0 < found.count() <= 3 * len(ROWS)
    gone = corpus_pipeline.MIX_COLUMNS if name == "mixed" else ()
    assert {r[c] for r in found.collect() for c in CLASHING if c not in gone} == {"x"}
    assert all(r["map"] == {"k": r["source"]} for r in found.collect())
    assert stage(spark, spark.createDataFrame([], SCHEMA), sf_dir).count() == 0


def test_row_keys(spark):
    rows = [(None, "a"), (1, "a"), (1, "1:a"), (11, "a"), (1, None), (1, ""), (None, None), (None, "")]
    keys = [r.key for r in spark.createDataFrame(rows, "doc_id bigint, text string").select(common.row_key(F.col("doc_id"), F.col("text")).alias("key")).collect()]
    assert all(len(k) == 16 for k in keys)
    assert keys[4] == keys[5] and keys[6] == keys[7] and len(set(map(bytes, keys))) == 6
