"""A training corpus from documents: language, near copies, benchmark passages, secrets, source mix.

Each stage takes (spark, docs, sf_dir) and returns documents; the last one returns the mix, each row as often as it is
taken. Rows are written between stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, mixing, secrets, simhash
from tidemark.llm.common import meet_classes, table, written

MIN_LANGUAGE_SCORE = 0.3
MIX_COLUMNS = ("size", "source_size", "target", "copy")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, null texts among them, and those no language fits, go. The languages are learned from docs.
    Repeated rows stay or go together; no rows give no rows; other columns of any name and type come along."""
    found = langid.identify(F.col("text"), langid.network(docs))
    fits = (found["lang_pred"] != langid.UNDETERMINED) & (found["score"] >= MIN_LANGUAGE_SCORE)
    return docs.filter(fits)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: the one with the smallest doc_id, without one only if all lack it, and
    of several the one with the smallest key of id and text. Rows are compared one by one, whatever doc_ids they share;
    repeated rows are copies of each other, and so are rows without words. No rows give no rows; other columns of any name
    and type come along."""
    keyed = docs.select(decontam.document_key().alias("key"), F.monotonically_increasing_id().alias("number"), F.struct("*").alias("row"))
    # Orders rows as above and tells all apart but those that share id and text, which are copies of each other.
    order = F.struct(F.col("row.doc_id").isNull().alias("unnamed"), F.col("row.doc_id").alias("doc_id"), "key")
    groups = simhash.near_copies(keyed.select(order.alias("doc_id"), F.col("row.text").alias("text")), shingle=4, max_bits=4, seed=42)
    firsts = written(groups.filter("doc_id = component_id").select("doc_id.key").distinct(), "pipeline-firsts")
    # Rows move once, to their key; what has a row per document meets them there and is not sent to every task.
    each = keyed.groupBy("key").agg(F.min_by("row", "number").alias("row"))
    return each.join(firsts.hint("merge"), "key").select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, each copy of a repeated row alike; rows without text or words
    stay. No rows give no rows; other columns of any name and type come along."""
    keyed = docs.select(F.struct("*").alias("row"), decontam.document_key().alias("key"))
    texts = keyed.select("key", F.col("row.text").alias("text"))
    found = written(decontam.hits(texts, table(spark, sf_dir, "benchmark")).select("key"), "pipeline-hits")
    return keyed.join(found, "key", "left_anti").select("row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts, each span replaced by its kind in angle brackets; n_chars follows the text. Every row
    stays, repeated ones and those without text too; no rows give no rows; other columns of any name and type come along."""
    return secrets.redacted(docs)


def _counted_off(rows: DataFrame, group: str, amount: Column) -> DataFrame:
    """rows with `before`: the amounts of the rows of their group that have smaller numbers. In runs by their numbers, so that
    a hot group is spread, and the runs by the group's amounts before them."""
    runs = rows.withColumn("amount", amount).withColumn("run", F.floor(F.col("number") / mixing.RUN))
    preceding = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.groupBy(group, "run").agg(F.sum("amount").alias("amounts"))
    earlier = F.sum("amounts").over(preceding(Window.partitionBy(group).orderBy("run")))
    starts = starts.select(group, "run", F.coalesce(earlier, F.lit(0)).alias("start"))
    own = F.sum("amount").over(preceding(Window.partitionBy(group, "run").orderBy("number")))
    return runs.withColumn("own", F.coalesce(own, F.lit(0))).join(starts, [group, "run"]).withColumn("before", F.col("start") + F.col("own"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (copy 1, 2, 3), with its size and its source's size and target. Columns
    of docs that have one of these names give way to them. Repeated rows and rows without an id are taken row by row; rows
    without words never; a null source is one of its own; no rows give no rows."""
    rows = docs.select(F.struct(decontam.document_key().alias("key"), "source").alias("id"), F.struct("*").alias("row"))
    key = F.struct(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), mixing.word_count(F.col("row.text")).alias("size"))
    sized = written(rows.select("id", key.alias("key"), F.monotonically_increasing_id().alias("number")), "pipeline-sizes")
    plan = mixing.plan(sized.select("key.doc_id", "key.source", "key.size")).filter("low > 0 or n_high > 0")
    groups = plan.select(F.struct("doc_id", "source", "size").alias("key"), F.col("m").alias("rows"), "m", "low", "n_high", "source_size", "target")
    # Rows that share id, text and source are a class; a group of the mix holds one or more of them.
    classes = written(sized.groupBy("id", "key").agg(F.count("*").alias("n"), F.min("number").alias("number")), "pipeline-classes")
    met = written(meet_classes(classes, written(groups, "pipeline-mix"), "key"), "pipeline-met")

    # Classes of a group with two numbers of copies are counted off by their rows, in the order of their first ones.
    shared = _counted_off(met.filter("m > n and n_high > 0"), "key", F.col("n"))
    high = F.greatest(F.least(F.col("n_high") - F.col("before"), F.col("n")), F.lit(0).cast("bigint"))
    given = ["id", F.col("n").alias("rows"), "low", "high", F.struct(F.col("key.size").alias("size"), "source_size", "target").alias("plan")]
    alone = met.filter("m = n or n_high = 0").withColumn("high", F.col("n_high"))
    taken = alone.select(*given).unionByName(shared.withColumn("high", high).select(*given)).filter("low > 0 or high > 0")
    taken = written(taken, "pipeline-taken")

    # Rows meet their class where both move to, once. Those of a class with over a thousandth of all rows stay, and only they
    # are written with numbers, to be counted off where they are.
    is_hot = F.col("rows") * 1000 > (taken.agg(F.sum("rows")).first()[0] or 0)
    hot = written(taken.filter(is_hot), "pipeline-hot")
    number = F.monotonically_increasing_id().alias("number")
    rest = rows.join(F.broadcast(hot.select("id")), "id", "left_anti").join(taken.filter(~is_hot).hint("merge"), "id")
    rest = rest.select("*", number).withColumn("before", F.row_number().over(Window.partitionBy("id").orderBy("number")) - 1)
    spread = _counted_off(written(rows.join(F.broadcast(hot), "id").select("*", number), "pipeline-rows"), "id", F.lit(1))
    columns = ["row", "plan", (F.col("low") + (F.col("before") < F.col("high")).cast("int")).cast("int").alias("copies")]
    every = rest.select(*columns).unionByName(spread.select(*columns)).filter("copies > 0")
    return every.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in MIX_COLUMNS],
        "plan.size", "plan.source_size", "plan.target",
        F.explode(F.sequence(F.lit(1), "copies")).alias("copy"),
    )


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontaminated", decontaminated),
    ("without_secrets", without_secrets),
    ("mixed", mixed),
]

# Networks, bit distances and Newton turns can't be said in SQL; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
