"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, written

EXACT = "decimal(38,6)"  # sums of it don't depend on the order of the rows, so reruns agree
RUN = 4096  # equal rows that one row of a plan is turned back into at a time


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", -1), "")).cast("bigint")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n, rank): sources by code point from rank 0, null last, without one task for all."""
    spread = written(
        sizes.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id()),
        "mix-sources",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = spread.groupBy("part").agg(F.count("*").alias("rows")).select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return spread.join(starts, "part").select(
        "source", "source_size", "n", (F.col("start") + F.row_number().over(own) - 1).alias("rank")
    )


def targets(sources: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """sources with target: the total shared by weight; none exceeds `most` times its source's size, and what exceeds it
    goes to the others by weight until all fit. Each turn settles at least one source, usually nearly all."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = written(sources.withColumn("weight", cycle[F.pmod("rank", F.lit(len(weights))).cast("int")]), "mix-weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else F.lit(level) * F.col("weight") >= most * F.col("source_size")
        row = weighed.agg(
            F.sum(F.when(full, most * F.col("source_size")).otherwise(0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
            F.count_if(full),
        ).first()
        if row[2] == capped or not row[1]:
            break
        capped, level = row[2], max(total - row[0], 0) / row[1]
    return weighed.withColumn(
        "target", F.least(F.lit(float(level or 0)) * F.col("weight"), (most * F.col("source_size")).cast("double"))
    )


def _rate(most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.col("dual") * F.col("size") / F.col("mean")))


def balance(histogram: DataFrame, sources: DataFrame, most: int, tolerance: float = 1e-9, turns: int = 80) -> DataFrame:
    """sources with dual: the multiplier of each source's token constraint.

    Of all document rates r, the ones nearest to 1 in relative entropy that meet sum(r * size) = target are
    exp(dual * size / mean), cut at `most`. The dual is convex with one unknown per source; each Newton turn gets gradient
    and curvature of all sources from one aggregation over (source, size, n), inside a bracket that each turn narrows.
    """
    ends = (F.col("target") >= most * F.col("source_size")) | (F.col("source_size") == 0)
    state = written(
        sources.select(
            "source", "source_size", "target",
            (F.col("source_size") / F.greatest("n", F.lit(1))).alias("mean"),
            F.lit(0.0).alias("dual"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
            ends.alias("done"),
        ),
        "mix-state",
    )
    for turn in range(turns + 1):
        if state.filter("not done").isEmpty():
            break
        if turn == turns:
            raise RuntimeError(f"{turns} Newton turns left sources that miss their targets by more than {tolerance:g} of them")
        s = state.filter("not done").withColumnRenamed("source", "s")
        rate = _rate(most)
        tokens = F.col("n") * F.col("size") * rate
        slope = F.when(rate < most, tokens * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            histogram.join(s, F.col("source").eqNullSafe(F.col("s")))
            .groupBy("source")
            .agg(F.sum(tokens.cast(EXACT)).cast("double").alias("taken"), F.sum(slope.cast(EXACT)).cast("double").alias("slope"))
            .withColumnRenamed("source", "s")
        )
        turned = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        over = F.col("taken") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.greatest("low", "dual"))
        high = F.when(over, F.least("high", "dual")).otherwise(F.col("high"))
        step = F.when(F.col("slope") > 0, F.col("dual") + (F.col("target") - F.col("taken")) / F.col("slope"))
        wider = F.when(over, F.least(F.col("dual") * 2, F.lit(-1.0))).otherwise(F.greatest(F.col("dual") * 2, F.lit(1.0)))
        between = F.coalesce((F.col("new_low") + F.col("new_high")) / 2, F.col("wider"))
        inside = (
            F.col("step").isNotNull()
            & (F.col("new_low").isNull() | (F.col("step") > F.col("new_low")))
            & (F.col("new_high").isNull() | (F.col("step") < F.col("new_high")))
        )
        met = F.abs(F.col("taken") - F.col("target")) <= tolerance * F.col("target")
        turned = turned.select(
            "source", "source_size", "target", "mean", "dual", "done", "taken",
            low.alias("new_low"), high.alias("new_high"), step.alias("step"), wider.alias("wider"), met.alias("met"),
        )
        state = written(
            turned.select(
                "source", "source_size", "target", "mean",
                F.when(F.col("done") | F.col("met"), F.col("dual")).when(inside, F.col("step")).otherwise(between).alias("dual"),
                F.col("new_low").alias("low"), F.col("new_high").alias("high"),
                (F.col("done") | F.coalesce("met", F.lit(True))).alias("done"),
            ),
            "mix-state",
        )
    return state


def rounded(rows: DataFrame, most: int, per_bucket: int = 512) -> DataFrame:
    """rows (doc_id, source, size, m, n_source, rate, ...) with low and n_high: of the m equal rows n_high have low + 1
    copies and the others low.

    A source's documents are dealt into buckets of about per_bucket rows. In a bucket, from the largest to the smallest,
    each group's words still owed are rounded to copies of one row and the rest is carried on, so a bucket misses its
    expected words by half its smallest document or so, however often a row repeats.
    """
    buckets = F.greatest(F.ceil(F.col("n_source") / per_bucket), F.lit(1))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), buckets))
    item = F.struct(
        (-F.col("size")).alias("order"), F.col("doc_id"), F.col("size"), F.col("m"), F.col("rate"), F.col("source_size"), F.col("target")
    )
    bucket = dealt.groupBy("source", "bucket").agg(F.array_sort(F.collect_list(item)).alias("items"))
    kind = "struct<doc_id:bigint,size:bigint,m:bigint,source_size:bigint,target:double,low:int,n_high:bigint>"
    start = F.struct(F.lit(0.0).alias("owed"), F.expr(f"CAST(array() AS array<{kind}>)").alias("out"))

    def settle(state: Column, x: Column) -> Column:
        words = x["size"].cast("double")
        want = state["owed"] + x["rate"] * words * x["m"]
        copies = F.when(words > 0, F.least(F.greatest(F.round(want / words), F.lit(0.0)), most * x["m"].cast("double"))).otherwise(0.0)
        low = F.floor(copies / x["m"])
        row = F.struct(
            x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["m"].alias("m"), x["source_size"].alias("source_size"),
            x["target"].alias("target"), low.cast("int").alias("low"), (copies - low * x["m"]).cast("bigint").alias("n_high"),
        )
        return F.struct((want - copies * words).alias("owed"), F.concat(state["out"], F.array(row)).alias("out"))

    done = F.aggregate("items", start, settle, lambda s: s["out"])
    return bucket.select("source", F.inline(done))


def planned(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row (source, doc_id, size, m, source_size, target, low, n_high) per group of m documents equal in the first
    three: n_high of them are taken low + 1 times, the others low times."""
    return plan(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), weights, most)


def plan(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``planned`` for documents (doc_id, source, size) whose words are counted already."""
    rows = written(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m")), "mix-rows")
    histogram = written(rows.groupBy("source", "size").agg(F.sum("m").alias("n")), "mix-histogram")
    sizes = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n"))
    sources = written(targets(ranked_sources(sizes), weights, most), "mix-targets")
    duals = balance(histogram, sources, most).select(F.col("source").alias("s"), "dual", "mean")
    known = sources.join(duals, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), "source_size", "target", F.col("n").alias("n_source"), "dual", "mean"
    )
    full = F.col("target") >= most * F.col("source_size")
    rated = rows.join(known, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "rate", F.when(full, F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.exp(F.round("dual", 9) * F.col("size") / F.col("mean"))))
    )
    return rounded(rated, most)


def mix(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row (doc_id, source, size, source_size, target, copies, taken) per document.

    Size counts words (null text: 0). taken = copies * size, and no document has over `most` copies; a document without
    words has none. Rows that repeat doc_id, source and size stay as many rows, each rounded by itself: their copies differ
    by one at most. Null sources are a source of their own, last; null doc_ids are dealt like any other. No rows give no
    rows; other columns aren't looked at.
    """
    # A group's rows are made again in runs of RUN that are dealt out first: no task or array holds a hot key's rows.
    share = F.explode(
        F.array(
            F.struct(F.col("low").alias("copies"), (F.col("m") - F.col("n_high")).alias("n")),
            F.struct((F.col("low") + 1).alias("copies"), F.col("n_high").alias("n")),
        )
    )
    shares = planned(documents, weights, most).withColumn("share", share).filter("share.n > 0")
    last = F.floor((F.col("share.n") - 1) / RUN)
    runs = shares.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).repartition("source", "doc_id", "size", "share", "run")
    length = F.least(F.lit(RUN), F.col("share.n") - F.col("run") * RUN).cast("int")
    return runs.withColumn("again", F.explode(F.array_repeat(F.lit(0), length))).select(
        "doc_id", "source", "size", "source_size", "target", "share.copies", (F.col("share.copies") * F.col("size")).alias("taken")
    )
