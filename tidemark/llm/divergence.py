"""Source divergence audit: how far the sources of a language are apart in their words, and which words mark each."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1_000_000_000
COUNTS = "lang string, source string, term string, n bigint, docs bigint"
# One pass over a text's bytes: letters in lower case, bytes of other scripts as they are, all else blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PIECE = 1 << 20  # bytes of a text that are split at once
HELD = 400_000  # terms that a task adds up before it sends them on


def term_counts(text: bytes) -> Counter:
    """How often each term occurs. A long text is split piece by piece, each cut at a blank."""
    blanked = text.translate(LETTERS)
    counts: Counter = Counter()
    start = 0
    while start < len(blanked):
        end = blanked.find(b" ", start + PIECE)
        end = len(blanked) if end < 0 else end
        counts.update(blanked[start:end].split())
        start = end
    return counts


def counted(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term. Tasks add up their documents before
    the shuffle, in memory that a count of terms bounds."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, source), (occurrences, docs) in totals.items():
                terms = list(occurrences)
                for at in range(0, len(terms), 50_000):
                    part = terms[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(part), pa.string()),
                            pa.array([source] * len(part), pa.string()),
                            pa.array([t.decode() for t in part], pa.string()),
                            pa.array([occurrences[t] for t in part], pa.int64()),
                            pa.array([docs[t] for t in part], pa.int64()),
                        ],
                        names=["lang", "source", "term", "n", "docs"],
                    )

        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(langs, sources, batch.column("text").cast(pa.large_binary()), strict=True):
                own = term_counts(text.as_buffer().to_pybytes())
                occurrences, docs = totals.setdefault((lang, source), (Counter(), Counter()))
                before = len(occurrences)
                for term, n in own.items():
                    occurrences[term] += n
                docs.update(own.keys())
                held += len(occurrences) - before
                if held >= HELD:
                    yield from sent()
                    totals, held = {}, 0
        yield from sent()

    parts = documents.select("lang", "source", "text").mapInArrow(each, COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (n + 2) / (total + 2 * kept)) in whole numbers: the long division takes three digits at a time, so
    that no product leaves the longs."""
    whole = total + 2 * kept
    rest, out = n + 2, F.lit(0).cast("bigint")
    for _ in range(3):
        out = out * 1000 + F.call_function("div", rest * 1000, whole)
        rest = (rest * 1000) % whole
    return out + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(documents: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """One row (lang, source, part, item, value, rank) per pair of sources of a language and per marking term.

    Part `pair` has every other source of the language, by divergence over all kept terms; part `term` the terms that
    the source has more often than its language, the `top` ones only. Null text, lang and source count as empty; a language
    without kept terms has pairs of value 0; a repeated row counts again; ties go to the smaller item; no rows give no
    rows. doc_id and other columns aren't looked at.

    Terms that neither source has differ by one number per pair, and terms that only one has by a number per count,
    so only terms that both have are joined, source by source; the rest comes from each source's histogram of counts.
    """
    filled = documents.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = written(counted(filled), "audit-counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    terms = written(terms.filter(F.col("docs") >= least_docs).drop("docs"), "audit-terms")
    own = written(counts.drop("docs").join(terms, ["lang", "term"]), "audit-own")

    zero = F.lit(0).cast("bigint")
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    sums = own.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    groups = (
        filled.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "held", "kept", "lang_total")])
    )
    absent = F.when(F.col("kept") > 0, _share(zero, F.col("total"), F.col("kept"))).otherwise(zero)
    groups = written(groups.withColumn("absent", absent), "audit-groups")

    marked = own.join(groups.drop("held", "absent"), ["lang", "source"]).select(
        "lang", "source", "term",
        _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    marked = written(marked, "audit-marked")
    part = marked.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    top_terms = part.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)

    others = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("other_absent"), F.col("held").alias("other_held"))
    # Terms that the source has and the other has not: as many as the histogram says, each p against one number.
    shares = marked.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    alone = shares.join(others, "lang").filter("source <> item").groupBy("lang", "source", "item").agg(
        F.sum(F.col("m") * _apart(F.col("p"), F.col("other_absent"))).alias("alone")
    )
    alone = written(alone, "audit-alone")
    # Terms that both have: their own difference in place of the two that `alone` counts.
    base = marked.join(groups.select("lang", "source", "absent"), ["lang", "source"]).select("lang", "term", "source", "p", "absent")
    a, b = base.alias("a"), base.alias("b")
    both = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.term") == F.col("b.term")) & (F.col("a.source") < F.col("b.source")))
    more = (
        _apart(F.col("a.p"), F.col("b.p")) - _apart(F.col("a.p"), F.col("b.absent")) - _apart(F.col("a.absent"), F.col("b.p"))
        + _apart(F.col("a.absent"), F.col("b.absent"))
    )
    both = both.groupBy(F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item")).agg(F.sum(more).alias("both"))
    both = written(both, "audit-both")
    turned = lambda df, name: df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col(name).alias(name + "_turned"))
    both = both.unionByName(turned(both, "both").withColumnRenamed("both_turned", "both"))
    keys = ["lang", "source", "item"]
    pairs = groups.join(others, "lang").filter("source <> item")
    pairs = pairs.join(alone, keys, "left").join(turned(alone, "alone"), keys, "left").join(both, keys, "left")
    neither = F.when(
        F.col("kept") > 0, (F.col("kept") - F.col("held") - F.col("other_held")) * _apart(F.col("absent"), F.col("other_absent"))
    )
    value = sum((F.coalesce(c, zero) for c in (F.col("alone"), F.col("alone_turned"), F.col("both"))), F.coalesce(neither, zero))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(top_terms)
