"""Benchmark decontamination by winnowing."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, row_key, written

# The contract's word rule (fixed values); the second also takes A-Z, for counting without lowering.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


PIECE = 1000  # words of a text that are looked at together


@dataclass(frozen=True)
class Grams:
    """Fingerprints that find every shared run of `need` words: hashes of k words, of which each window of
    need - k + 1 consecutive ones keeps its least."""

    k: int
    need: int

    @property
    def reach(self) -> int:
        """A shared run that holds a kept k-gram need not start further away from it than this."""
        return self.need - self.k


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS, -1), "")


def _hashes(name: str, grams: Grams) -> Column:
    """Hash of the k words from each position of the array column `name`."""
    gram = lambda i: F.xxhash64(F.lit(grams.need), *[F.col(name)[i + j] for j in range(grams.k)])
    many = F.transform(F.sequence(F.lit(0), F.size(name) - grams.k), gram)
    return F.when(F.size(name) >= grams.k, many).otherwise(F.expr("CAST(array() AS array<bigint>)"))


def _winnowed(name: str, grams: Grams) -> Column:
    """The least hash of each window of the array column `name`, each value once."""
    span = grams.reach + 1
    if span == 1:
        return F.array_distinct(name)
    least = F.transform(F.sequence(F.lit(0), F.size(name) - span), lambda i: F.least(*[F.col(name)[i + j] for j in range(span)]))
    return F.when(F.size(name) >= span, F.array_distinct(least)).otherwise(F.expr("CAST(array() AS array<bigint>)"))


def pieces(worded: DataFrame, overlap: int) -> DataFrame:
    """(key, offset, words) of bounded length from (key, words): every run of overlap + 1 words lies whole in a piece, so work
    that goes by pieces grows with a text's length and not with its square."""
    at = F.sequence(F.lit(0), F.floor(F.greatest(F.size("words") - 1, F.lit(0)) / PIECE).cast("int"))
    cut = F.transform(at, lambda i: F.struct((i * PIECE).alias("offset"), F.slice("words", i * PIECE + 1, PIECE + overlap).alias("words")))
    return worded.select("key", F.explode(cut).alias("piece")).select("key", "piece.offset", "piece.words")


def _of_kind(items: DataFrame, grams: Grams) -> DataFrame:
    """The items whose windows have the kind's length."""
    return items.filter(F.size("words") >= grams.need if grams.reach else F.size("words") == grams.need)


def item_fingerprints(items: DataFrame, grams: Grams) -> DataFrame:
    """(hash) of the kept fingerprints in items (item, words), each once."""
    hashed = _of_kind(items, grams).select(_hashes("words", grams).alias("hashes"))
    return hashed.select(F.explode(_winnowed("hashes", grams)).alias("hash")).distinct()


def _window(start: Column, grams: Grams) -> Column:
    """The window that starts there in the array column `words`: its hash and its words."""
    own = F.slice("words", start + 1, grams.need)
    return F.struct(F.xxhash64(F.lit(-grams.need), own).alias("hash"), own.alias("words"), start.alias("start"))


def item_windows(items: DataFrame, grams: Grams) -> DataFrame:
    """(hash, words, item) of every window of the items (item, words), each once."""
    all_of = F.transform(F.sequence(F.lit(0), F.size("words") - grams.need), lambda i: _window(i, grams))
    return _of_kind(items, grams).select("item", F.explode(all_of).alias("w")).select("w.hash", "w.words", "item").distinct()


def _windows_around(grams: Grams, hashes: str) -> Column:
    """Every window of the kind, in the array column `words`, that holds a met fingerprint."""
    at = F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.array_contains("met", F.col(hashes)[i]))
    first = lambda i: F.greatest(i - grams.reach, F.lit(0))
    last = lambda i: F.least(i, F.size("words") - grams.need)
    starts = F.array_distinct(F.flatten(F.transform(at, lambda i: F.when(first(i) <= last(i), F.sequence(first(i), last(i))).otherwise(F.expr("CAST(array() AS array<int>)")))))
    found = F.transform(starts, lambda i: _window(i, grams))
    return F.when(F.size(hashes) > 0, found).otherwise(F.expr("CAST(array() AS array<struct<hash:bigint,words:array<string>,start:int>>)"))


def hits(texts: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 6) -> DataFrame:
    """(key, n_hit, items) of the texts (key, text) in which a window of a benchmark item occurs; items are its ids.

    Kept fingerprints of both sides are joined on the hash; texts that meet one are read again, and each hit is extended to
    the windows that hold it. These meet the items' windows by all their words, so a phrase that texts and items share,
    but shorter than a window, joins nothing, and items come in only where a window is met. The benchmark's side is broadcast only if Spark finds it
    small as written. All lengths of items are looked for in the same two passes.
    """
    items = written(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words"))
        .filter(F.size("words") > 0)
        .distinct(),
        "benchmark-items",
    )
    lengths = [r[0] for r in items.select(F.least(F.size("words"), F.lit(window)).alias("n")).distinct().collect()]
    # Items shorter than the window are windows of their own length, matched whole: at most window - 1 such lengths.
    kinds = [Grams(k, window) if n == window else Grams(n, n) for n in sorted(lengths)]
    if not kinds:
        return texts.select("key", F.lit(0).cast("bigint").alias("n_hit"), F.array(F.lit("")).alias("items")).limit(0)
    union = lambda parts: functools.reduce(DataFrame.unionByName, parts)
    prints = written(union([item_fingerprints(items, grams) for grams in kinds]).distinct(), "benchmark-prints")
    windows = written(union([item_windows(items, grams) for grams in kinds]), "benchmark-windows")

    def hashed(own: DataFrame) -> DataFrame:
        return pieces(own.select("key", words(F.col("text")).alias("words")), window - 1)

    columns = [_hashes("words", grams).alias(f"hashes_{grams.need}") for grams in kinds]
    kept = F.concat(*[_winnowed(f"hashes_{grams.need}", grams) for grams in kinds])
    met = hashed(texts).select("key", "offset", *columns).select("key", "offset", F.explode(kept).alias("hash")).join(prints, "hash")
    met = written(met.groupBy("key", "offset").agg(F.collect_set("hash").alias("met")), "benchmark-candidates")
    again = texts.join(met.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    placed = hashed(again).join(met, ["key", "offset"]).select("key", "offset", "words", "met", *columns)
    found = F.concat(*[_windows_around(grams, f"hashes_{grams.need}") for grams in kinds])
    placed = placed.select("key", "offset", F.explode(found).alias("w")).select("key", "w.hash", "w.words", (F.col("offset") + F.col("w.start")).alias("first"))
    runs = placed.join(windows.select("hash", "words").distinct(), ["hash", "words"], "left_semi")
    runs = written(runs.distinct(), "benchmark-runs")
    covered = runs.select("key", F.explode(F.sequence("first", F.col("first") + F.size("words") - 1)).alias("at")).distinct()
    counted = covered.groupBy("key").agg(F.count("*").alias("n_hit"))
    named = runs.select("key", "hash", "words").distinct().join(windows, ["hash", "words"]).select("key", "item").distinct()
    return counted.join(named.groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items")), "key")


def document_key(doc_id: Column | None = None, text: Column | None = None) -> Column:
    return row_key(F.col("doc_id") if doc_id is None else doc_id, F.col("text") if text is None else text)


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 6) -> DataFrame:
    """One row (doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per document.

    Null and empty texts have no words and no hits; items without words have no windows; an item without an id counts
    under the empty id, items that share an id count once. Rows that repeat doc_id and text repeat their result. No
    documents give no rows, no items no hits. Other columns aren't looked at.
    """
    texts = documents.select("doc_id", "text", document_key().alias("key"))
    found = written(hits(texts.select("key", "text"), benchmark, window, k), "benchmark-hits")
    count = F.coalesce(F.regexp_count("text", F.lit(ANY_CASE)), F.lit(0)).cast("bigint")
    return (
        texts.select("doc_id", "key", count.alias("n_words"))
        .join(found, "key", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )
