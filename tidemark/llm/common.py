"""What the operators share: reading tables, cutting lineage, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

# The word rules of the contracts (fixed values).
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared scratch folder: a lost executor costs no earlier step, and the planner knows
    the true size of what it may broadcast."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def row_key(doc_id: Column, text: Column) -> Column:
    """A 128-bit key of a row's id and text, as 16 bytes: equal rows share it, others don't at any size of a corpus. A null
    text counts as empty."""
    named = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.concat_ws(":", F.length(named), named, F.coalesce(text, F.lit("")))))


def meet_classes(rows: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """rows with the columns of their class, by inner join; classes has one row per key and its number of `rows`.

    A class with over a thousandth of all these rows is one of a thousand at most: those are sent to every task, so a hot
    key's rows stay where they are. The others meet their rows in a shuffle.
    """
    total = classes.agg(F.sum("rows")).first()[0] or 0
    is_hot = F.col("rows") * 1000 > total
    given = [c for c in classes.columns if c not in (key, "rows")]
    found = classes.select(key, "rows", F.struct(*given).alias("found"))
    hot = written(found.filter(is_hot).drop("rows"), "classes-hot")
    met = rows.join(F.broadcast(hot), key, "left")
    rest = met.filter("found is null").drop("found").join(found.filter(~is_hot).drop("rows"), key)
    every = met.filter("found is not null").unionByName(rest.select(met.columns))
    return every.select(*rows.columns, "found.*")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges (a, b: bigint); a component is named by its smallest node.

    Alternating large and small stars. A node's neighbours are never collected: each round takes minima per node, which
    tasks reduce before the shuffle, and joins them back. No edges give no rows; null ends and loops are left out.
    """
    current = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a is not null and b is not null and a <> b")
        .distinct(),
        "edges",
    )
    state = None
    while True:
        # Large star: every greater neighbour of a node moves to the least node around.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # Small star: a node and its smaller neighbours move to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = written(
            small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(),
            "edges",
        )
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def hash_sample(rows: DataFrame, limit: int, *keys: str) -> DataFrame:
    """At most `limit` rows: those with the smallest hashes of their keys, the same in every run.

    The row count sets a hash below which about 1.2 * limit rows lie, so a task sends a few rows, not `limit` of them.
    """
    share = min(1.0, 1.2 * limit / max(rows.count(), 1) + 1e-9)
    spot = F.pmod(F.xxhash64(*keys), F.lit(1 << 31))
    return rows.filter(spot < int(share * (1 << 31))).orderBy(F.xxhash64(*keys), *keys).limit(limit)


def labelled_texts(documents: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, quality, text) of at most `limit` rows: each text of a labelled document once, however often it or its
    label is repeated. First the labels, then their texts are those with the smallest hashes. Labels without id or quality
    are left out; a null text counts as empty."""
    known = labels.filter("doc_id is not null and quality is not null").select(F.col("doc_id").alias("label_id"), "quality")
    picked = hash_sample(known.distinct(), limit, "label_id", "quality")
    own = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(picked, F.col("doc_id") == F.col("label_id"))
    own = own.select("doc_id", "quality", "text", F.unhex(F.md5("text")).alias("text_hash"))
    keys = ["doc_id", "quality", "text_hash"]
    chosen = hash_sample(written(own.select(keys).distinct(), "labelled-texts"), limit, *keys)
    return own.join(written(chosen, "labelled-sample"), keys).dropDuplicates(keys).select("doc_id", "quality", "text")
