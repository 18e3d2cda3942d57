"""SimHash fingerprints and near copies by pigeonring filtering."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64


def _fingerprint(text: bytes | None, shingle: int, seed: int) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) <= shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):  # a long text needs no more memory than this
        part = hashes[at : at + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """The text's 64-bit fingerprint as a signed long; null and texts without words give 0.

    A-Z count as a-z, words are what is not ASCII white space, a text of fewer words than a shingle is one shingle.
    """

    def each(texts: pa.Array) -> pa.Array:
        values = texts.cast(pa.binary()).to_pylist()
        return pa.array([_fingerprint(v, shingle, seed) for v in values], pa.int64())

    return F.arrow_udf(each, "bigint")(text)


def _segments(count: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of the ring."""
    bounds = [round(BITS * i / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _mask(segments: list[tuple[int, int]], start: int, length: int) -> int:
    total = 0
    for step in range(length):
        first, width = segments[(start + step) % len(segments)]
        total |= ((1 << width) - 1) << first
    return _signed(total)


def _keys(value: Column, segments: list[tuple[int, int]], probe: bool) -> Column:
    """One key per chain start: a segment as it is and the next one, for a probe also with each of its bits turned."""
    keys = []
    for start in range(len(segments)):
        (first, width), (after, more) = segments[start], segments[(start + 1) % len(segments)]
        head = F.shiftrightunsigned(value, first).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
        tail = F.shiftrightunsigned(value, after).bitwiseAND(F.lit((1 << more) - 1).cast("bigint"))
        base = F.shiftleft(F.lit(start).cast("bigint"), 40).bitwiseOR(F.shiftleft(head, 20)).bitwiseOR(tail)
        keys.append(base)
        if probe:
            keys += [base.bitwiseXOR(F.lit(1 << bit).cast("bigint")) for bit in range(more)]
    return F.explode(F.array(*keys))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _contracted(stars: DataFrame, steps: int = 3) -> DataFrame:
    """(fingerprint, label): the least fingerprint within `steps` edges of stars (a, b). Equal labels are connected, which is
    all that contraction needs; the components themselves are found once, over all links."""
    both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("label"))
    for _ in range(steps - 1):
        around = both.join(labels.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("least"))
        labels = labels.join(around, "a").select("a", F.least("label", "least").alias("label"))
    return labels.withColumnRenamed("a", "fingerprint")


def linked_components(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """(fingerprint, component) of distinct fingerprints that have a partner within max_bits differing bits.

    The ring has m = max_bits + 1 segments (4 at least). By the pigeonring principle two fingerprints within max_bits
    share a chain: from some segment on, the first l segments differ in at most l * max_bits / m bits for every l. So
    the first segment is equal and the second differs in one bit at most, which is the join key; longer chains are
    tested before the full distance. Dense groups are contracted first: each member is tied to the least one under its
    key, takes the least one near it as its label, and afterwards only links between different labels leave the join. Members that
    are not tied by one round keep labels of their own, and links between these leave the join too: in trials with clouds of thousands of distinct fingerprints
    around one text, tens of links a member, rising slowly with their number. Fingerprints that many documents share count once.
    """
    count = max(max_bits + 1, 4)
    segments = _segments(count)
    keyed = prints.select("fingerprint", _keys(F.col("fingerprint"), segments, False).alias("key"))
    leaders = keyed.groupBy("key").agg(F.min("fingerprint").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    stars = (
        keyed.join(leaders, "key")
        .filter((F.col("fingerprint") != F.col("leader")) & (_distance("fingerprint", "leader") <= max_bits))
        .select(F.col("fingerprint").alias("a"), F.col("leader").alias("b"))
    )
    stars = written(stars.distinct(), "simhash-stars")
    groups = written(_contracted(stars), "simhash-groups")
    labelled = prints.join(groups, "fingerprint", "left").select(
        "fingerprint", F.coalesce("label", "fingerprint").alias("label")
    )
    probes = labelled.select(
        F.col("fingerprint").alias("a"),
        F.col("label").alias("a_label"),
        _keys(F.col("fingerprint"), segments, True).alias("key"),
    )
    index = labelled.select(
        F.col("fingerprint").alias("b"),
        F.col("label").alias("b_label"),
        _keys(F.col("fingerprint"), segments, False).alias("key"),
    )
    start = F.shiftright(F.col("p.key"), 40).cast("int")
    differing = F.col("a").bitwiseXOR(F.col("b"))
    matched = (F.col("a") < F.col("b")) & (F.col("a_label") != F.col("b_label"))
    for length in range(3, count):
        masks = F.array(*[F.lit(_mask(segments, s, length)).cast("bigint") for s in range(count)])
        matched &= F.bit_count(differing.bitwiseAND(masks[start])) <= length * max_bits // count
    matched &= F.bit_count(differing) <= max_bits
    crossing = probes.alias("p").join(index.alias("i"), (F.col("p.key") == F.col("i.key")) & matched)
    links = crossing.select("a", "b").distinct().unionByName(stars)
    return components(links).withColumnsRenamed({"node": "fingerprint"})


def near_copies(documents: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) per document.

    component_id is the smallest doc_id that links of at most max_bits differing bits reach. Null and empty texts have
    fingerprint zero and link like any other. Repeated rows stay, each with its row. A component whose documents all
    lack a doc_id has a null component_id. An empty table gives no rows. Other columns are not looked at.
    """
    prints = written(
        documents.select("doc_id", fingerprint(F.col("text"), shingle, seed).alias("fingerprint")), "simhash-prints"
    )
    classes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    linked = written(linked_components(classes.select("fingerprint"), max_bits), "simhash-components")
    named = classes.join(linked, "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    firsts = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    resolved = named.join(firsts, "component").select("fingerprint", "component_id")
    return prints.join(resolved, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
