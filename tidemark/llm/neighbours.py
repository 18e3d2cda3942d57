"""Approximate nearest neighbours: a neighbour graph by NN-descent, and greedy search in it."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import meet_classes, written
from .whitening import finite

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EDGES = "a bigint, b bigint, d float"
HALF_MAX = 65504.0


@dataclass(frozen=True)
class Settings:
    """degree: neighbours a node keeps; reverse: nodes that name it, of which so many join its neighbourhood in a turn; trees
    and chunk: orders of the start, and rows compared with each other in each; a turn that renews less than `settled` of all
    edges is the last. beam, width: nodes a query holds, and opens in a round; entries: nodes each query also starts at."""

    degree: int = 32
    reverse: int = 16
    trees: int = 3
    chunk: int = 1000
    turns: int = 12
    settled: float = 0.15
    beam: int = 240
    width: int = 32
    rounds: int = 24
    entries: int = 64


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, each once; a shorter vector ends in zeros."""
    kept = embeddings.filter(F.col("vec_id").isNotNull() & finite("embedding") & F.exists("embedding", lambda c: c != 0))
    kept = kept.select("vec_id", F.col("embedding").alias("v"))
    width = kept.agg(F.max(F.size("v"))).first()[0] or 0
    padded = F.concat("v", F.array_repeat(F.lit(0).cast(kept.schema["v"].dataType.elementType), F.lit(width) - F.size("v")))
    return kept.select("vec_id", padded.alias("v")).distinct()


def _rows(column: pa.Array, dtype: type = float) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1)


def _half(column: pa.Array) -> np.ndarray:
    """The codes of a binary column as rows of floats."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f2").astype(np.float32).reshape(len(column), -1)


def coded(nodes: DataFrame) -> DataFrame:
    """nodes (id, v) with code: the vector from the mean of all, in units of the mean deviation, as half floats. Codes serve to
    build the graph and to find ways in it; results are measured on the vectors."""
    entries = nodes.select(F.posexplode("v").alias("at", "c"))
    means = [r.m for r in sorted(entries.groupBy("at").agg(F.avg("c").alias("m")).collect(), key=lambda r: r["at"])]
    centre = np.array(means)
    held = F.array(*[F.lit(float(m)) for m in means])
    unit = entries.agg(F.avg(F.abs(F.col("c").cast("double") - held[F.col("at")]))).first()[0] or 1.0

    def each(vectors: pa.Array) -> pa.Array:
        scaled = np.clip((_rows(vectors) - centre) / unit, -HALF_MAX, HALF_MAX).astype("<f2")
        return pa.array([row.tobytes() for row in scaled], pa.binary())

    return nodes.withColumn("code", F.arrow_udf(each, "binary")(F.col("v")))


def _order_keys(width: int, trees: int, bits: int) -> Callable[[Column], Column]:
    """One sort key per tree: the sides of random planes on which a code lies, then its place along one more line."""
    planes = np.random.default_rng(11).normal(size=(trees, bits + 1, width)).astype(np.float32)

    def each(codes: pa.Array) -> pa.Array:
        x, keys = _half(codes), []
        for tree in planes:
            spots = x @ tree.T
            keys.append((spots[:, :-1] > 0) @ (2.0 ** np.arange(bits)) + 0.5 + np.arctan(spots[:, -1]) / np.pi)
        return pa.array(np.stack(keys, axis=1).astype(float).tolist(), pa.list_(pa.float64()))

    return F.arrow_udf(each, "array<double>")


def _squares(x: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x in each of its blocks."""
    norms = (x * x).sum(axis=-1)
    return np.maximum(norms[..., :, None] + norms[..., None, :] - 2 * (x @ np.swapaxes(x, -1, -2)), 0)


def _first_edges(kept: int) -> Callable[[pa.Table], pa.Table]:
    """Of the nodes of a chunk, each one's nearest in it."""

    def each(rows: pa.Table) -> pa.Table:
        ids, first = np.unique(rows.column("id").to_numpy(), return_index=True)
        x = _half(rows.column("code").combine_chunks())[first]
        n = min(kept, len(ids) - 1)
        if n < 1:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "d": pa.array([], pa.float32())})
        d = _squares(x)
        np.fill_diagonal(d, np.inf)
        near = np.argpartition(d, n - 1, axis=1)[:, :n]
        return pa.table({"a": np.repeat(ids, n), "b": ids[near].ravel(), "d": np.take_along_axis(d, near, 1).ravel().astype(np.float32)})

    return each


def start(nodes: DataFrame, count: int, width: int, settings: Settings) -> DataFrame:
    """First edges (a, b, d): nodes are put in order by each tree's key, and runs of `chunk` of them compared. A run has so many
    nodes however many lie close together."""
    bits = max(1, min(30, int(math.log2(max(count / settings.chunk, 2)))))
    keys = _order_keys(width, settings.trees, bits)(F.col("code"))
    placed = nodes.select("id", F.posexplode(keys).alias("tree", "key")).repartitionByRange("tree", "key", "id")
    placed = written(placed.withColumn("part", F.spark_partition_id()), "neighbours-order")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("tree", "key", "id")) - 1 + F.col("start")
    chunks = placed.join(starts, "part").select("id", F.floor(rank / settings.chunk).alias("chunk"))
    each = _first_edges(max(settings.degree // 2, 1))
    return chunks.join(nodes.select("id", "code"), "id").groupBy("chunk").applyInArrow(each, EDGES)


def _nearest(edges: DataFrame, degree: int) -> DataFrame:
    """(a, b, d, fresh) of each node's nearest; an edge that was there before isn't fresh."""
    once = edges.groupBy("a", "b").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    return once.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy("d", "b"))).filter(F.col("r") <= degree).drop("r")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The local join: two neighbours of a node, one of them fresh, become each other's where that is nearer than what they
    have."""
    for batch in batches:
        lists = batch.column("members")
        sizes = np.asarray(lists.value_lengths())
        flat = lists.flatten()
        ids, fresh = flat.field("m").to_numpy(), flat.field("fresh").to_numpy(zero_copy_only=False)
        worst, codes = flat.field("worst").to_numpy(), _half(flat.field("code"))
        ends = np.cumsum(sizes)
        for at in range(0, len(sizes), 256):
            own = sizes[at : at + 256]
            most = int(own.max())
            place = np.arange(most)
            pick = np.minimum((ends - sizes)[at : at + 256, None] + place, len(ids) - 1)
            there = place < own[:, None]
            d = _squares(codes[pick]).astype(np.float32)
            pair = there[:, :, None] & there[:, None, :] & (fresh[pick][:, :, None] | fresh[pick][:, None, :])
            pair &= (ids[pick][:, :, None] != ids[pick][:, None, :]) & (d < worst[pick][:, :, None])
            group, i, j = np.nonzero(pair)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[pick[group, i]]), pa.array(ids[pick[group, j]]), pa.array(d[group, i, j])], names=["a", "b", "d"]
            )


def descend(nodes: DataFrame, edges: DataFrame, count: int, settings: Settings) -> DataFrame:
    """The graph (a, b, d) after turns of neighbours of neighbours. nodes has (id, code), edges are the first ones.

    In a turn a node's neighbourhood is what it names and a bounded number of those that name it, so a node that very many
    name gets no larger group than others. Codes travel to the neighbourhoods; only nearer pairs come back.
    """
    graph = written(_nearest(edges.withColumn("fresh", F.lit(True)), settings.degree), "neighbours-graph")
    for turn in range(settings.turns):
        some = F.row_number().over(Window.partitionBy("b").orderBy(F.xxhash64("a", F.lit(turn))))
        back = graph.withColumn("r", some).filter(F.col("r") <= settings.reverse).select(F.col("b").alias("u"), F.col("a").alias("m"), "fresh")
        around = graph.select(F.col("a").alias("u"), F.col("b").alias("m"), "fresh").unionByName(back)
        around = around.groupBy("u", "m").agg(F.max("fresh").alias("fresh"))
        limits = graph.groupBy("a").agg(F.when(F.count("*") >= settings.degree, F.max("d")).otherwise(F.lit(float("inf")).cast("float")).alias("worst"))
        known = nodes.join(limits, nodes["id"] == limits["a"]).select(F.col("id").alias("m"), "worst", "code")
        groups = around.join(known, "m").groupBy("u").agg(F.collect_list(F.struct("m", "fresh", "worst", "code")).alias("members"))
        busy = groups.filter(F.exists("members", lambda x: x["fresh"])).select("members")
        nearer = busy.mapInArrow(_joined, EDGES).withColumn("fresh", F.lit(True))
        graph = written(_nearest(graph.withColumn("fresh", F.lit(False)).unionByName(nearer), settings.degree), "neighbours-graph")
        if graph.filter("fresh").count() < settings.settled * settings.degree * count:
            break
    return graph.select("a", "b", "d")


def distance(a: Column, b: Column) -> Column:
    """Euclidean, in double precision, of two array columns of one length."""

    def each(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array(np.sqrt(((_rows(x) - _rows(y)) ** 2).sum(axis=1)) if len(x) else [], pa.float64())

    return F.arrow_udf(each, "double")(a, b)


def search(nodes: DataFrame, graph: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(q, c, d) of the nearest nodes found for the nodes q of wanted (q, v): greedy search from q's own neighbours and from the
    entries, on the graph with some edges turned. In a round each query opens the nearest nodes it holds and has not opened;
    it ends when all it holds are open. d is the Euclidean distance of the vectors, in double precision."""
    some = F.row_number().over(Window.partitionBy("b").orderBy(F.xxhash64("a")))
    back = graph.withColumn("r", some).filter(F.col("r") <= settings.reverse).select(F.col("b").alias("a"), F.col("a").alias("b"))
    ways = written(graph.select("a", "b").unionByName(back).distinct(), "neighbours-ways")
    vectors = nodes.select("id", F.col("v").alias("w"))
    # A bounded number of nodes, written by itself: the only rows that meet every query.
    few = written(nodes.orderBy(F.xxhash64("id")).limit(settings.entries).select(F.col("id").alias("c")), "neighbours-entries")
    by_distance = Window.partitionBy("q").orderBy("d", "c")

    def measured(pairs: DataFrame) -> DataFrame:
        near = pairs.filter("q <> c").join(vectors, F.col("c") == F.col("id")).drop("id").join(wanted, "q")
        return near.select("q", "c", distance(F.col("v"), F.col("w")).alias("d"), F.lit(False).alias("open"))

    first = wanted.select("q", F.explode(F.array(*[F.lit(r.c) for r in few.collect()])).alias("c"))
    own = wanted.select("q").join(ways, F.col("q") == F.col("a")).select("q", F.col("b").alias("c"))
    held = written(measured(first.unionByName(own).distinct()), "neighbours-held")
    for _ in range(settings.rounds):
        nth = F.row_number().over(by_distance)
        kept = held.withColumn("r", nth).filter(F.col("r") <= settings.beam).drop("r")
        nth_closed = F.row_number().over(Window.partitionBy("q", "open").orderBy("d", "c"))
        marked = written(kept.withColumn("next", ~F.col("open") & (nth_closed <= settings.width)), "neighbours-beam")
        if marked.filter("next").isEmpty():
            break
        reached = marked.filter("next").join(ways, F.col("c") == F.col("a")).select("q", F.col("b").alias("c")).distinct()
        new = measured(reached.join(marked.select("q", "c"), ["q", "c"], "left_anti"))
        opened = marked.select("q", "c", "d", (F.col("open") | F.col("next")).alias("open"))
        held = written(opened.unionByName(new), "neighbours-held")
    return held.select("q", "c", "d")


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10, settings: Settings = Settings()) -> DataFrame:
    """One row (query_id, rank, vec_id, score) for each of the k nearest rows found of each row that is_query, a condition on
    vec_id, holds for; all rows but the query's own are candidates. score is their Euclidean distance, ties go to the
    smaller vec_id.

    Rows without a vec_id, and vectors that are null, zero or hold null or non-finite entries, take no part; a shorter vector
    ends in zeros. Rows equal in vec_id and vector are one; a vec_id with two vectors is two queries and two candidates. Equal vectors are
    one node of the graph, which keeps its k + 1 smallest vec_ids: more can't come among the nearest. With fewer candidates all
    come; a single row has none; no rows give no rows. Other columns aren't looked at.
    """
    rows = written(usable(embeddings), "neighbours-rows")
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    least = rows.withColumn("r", nth).filter(F.col("r") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    sizes = rows.groupBy("v").agg(F.count("*").alias("rows"))
    classes = written(least.join(sizes, "v").withColumn("id", F.monotonically_increasing_id()), "neighbours-classes")
    count, width = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    if not count:
        return rows.select(
            F.col("vec_id").cast("bigint").alias("query_id"), F.lit(0).alias("rank"), F.col("vec_id").cast("bigint").alias("vec_id"), F.lit(0.0).alias("score")
        ).limit(0)
    nodes = written(coded(classes.select("id", "v")), "neighbours-nodes")
    graph = descend(nodes.select("id", "code"), start(nodes, count, width, settings), count, settings)
    asked = written(meet_classes(rows.filter(is_query), classes.select("v", "id", "rows"), "v").select("vec_id", F.col("id").alias("q")), "neighbours-asked")
    wanted = written(asked.select("q").distinct().join(nodes.select(F.col("id").alias("q"), "v"), "q"), "neighbours-wanted")
    found = search(nodes, graph, wanted, settings)
    # The query's own node comes with the rest of its rows; k nodes beside it hold the k nearest rows.
    found = found.withColumn("r", F.rank().over(Window.partitionBy("q").orderBy("d"))).filter(F.col("r") <= k)
    found = found.select("q", "c", "d").unionByName(wanted.select("q", F.col("q").alias("c"), F.lit(0.0).alias("d")))
    named = found.join(classes.select(F.col("id").alias("c"), "ids"), "c").select("q", "d", F.explode("ids").alias("id"))
    # One more than k, as one of them may be the query itself.
    named = named.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("d", "id"))).filter(F.col("r") <= k + 1)
    lists = named.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("d", "id"))).alias("near"))
    lists = written(lists.join(asked.groupBy("q").agg(F.count("*").alias("rows")), "q"), "neighbours-lists")
    answers = meet_classes(asked, lists, "q")
    others = F.slice(F.filter("near", lambda x: ~((x["d"] == 0) & (x["id"] == F.col("vec_id")))), 1, k)
    return answers.select(F.col("vec_id").cast("bigint").alias("query_id"), F.posexplode(others).alias("at", "found")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("found.id").cast("bigint").alias("vec_id"), F.col("found.d").alias("score")
    )
