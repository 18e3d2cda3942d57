"""Embedding whitening by a covariance over distinct vectors, weighted by how often each occurs."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import meet_classes, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The contract's grid (fixed values).
STEPS, SHIFT = 1024, 100_000
LONG_MAX = (1 << 63) - 1


def finite(vector: str) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~bad, F.lit(False))


def gridded(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vectors are finite; x holds longs, and a shorter vector ends in zeros."""
    kept = embeddings.filter(finite("embedding")).select("vec_id", F.col("embedding").cast("array<double>").alias("c"))
    width = kept.agg(F.max(F.size("c"))).first()[0] or 0
    padded = F.concat("c", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("c")))
    return kept.select("vec_id", F.transform(padded, lambda c: F.floor(c * STEPS).cast("bigint") + SHIFT).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _from_mean(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: in longs where they hold it, else in Python's numbers."""
    if n * float(np.abs(x).max(initial=0)) < 1 << 61 and float(np.abs(sums).astype(float).max(initial=0)) < 1 << 61:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums.astype(object)


def covariance(classes: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Of the vectors x in classes (x, weight), divisor n. Each task centres its vectors, multiplies them in blocks and sends
    one matrix; Spark adds these up entry by entry, and what comes back has one number per pair of dimensions."""
    exact = np.array(sums, dtype=object)
    width = len(sums)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                centred = _from_mean(_matrix(batch.column("x")), n, exact).astype(float) / n
                total += (centred * batch.column("weight").to_numpy().astype(float)[:, None]).T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(width), width), pa.int32()), pa.array(np.tile(np.arange(width), width), pa.int32()), pa.array(total.ravel())],
            names=["i", "j", "v"],
        )

    added = classes.select("x", "weight").mapInArrow(each, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for row in added.collect():
        out[row.i, row.j] = row.v
    return (out + out.T) / 2 / n


def components(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` greatest eigenvalues, falling, and their unit eigenvectors as columns; each vector's largest entry is
    positive, so that reruns agree."""
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = np.maximum(values[::-1][:most], 0.0), vectors[:, ::-1][:, :most]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs


def whiten_classes(classes: DataFrame, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """classes (x, weight) with deviation and the whitened coordinates z."""
    exact = np.array(sums, dtype=object)
    usable = values > values[0] * len(sums) * np.finfo(float).eps if len(values) else values > 0
    scale = np.where(usable, 1 / np.sqrt(np.where(usable, values, 1.0)), np.nan)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = _from_mean(_matrix(batch.column("x")), n, exact)
            if apart.dtype != object and len(sums) * float(np.abs(apart).max(initial=0)) ** 2 < 1 << 62:
                squares = (apart * apart).sum(axis=1).tolist()
            else:
                squares = [sum(int(v) * int(v) for v in row) for row in apart]
            z = (apart.astype(float) / n) @ vectors * scale
            rows = [[None if np.isnan(v) else v for v in row] for row in z.tolist()] if not usable.all() else z.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("x"), batch.column("weight"),
                    pa.array([s if s <= LONG_MAX else None for s in squares], pa.int64()),
                    pa.array(rows, pa.list_(pa.float64())),
                ],
                names=["x", "weight", "deviation", "z"],
            )

    return classes.select("x", "weight").mapInArrow(each, "x array<bigint>, weight bigint, deviation bigint, z array<double>")


def identity_error(whitened: DataFrame, n: int, size: int) -> float | None:
    """The largest entry of z's covariance minus the identity, over the components that vary; None without one."""
    if not size:
        return None
    weight, z = F.col("weight"), F.col("z")
    means = whitened.agg(*[(F.sum(weight * z[i]) / n).alias(str(i)) for i in range(size)]).first()
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    off = whitened.agg(
        *[(F.sum(weight * ((z[i] - F.lit(means[i])) * (z[j] - F.lit(means[j])))) / n).alias(f"{i}_{j}") for i, j in pairs]
    ).first()
    return max(abs(off[k] - (i == j)) for k, (i, j) in enumerate(pairs))


def whiten(embeddings: DataFrame, most: int = 8, weights: str = "counts") -> DataFrame:
    """One row (vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    Rows whose vector is null or holds null or non-finite entries are left out; zero vectors stay, and a shorter vector
    ends in zeros. Equal vectors are one class, whose fit weight is its rows (`weights="counts"`) or one (`"one"`); n, the
    sums, the mean and every covariance go by these weights. Rows are told apart by nothing but themselves: repeated rows and null ids
    repeat their results. A component without variance has a null coordinate and is not in identity_error, explained is
    null if nothing varies, and a deviation past the longs is null. No usable rows give no rows; other columns aren't
    looked at.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights must be 'counts' or 'one', got {weights!r}")
    rows = written(gridded(embeddings), "whitening-rows")
    weight = F.count("*") if weights == "counts" else F.lit(1).cast("bigint")
    classes = written(rows.groupBy("x").agg(F.count("*").alias("rows"), weight.alias("weight")), "whitening-classes")
    fit = classes.agg(F.sum("weight"), F.max(F.size("x"))).first()
    n, width = fit[0] or 0, fit[1] or 0
    entries = classes.select("weight", F.posexplode("x").alias("at", "v"))
    summed = entries.groupBy("at").agg(F.sum(F.col("weight").cast("decimal(19,0)") * F.col("v")).alias("s")).collect()  # one per dimension
    sums = [int(r.s) for r in sorted(summed, key=lambda r: r["at"])]
    if width:
        matrix = covariance(classes, n, sums)
        values, vectors = components(matrix, most)
    else:
        matrix, values, vectors = np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0))
    done = written(whiten_classes(classes, n, sums, values, vectors), "whitening-done")
    varied = int((values > values[0] * width * np.finfo(float).eps).sum()) if len(values) else 0
    error, trace = identity_error(done, n, varied), float(np.trace(matrix))
    explained = F.array(*[F.lit(float(v / trace) if trace > 0 else None).cast("double") for v in values])
    found = done.join(classes.select("x", "rows"), "x").select("x", "rows", "deviation", "z")
    every = meet_classes(rows, found, "x")
    return every.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained") if len(values) else F.lit(None).cast("double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
