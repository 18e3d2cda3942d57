"""Language identification by a byte convolutional network trained in numpy."""

from __future__ import annotations

import functools
import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTHS = (2, 3, 4)
UNDETERMINED = "und"
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


@dataclass(frozen=True)
class ByteConvNet:
    """kernels[w]: (w, 256, filters) weights of the one-hot bytes; a linear softmax layer over the pooled maxima."""

    labels: tuple[str, ...]
    window: int
    kernels: tuple[np.ndarray, ...]
    bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray


def _lower_bytes(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the Latin-1 capitals in lower case."""
    lowered = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    capitals = (lowered[1:] >= 0x80) & (lowered[1:] <= 0x9E) & (lowered[:-1] == 0xC3)
    lowered[1:][capitals] += 0x20
    return lowered


def _windows(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, first byte) of the fixed-length windows that cover every text."""
    counts = -(-np.diff(offsets) // window)
    texts = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(texts)) - np.repeat(np.cumsum(counts) - counts, counts)
    return texts, offsets[texts] + nth * window


def _gather(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, window: int) -> np.ndarray:
    """Windows as rows, with what the widest filter reads beyond; zero past the text's end."""
    at = starts[:, None] + np.arange(window + max(WIDTHS) - 1)
    return np.where(at < stops[:, None], data[np.minimum(at, len(data) - 1)], 0)


@functools.lru_cache(maxsize=2)
def _tables(packed: bytes) -> tuple[ByteConvNet, np.ndarray, np.ndarray, np.ndarray]:
    """Kernels summed for byte pairs, so that a position costs three look-ups."""
    net: ByteConvNet = pickle.loads(packed)
    pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
    two, three, four = net.kernels
    first = np.concatenate([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])], axis=1)
    return net, np.ascontiguousarray(first), np.ascontiguousarray(three[2]), pair(four[2], four[3])


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _predict(packed: bytes, data: np.ndarray, offsets: np.ndarray, block: int = 512) -> np.ndarray:
    """Log-probabilities of each text: the mean over its windows."""
    net, first, third, second_pair = _tables(packed)
    n = third.shape[1]
    texts, starts = _windows(data, offsets, net.window)
    total = np.zeros((len(offsets) - 1, len(net.labels)))
    for at in range(0, len(texts), block):
        rows = slice(at, at + block)
        found = _gather(data, starts[rows], offsets[texts[rows] + 1], net.window).astype(np.int32)
        pairs = found[:, :-1] * 256 + found[:, 1:]
        out = first[pairs[:, : net.window]]
        out[:, :, n : 2 * n] += third[found[:, 2 : net.window + 2]]
        out[:, :, 2 * n :] += second_pair[pairs[:, 2 : net.window + 2]]
        pooled = np.maximum(out.max(axis=1) + net.bias, 0)
        np.add.at(total, texts[rows], _log_softmax(pooled @ net.output + net.output_bias))
    windows = np.maximum(-(-np.diff(offsets) // net.window), 1)
    return _log_softmax(total / windows[:, None])


def train(samples: list[tuple[str, str]], window: int = 256, filters: int = 8, epochs: int = 24, seed: int = 7) -> ByteConvNet | None:
    """Fit the network to (language, passage) samples by Adam; each language weighs the same. A passage of more bytes than a
    window is as many samples as it fills windows. None without samples."""
    labels = tuple(sorted({lang for lang, _ in samples}))
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    whole = [(lang, text.encode()) for lang, text in samples]
    cut = [(lang, data[at : at + window]) for lang, data in whole for at in range(0, max(len(data), 1), window)]
    encoded = [np.frombuffer(data, np.uint8) for _, data in cut]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in encoded])))
    data = _lower_bytes(np.concatenate([*encoded, np.zeros(1, np.uint8)]))
    x = _gather(data, offsets[:-1], offsets[1:], window).astype(np.int64)
    y = np.array([labels.index(lang) for lang, _ in cut])
    weight = 1 / np.bincount(y, minlength=len(labels))[y]
    params = [rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in WIDTHS]
    params += [np.zeros(len(WIDTHS) * filters, np.float32)]
    params += [rng.normal(0, 0.3, (len(WIDTHS) * filters, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            rows = order[at : at + 128]
            batch, each = x[rows], np.arange(len(rows))[:, None]
            pooled, peaks = [], []
            for k, w in zip(params[:3], WIDTHS, strict=True):
                out = sum(k[j][batch[:, j : j + window]] for j in range(w))
                peaks.append(out.argmax(axis=1))
                pooled.append(out.max(axis=1))
            hidden = np.concatenate(pooled, axis=1) + params[3]
            active = np.maximum(hidden, 0)
            delta = np.exp(_log_softmax(active @ params[4] + params[5]))
            delta[np.arange(len(rows)), y[rows]] -= 1
            delta *= (weight[rows] / weight[rows].sum())[:, None]
            back = (delta @ params[4].T) * (hidden > 0)
            grads = []
            for i, w in enumerate(WIDTHS):
                grad, part = np.zeros_like(params[i]), back[:, i * filters : (i + 1) * filters]
                for j in range(w):
                    np.add.at(grad, (j, batch[each, peaks[i] + j], np.arange(filters)[None, :]), part)
                grads.append(grad)
            grads += [back.sum(axis=0), active.T @ delta, delta.sum(axis=0)]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return ByteConvNet(labels, window, tuple(params[:3]), params[3], params[4], params[5])


def sample(labelled: DataFrame, limit: int = 6000, window: int = 256) -> DataFrame:
    """(lang, passage): up to limit samples, two passages, anywhere in it, of each text picked by a hash of its doc_id, so a
    rerun takes the same. Languages share the texts evenly, so a rare one is learned at any size of the table. Null ids,
    null languages and null or empty texts are left out."""
    rows = labelled.filter("doc_id is not null and lang is not null").select("doc_id", "lang", "text")
    counts = written(rows.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    each = max(limit // 2 // max(counts.count(), 1), 1)
    # The counts set a hash below which about 1.2 * each rows of a language lie, so a task sends few rows.
    code, spots = F.xxhash64("doc_id", "lang"), 1 << 31
    below = rows.join(counts, "lang").filter(F.pmod(code, F.lit(spots)) < F.lit(1.2 * each * spots) / F.col("n") + 1)
    ids = below.select("doc_id", "lang").distinct().withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(code, "doc_id")))
    ids = written(ids.filter(F.col("nth") <= each).select("doc_id", "lang"), "language-ids")
    picked = rows.join(ids, ["doc_id", "lang"]).filter("text <> ''")
    spot = lambda i: F.lit(1) + F.pmod(F.xxhash64("text", F.lit(i)), F.greatest(F.length("text") - window + 1, F.lit(1))).cast("int")
    passages = F.explode(F.array(*[F.substr("text", spot(i), F.lit(window)) for i in range(2)]))
    return picked.select("doc_id", "lang", passages.alias("passage")).distinct().orderBy("doc_id", "lang", "passage").limit(limit).select("lang", "passage")


def identify(text: Column, net: ByteConvNet | None) -> Column:
    """struct (lang_pred, score in 0..1). Null texts, texts without a letter, and an untrained network give (und, 0)."""
    packed = pickle.dumps(net)

    def each(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_string())
        known = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False))
        preds, scores = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
        if net is not None and known.any():
            kept = pa.concat_arrays([texts.filter(pa.array(known))])
            offsets = np.frombuffer(kept.buffers()[1], np.int64)[kept.offset : kept.offset + len(kept) + 1]
            data = np.frombuffer(kept.buffers()[2], np.uint8)[: offsets[-1]]
            logs = _predict(packed, _lower_bytes(data), offsets)
            preds[known] = np.array(net.labels, object)[logs.argmax(axis=1)]
            scores[known] = np.exp(logs.max(axis=1))
        return pa.StructArray.from_arrays([pa.array(preds, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return F.arrow_udf(each, RESULT)(text)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from; without a doc_id a row is none of them, and none to learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def network(documents: DataFrame, limit: int = 6000) -> ByteConvNet | None:
    """Train on a bounded sample of the documents that aren't held out, in a task that holds the sample."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = [(r["lang"], r["passage"]) for batch in batches for r in batch.to_pylist()]
        if samples:
            net = train(sorted(samples))
            parts = pickle.dumps(tuple(getattr(net, f.name) for f in fields(net)))
            yield pa.RecordBatch.from_arrays([pa.array([parts], pa.binary())], names=["net"])

    samples = sample(documents.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), limit)
    fitted = samples.coalesce(1).mapInArrow(each, "net binary").collect()
    return ByteConvNet(*pickle.loads(fitted[0].net)) if fitted else None


def languages(documents: DataFrame, limit: int = 6000) -> DataFrame:
    """One row (doc_id, held_out, lang_pred, score) per document, from its whole text alone.

    The network learns from at most `limit` passages of documents that aren't held out. A repeated row gives a repeated
    result; ties go to the language first in code-point order; no rows give no rows; other columns aren't looked at.
    """
    return documents.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), identify(F.col("text"), network(documents, limit)).alias("_found")
    ).select("doc_id", "held_out", "_found.lang_pred", "_found.score")
