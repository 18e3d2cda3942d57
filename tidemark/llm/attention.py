"""Quality classifier by attention-based multiple-instance learning."""

from __future__ import annotations

import operator
import pickle
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PASSAGE_WORDS = 64
# Classes of bytes: a passage is encoded by the shares of neighbouring pairs of them.
_CLASSES = (b"aeiou", b"bcdfghjklm", b"npqrstvwxyz", b"AEIOU", b"BCDFGHJKLMNPQRSTVWXYZ", b"0123456789", b" ", b".,;:", b"!?", b"#*$%&<>", b"|")
_OTHER, _HIGH = len(_CLASSES), len(_CLASSES) + 1
KINDS = len(_CLASSES) + 2
FEATURES = KINDS * KINDS + 4


def _class_table() -> np.ndarray:
    table = np.full(256, _OTHER, np.int64)
    table[128:] = _HIGH
    for i, members in enumerate(_CLASSES):
        table[list(members)] = i
    return table


def passages(text: bytes | None) -> list[list[bytes]]:
    """Runs of PASSAGE_WORDS words; the whole text is covered. A text without words is one empty passage."""
    words = (text or b"").split()
    return [words[i : i + PASSAGE_WORDS] for i in range(0, max(len(words), 1), PASSAGE_WORDS)]


def encode(found: list[list[bytes]]) -> np.ndarray:
    """(passages, FEATURES)."""
    joined = [b" ".join(p) + b"\n" for p in found]
    lengths = np.fromiter(map(len, joined), np.int64, len(joined))
    data = np.frombuffer(b"".join(joined), np.uint8)
    kinds = _class_table()[data]
    owner = np.repeat(np.arange(len(joined)), lengths)
    inside = data[:-1] != 10  # words hold no line feed: it ends a passage
    cell = (owner[:-1] * KINDS + kinds[:-1]) * KINDS + kinds[1:]
    pairs = np.bincount(cell[inside], minlength=len(joined) * KINDS * KINDS).reshape(len(joined), -1)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    distinct = np.fromiter((len(set(p)) for p in found), np.int64, len(found))
    beside = np.fromiter((sum(map(operator.eq, p, p[1:])) for p in found), np.int64, len(found))
    per_word = np.maximum(sizes, 1)
    extra = np.stack([distinct / per_word, beside / per_word, (lengths - 1) / per_word / 10, np.log1p(sizes) / 4], axis=1)
    return np.concatenate([pairs / np.maximum(lengths - 1, 1)[:, None], extra], axis=1).astype(np.float32)


@dataclass(frozen=True)
class Attention:
    mean: np.ndarray
    scale: np.ndarray
    encoder: np.ndarray
    encoder_bias: np.ndarray
    content: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    output: np.ndarray
    bias: float


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _states(model: Attention, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hidden state, attention logit) of each passage."""
    hidden = np.tanh((features - model.mean) / model.scale @ model.encoder + model.encoder_bias)
    return hidden, (np.tanh(hidden @ model.content) * _sigmoid(hidden @ model.gate)) @ model.attend


def _pooled(hidden: np.ndarray, logits: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bag representation): a softmax over each bag's passages and the weighted mean of their states."""
    weights = np.exp(logits - np.repeat(np.maximum.reduceat(logits, starts), counts))
    weights /= np.repeat(np.add.reduceat(weights, starts), counts)
    return weights, np.add.reduceat(hidden * weights[:, None], starts, axis=0)


def scores(model: Attention, texts: list[bytes | None], block: int = 2048) -> np.ndarray:
    bags = [passages(t) for t in texts]
    counts = np.array([len(b) for b in bags])
    every = [p for b in bags for p in b]
    parts = [_states(model, encode(every[i : i + block])) for i in range(0, len(every), block)]
    hidden, logits = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    _, bag = _pooled(hidden, logits, np.cumsum(counts) - counts, counts)
    return _sigmoid(bag @ model.output + model.bias)


def train(bags: list[np.ndarray], labels: np.ndarray, size: int = 16, epochs: int = 200, rate: float = 0.02, decay: float = 1e-3, seed: int = 7) -> Attention | None:
    """Adam on the log loss of the document labels; None unless both labels occur."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    features, counts = np.concatenate(bags).astype(float), np.array([len(b) for b in bags])
    starts = np.cumsum(counts) - counts
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x, y = (features - mean) / scale, labels.astype(float)
    owner = np.repeat(np.arange(len(bags)), counts)
    params = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], size)), np.zeros(size),
        rng.normal(0, 0.3, (size, size)), rng.normal(0, 0.3, (size, size)), rng.normal(0, 0.3, size),
        rng.normal(0, 0.3, size), np.zeros(1),
    ]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, epochs + 1):
        enc, enc_bias, content, gate, attend, out, bias = params
        hidden = np.tanh(x @ enc + enc_bias)
        c, g = np.tanh(hidden @ content), _sigmoid(hidden @ gate)
        weights, bag = _pooled(hidden, (c * g) @ attend, starts, counts)
        error = (_sigmoid(bag @ out + bias[0]) - y) / len(y)
        d_bag = error[:, None] * out
        dot = (hidden * d_bag[owner]).sum(axis=1)
        d_logit = weights * (dot - np.add.reduceat(weights * dot, starts)[owner])
        d_c, d_g = d_logit[:, None] * attend * g * (1 - c * c), d_logit[:, None] * attend * c * g * (1 - g)
        d_hidden = weights[:, None] * d_bag[owner] + d_c @ content.T + d_g @ gate.T
        d_pre = d_hidden * (1 - hidden * hidden)
        grads = [x.T @ d_pre, d_pre.sum(axis=0), hidden.T @ d_c, hidden.T @ d_g, (c * g).T @ d_logit, bag.T @ error, np.array([error.sum()])]
        for p, grad, (m, v) in zip(params, grads, moments, strict=True):
            grad = grad + decay * p / len(y) ** 0.5
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Attention(mean, scale, *params[:6], float(params[6][0]))


def _features(text: Column, most: int) -> Column:
    """The encoded passages of a text as float32 bytes: all, or `most` spread evenly over it."""

    def each(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts.cast(pa.binary()).to_pylist():
            found = passages(value)
            picked = [found[i * len(found) // most] for i in range(most)] if len(found) > most else found
            out.append(encode(picked).tobytes())
        return pa.array(out, pa.binary())

    return F.arrow_udf(each, "binary")(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learned(documents: DataFrame, labels: DataFrame, limit: int = 4000, most: int = 32) -> Attention | None:
    """Fit to at most `limit` different texts of labelled documents that aren't held out (smallest hashes), of a long one
    to `most` passages; scoring takes all passages. Labels without id or quality are left out."""
    own = labelled_texts(documents, labels.filter(~held_out(F.col("doc_id"))), limit)
    rows = own.select("doc_id", "quality", _features(F.col("text"), most).alias("bag")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.quality, bytes(r.bag)))
    bags = [np.frombuffer(bytes(r.bag), np.float32).reshape(-1, FEATURES) for r in rows]
    return train(bags, np.array([int(r.quality == 1) for r in rows]))


def quality(text: Column, model: Attention | None) -> Column:
    packed = pickle.dumps(model)

    def each(texts: pa.Array) -> pa.Array:
        own = pickle.loads(packed)
        values = texts.cast(pa.binary()).to_pylist()
        out = np.full(len(values), 0.5)
        if own is not None:
            for at in range(0, len(values), 256):
                out[at : at + 256] = scores(own, values[at : at + 256])
        return pa.array(out, pa.float64())

    return F.arrow_udf(each, "double")(text)


def classified(documents: DataFrame, labels: DataFrame, limit: int = 4000, threshold: float = 0.3) -> DataFrame:
    """One row (doc_id, held_out, score, predicted) per document, from its whole text.

    Null and empty texts are one empty passage and get that passage's score. Without labels of both kinds every score is
    0.5. Repeated rows repeat their result, no rows give no rows, other columns aren't looked at.
    """
    score = quality(F.col("text"), learned(documents, labels, limit))
    return documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)
    )
