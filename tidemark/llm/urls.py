"""URL filters: host rules, and a character language-model ratio for what no rule decides."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The contract's rules (fixed values).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ORDER = 5  # a context and its character fit into a 64-bit key
SLOT_BITS = 19  # n-grams of three bytes and more are counted in 2**SLOT_BITS slots of each order, which bounds a model
STEPS = 1024  # of a unit of score, in which held-out scores are counted; a power of two, so that multiplying is exact
WIDEST = 16  # scores beyond count as this
SLICE_BYTES = 1 << 20  # of text whose n-grams are counted together
GRAMS = "accepted boolean, length int, gram bigint, slot bigint, context bigint, n bigint"


def parts(url: Column) -> tuple[Column, Column]:
    """(host in lower case, path); both empty for null and for what has no ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """struct (rule, verdict) of the longest rule for the host or a parent of it whose path begins the url's; else null."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + start))
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


@dataclass(frozen=True)
class Markov:
    """For each order: sorted slots of (context, character) with counts, of contexts with totals and distinct followers."""

    grams: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]
    contexts: tuple[np.ndarray, ...]
    totals: tuple[np.ndarray, ...]
    kinds: tuple[np.ndarray, ...]


def _keys(data: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """Key of each byte with its `order` bytes before; before a text's first byte there are zeros."""
    key = data.astype(np.uint64)
    place = np.arange(len(data)) - np.repeat(starts[:-1], np.diff(starts))
    for back in range(1, order + 1):
        earlier = np.zeros(len(data), np.uint64)
        earlier[back:] = data[:-back] if back else data
        key |= np.where(place >= back, earlier, 0).astype(np.uint64) << np.uint64(8 * back)
    return key


def _packed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), starts


def _slots(keys: np.ndarray, order: int) -> np.ndarray:
    """Where keys are counted: short ones by themselves, others by a hash, so that a model has a largest size whatever the
    number of urls. Keys that share a slot count together."""
    return keys if order < 2 else keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)


def _context_slots(keys: np.ndarray, order: int) -> np.ndarray:
    return _slots(keys >> np.uint64(8), order - 1)


def _counted(texts: list[bytes], order: int) -> tuple[np.ndarray, ...]:
    """(n-gram, its slot, its context's slot, how often it occurs) of each distinct n-gram."""
    grams, counts = np.unique(_keys(*_packed(texts), order), return_counts=True)
    return grams, _slots(grams, order), _context_slots(grams, order), counts


def _summed(slots: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    unique, at = np.unique(slots, return_inverse=True)
    return unique, *(np.bincount(at, weights=v, minlength=len(unique)) for v in values)


def fit(texts: list[bytes]) -> Markov:
    tables = []
    for order in range(ORDER + 1):
        _, slots, contexts, counts = _counted(texts, order)
        tables.append((*_summed(slots, counts), *_summed(contexts, counts, np.ones(len(counts)))))
    return Markov(*map(tuple, zip(*tables, strict=True)))


def _looked_up(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


def log_likelihood(model: Markov, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each text. Each order is smoothed by the next shorter one (Witten-Bell); contexts never seen leave it as it is."""
    chance = np.full(len(data), 1 / 256)
    for order in range(ORDER + 1):
        keys = _keys(data, starts, order)
        slots, context = _slots(keys, order), _context_slots(keys, order)
        total = _looked_up(model.contexts[order], context, model.totals[order])
        kinds = _looked_up(model.contexts[order], context, model.kinds[order])
        count = _looked_up(model.grams[order], slots, model.counts[order])
        seen = total > 0
        chance[seen] = (count[seen] + kinds[seen] * chance[seen]) / (total[seen] + kinds[seen])
    # Each text is summed by itself, so that its score does not depend on the texts beside it.
    sums, filled = np.zeros(len(starts) - 1), np.diff(starts) > 0
    if filled.any():
        sums[filled] = np.add.reduceat(np.log(chance), starts[:-1][filled])
    return sums


@dataclass(frozen=True)
class Judge:
    accepted: Markov
    rejected: Markov
    threshold: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Log-likelihood difference for each character; 0 for empty texts."""
        data, starts = _packed(texts)
        if not len(data):
            return np.zeros(len(texts))
        difference = log_likelihood(self.accepted, data, starts) - log_likelihood(self.rejected, data, starts)
        return difference / np.maximum(np.diff(starts), 1)


def _bins(scores: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(scores, -WIDEST, WIDEST) * STEPS).astype(np.int64)


def _threshold(bins: np.ndarray, accepted: np.ndarray, rejected: np.ndarray) -> float:
    """The limit with the best balanced accuracy, from the numbers of rows in sorted bins; 0 if either kind is missing."""
    if not accepted.sum() or not rejected.sum():
        return 0.0
    # With the limit below position i, the rows before are rejected; it lies between the bins' near ends.
    right = np.concatenate(([0], np.cumsum(rejected))) / rejected.sum() + 1 - np.concatenate(([0], np.cumsum(accepted))) / accepted.sum()
    edges = np.concatenate(([bins[0] - STEPS], (bins[1:] + bins[:-1] + 1) / 2, [bins[-1] + 1 + STEPS])) / STEPS
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


def calibrate(rows: list[tuple[bytes, bool]]) -> Judge | None:
    """``train`` for rows (text, accepted) at hand: fit to three of four, the threshold from the others."""
    rows = [r for r in rows if r[0]]
    fitted, held = [r for i, r in enumerate(rows) if i % 4], [r for i, r in enumerate(rows) if not i % 4]
    if len({ok for _, ok in fitted}) < 2:
        return None
    judge = Judge(fit([t for t, ok in fitted if ok]), fit([t for t, ok in fitted if not ok]), 0.0)
    accepted = np.array([ok for _, ok in held], float)
    bins, yes, no = _summed(_bins(judge.scores([t for t, _ in held])), accepted, 1 - accepted)
    return Judge(judge.accepted, judge.rejected, _threshold(bins, yes, no))


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, kinds = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()
        for accepted in (True, False):
            for part in _slices([t for t, ok in zip(texts, kinds, strict=True) if ok is accepted]):
                for order in range(ORDER + 1):
                    grams, *more = (x.astype(np.int64) for x in _counted(part, order))
                    given = [np.full(len(grams), accepted), np.full(len(grams), order, np.int32), grams, *more]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in given], names=["accepted", "length", "gram", "slot", "context", "n"])


def fit_all(urls: DataFrame) -> tuple[Markov, Markov] | None:
    """The models of accepted and rejected urls (text, accepted), each row of them counted; None if either kind is missing.

    N-grams are counted as relations. What comes to the driver are their sums by slot: as many rows as slots at most."""
    keys = ["accepted", "length", "gram", "slot", "context"]
    grams = written(urls.mapInArrow(_gram_rows, GRAMS).groupBy(*keys).agg(F.sum("n").alias("n")), "url-grams")
    slots = grams.groupBy("accepted", "length", F.col("slot").alias("key")).agg(F.sum("n").alias("n"), F.lit(0).cast("bigint").alias("kinds"))
    contexts = grams.groupBy("accepted", "length", F.col("context").alias("key")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))

    def columns(sums: DataFrame) -> list[np.ndarray]:
        table = sums.toArrow()
        return [table.column(c).to_numpy() for c in ("accepted", "length", "key", "n", "kinds")]

    found = {False: columns(slots), True: columns(contexts)}
    models = []
    for accepted in (True, False):
        tables = []
        for order in range(ORDER + 1):
            row = []
            for is_context, (kind, length, key, n, kinds) in found.items():
                own = np.flatnonzero((kind == accepted) & (length == order))
                own = own[np.argsort(key[own])]
                row += [key[own].astype(np.uint64), n[own].astype(float), *([kinds[own].astype(float)] if is_context else [])]
            tables.append(row)
        if not len(tables[0][0]):
            return None
        models.append(Markov(*map(tuple, zip(*tables, strict=True))))
    return models[0], models[1]


def train(ruled: DataFrame) -> Judge | None:
    """Learn from all urls that rules decide (text, verdict), whole and each once: three of four, by hash, are fitted; the
    threshold is the one with the best balanced accuracy on all others, to a part in STEPS. None if either kind is missing."""
    known = ruled.filter("verdict is not null and text <> ''").select("text", (F.col("verdict") == "allow").alias("accepted")).distinct()
    known = written(known.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(4)) == 0), "url-known")
    models = fit_all(known.filter("not held").select("text", "accepted"))
    if models is None:
        return None
    score = F.greatest(F.least(model_score(F.col("text"), Judge(*models, 0.0)), F.lit(float(WIDEST))), F.lit(-float(WIDEST)))
    held = known.filter("held").select("accepted", F.floor(score * STEPS).alias("bin"))
    counted = held.groupBy("bin").agg(F.count_if("accepted").alias("yes"), F.count_if(~F.col("accepted")).alias("no")).orderBy("bin").toArrow()
    return Judge(*models, _threshold(*(counted.column(c).to_numpy() for c in ("bin", "yes", "no"))))


def model_score(text: Column, judge: Judge | None) -> Column:
    packed, held = pickle.dumps(judge), []

    def each(texts: pa.Array) -> pa.Array:
        if not held:  # once a task, not for each batch
            held.append(pickle.loads(packed))
        own = held[0]
        values = [v or b"" for v in texts.cast(pa.binary()).to_pylist()]
        out = np.zeros(len(values))
        if own is not None:
            for at in range(0, len(values), 2000):
                out[at : at + 2000] = own.scores(values[at : at + 2000])
        return pa.array(out, pa.float64())

    return F.arrow_udf(each, "double")(text)


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row (page_id, host, path, rule, verdict, score) per page.

    The verdict is the rule's; where none fits, a page is allowed if its score (the models' log-likelihood difference for
    each character of host and path) reaches the calibrated threshold. Null and malformed urls have no host, no path and
    score 0, and are blocked. If the rules decide no urls of one kind, nothing is learned and the rest is allowed. Repeated
    rows repeat their result, no rows give no rows, other columns aren't looked at.
    """
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = split.withColumn("_found", rule_for(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", "_found.rule", "_found.verdict", F.concat("host", "path").alias("text")
    )
    judge = train(ruled)
    scored = ruled.withColumn("score", model_score(F.col("text"), judge))
    threshold = judge.threshold if judge else 0.0
    own = F.when((F.col("text") != "") & (F.col("score") >= threshold), "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "score")
