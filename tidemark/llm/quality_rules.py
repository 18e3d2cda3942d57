"""Quality rules: a decision list learned by sequential covering, applied as a Spark expression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, WORD_CLASS, labelled_texts

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATISTICS = ("n_words", "word_length", "symbol_share", "repeat_share", "dup_line_share", "capital_share", "bang_share")


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.statistic) >= self.threshold if self.at_least else F.col(self.statistic) <= self.threshold

    def holds(self, data: dict[str, np.ndarray]) -> np.ndarray:
        values = data[self.statistic]
        return values >= self.threshold if self.at_least else values <= self.threshold


Rule = tuple[Condition, ...]


def _without(text: Column, characters: str) -> Column:
    """How many of these characters the text has."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measured(documents: DataFrame, *kept: str) -> DataFrame:
    """The kept columns with base counts and the statistics that rules test; null texts count as empty."""
    text = F.col("text")
    no_longs, no_ints = F.expr("CAST(array() AS array<bigint>)"), F.expr("CAST(array() AS array<int>)")
    rows = documents.select(*kept, F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        *kept,
        F.array_remove(F.split(text, SPACE_CLASS + "+", -1), "").alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD_CLASS)).alias("lines"),
        (F.length(text) - _without(text, SPACES)).cast("bigint").alias("word_chars"),
        _without(text, SYMBOLS).cast("bigint").alias("n_symbols"),
        _without(text, CAPITALS).alias("n_capitals"),
        _without(text, "!").alias("n_bangs"),
    )
    word = F.col("words")
    triple = F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(word[i], word[i + 1], word[i + 2]))
    rows = rows.select(
        *kept, "word_chars", "n_symbols", "n_capitals", "n_bangs",
        F.size("words").cast("bigint").alias("n_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("words") >= 3, triple).otherwise(no_longs).alias("triples"),
    )
    # Only texts that repeat a window are sorted: equal windows then lie side by side, and their places can be counted.
    ordered = F.array_sort(F.transform("triples", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    nothing = F.expr("CAST(array() AS array<struct<h:bigint,i:int>>)")
    rows = rows.withColumn(
        "ordered", F.when(F.size(F.array_distinct("triples")) < F.size("triples"), ordered).otherwise(nothing)
    ).drop("triples")
    near = F.col("ordered")
    twice = lambda x, i: F.when((F.get(near, i - 1)["h"] == x["h"]) | (F.get(near, i + 1)["h"] == x["h"]), x["i"])
    rows = rows.withColumn("places", F.sort_array(F.array_compact(F.transform("ordered", twice))))
    state = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("total"))
    covered = F.aggregate(
        "places",
        state,
        lambda s, p: F.struct(p.alias("last"), (s["total"] + F.least(F.lit(3), p - s["last"])).alias("total")),
        lambda s: s["total"],
    )
    rows = rows.withColumn("n_repeat_words", covered)
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    result = F.struct(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("word_length"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_capitals", "word_chars").alias("capital_share"),
        share("n_bangs", "word_chars").alias("bang_share"),
    )
    # A filter on a result is not pushed below a generator; below these projections it would split the text anew for
    # each element of the arrays.
    return rows.select(F.inline(F.array(result)))


def _counts(mask: np.ndarray, bad: np.ndarray) -> tuple[int, int]:
    return int((mask & bad).sum()), int((mask & ~bad).sum())


def _grown(data: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray], longest: int) -> list[Condition]:
    """Add the condition of the highest information gain until no good row is covered or nothing gains."""
    rule: list[Condition] = []
    mask = np.ones(len(bad), bool)
    while len(rule) < longest:
        p0, n0 = _counts(mask, bad)
        if not p0 or not n0:
            break
        best, best_gain = None, 1e-9
        for name, thresholds in cuts.items():
            for threshold in thresholds:
                for at_least in (True, False):
                    condition = Condition(name, at_least, float(threshold))
                    p, n = _counts(mask & condition.holds(data), bad)
                    if p and (gain := p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))) > best_gain:
                        best, best_gain = condition, gain
        if best is None:
            break
        rule.append(best)
        mask &= best.holds(data)
    return rule


def learn(data: dict[str, np.ndarray], bad: np.ndarray, most_rules: int = 8, longest: int = 4, precision: float = 0.85, least: int = 3, seed: int = 7) -> list[Rule]:
    """An ordered list of conjunctions that mark bad rows.

    Sequential covering: a rule is grown on two thirds of what is left, its last conditions are cut while that doesn't
    lower its worth on the other third, and the rows it covers are taken out. It ends with a rule that covers fewer than
    `least` bad rows or is less precise than asked.
    """
    rules: list[Rule] = []
    if not len(bad) or not bad.any():
        return rules
    part = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    left = np.ones(len(bad), bool)
    cuts = {s: np.unique(np.quantile(data[s], np.linspace(0, 1, 49))) for s in STATISTICS}
    for _ in range(most_rules):
        grow, prune = left & part, left & ~part
        rule = _grown({s: v[grow] for s, v in data.items()}, bad[grow], cuts, longest)

        def covers(conditions: list[Condition], among: np.ndarray) -> np.ndarray:
            return np.logical_and.reduce([among, *[c.holds(data) for c in conditions]])

        def worth(conditions: list[Condition], prune: np.ndarray = prune) -> float:
            p, n = _counts(covers(conditions, prune), bad)
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        if not rule:
            break
        p, n = _counts(covers(rule, left), bad)
        if p < least or p < precision * (p + n):
            break
        rules.append(tuple(rule))
        left &= ~covers(rule, left)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """true to keep: the first rule that holds drops a document, the default keeps it."""
    out = None
    for rule in rules:
        met = rule[0].column()
        for condition in rule[1:]:
            met &= condition.column()
        out = F.when(met, F.lit(False)) if out is None else out.when(met, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def training_rows(documents: DataFrame, labels: DataFrame, limit: int = 10_000) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Statistics and badness (quality 0) of at most `limit` different texts of labelled documents, the ones with the
    smallest hashes; rows without a document, id or label are left out."""
    own = labelled_texts(documents, labels, limit)
    rows = measured(own, "doc_id", "quality").select("doc_id", "quality", *STATISTICS).collect()
    rows.sort()  # learn() splits them by their place
    data = {s: np.array([r[s] for r in rows], float) for s in STATISTICS}
    return data, np.array([r.quality == 0 for r in rows], bool)


def filtered(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) per document.

    Null and empty texts have zero counts and fail the base. Without rules all that pass the base are kept. Repeated rows
    repeat their result, no rows give no rows, other columns aren't looked at.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured(documents, "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )


def quality_filter(documents: DataFrame, labels: DataFrame, limit: int = 10_000) -> DataFrame:
    return filtered(documents, learn(*training_rows(documents, labels, limit)))
