"""Secret scans through a trigram index: Boolean queries from the rules, posting intersection, verification."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants, _parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, row_key, written


@dataclass(frozen=True)
class Rule:
    """A regex that Java and Python read alike; a match counts if its group has min_length code points or more."""

    kind: str
    pattern: str
    group: int
    min_length: int


# Fixed values of the contract, in its order. [0-9a-f]{24,} finds the runs of [0-9a-f]+ that have 24 or more.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Published token formats that the index finds at no further pass over the texts.
MORE_RULES = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
_LIMIT = 64  # alternatives a derivation may hold before it gives a factor up


def _exact(items) -> set[str] | None:
    """All lower-case strings the items can match, if they are few."""
    found = {""}
    for op, value in items:
        if op is _constants.LITERAL:
            more = {chr(value).lower()}
        elif op is _constants.IN and all(o is _constants.LITERAL for o, _ in value):
            more = {chr(v).lower() for _, v in value}
        elif op is _constants.SUBPATTERN:
            more = _exact(value[3])
        elif op is _constants.BRANCH:
            parts = [_exact(x) for x in value[1]]
            more = None if None in parts else set().union(*parts)
        elif op is _constants.MAX_REPEAT and value[1] == 1:
            inner = _exact(value[2])
            more = None if inner is None else inner | ({""} if value[0] == 0 else set())
        else:
            more = None
        if more is None or len(found) * len(more) > _LIMIT:
            return None
        found = {a + b for a, b in product(found, more)}
    return found


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The Boolean query of a regex in disjunctive form: every match's text, in lower case, holds all trigrams of one of
    the sets. An empty list: no trigram is mandatory, and the rule must scan everything."""
    factors: list[set[str]] = []
    run: list = []

    def flush() -> None:
        if run and (strings := _exact(run)):
            factors.append(strings)
        run.clear()

    for item in _parser.parse(pattern):
        if _exact([*run, item]) is not None:
            run.append(item)
            continue
        flush()
        if _exact([item]) is not None:
            run.append(item)
    flush()
    choices = []
    for strings in factors:
        if all(len(s) >= 3 for s in strings):
            choices.append({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})
    found: set[frozenset[str]] = set()
    for picked in product(*choices) if choices else ():
        found.add(frozenset().union(*picked))
        if len(found) > _LIMIT:
            return sorted(choices[0], key=sorted)
    # A set that holds another adds nothing.
    return sorted((s for s in found if not any(o < s for o in found)), key=sorted)


def postings(texts: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, key) of the texts (key, text) that hold a gram of the rules, in either case; each pair once a row."""
    anywhere = "(?=(" + "|".join(re.escape(g) for g in grams) + "))"
    held = F.array_distinct(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(anywhere), F.lit(1)))
    return texts.select("key", F.explode(held).alias("gram"))


def _matches(text: Column, rule: Rule, order: int) -> Column:
    """array of (kind, idx, gap, len, ok): each match with the text's length since the match before."""
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("m"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("g"),
        F.split(text, rule.pattern, -1).alias("p"),
    )
    rows = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(order).alias("kind"),
            i.alias("idx"),
            F.length(x["p"]).alias("gap"),
            F.length(x["m"]).alias("len"),
            (F.length(x["g"]) >= rule.min_length).alias("ok"),
        ),
    )
    return F.filter(rows, lambda x: x["len"].isNotNull())


_NONE = "CAST(array() AS array<struct<kind:int,idx:int,gap:int,len:int,ok:boolean>>)"


def candidates(texts: DataFrame, rules: dict[int, Rule]) -> DataFrame:
    """(key, rules): the texts whose postings meet a rule's Boolean query."""
    plan = [
        (order, choice, gram, len(grams))
        for order, rule in rules.items()
        for choice, grams in enumerate(trigram_query(rule.pattern))
        for gram in sorted(grams)
    ]
    wanted = texts.sparkSession.createDataFrame(plan, "rule int, choice int, gram string, need int")
    met = (
        postings(texts, sorted({p[2] for p in plan}))
        .join(wanted, "gram")
        .groupBy("key", "rule", "choice", "need")
        .agg(F.size(F.collect_set("gram")).alias("held"))
        .filter("held = need")
    )
    return met.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def spans(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, kind, start, end) of every counting match in texts (key, text); kind is the rule's position in the list.

    Offsets are code points, the end exclusive. Matches of a rule are leftmost and don't overlap.
    """
    numbered = dict(enumerate(rules))
    indexed = {i: r for i, r in numbered.items() if trigram_query(r.pattern)}
    scanned = {i: r for i, r in numbered.items() if i not in indexed}
    found = []
    for order, rule in scanned.items():
        hits = texts.filter(F.col("text").rlike(rule.pattern))
        found.append(hits.select("key", F.inline(_matches(F.col("text"), rule, order))))
    if indexed:
        picked = written(candidates(texts, indexed), "secret-candidates")
        arrays = [
            F.when(F.array_contains("rules", order), _matches(F.col("text"), rule, order)).otherwise(F.expr(_NONE))
            for order, rule in indexed.items()
        ]
        found.append(texts.join(picked, "key").select("key", F.inline(F.concat(*arrays))))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    # Repeated rows share a key and have the same matches.
    so_far = Window.partitionBy("key", "kind").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.distinct()
        .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far))
        .filter("ok")
        .select("key", "kind", (F.col("end") - F.col("len")).alias("start"), "end")
    )


def _joined(kinds: Column, chosen: Column) -> Column:
    named = F.transform(
        F.array_sort(chosen),
        lambda x: F.concat_ws(":", kinds[x["kind"]], x["start"].cast("string"), x["end"].cast("string")),
    )
    return F.array_join(named, ",")


def scan(documents: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """One row per document: doc_id, n_<kind> of the base rules, base_sha256, spans.

    Null texts count as empty and have no spans. Rows that repeat doc_id and text repeat their result. No rows give no
    rows. Other columns aren't looked at. Documents meet their spans over a key of doc_id and text, so neither copies
    nor missing ids share one.
    """
    text = F.coalesce("text", F.lit(""))
    texts = documents.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", text.alias("text"))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    grouped = (
        spans(texts.select("key", "text"), rules)
        .groupBy("key")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("found"))
    )
    own = F.filter("found", lambda x: x["kind"] < base)

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{rules[kind].kind}")

    counts = [count(i) for i in range(base)]
    nothing = F.expr("CAST(array() AS array<struct<start:bigint,kind:int,end:bigint>>)")
    return (
        texts.select("key", "doc_id")
        .join(grouped, "key", "left")
        .withColumn("found", F.coalesce("found", nothing))
        .select("doc_id", *counts, F.sha2(_joined(kinds, own), 256).alias("base_sha256"), _joined(kinds, F.col("found")).alias("spans"))
    )


def redacted(documents: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets (where spans overlap: the first's), and
    n_chars, if there is such a column, counted anew for these. All other documents and columns stay as they are."""
    keyed = documents.select(F.struct("*").alias("row"), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    found = spans(keyed.select("key", F.coalesce("row.text", F.lit("")).alias("text")), rules)
    grouped = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    grouped = written(grouped, "secret-spans")
    text, kinds = F.col("row.text"), F.array(*[F.lit(f"<{r.kind}>") for r in rules])

    def step(state: Column, x: Column) -> Column:
        piece = F.substr(text, (state["at"] + 1).cast("int"), (x["start"] - state["at"]).cast("int"))
        out = F.when(x["start"] >= state["at"], F.concat(state["out"], piece, kinds[x["kind"]])).otherwise(state["out"])
        return F.struct(out.alias("out"), F.greatest(state["at"], x["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    rest = lambda s: F.concat(s["out"], F.substr(text, (s["at"] + 1).cast("int")))
    cut = F.when(F.col("spans").isNull(), text).otherwise(F.aggregate("spans", start, step, rest))
    joined = keyed.join(grouped, "key", "left").select("row", "spans", cut.alias("cut"))
    length = F.when(F.col("spans").isNull(), F.col("row")["n_chars"]).otherwise(F.length("cut").cast("bigint")) if "n_chars" in documents.columns else None
    anew = {"text": F.col("cut"), "n_chars": length}
    return joined.select(*[(anew[c] if c in anew else F.col("row")[c]).alias(c) for c in documents.columns])
