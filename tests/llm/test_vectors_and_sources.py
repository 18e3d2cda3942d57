"""Nearest neighbours, whitening and the source audit against brute force, and on odd input."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence, neighbours, queries, whitening

VECTORS = "vec_id bigint, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def embeddings(spark, vectors, more=()):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], VECTORS).select("*", *[F.lit("x").alias(c) for c in more])


def near_by_brute_force(vectors, k=10):
    """{query: [(score, vec_id)]} over distinct (vec_id, vector) rows."""
    width = max((len(v) for _, v in vectors), default=0)
    rows = sorted({(i, tuple([*v, *[0.0] * (width - len(v))])) for i, v in vectors})
    own = np.array([np.float32(v) for _, v in rows], dtype=float).reshape(len(rows), width)
    out = {}
    for at, (i, _) in enumerate(rows):
        if i % 100 == 0:
            d = np.sqrt(((own - own[at]) ** 2).sum(axis=1))
            out[i] = sorted((d[j], rows[j][0]) for j in range(len(rows)) if j != at)[:k]
    return out


def found_near(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append(r)
    return out


def test_neighbours_query_has_the_nearest(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    expected = near_by_brute_force([(r.vec_id, r.embedding) for r in rows])
    found = found_near(queries.QUERIES["op11_nearest_neighbours"](spark, sf_dir))
    assert set(found) == set(expected)
    right = 0
    for q, near in expected.items():
        own = found[q]
        assert [r.rank for r in own] == list(range(1, len(near) + 1))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        right += len({r.vec_id for r in own} & {i for _, i in near})
    assert right >= 0.98 * sum(map(len, expected.values()))


def test_descent_and_search_without_comparing_all(spark):
    """Chunks of 50 of 3,000 rows: the graph has to come from turns of neighbours of neighbours."""
    rng = np.random.default_rng(3)
    vectors = [(int(i), rng.normal(size=12).tolist()) for i in range(3000)]
    settings = neighbours.Settings(degree=16, reverse=8, chunk=50, beam=80, width=16)
    found = found_near(neighbours.nearest(embeddings(spark, vectors), F.col("vec_id") % 100 == 0, settings=settings))
    expected = near_by_brute_force(vectors)
    right = sum(len({r.vec_id for r in found[q]} & {i for _, i in near}) for q, near in expected.items())
    assert right >= 0.95 * 300
    for q, near in expected.items():
        scores = dict((i, d) for d, i in near)
        assert all(math.isclose(r.score, scores[r.vec_id], rel_tol=1e-12) for r in found[q] if r.vec_id in scores)


def test_neighbours_of_equal_and_close_vectors(spark):
    """A third of all rows share one vector, another third lie close around it."""
    rng = random.Random(5)
    same = [1.0, 2.0, 3.0, 4.0]
    vectors = [(i, same) for i in range(400)]
    vectors += [(i, [c + rng.random() / 64 for c in same]) for i in range(400, 800)]
    vectors += [(i, [rng.gauss(0, 3) for _ in same]) for i in range(800, 1200)]
    found = found_near(neighbours.nearest(embeddings(spark, vectors), F.col("vec_id") % 100 == 0))
    expected = near_by_brute_force(vectors)
    for q in (0, 100, 200, 300):
        assert [(r.vec_id, r.score) for r in found[q]] == [(i, 0.0) for i in range(11) if i != q][:10]
    right = sum(len({r.vec_id for r in found[q]} & {i for _, i in near}) for q, near in expected.items())
    assert right >= 0.95 * sum(map(len, expected.values()))


def test_neighbours_of_odd_rows(spark):
    good = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [2.0]), (4, [0.0, 3.0]), (200, [0.0, 4.0])]
    bad = [(5, None), (300, [0.0, 0.0]), (6, [NAN, 1.0]), (7, [INF, 1.0]), (8, [None, 1.0]), (9, []), (None, [1.0, 1.0])]
    for more in ([], "id v code a b d q c open ids rows rank score found near".split()):
        found = found_near(neighbours.nearest(embeddings(spark, good + bad, more), F.col("vec_id") % 100 == 0))
        got = {q: [(r.vec_id, round(r.score, 6)) for r in own] for q, own in found.items()}
        assert got == {q: [(i, round(d, 6)) for d, i in near] for q, near in near_by_brute_force(good).items()}
    assert neighbours.nearest(embeddings(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert neighbours.nearest(embeddings(spark, bad), F.col("vec_id") % 100 == 0).count() == 0
    assert neighbours.nearest(embeddings(spark, [(0, [1.0])]), F.col("vec_id") % 100 == 0).count() == 0


# --- whitening


def whitened_by_numpy(vectors, most=8, one=False):
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in vectors]
    fit = sorted(set(map(tuple, x))) if one else x
    n, d = len(fit), len(x[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    centred = np.array([[(n * v[i] - sums[i]) / n for i in range(d)] for v in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = np.array([[(n * v[i] - sums[i]) / n for i in range(d)] for v in x]) @ axes[:, :most] / np.sqrt(values[:most])
    return n, [sum((n * v[i] - sums[i]) ** 2 for i in range(d)) for v in x], out, values[:most] / values.sum()


@pytest.mark.parametrize("one", [False, True])
def test_whitening_equals_numpy(spark, one):
    rng = np.random.default_rng(9)
    scale = np.array([9, 7, 5, 4, 3, 2.5, 2, 1.5, 1, 0.5])
    vectors = [(i, (rng.normal(size=10) * scale).tolist()) for i in range(300)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(200)]
    found = whitening.whiten(embeddings(spark, vectors), weights="one" if one else "counts").collect()
    n, deviations, z, explained = whitened_by_numpy(vectors, one=one)
    assert len(found) == 8 * len(vectors)
    at = {i: k for k, (i, _) in enumerate(vectors)}
    signs = {}
    for r in found:
        k, j = at[r.vec_id], r.component - 1
        assert (r.n, r.deviation) == (n, deviations[k])
        signs.setdefault(j, round(r.whitened / z[k, j]))
        assert math.isclose(r.whitened, signs[j] * z[k, j], rel_tol=1e-6, abs_tol=1e-7)
        assert math.isclose(r.explained, explained[j], rel_tol=1e-9)
        assert r.identity_error < 1e-9
    assert set(map(abs, signs.values())) == {1}


def test_whitening_query_is_white(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = queries.QUERIES["op13_embedding_whitening"](spark, sf_dir).collect()
    assert Counter(r.vec_id for r in found) == {r.vec_id: 8 for r in rows}
    by_row = defaultdict(dict)
    for r in found:
        by_row[r.vec_id][r.component] = r.whitened
    z = np.array([[own[c] for c in range(1, 9)] for own in by_row.values()])
    assert np.abs(z.T @ z / len(z) - np.eye(8)).max() < 1e-9
    n, deviations, _, explained = whitened_by_numpy([(r.vec_id, r.embedding) for r in rows])
    own = {r.vec_id: r.deviation for r in found}
    assert [own[r.vec_id] for r in rows] == deviations
    assert all(math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-6) for r in found)


def test_whitening_of_odd_rows(spark):
    good = [(1, [0.0, 0.0, 0.0]), (1, [0.0, 0.0, 0.0]), (None, [1.0, 0.5]), (2, [3.0, 1.0, 0.0]), (3, [])]
    bad = [(4, None), (5, [NAN, 1.0, 0.0]), (6, [INF, 0.0, 0.0]), (7, [None, 0.0, 0.0])]
    plain = whitening.whiten(embeddings(spark, good + bad)).collect()
    assert Counter(r.vec_id for r in plain) == {1: 6, None: 3, 2: 3, 3: 3}
    assert {r.n for r in plain} == {5}
    assert all((r.whitened is None) == (r.component > 2) for r in plain)  # the rows lie in a plane
    assert all(r.identity_error < 1e-9 for r in plain)
    wider = whitening.whiten(embeddings(spark, good + bad, "x c n weight rows found deviation z component at v i j".split())).collect()
    key = lambda r: repr((r.vec_id, r.component, r.deviation))
    assert [(r.vec_id, r.component, r.deviation) for r in sorted(plain, key=key)] == [(r.vec_id, r.component, r.deviation) for r in sorted(wider, key=key)]
    assert whitening.whiten(embeddings(spark, [])).count() == 0
    single = whitening.whiten(embeddings(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(single)] == [(1, 0, None, None, None), (2, 0, None, None, None)]


def test_whitening_past_the_longs(spark):
    """Deviations are exact as far as longs go, and null beyond."""
    found = whitening.whiten(embeddings(spark, [(1, [1e12]), (2, [0.0]), (3, [1.0])])).collect()
    own = {r.vec_id: r.deviation for r in found}
    x = [math.floor(1024 * float(np.float32(c))) + 100_000 for c in (1e12, 0.0, 1.0)]
    exact = [(3 * v - sum(x)) ** 2 for v in x]
    assert [own[i] for i in (1, 2, 3)] == [e if e < 1 << 63 else None for e in exact]


# --- source audit


def audit_by_brute_force(docs, least=10, top=10):
    groups, found, n = set(), defaultdict(Counter), defaultdict(set)
    for at, (text, lang, source) in enumerate(docs):
        group = (lang or "", source or "")
        groups.add(group)
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for term in "".join(c if "a" <= c <= "z" or ord(c) >= 128 else " " for c in lowered).split(" "):
            if term:
                found[group][term] += 1
                n[group[0], term].add(at)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for (own, t), where in n.items() if own == lang and len(where) >= least]
        own = {s: found[lang, s] for g, s in groups if g == lang}
        total = {s: sum(c[t] for t in kept) for s, c in own.items()}
        share = lambda count, whole: 1 + 10**9 * (count + 2) // (whole + 2 * len(kept))
        for s in own:
            pairs = [
                (-sum((p - q) ** 2 // (p + q) for t in kept for p, q in [(share(own[s][t], total[s]), share(own[o][t], total[o]))]), o)
                for o in own if o != s
            ]
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, o) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())))}
            marks = []
            for t in kept:
                p, q = share(own[s][t], total[s]), share(sum(c[t] for c in own.values()), sum(total.values()))
                if own[s][t] and p > q:
                    marks.append((-((p - q) ** 2 // (p + q)), t))
            out |= {(lang, s, "term", t, -v, i + 1) for i, (v, t) in enumerate(sorted(marks, key=lambda x: (x[0], x[1].encode()))[:top])}
    return out


def test_audit_equals_brute_force(spark):
    rng = random.Random(2)
    words = ["Ab", "cd", "éé", "İx", "z y", "qu", "ßß", "日本", "w", "v", "u", "t"]
    docs = [
        (" ,1\x85\n"[rng.randrange(5)].join(rng.choices(words, k=rng.randrange(9))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "", None]))
        for _ in range(400)
    ]
    docs += [(None, "xx", "a"), ("", "xx", "b"), ("lonely words", "yy", "a")] + [("hot " * 50, "en", "a")] * 30
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id bigint, text string, lang string, source string")
    expected = audit_by_brute_force(docs)
    assert set(map(tuple, divergence.audit(df).collect())) == expected
    wider = df.select("*", *[F.lit(1).alias(c) for c in "n term docs p q item value rank part kept held total absent".split()])
    assert set(map(tuple, divergence.audit(wider).collect())) == expected
    assert divergence.audit(df.limit(0)).count() == 0


def test_audit_long_texts_and_large_counts(spark, monkeypatch):
    text = ("Ää bb cc9" * 40).encode()
    whole = divergence.term_counts(text)
    monkeypatch.setattr(divergence, "PIECE", 7)
    assert divergence.term_counts(text) == whole == Counter({b"\xc3\xa4\xc3\xa4": 0, **Counter(text.lower().replace(b"\xc3\x84", b"\xc3\x84").translate(divergence.LETTERS).split())}) - Counter()
    row = spark.range(1).select(divergence._share(F.lit(10**12 + 1), F.lit(3 * 10**14), F.lit(10**8)).alias("p")).first()
    assert row.p == 1 + 10**9 * (10**12 + 3) // (3 * 10**14 + 2 * 10**8)
