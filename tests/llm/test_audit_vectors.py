import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.llm import divergence, topk, whitening
from tests.llm import fixture

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_audit(rows, least, top):
    """rows: [(text, lang, source)] -> the rows of ``audit``, by the definition over all kept terms."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[1] for r in rows}:
        mine = [(Counter(LETTERS.findall(t.translate(UPPER))), s) for t, la, s in rows if la == lang]
        docs = Counter(w for c, _ in mine for w in c)
        kept = sorted(w for w, n in docs.items() if n >= least)
        counts = defaultdict(Counter)
        for c, s in mine:
            counts[s].update({w: c[w] for w in kept if c[w]})

        def share(c):
            total = sum(c.values()) + 2 * len(kept)
            return {w: 1 + 1_000_000_000 * (c[w] + 2) // total for w in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)
        p = {s: share(counts[s]) for s in {s for _, s in mine}}
        q = share(sum(counts.values(), Counter()))
        for s in p:
            pair = [(-sum(f(p[s][w], p[o][w]) for w in kept), o.encode()) for o in p if o != s]
            term = [(-f(p[s][w], q[w]), w.encode()) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                out += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(found)[:most])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least", [1, 3])
def test_audit_equals_brute_force(spark, least):
    rows = [(r[1], r[2], r[3]) for r in fixture.rows()]
    found = divergence.audit(fixture.documents(spark), least=least, top=4)
    assert got(found) == brute_audit(rows, least, 4)


def test_audit_shared_paths_long_texts_and_batches(spark):
    """Many terms of one pattern, a long text, one long word, sources without terms; small Arrow batches split branches."""
    common = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400))
    rows = [(common, "en", s) for s in "abc"] * 2 + [(common * 500, "en", "d"), ("x" * 3_000_000, "en", "a"), (None, "en", "e"),
                                                    ("zz", None, None), ("zz", None, "k"), ("", "fr", "a")]
    docs = spark.createDataFrame([(i, *r, "n") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert got(divergence.audit(docs, least=1)) == brute_audit(rows, 1, 10)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_audit_few_terms_and_empty(spark):
    rows = [(f"rare{chr(97 + i)}", "en", s) for i, s in enumerate("aab")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert got(divergence.audit(docs)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert divergence.audit(fixture.empty(spark)).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, score double, rank int, n long, key string, block long"


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, 0.0, 0, 0, "k", 0) for i, v in rows], VECTORS).repartition(parts)


def odd_vectors():
    rnd = np.random.default_rng(5)
    near = rnd.standard_normal(8)
    rows = [(i, (rnd.standard_normal(8) + (2 * near if i % 3 == 0 else 0)).tolist()) for i in range(420)]
    rows += [(500 + i, rows[7][1]) for i in range(150)]                         # more copies than k and than a block
    rows += [(700, rows[7][1]), (700, rows[7][1]), (None, rows[7][1]), (None, [9.0] * 8), (800, [0.0] * 8), (900, []), (901, [1.0, 2.0]),
             (1000, None), (1100, [1.0, None]), (1200, [float("nan")] * 8), (1300, [float("inf")] * 8)]
    return rows


def usable(rows, scale, d):
    return [(i, [math.floor(scale * float(np.float32(c))) for c in v] + [0] * (d - len(v))) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def brute_topk(rows, every, k):
    rows, out = usable(rows, 1024, 8), []
    for a, (i, x) in enumerate(rows):
        if i is not None and i % every == 0:
            s = sorted((-sum(p * q for p, q in zip(x, y)), j is None, j or 0) for b, (j, y) in enumerate(rows) if b != a)
            out += [(i, r + 1, None if none else j, -v) for r, (v, none, j) in enumerate(s[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("span,group", [(topk.SPAN, topk.GROUP_BYTES), (2, 64 * 8 * 3)])
def test_topk_equals_brute_force(spark, monkeypatch, span, group):
    monkeypatch.setattr(topk, "SPAN", span)
    monkeypatch.setattr(topk, "GROUP_BYTES", group)                             # several groups of queries
    monkeypatch.setattr(topk, "BLOCK", 32)
    rows, every = odd_vectors(), 20 if group < 10_000 else 50
    found = topk.exact_topk(vectors(spark, rows), F.col("vec_id") % every == 0)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_topk(rows, every, 10)


def test_topk_few_rows_and_large_entries(spark):
    few = [(0, [1.0, 2.0]), (1, [-1.0, 0.5])]
    found = topk.exact_topk(vectors(spark, few), F.col("vec_id") % 100 == 0)
    assert got(found) == [(0, 1, 1, 0)]
    assert topk.exact_topk(vectors(spark, few[:1]), F.col("vec_id") % 100 == 0).count() == 0
    assert topk.exact_topk(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    big = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 0.0]), (3, [3.0, 0.0])]
    found = topk.exact_topk(vectors(spark, big), F.col("vec_id") % 100 == 0)
    top = (1 << 63) - 1
    assert got(found) == [(0, 1, 1, top), (0, 2, 3, top), (0, 3, 2, -top - 1)]


def test_topk_prunes(spark):
    """With clusters a query scores few blocks: bounds of the others fall below its k-th best."""
    rnd = np.random.default_rng(3)
    centres = rnd.standard_normal((8, 16)) * 3
    x = np.floor(1024 * (centres.repeat(64, 0) + 0.05 * rnd.standard_normal((512, 16)))).astype(np.int64)
    high, low = x.reshape(8, 64, 16).max(axis=1), x.reshape(8, 64, 16).min(axis=1)
    bound, exact = topk.bounds(x, high, low), x @ x.T
    assert (bound >= exact.reshape(512, 8, 64).max(axis=2)).all()
    tenth = np.sort(exact, axis=1)[:, -10]
    assert (bound >= tenth[:, None]).sum(axis=1).mean() < 3


def check_whitening(rows, found, d, expect=None):
    rows = usable(rows, 256, d)
    x = np.array([v for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    a = fit - s / n
    values, basis = np.linalg.eigh(a.T @ a / n)
    values, basis = values[::-1], basis[:, ::-1]
    k = expect or min(4, d)
    assert len(found) == len(rows) * k
    by = defaultdict(list)
    for r in found:
        by[r["component"]].append(r)
        assert r["n"] == n and abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-9
        assert r["identity_error"] < 1e-9
    want = sorted((-1 if i is None else i, int(((n * v - s) ** 2).sum())) for (i, _), v in zip(rows, x))
    for c in range(k):
        mine = by[c + 1]
        assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["deviation"]) for r in mine) == want
        gap = min([abs(values[c] - values[j]) for j in range(d) if j != c] or [1])
        if gap > 1e-6 * values[0]:
            exact = {(i, tuple(v)): float((np.array(v) - s / n) @ basis[:, c] / np.sqrt(values[c])) for i, v in rows}
            signs = {round(r["whitened"], 7) for r in mine}
            up, down = {round(y, 7) for y in exact.values()}, {round(-y, 7) for y in exact.values()}
            assert signs in (up, down) or min(max(abs(p - q) for p, q in zip(sorted(signs), sorted(t))) for t in (up, down)) < 1e-6


def test_whitening_equals_eigh(spark):
    rows = odd_vectors()
    check_whitening(rows, whitening.whiten(vectors(spark, rows)).collect(), 8)


def test_whitening_repeated_deviations_and_low_rank(spark):
    cube = [(i, [float(i >> b & 1) for b in range(5)]) for i in range(32)]       # all deviations equal
    check_whitening(cube, whitening.whiten(vectors(spark, cube)).collect(), 5)
    flat = [(i, [float(i), 2.0 * i, float(i % 4), 1.0, 1.0]) for i in range(40)]  # rank 2
    check_whitening(flat, whitening.whiten(vectors(spark, flat)).collect(), 5, expect=2)
    line = [(0, [1.0, 2.0]), (1, [3.0, 5.0]), (1, [3.0, 5.0])]
    check_whitening(line, whitening.whiten(vectors(spark, line)).collect(), 2, expect=1)


def test_whitening_without_spread(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])] * 3, [(1, [])]):
        found = whitening.whiten(vectors(spark, rows))
        assert found.count() == 0 and len(found.columns) == 7


def test_whitening_large_entries(spark):
    rows = [(i, [1e30 * (-1) ** i, float(i), 2.0 * (i % 3)]) for i in range(9)]
    found = whitening.whiten(vectors(spark, rows)).collect()
    assert len(found) >= 9 and all(r["deviation"] is None for r in found)        # beyond long
    assert all(math.isfinite(r["whitened"]) for r in found)


def test_bidiagonalisation_stops_early(spark):
    rnd = np.random.default_rng(2)
    a = rnd.standard_normal((300, 40)) * (0.5 ** np.arange(40))
    passes = []
    s, v = whitening.bidiagonalise(lambda w: passes.append(1) or a.T @ (a @ w), 40, 4, float((a * a).sum()))
    u, t, q = np.linalg.svd(a)
    assert np.allclose(s, t[:4], rtol=1e-12) and np.allclose(np.abs((v * q[:4]).sum(axis=1)), 1, atol=1e-12)
    assert len(passes) < 30
