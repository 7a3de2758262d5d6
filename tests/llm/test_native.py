import hashlib

import pytest
from pyspark.sql import functions as F

from tandem.llm import fingerprint, mixing
from tests.llm import fixture
from tests.llm.test_tokens import split


def brute_targets(sizes, weights):
    total, capped = float(sum(sizes)), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = total - sum(3 * sizes[i] for i in capped)
        share = {i: rest * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] > 3 * sizes[i]}
        if not over:
            return [3.0 * s if i in capped else share[i] for i, s in enumerate(sizes)]
        capped |= over


def brute_mix(rows):
    """rows: [(doc_id, text, source)] -> sorted (doc_id, size, source_size, target, taken)"""
    size = [len(split(t)) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    per = [sum(n for n, r in zip(size, rows) if r[2] == s) for s in names]
    target = brute_targets(per, [[5, 2, 1][i % 3] for i in range(len(names))])
    offers, out = [], {}
    for k, s in enumerate(names):
        mine = sorted((hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest(), r[0] or 0, n, i)
                      for i, (n, r) in enumerate(zip(size, rows)) if r[2] == s)
        done = 0
        for order, _, n, i in mine:
            done += n
            out[i] = [rows[i][0], n, per[k], target[k], 0]
            if n and target[k]:
                offers += [((t * per[k] + done) / target[k], k, order, i, t) for t in range(3)]
    spent = 0
    for _, _, _, i, _ in sorted(offers):
        spent += out[i][1]
        if spent > sum(size):
            break
        out[i][4] += out[i][1]
    return out.values()


def test_mix_equals_brute_force(spark):
    rows = [(r[0], r[1], r[3]) for r in fixture.rows()]
    got = mixing.mix(fixture.documents(spark)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    want = sorted(brute_mix(rows), key=key)
    for g, w in zip(sorted((list(r) for r in got), key=key), want, strict=True):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3]) and g[4] == w[4]
    assert mixing.mix(fixture.empty(spark)).count() == 0


def test_mix_on_a_table(spark):
    from tests.conftest import SF01
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = mixing.mix(docs)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    want = {w[0]: w for w in brute_mix(rows)}
    for r in got.collect():
        assert (r.size, r.source_size, r.taken) == (want[r.doc_id][1], want[r.doc_id][2], want[r.doc_id][4])
    per = got.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("t"), F.first("target").alias("w"), F.max("size").alias("m")).collect()
    assert all(abs(r.t - r.w) <= 2 * r.m for r in per)


def test_fingerprints_equal_brute_force(spark):
    got = fingerprint.fingerprints(fixture.documents(spark)).collect()
    rows = sorted(fixture.rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in rows]
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)

    def sh(t):
        w = split(t)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    def near(a, b):
        a, b = sh(a), sh(b)
        return 1.0 if not a | b else len(a & b) / len(a | b) if len(a | b) < fingerprint.KEEP else None

    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        t, nxt = texts[i], texts[(i + 1) % len(texts)]
        m = len(t) // 4
        edited = t[: len(t) - m] + nxt[:m]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        g = next(x for x in by[r[0]] if x.edited_sha256 == sha and x.n_chars == len(t))
        for have, want in ((g.near_edited, near(t, edited)), (g.near_next, near(t, nxt))):
            assert 0 <= have <= 1 and (want is None or have == pytest.approx(want))
    same = {}
    for r, t in ((r, [x[1] or "" for x in fixture.rows() if x[0] == r.doc_id]) for r in got):
        if len(t) == 1:
            same.setdefault(t[0], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in same.values())
    assert fingerprint.fingerprints(fixture.empty(spark)).count() == 0


def test_sketches_merge_and_estimate(spark):
    words = [f"w{i}" for i in range(3000)]
    a, b = " ".join(words[:2000]), " ".join(words[1000:])
    df = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, c string")
    s = {c: fingerprint.sketch(F.col(c)) for c in "abc"}
    r = df.select(*(v.alias(c) for c, v in s.items())).select(
        fingerprint.resemblance(F.col("a"), F.col("b")).alias("j"), fingerprint.containment(F.col("a"), F.col("b")).alias("c"),
        fingerprint.distinct_shingles(F.col("a")).alias("n"),
        F.size(F.array_except(F.col("c"), fingerprint.merge(F.col("a"), F.col("b")))).alias("lost")).first()
    assert abs(r.j - 1 / 3) < 0.15 and abs(r.c - 0.5) < 0.2 and abs(r.n - 1996) < 700 and r.lost <= 3


def test_one_row(spark):
    df = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")
    r = fingerprint.fingerprints(df).first()
    assert r.near_next == 1.0 and r.n_chars == 15
