import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tandem.llm import katz
from tandem.llm.queries import remainder
from tests.llm import fixture
from tests.llm.test_tokens import split

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*split((text or "").translate(LOWER)), None]


def brute(train, score):
    uni, bi, begins = Counter(), Counter(), len(train)
    for t in train:
        prev = "<s>"
        for w in tokens(t):
            uni[w] += 1
            bi[prev, w] += 1
            prev = (w,)
    n = sum(uni.values())
    seen = lambda c: [sum(v == r for v in c.values()) for r in range(1, katz.K + 2)]
    d1, d2 = katz.discounts(seen(uni)), katz.discounts(seen(bi))
    left = sum((1 - d1[min(c, katz.K)]) * c for c in uni.values() if c <= katz.K)
    den = n if left > 0 else n + 1
    unk = left / n if left > 0 else 1 / (n + 1)
    d = lambda table, c: table[c] if c <= katz.K else 1.0
    p1 = lambda w: d(d1, uni[w]) * uni[w] / den if uni[w] else unk
    follow = defaultdict(list)
    for (h, w), c in bi.items():
        follow[h].append((w, c))
    assert abs(sum(p1(w) for w in uni) + unk - 1) < 1e-9

    def model(h):
        ch = begins if h == "<s>" else uni[h[0]]
        more = follow[h]
        free = sum((1 - d(d2, c)) * c for _, c in more)
        total, free = (ch, free) if free > 1e-15 else (ch + 1, 1.0)
        p = {w: d(d2, c) * c / total for w, c in more}
        alpha = free / total / (1 - sum(p1(w) for w in p))
        return p, alpha

    cache = {}
    out = []
    for t in score:
        lp, base, known, prev = 0.0, 0.0, 0, "<s>"
        for w in tokens(t):
            if prev not in cache:
                cache[prev] = model(prev) if prev in follow else ({}, 1.0)
                p, a = cache[prev]
                whole = sum(p.values()) + a * (unk + sum(p1(x) for x in uni if x not in p))
                assert abs(whole - 1) < 1e-9
            p, a = cache[prev]
            lp += math.log10(p[w] if w in p else a * p1(w))
            base += math.log10((uni[w] + 0.1) / (n + 0.1 * (len(uni) + 1)))
            known += uni[w] > 0
            prev = (w,)
        out.append((len(tokens(t)), known, n, base, lp))
    return out


@pytest.mark.parametrize("chunk, hot", [(10**6, 10**6), (150, 40)])
def test_scores_equal_brute_force(spark, chunk, hot):
    docs = fixture.documents(spark).select("*", (remainder("doc_id", 10) == 0).alias("held"))
    got = {(r.doc_id, r.n_tokens): r for r in katz.katz_scores(docs, "held", chunk_tokens=chunk, hot=hot).collect()}
    rows = docs.select("doc_id", "text", "held").collect()
    want = brute([r.text for r in rows if not r.held], [r.text for r in rows])
    assert any(r.held for r in rows)
    for r, w in zip(rows, want):
        g = got[r.doc_id, w[0]]
        assert (g.held_out, g.n_known, g.train_tokens) == (r.held, w[1], w[2])
        assert g.base_score == pytest.approx(w[3], abs=1e-6) and g.score == pytest.approx(w[4], abs=1e-6)


def test_without_training_rows_and_empty(spark):
    docs = fixture.documents(spark).withColumn("held", F.lit(True))
    got = katz.katz_scores(docs, "held").agg(F.count("*"), F.max(F.abs("score")), F.sum("n_known")).first()
    assert tuple(got) == (len(fixture.rows()), 0.0, 0)
    none = fixture.empty(spark).withColumn("held", F.lit(False))
    assert katz.katz_scores(none, "held").count() == 0


def test_pack_round_trip():
    import numpy as np
    for a in (np.zeros(0, np.int64), np.arange(300), np.array([2**63], np.uint64), np.array([0.5, -1.25])):
        assert (katz.unpack(katz.pack(a)).view(np.uint64) == a.astype(np.int64 if a.dtype.kind in "iu" else float).view(np.uint64)).all()
