import random

import pytest

from tandem.llm import minhash
from tests.llm import fixture
from tests.llm.test_katz import LOWER
from tests.llm.test_tokens import split


def shingles(text):
    w = split((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(docs):
    """docs: [(doc_id, text)] -> {doc_id: component} by all pairs."""
    sets = [(d, shingles(t)) for d, t in docs]
    up = {d: d for d, _ in docs}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {d: root(d) for d, _ in docs}, {d: len(s) for d, s in sets}


def check(spark, docs):
    want, sizes = brute(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = minhash.near_duplicates(frame).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(docs)


def test_fixture_equals_brute_force(spark):
    check(spark, [(r[0], r[1]) for r in {r[0]: r for r in fixture.rows() if r[0] is not None}.values()])


@pytest.mark.parametrize("small,block", [(32, 2048), (3, 2048), (3, 4)])
def test_families_at_all_similarities(spark, small, block, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    docs = []
    passage = [word() for _ in range(60)]
    for _ in range(8):
        base = [word() for _ in range(120)] + passage
        for k in range(12):
            w = list(base)
            for _ in range(rnd.randint(0, 9)):
                w[rnd.randrange(len(w))] = word()
            docs.append(" ".join(w))
    docs += docs[:5]
    check(spark, list(enumerate(docs)))


def test_split_of_large_groups_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 1)            # every group is large
    monkeypatch.setattr(minhash, "FIRST_BANDS", 1)
    monkeypatch.setattr(minhash, "PARTNERS", 1)         # pairs that share no neighbouring bands are common
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    docs = []
    for _ in range(200):
        base = [word() for _ in range(100)]
        docs += [" ".join(base), " ".join([word() for _ in range(13)] + base[13:])]
    check(spark, list(enumerate(docs)))


def test_odd_rows_and_empty(spark):
    got = minhash.near_duplicates(fixture.documents(spark)).collect()
    assert len(got) == len(fixture.rows())
    assert [(r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None] == [(1, None, True)]
    assert minhash.near_duplicates(fixture.empty(spark)).count() == 0


def test_estimates_follow_similarity():
    import numpy as np
    import pyarrow as pa
    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join(words), " ".join(words[:1600] + [f"x{i}" for i in range(400)])]
    h, b = minhash.shingle_sets(pa.array(texts))
    sig = minhash.signatures(h, b)
    s = len(np.intersect1d(h[:b[1]], h[b[1]:])) / len(np.unique(h))
    assert abs((sig[0] == sig[1]).mean() - s) < 0.13


def test_bucket_counts_never_refuse_a_link():
    import numpy as np
    rnd = np.random.default_rng(3)
    for n in (1, 7, 200, 30_000, 90_000):
        shared, own = rnd.integers(0, 2**63, n, np.uint64), rnd.integers(0, 2**63, max(1, n // 8), np.uint64)
        sets = [np.unique(shared), np.unique(np.concatenate([shared, own]))]
        x, y = (minhash.bucket_counts(s, np.array([0, len(s)])) for s in sets)
        same = np.zeros((1, minhash.COORDS), np.uint8)
        linked = 100 * len(sets[0]) >= 75 * len(sets[1])
        got = minhash.may_be_linked(minhash.packed(np.hstack([same, x])), minhash.packed(np.hstack([same, y])),
                                    *(np.array([len(s)]) for s in sets))[0]
        assert got or not linked
    far = rnd.integers(0, 2**63, 400, np.uint64).reshape(2, 200)
    x, y = (minhash.bucket_counts(np.unique(s), np.array([0, len(np.unique(s))])) for s in far)
    assert not minhash.may_be_linked(minhash.packed(np.hstack([same, x])), minhash.packed(np.hstack([same, y])), np.array([200]), np.array([200]))[0]
