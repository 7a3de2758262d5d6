"""Vocabulary lookups over flat arrays, and what the BPE queries read."""

import pickle
import random

import numpy as np
import pyarrow as pa
import pytest

from tandem.operators import encode as EN


def _words(n, seed=1):
    rng = random.Random(seed)
    return sorted({"".join(rng.choices("abcé中", k=rng.randint(0, 6))) for _ in range(n)})


@pytest.mark.parametrize("hashes", [1 << 40, 7])
def test_index_finds_every_token_and_no_other(monkeypatch, hashes):
    real = EN.part_hashes
    monkeypatch.setattr(EN, "part_hashes", lambda d, s, e: real(d, s, e) % np.uint64(hashes))
    monkeypatch.setattr(EN, "HASHED_WORDS", 100)
    words = _words(400)
    index = EN.TokenIndex.of(pa.table({"token": [*words, words[0], None], "id": range(len(words) + 2)}))
    asked = [*words, "zz", "abcabcabc", "é" * 9]
    at = {w: i for i, w in enumerate(words)}
    assert index.ids_of(pa.array(asked).slice(2), -1).tolist() == [at.get(w, -1) for w in asked[2:]]
    assert index.null_id == len(words) + 1


def test_rare_tokens_are_told_by_the_small_table():
    """What the table lets through is looked up; the same places are found, and most stretches that are no token stop there."""
    words = _words(3000)
    index = EN.TokenIndex.of(pa.table({"token": words, "id": range(len(words))}))
    data = np.frombuffer("".join(words).encode(), np.uint8)
    starts = np.random.default_rng(1).integers(0, len(data), 20_000)
    ends = np.minimum(starts + np.random.default_rng(2).integers(0, 12, 20_000), len(data))
    found = index.find(data, starts, ends)
    assert (index.find(data, starts, ends, rare=True) == found).all() and (found >= 0).any()
    digit = index._digits(EN.part_hashes(data, starts, ends), 8 * len(index._bits))
    passed = index._bits[digit >> 3] >> (digit & 7).astype(np.uint8) & 1 > 0
    assert passed[found >= 0].all() and passed[found < 0].mean() < 0.15


def test_a_worker_holds_no_more_than_the_vocabulary():
    """No table is built from it for a lookup."""
    words = [f"w{i}" for i in range(50_000)]
    index = EN.TokenIndex.of(pa.table({"token": words, "id": range(len(words))}))
    assert len(pickle.dumps(index, 5)) < sum(map(len, words)) + 17 * len(words)
    assert index.ids_of(pa.array(["w7", "x"]), 0).tolist() == [7, 0]


def test_empty_vocabulary():
    index = EN.TokenIndex.of(pa.table({"token": pa.array([], pa.string()), "id": pa.array([], pa.int64())}))
    assert index.ids_of(pa.array(["a", ""]), 5).tolist() == [5, 5]


@pytest.mark.parametrize("name", ["bpe_ids", "bpe_encode", "byte_decode", "encode_bitext"])
def test_bpe_queries_prepare_the_corpus_once(spark, monkeypatch, name):
    from tandem.plans import catalog as C
    from tests.conftest import SF001
    calls, real, learn = [], C.c1, C.BP.train_bpe
    monkeypatch.setattr(C, "c1", lambda *a, **k: calls.append(a) or real(*a, **k))
    monkeypatch.setattr(C.BP, "train_bpe", lambda df, text, lang: learn(df, text, lang, num_merges=2))
    assert C.QUERIES[name](spark, SF001).count() > 0
    assert len(calls) == 1
