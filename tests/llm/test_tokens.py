import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tandem.llm import token_counts, token_store
from tandem.llm.queries import tokenizer_file
from tests.llm import fixture

PATH = tokenizer_file()


def greedy(s, vocab):
    n = i = 0
    while i < len(s):
        j = next((j for j in range(len(s), i, -1) if s[i:j] in vocab), None)
        if j is None:
            return 1
        n, i = n + 1, j
    return n


def split(text):
    return [w for w in (text or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]


def test_counts_equal_greedy_longest_match(spark):
    vocab = set(token_counts.byte_level_vocab(PATH))
    got = token_counts.token_counts(fixture.documents(spark), PATH).collect()
    want = [(r[0], len(split(r[1])), sum(greedy(b" " + w.encode(), vocab) for w in split(r[1])))
            for r in fixture.rows()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.n_words, r.n_tokens) for r in got), key=key) == sorted(want, key=key)
    assert token_counts.token_counts(fixture.empty(spark), PATH).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_automaton_on_random_vocabularies(seed):
    rnd = random.Random(seed)
    vocab = {bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 5))) for _ in range(6)}
    auto = token_counts.Automaton(sorted(vocab))
    words = [bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    off = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    got = auto.count(np.frombuffer(b"".join(words), np.uint8), off)
    assert got.tolist() == [greedy(w, vocab) for w in words]


@pytest.mark.parametrize("words", [3, 400])
def test_long_words_go_on_alone(words):
    """A word of 2 MB beside few or many short ones, and one that no piece covers far in."""
    rnd = random.Random(words)
    vocab = [b"a", b"b", b"ab", b"abba", b"bab"]
    auto = token_counts.Automaton(vocab)
    short = [bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 9))) for _ in range(words)]
    long = b"abbaab" * 350_000
    every = [*short, long, long + b"c" + long, b"ab" * 200]
    off = np.concatenate([[0], np.cumsum([len(w) for w in every])])
    got = auto.count(np.frombuffer(b"".join(every), np.uint8), off)
    assert got.tolist() == [*(greedy(w, set(vocab)) for w in short), 700_000, 1, greedy(every[-1], set(vocab))]


def test_direct_access_codes():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 7, 511, 512, 513, 5000):
        ids = (rnd.integers(0, 1 << 32, n) >> rnd.integers(0, 32, n)).astype(np.uint32)
        r = token_store.DacReader(token_store.dac_encode(ids))
        assert len(r) == n and (r.all() == ids).all()
        assert [r[i] for i in range(0, n, 3)] == ids[::3].tolist()
    with pytest.raises(IndexError):
        r[n]


def test_pieces_encode_like_whole_texts():
    rnd = random.Random(3)
    alphabet = ["a", "B", "ñ", "中", "'s", "'", " ", "  ", "\n", "\t", "9", ".", "%", " ", "　", "\u0085",
                "\U0001f600", "<|endoftext|>", "́"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(1500)]
    ids, bounds = token_store.encode_texts(pa.array(texts), PATH)
    tok = token_store.encoder(PATH).tokenizer
    for i, t in enumerate(texts):
        assert ids[bounds[i]: bounds[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_added_tokens_encode_like_the_file():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "a <|endoftext| b", None, "",
             "\u3000<|endoftext|>", "plain words", "<|ENDOFTEXT|> 中<|endoftext|>中"]
    ids, bounds = token_store.encode_texts(pa.array(texts), PATH)
    assert ids[bounds[0]: bounds[1]].tolist() == [64, 220, 50256, 275]
    for i, t in enumerate(texts):
        assert ids[bounds[i]: bounds[i + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_store_and_read_back(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_store.write_tokens(fixture.documents(spark), path, PATH, 2)
    got = token_store.read_documents(spark, path).orderBy("start").collect()
    tok = token_store.encoder(PATH).tokenizer
    start = 0
    for g, r in zip(got, sorted(fixture.rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), strict=True):
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 2]
        assert tuple(g) == (r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    seg = token_store.read_segments(spark, path).orderBy("start").first()
    assert token_store.DacReader(bytes(seg.payload))[seg.n_tokens - 1] == 2


def test_empty_store(spark, tmp_path):
    path = str(tmp_path / "none")
    token_store.write_tokens(fixture.empty(spark), path, PATH, 2)
    assert token_store.read_documents(spark, path).count() == 0
