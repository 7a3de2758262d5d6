"""BPE learning and encoding: hand goldens and the public tokenizers package as oracle."""

import pytest
from pyspark.sql import functions as F

from tandem.operators import bpe as BP

WORDS = "low low lower newest newest widest ab ab cd cd"


def _model(spark, text, vocab_size, lang="en", candidates=BP.CANDIDATES):
    df = spark.createDataFrame([(1, text)], "pair_id long, en string")
    return BP.train_bpe(df, "en", lang, vocab_size=vocab_size, candidates=candidates)


def test_merges_golden(spark):
    m = _model(spark, WORDS, 20)
    assert m.tokens[:4] == ["<unk>", "<pad>", "<bos>", "<eos>"]
    assert m.tokens[4:17] == list("abcdeilnorstw")
    assert m.tokens[17:] == ["es", "lo", "est"]


@pytest.mark.parametrize("candidates", [BP.CANDIDATES, 2, 1])
def test_merge_ties(spark, candidates):
    m = _model(spark, "zy zy ab ab ba ba aaa aaa aaaa", 100, candidates=candidates)
    merged = [(m.tokens[a], m.tokens[b]) for a, b, _ in m.merges]
    assert merged == [("a", "a"), ("a", "b"), ("b", "a"), ("z", "y"), ("aa", "a"), ("aa", "aa")]


def test_min_frequency_zero(spark):
    m = _model(spark, "xy", 100)
    assert [(m.tokens[a], m.tokens[b]) for a, b, _ in m.merges] == [("x", "y")]


def test_encode_golden(spark):
    m = _model(spark, WORDS, 20)
    df = spark.createDataFrame([(1, "low zzq <eos> lowest"), (2, "")], "pair_id long, en string")
    got = {r["pair_id"]: r["ids"] for r in BP.bpe_encode(df, "en", m).collect()}
    assert got[1] == [18, 16, 0, 0, 0, 3, 18, 16, 19]
    assert got[2] == []
    dec = {r["pair_id"]: r["text"] for r in BP.bpe_decode(
        spark.createDataFrame([(1, got[1]), (2, [2, 5, 12, 3, 0, 1, 6])], "pair_id long, ids array<int>"),
        "ids", m).collect()}
    assert dec[1] == "lo w lo w est"
    assert dec[2] == "b o c"


def test_merge_expression(spark):
    df = spark.createDataFrame([([5, 5, 5],), ([5, 5, 5, 5],), ([1, 5, 6, 5, 6],)], "s array<int>")
    a = [r[0] for r in df.select(BP.merge_pair(F.col("s"), 5, 5, 9)).collect()]
    assert a[:2] == [[9, 5], [9, 9]]
    b = [r[0] for r in df.select(BP.merge_pair(F.col("s"), 5, 6, 9)).collect()]
    assert b[2] == [1, 9, 9]


def _library(texts, vocab_size, lang):
    from tokenizers import Tokenizer, normalizers
    from tokenizers.models import BPE
    from tokenizers.normalizers import NFD, Lowercase, StripAccents
    from tokenizers.pre_tokenizers import ByteLevel, Whitespace
    from tokenizers.trainers import BpeTrainer
    tok = Tokenizer(BPE(unk_token="<unk>"))
    tok.normalizer = normalizers.Sequence([NFD(), Lowercase(), StripAccents()])
    tok.pre_tokenizer = Whitespace() if lang == "en" else ByteLevel()
    tok.train_from_iterator(texts, BpeTrainer(special_tokens=["<unk>", "<pad>", "<bos>", "<eos>"],
                                              vocab_size=vocab_size, show_progress=False))
    return tok


@pytest.mark.parametrize("lang", ["en", "zh"])
def test_matches_public_library(spark, lang):
    from tandem.plans import inputs as I
    from tests.conftest import SF001
    b = I.bitext(spark, SF001).cache()
    col = "en" if lang == "en" else "zh"
    texts = [r[0] for r in b.select(col).collect()]
    words = BP.training_words(b, col, lang)
    n_alpha = len(BP.initial_words(words)[0])
    size = n_alpha + 30
    ours = BP.train_bpe(b, col, lang, vocab_size=size)
    lib = _library(texts, size, lang)
    assert lib.get_vocab() == {t: i for i, t in enumerate(ours.tokens)}
    enc = {r["pair_id"]: r["ids"] for r in BP.bpe_encode(b.select("pair_id", col), col, ours).collect()}
    pids = [r[0] for r in b.select("pair_id").collect()]
    for pid, t in zip(pids, texts):
        assert enc[pid] == lib.encode(t).ids


@pytest.mark.parametrize("seed", [None, 1, 2])
def test_self_pairs_keep_the_exact_order(spark, seed):
    import random
    rnd = random.Random(seed)
    text = " ".join(["aaa"] * 10 + ["bc"] * 9) if seed is None else " ".join(
        "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 7))) for _ in range(40))
    df = spark.createDataFrame([(1, text)], "pair_id int, t string")
    lib = _library([text], 14, "en")
    for options in ({}, {"candidates": 1}, {"candidates": 3}):
        m = BP.train_bpe(df, "t", "en", vocab_size=14, **options)
        assert {t: i for i, t in enumerate(m.tokens)} == lib.get_vocab(), options


def test_rows_are_encoded_where_they_lie(spark):
    m = _model(spark, "low lower lowest", 12)
    rows = [("a", 1, "low lowest"), ("b", 1, "lower"), ("b", 2, None), ("c", 3, "low <eos> low")]
    df = spark.createDataFrame(rows, "corpus string, pair_id int, t string")
    got = {(r.corpus, r.pair_id): r.ids for r in BP.bpe_encode(df, "t", m, key=["corpus", "pair_id"]).collect()}
    assert len(got) == 4 and got["b", 2] == [] and 3 in got["c", 3] and got["a", 1] != got["b", 1]


def brute_bpe(words, size):
    """Recount every pair of every word before each merge; a string that is a token keeps its id."""
    alphabet = sorted({c for w in words for c in w})
    tokens = ["<unk>", "<pad>", "<bos>", "<eos>", *alphabet]
    table = {w: [tokens.index(c) for c in w] for w in words}
    merges = []
    while len(tokens) < size:
        counts = {}
        for w, s in table.items():
            for p in zip(s, s[1:]):
                counts[p] = counts.get(p, 0) + words[w]
        if not counts:
            break
        a, b = min(counts, key=lambda p: (-counts[p], p))
        name = tokens[a] + tokens[b]
        if name not in tokens:
            tokens.append(name)
        new = tokens.index(name)
        merges.append((a, b, new))
        for w, s in table.items():
            out, i = [], 0
            while i < len(s):
                hit = s[i:i + 2] == [a, b]
                out.append(new if hit else s[i])
                i += 2 if hit else 1
            table[w] = out
    return tokens, merges


@pytest.mark.parametrize("seed,candidates", [(1, 64), (2, 8)])
def test_learning_to_the_end_equals_recounting(spark, monkeypatch, seed, candidates):
    """Few letters, so strings come about in two ways; few runs allowed, so rounds shrink."""
    import random
    from collections import Counter
    rnd = random.Random(seed)
    words = Counter("".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9))) for _ in range(80))
    words["ab" * 60] += 3
    monkeypatch.setattr(BP, "MAX_RUNS", 40)
    df = spark.createDataFrame([(i, " ".join([w] * c)) for i, (w, c) in enumerate(words.items())], "pair_id int, t string")
    m = BP.train_bpe(df, "t", "en", vocab_size=70, candidates=candidates)
    assert (m.tokens, m.merges) == brute_bpe(words, 70)


@pytest.mark.parametrize("lang", ["en", "zh"])
def test_full_vocabulary_equals_public_library(spark, lang):
    """No pair is left (or 30,000 entries are reached): tokens, ids and encodings are those of the library."""
    from tests.conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("text is not null")
    b = docs.select(F.col("doc_id").alias("pair_id"), F.col("text").alias(lang)).cache()
    texts = {r[0]: r[1] for r in b.collect()}
    lib = _library(list(texts.values()), 30_000, lang)
    ours = BP.train_bpe(b, lang, lang)
    assert len(ours.merges) > 5000 and ours.rounds < 40
    assert lib.get_vocab() == {t: i for i, t in enumerate(ours.tokens)}
    for r in BP.bpe_encode(b, lang, ours).collect():
        assert r["ids"] == lib.encode(texts[r["pair_id"]]).ids


def test_long_words_merge_like_short_ones():
    import random
    rnd = random.Random(3)
    table = {BP._code(a, b): (r, 10 + r) for r, (a, b) in enumerate(
        [(1, 1), (1, 2), (10, 1), (2, 10), (11, 11), (14, 3), (3, 3), (16, 16), (10, 10), (18, 18)])}
    for _ in range(200):
        word = [rnd.randint(1, 3) for _ in range(rnd.randint(1, 60))]
        assert BP._merge_long(word, table) == BP.merge_symbols(word, table)
    assert len(BP.merge_symbols([1] * 1_000_000, table)) == 125_000


def test_empty_corpus_learns_nothing(spark):
    m = BP.train_bpe(spark.createDataFrame([], "pair_id int, t string"), "t", "en")
    assert m.tokens == ["<unk>", "<pad>", "<bos>", "<eos>"] and m.merges == []


def test_special_strings_inside_other_text(spark):
    m = _model(spark, "low lower lowest eos bos", 40)
    rows = [(1, "low<eos>low"), (2, "<EOS> low"), (3, "<pad><bos> \ufdd1low"), (4, "")]
    got = {r["pair_id"]: r["ids"] for r in BP.bpe_encode(
        spark.createDataFrame(rows, "pair_id int, t string"), "t", m).collect()}
    low = m.tokens.index("low")
    assert got[1] == [low, 3, low] and got[3] == [1, 2, 0, low] and got[4] == []
    assert 3 not in got[2] and got[2][-1] == low            # lower-cased only after the special strings were found


def test_byte_level_roundtrip(spark):
    """decode(encode(x)) == normalise(x) (with the prefix space, T13) for text whose bytes the
    vocabulary covers."""
    from tandem.functions.text import normalize_py
    texts = ["Hello world, this is text.", "Große Überraschung für Ünal!", "naïve café au lait"]
    df = spark.createDataFrame(list(enumerate(texts)), "pair_id long, zh string")
    m = BP.train_bpe(df, "zh", "zh", num_merges=30)
    enc = BP.bpe_encode(df, "zh", m)
    dec = {r["pair_id"]: r["text"] for r in BP.bpe_decode(enc, "ids", m).collect()}
    for i, t in enumerate(texts):
        assert dec[i] == " " + normalize_py(t)


ODD_TEXTS = ["one Two, it's 'S 12ab _x", "one  Two", " lead", "trail ", "a \u0301 b", "one two", "x\t y", " ", "Plain ASCII, it's 'S here_1\t\x1fx  y ", "Éa'Ś İstanbul ǅ naïve ¨´ ȺɁ'Ⱥ x\x85y\xa0z ß_ÿ ǅ", "A\u0301b Ελλάς ΣΑΣ 한글 Ünal", "", None,
             " <eos> é <PAD>", "\ufdd1 a", "日本 Ａ 電 \U0001d400 x\u0345", "\x7f\x00 tab\t'Re", "x" * 300 + " \u3000"]


@pytest.mark.parametrize("lang", ["en", "zh"])
def test_training_words_of_odd_texts(spark, lang):
    """As cut from the normalised text row by row by the public library, whatever path a row takes."""
    from collections import Counter
    from tokenizers.pre_tokenizers import ByteLevel, Whitespace
    from tandem.functions.text import normalize_py
    cut = Whitespace() if lang == "en" else ByteLevel()
    want = Counter(w for t in ODD_TEXTS if t is not None for w, _ in cut.pre_tokenize_str(normalize_py(t)))
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "pair_id int, t string")
    got = {r["word"]: r["c"] for r in BP.training_words(df, "t", lang).collect()}
    if lang == "zh":
        want[BP_SPACE] += 1                               # the empty text: the prefix space alone
    assert got == {w: n for w, n in want.items() if n}


BP_SPACE = "\u0120"


def test_rounds_of_the_full_vocabulary(spark, monkeypatch):
    """A round learns as many merges as its runs allow: few rounds to the end, and
    words of one symbol leave the table."""
    from tests.conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("text is not null")
    sizes, write = [], BP._write_words

    def counted(words):
        table, path = write(words)
        sizes.append(table.count())
        assert len(sizes) == 1 or table.where(F.size("syms") < 2).count() == 0
        return table, path
    monkeypatch.setattr(BP, "_write_words", counted)
    m = BP.train_bpe(docs.select(F.col("text").alias("t")), "t", "en")
    assert m.rounds <= 7 and sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0] // 2


def test_words_merged_together_like_alone(monkeypatch):
    import random
    import numpy as np
    rnd = random.Random(5)
    merges = [(1, 1, 10), (1, 2, 11), (10, 1, 12), (2, 10, 13), (11, 11, 14), (14, 3, 15), (3, 3, 16), (16, 16, 17), (10, 10, 18), (18, 18, 19), (1, 2, 11)]
    words = [[rnd.randint(0, 3) for _ in range(rnd.choice([0, 1, 2, 3, 8, 40, 90]))] for _ in range(400)]
    table = {BP._code(a, b): (r, new) for r, (a, b, new) in enumerate(merges)}
    for block in (1, 50, 1 << 17):
        monkeypatch.setattr(BP, "MERGE_SYMBOLS", block)
        flat, lens = BP.MergeTable(merges).merge(np.array([x for w in words for x in w], np.int64), np.array([len(w) for w in words]))
        ends = np.cumsum(lens)
        assert [flat[e - n: e].tolist() for e, n in zip(ends, lens)] == [BP.merge_symbols(w, table) for w in words]
    assert BP.MergeTable([]).merge(np.array([1, 2, 1]), np.array([2, 0, 1]))[0].tolist() == [1, 2, 1]


@pytest.mark.parametrize("lang", ["en", "zh"])
def test_odd_texts_encoded_by_parts(spark, lang):
    """Texts that are cut at their spaces, and those that are not, get the ids of their words, cut by the public library, one by one."""
    import random
    from tokenizers.pre_tokenizers import ByteLevel, Whitespace
    from tandem.functions.text import SPECIALS, normalize_py
    rnd = random.Random(9)
    some = ["a", "it's", "'s", "'re", "x'd", "don't", "-'t", "1's", "'", "\u00e9", "\u0301", "\u4e2d\u6587", "one", "Two", "\u0130", "\u1e9e"]
    texts = [t for t in ODD_TEXTS if t is not None and not any(s in t for s in SPECIALS) and "\ufdd1" not in t]
    texts += [" ".join(rnd.choices(some, k=rnd.randint(1, 7))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "pair_id int, t string").cache()
    model = BP.train_bpe(df, "t", lang, num_merges=60)
    table = {BP._code(a, b): (r, new) for r, (a, b, new) in enumerate(model.merges)}
    ids = {t: i for i, t in enumerate(model.tokens)}
    cut = Whitespace() if lang == "en" else ByteLevel()
    got = {r["pair_id"]: r["ids"] for r in BP.bpe_encode(df, "t", model).collect()}
    for i, t in enumerate(texts):
        words = [w for w, _ in cut.pre_tokenize_str(normalize_py(t))] or ([BP_SPACE] if lang == "zh" else [])
        want = [x for w in words for x in BP.merge_symbols([ids.get(c, 0) for c in w], table)]
        assert got[i] == want, (t, words)


def test_a_part_of_the_texts_is_encoded_once():
    """What lies between two spaces goes through the merges once a task, however often it comes; a text with a special string, or
    one whose spaces meet, is encoded whole at byte level."""
    import pyarrow as pa
    for lang in ("en", "zh"):
        asked = []
        encoder = BP.BpeEncoder(BP.BpeModel(lang, ["<unk>", "<pad>", "<bos>", "<eos>", "a", "b", BP_SPACE]), bytes(0x110000))
        real = encoder.encode
        encoder.encode = lambda texts, real=real: asked.extend(texts) or real(texts)
        out = encoder(pa.array(["a b a", "b a", "", "a<eos> a"] * 50)).to_pylist() + encoder(pa.array(["b b  a"])).to_pylist()
        assert len(asked) == len(set(asked)) <= 5
        assert out[0] == ([4, 5, 4] if lang == "en" else [6, 4, 6, 5, 6, 4]) and out[3] == ([4, 3, 4] if lang == "en" else [6, 4, 3, 6, 4])
        assert out[2] == ([] if lang == "en" else [6]) and out[-1] == ([5, 5, 4] if lang == "en" else [6, 5, 6, 5, 6, 6, 4])


def test_both_sides_in_one_worker(spark, monkeypatch):
    """As C2 encodes them: the ids of both sides come from one pass; a worker keeps the encoders of both models and no more."""
    en, zh = _model(spark, WORDS, 20), BP.train_bpe(spark.createDataFrame([("low lower",)], "t string"), "t", "zh")
    df = spark.createDataFrame([(1, "low zzq", "lower"), (2, None, "low")], "k int, en string, zh string")
    coded = BP.bpe_encode(df, "en", en, key=["k", "zh"], out="en_ids")
    coded = BP.bpe_encode(coded, "zh", zh, key=["k", "en_ids"], out="zh_ids").select("*", F.size("en_ids"), F.reverse("en_ids"))
    assert coded._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    for side, model in (("en", en), ("zh", zh)):
        alone = {r["k"]: r["ids"] for r in BP.bpe_encode(df, side, model, key="k").collect()}
        assert alone == {r["k"]: r[f"{side}_ids"] for r in coded.collect()}
    monkeypatch.setattr(BP, "_KEPT", {})
    for name in "abcb":
        sent = type("Sent", (), {"value": ("en", en.tokens, en.merges, bytes(0x110000))})
        assert BP._encoder(name, sent) is BP._encoder(name, sent)
    assert [*BP._KEPT] == ["c", "b"] or [*BP._KEPT] == ["b", "c"]
