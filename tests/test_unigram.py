"""Best-path segmentation vs brute force over all segmentations of short words."""

import itertools
import math

from tandem.operators import unigram as U

PIECES = {"▁": (-3.0, 3), "▁ab": (-2.0, 4), "a": (-2.5, 5), "b": (-2.5, 6), "ab": (-2.2, 7),
          "▁a": (-1.5, 8), "c": (-4.0, 9), "bc": (-3.5, 10), "▁abc": (-6.0, 11)}


def brute(word, unk):
    best, arg = -math.inf, None
    n = len(word)
    for cuts in itertools.product([0, 1], repeat=n - 1):
        segs, start = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                segs.append(word[start:i])
                start = i
        segs.append(word[start:])
        score, ids = 0.0, []
        for s in segs:
            if s in PIECES:
                score += PIECES[s][0]
                ids.append(PIECES[s][1])
            elif len(s) == 1:
                score += unk
                ids.append(2)
            else:
                score = -math.inf
        if score > best:
            best, arg = score, ids
    out = []
    for i in arg:
        if not (i == 2 and out and out[-1] == 2):
            out.append(i)
    return out


def test_best_path_matches_brute_force():
    unk = min(s for s, _ in PIECES.values()) - U.UNK_PENALTY
    for w in ["▁abc", "▁ab", "▁a", "▁bcab", "▁xyab", "▁abcbc", "▁cab"]:
        assert U.best_path_py(w, PIECES, 4, unk) == brute(w, unk), w


def test_unigram_encode_end_token_and_cap(spark):
    pieces = spark.createDataFrame([(p, s, i) for p, (s, i) in PIECES.items()], "piece string, score double, id int")
    df = spark.createDataFrame([(1, "ab abc"), (2, " ".join(["ab"] * 300))], "pair_id long, t string")
    got = {r["pair_id"]: r for r in U.unigram_encode(df, "t", pieces).collect()}
    assert got[1]["input_ids"][-1] == 1 and got[1]["attention_mask"] == [1] * len(got[1]["input_ids"])
    assert len(got[2]["input_ids"]) == 128 and got[2]["input_ids"][-1] == 1


def _library(pieces, byte_fallback):
    from tokenizers import Tokenizer, normalizers, pre_tokenizers
    from tokenizers.models import Unigram
    tok = Tokenizer(Unigram([("<pad>", 0.0), ("</s>", 0.0), ("<unk>", 0.0), *pieces], unk_id=2, byte_fallback=byte_fallback))
    tok.normalizer = normalizers.Sequence([normalizers.Nmt(), normalizers.NFKC()])
    tok.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace()])
    return tok


TEXTS = ["", "  ", "low lower", "ｆｕｌｌ width ﬁ … ½", "e\u0301 \u1e9b\u0323 a\u200bb\ufeff\tc\x07d", "中文 字 🙂🙂 x🙂y", "a\u00a0b\u3000c",
         "▁ x▁y", "na\u00efve \u0130 \u212b", "x" * 300, "\u0085 z"]


def test_ids_equal_the_public_library(spark):
    """Given pieces of the documents, whole texts of the documents and odd ones, with and without byte pieces."""
    from pyspark.sql import functions as F
    from tandem.functions.text import py_split_ws
    from tandem.operators import vocab as VO
    from tests.conftest import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id").alias("k"), "text").where("text is not null")
    odd = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(TEXTS)], "k long, text string")
    rows = docs.unionByName(odd).cache()
    derived = U.pieces_from_counts(VO.word_counts(docs.where("k % 2 = 0"),
                                                  py_split_ws(F.col("text"))))
    table = [(r["piece"], r["score"]) for r in derived.orderBy("id").collect()]
    for byte_fallback in (False, True):
        pieces = table + ([(f"<0x{b:02X}>", -20.0) for b in range(256)] if byte_fallback else [])
        frame = spark.createDataFrame([(p, s, i + 3) for i, (p, s) in enumerate(pieces)], "piece string, score double, id int")
        lib = _library(pieces, byte_fallback)
        texts = {r["k"]: r["text"] for r in rows.collect()}
        for r in U.unigram_encode(rows, "text", frame, key="k", max_ids=1 << 30, byte_fallback=byte_fallback).collect():
            assert r["input_ids"] == lib.encode(texts[r["k"]]).ids + [1], (texts[r["k"]][:60], byte_fallback)


def test_rows_are_encoded_where_they_lie(spark):
    pieces = spark.createDataFrame([(p, s, i) for p, (s, i) in PIECES.items()], "piece string, score double, id int")
    df = spark.createDataFrame([(1, "a", "ab"), (2, "a", None)], "pair_id long, corpus string, t string")
    out = U.unigram_encode(df, "t", pieces, key=["pair_id", "corpus"])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["pair_id"]: r["input_ids"] for r in out.collect()} == {1: [4, 1], 2: [1]}


def test_long_word_is_linear():
    made = U.Pieces.of([(p, s, i) for p, (s, i) in PIECES.items()])
    assert len(U.best_path("abc" * 300_000, made)) == 600_000


def test_pieces_are_flat_and_the_pieces_of_words_are_found():
    """A worker holds a piece in some 32 bytes besides its text (a dictionary of tuples took over 200)."""
    import pickle
    import pyarrow as pa
    rows = [(f"▁w{i}é", -1.0 - i % 7, i + 300) for i in range(20_000)] + [(p, s, i) for p, (s, i) in PIECES.items()]
    table = pa.table({"token": [r[0] for r in rows], "score": [r[1] for r in rows], "id": [r[2] for r in rows]})
    index = U.PieceIndex.of(table)
    assert len(pickle.dumps(index, 5)) < 50 * len(rows)
    whole = U.Pieces.of(rows)
    words = ["▁w19999é", "▁w7éab", "▁abcbc", "▁xyab中", "▁", "▁" + "abc" * 2000]
    known = index.within(words)
    assert len(known.table) < 40
    assert [U.best_path(w, known) for w in words] == [U.best_path(w, whole) for w in words]


def test_both_sides_in_one_worker(spark):
    pieces = spark.createDataFrame([(p, s, i) for p, (s, i) in PIECES.items()], "piece string, score double, id int")
    df = spark.createDataFrame([(1, "ab abc", None), (1, "", "c")], "k long, en string, zh string")
    out = U.unigram_encode_sides(df, {"en": "en", "zh": "zh"}, pieces, ["k"])
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    for side in ("en", "zh"):
        alone = U.unigram_encode(df, side, pieces, key="k").collect()
        assert sorted(r["input_ids"] for r in alone) == sorted(r[f"{side}_ids"] for r in out.collect())


def test_paths_found_together_equal_those_found_alone():
    """Many words step by step, with unknown characters, equal scores, empty and long words."""
    import random
    import numpy as np
    import pyarrow as pa
    rnd = random.Random(4)
    rows = [(p, s, i) for p, (s, i) in PIECES.items()] + [("aa", -5.0, 20), ("aaa", -7.5, 21), ("é", -3.0, 22), ("éa", -5.5, 23)]
    index = U.PieceIndex.of(pa.table({"token": [r[0] for r in rows], "score": [r[1] for r in rows], "id": [r[2] for r in rows]}))
    whole = U.Pieces.of(rows)
    words = ["▁" + "".join(rnd.choices("abcéxy", k=rnd.choice([0, 1, 3, 9, 30]))) for _ in range(500)] + [""]
    flat, lens = index.best_paths("".join(words), np.array([len(w) for w in words]))
    ends = np.cumsum(lens)
    assert [flat[e - n: e].tolist() for e, n in zip(ends, lens)] == [U.best_path(w, whole) for w in words]
    mixed = words[:20] + ["▁" + "abx" * 50] + words[20:40] + ["▁" + "é" * 200]
    flat, lens = U.PieceEncoder(index)._paths(mixed)
    assert flat.tolist() == [i for w in mixed for i in U.best_path(w, whole)] and len(lens) == len(mixed)


def test_a_part_of_the_texts_is_encoded_once(monkeypatch):
    """Texts are cut at their spaces and a part goes through normalisation and the best path once; odd texts get what the whole
    normalised text gives."""
    import pyarrow as pa
    from tandem.operators import encode as EN
    rows = [(p, s, i) for p, (s, i) in PIECES.items()]
    index = U.PieceIndex.of(pa.table({"token": [r[0] for r in rows], "score": [r[1] for r in rows], "id": [r[2] for r in rows]}))
    whole, encoder, asked = U.Pieces.of(rows), U.PieceEncoder(index), []
    real = encoder.encode
    encoder.encode = lambda texts: asked.extend(texts) or real(texts)
    texts = (["ab abc ab", "abc  ab", "á ́b", "a¨b ½", "a\nb c\td", "\x07a\x1cb\x85c ", "\x00 a"] + TEXTS) * 5
    monkeypatch.setattr(EN, "CHUNK_BYTES", 100)
    got = encoder(pa.array(texts)).to_pylist()
    assert got == [[i for w in U.normalise_pieces(t).split() for i in U.best_path("▁" + w, whole)] for t in texts]
    assert len(asked) == len(set(asked))


def test_counts_are_read_once(spark):
    from pyspark.sql import functions as F
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def word(w):
        seen.add(1)
        return w
    counts = spark.createDataFrame([("ab", 5), ("abc", 4), ("c", 1)], "w string, count long").select(
        word.asNondeterministic()("w").alias("word"), "count")
    assert U.pieces_from_counts(counts).count() > 3 and seen.value == 3
