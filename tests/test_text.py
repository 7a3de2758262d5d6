"""Goldens for the text functions (FIXTURES section 3) and library parity on our own strings."""

from pyspark.sql import functions as F

from tandem.functions import text as TX
from tandem.operators import clean


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "x string").select(col.alias("y")).first()["y"]


def test_strip_python_whitespace(spark):
    s = " 　 a b \u001c "
    assert one(spark, TX.py_strip(F.col("x")), s) == "a b" == s.strip()
    # U+200B and U+FEFF are not whitespace for Python
    assert one(spark, TX.py_strip(F.col("x")), "​x﻿") == "​x﻿"


def test_split_keeps_empty_fields(spark):
    assert one(spark, TX.split_fields(F.col("x")), "a\t\t") == ["a", "", ""]


def test_normalize_golden_and_udf_path(spark):
    s = "Élan İstanbul ÅΣΑΣ ﬁ Straße कः"
    assert one(spark, TX.normalize(F.col("x")), s) == "elan istanbul aσασ ﬁ straße क"
    # Hangul goes through the UDF path and becomes Jamo
    h = "한국어 Ab"
    assert one(spark, TX.normalize(F.col("x")), h) == TX.normalize_py(h)


def test_normalize_matches_library(spark):
    from tokenizers import normalizers
    from tokenizers.normalizers import NFD, Lowercase, StripAccents
    lib = normalizers.Sequence([NFD(), Lowercase(), StripAccents()])
    samples = ["Crème Brûlée", "ΟΔΥΣΣΕΥΣ", "Ǆemal", "ﬃ ℌ Ⅻ", "가나다", "Ωmega", "naïve café"]
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    got = [r[0] for r in df.select(TX.normalize(F.col("x"))).collect()]
    assert got == [lib.normalize_str(s) for s in samples]


def test_word_pretokenizer_golden(spark):
    got = one(spark, TX.pretok_words(F.col("x")), "I don't like_it 5.3% 中文，字!")
    assert got == ["I", "don", "'", "t", "like_it", "5", ".", "3", "%", "中文", "，", "字", "!"]


def test_byte_level_golden_and_library(spark):
    got = one(spark, TX.pretok_bytes(F.col("x")), "Hi 中文，字 2016年")
    assert got == ["ĠHi", "Ġä¸Ńæĸĩ", "ï¼Į", "åŃĹ", "Ġ2016", "å¹´"]
    from tokenizers.pre_tokenizers import ByteLevel
    bl = ByteLevel()
    for s in ["Hello  world!", "  two spaces", "it's 3.5% ok\n", "混合 text 😀"]:
        assert one(spark, TX.pretok_bytes(F.col("x")), s) == [p for p, _ in bl.pre_tokenize_str(s)]


def test_byte_decode_replaces_broken_sequences(spark):
    # symbols of the raw bytes E4 B8 61: a truncated 3-byte sequence, then "a"
    syms = "".join(TX.BYTE_TO_CHAR[b] for b in [0xE4, 0xB8, 0x61])
    got = spark.createDataFrame([(syms,)], "x string").select(TX.symbols_to_text(F.col("x"))).first()[0]
    assert got == "\ufffda"


def test_normalize_fast_path_equals_python_on_random_text(spark):
    import random
    rng = random.Random(7)
    pools = [range(0x20, 0x250), range(0x370, 0x530), range(0x300, 0x370), range(0xAC00, 0xAC40),
             range(0x4E00, 0x4E40), range(0x1E00, 0x1F00), range(0xFB00, 0xFB10)]
    samples = []
    for _ in range(300):
        pool = rng.choice(pools)
        samples.append("".join(chr(rng.choice(pool)) for _ in range(rng.randint(0, 20))))
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    got = [r[0] for r in df.select(TX.normalize(F.col("x"))).collect()]
    assert got == [TX.normalize_py(s) for s in samples]


def test_zh_tokens_golden(spark):
    got = one(spark, F.array_join(TX.zh_tokens(F.col("x")), " "), "在2016年11月, U.S. (test) 3.5% a-b 5-6。")
    assert got == "在 2016 年 11 月 , U . S . ( test ) 3.5 % a-b 5 - 6 。"


def test_cleanup_spaces(spark):
    got = one(spark, TX.cleanup_spaces(F.col("x")), "i do n't know , he 's here .")
    assert got == "i don't know, he's here."


def test_script_conversion_chars_and_phrases(spark):
    from tandem.operators import clean as C
    chars = {"電": "电", "腦": "脑", "軟": "软", "體": "体"}
    assert one(spark, C.convert_script(F.col("x"), chars), "電腦軟體") == "电脑软体"
    # phrases first (longest match), then characters
    assert one(spark, C.convert_script(F.col("x"), chars, {"軟體": "软件"}), "電腦軟體") == "电脑软件"
    df = spark.createDataFrame([("x", "軟", "zh-Hans"), ("y", "軟", "zh-Hant")],
                               "pair_id string, zh string, to_lang string")
    allc = {r[0]: r[1] for r in C.convert_where(df, chars=chars).select("pair_id", "zh").collect()}
    some = {r[0]: r[1] for r in C.convert_where(df, mode="non_simplified", chars=chars)
            .select("pair_id", "zh").collect()}
    assert allc == {"x": "软", "y": "软"} and some == {"x": "軟", "y": "软"}


def brute_phrases(text, phrases):
    out, i = [], 0
    while i < len(text):
        n = next((n for n in range(len(text) - i, 0, -1) if text[i:i + n] in phrases), 0)
        out.append(phrases[text[i:i + n]] if n else text[i])
        i += n or 1
    return "".join(out)


def test_phrases_equal_brute_force():
    import random
    rnd = random.Random(1)
    for k in range(3000):
        phrases = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))): rnd.choice(["X", "", "YZ", "a"])
                   for _ in range(rnd.randint(1, 6))}
        text = "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 14)))
        assert clean.replace_phrases(text, clean._automaton(f"d{k}", phrases)) == brute_phrases(text, phrases), (phrases, text)


def test_phrase_dictionary_as_a_table(spark):
    """Nulls in rows and table, repeated sources, an empty table, two dictionaries in one plan, a long text, a size bound."""
    import pytest
    table = spark.createDataFrame([("軟體", "软件"), ("軟體", "软体"), ("軟體工程", "软件工程"), (None, "x"), ("y", None), ("", "z")],
                                  "src string, dst string")
    rows = [(1, "做軟體工程的軟體y"), (2, ""), (3, None), (4, "軟" * 500_000 + "軟體")]
    df = spark.createDataFrame(rows, "i int, x string").repartition(2)
    got = {r["i"]: (r["a"], r["b"]) for r in df.select(
        "i", clean.convert_phrases("x", table).alias("a"), clean.convert_phrases("x", {"的": ""}).alias("b")).collect()}
    # of two targets of a source the smaller one by code point
    assert got[1] == ("做软件工程的" + min("软件", "软体") + "y", "做軟體工程軟體y")
    assert got[2] == ("", "") and got[3] == (None, None) and len(got[4][0]) == 500_002 and "軟體" not in got[4][0]
    assert [r["a"] for r in df.where("i < 3").orderBy("i").select(clean.convert_phrases("x", table.limit(0)).alias("a")).collect()] == [
        rows[0][1], ""]
    with pytest.raises(ValueError):
        clean._as_mapping(table, max_bytes=10)


def test_phrases_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("ab cabd",), (None,)], "x string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("x string").parquet(str(tmp_path / "in"))
    query = (stream.select(clean.convert_phrases("x", {"ab": "1", "abd": "2"}).alias("x")).writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination()
    assert {r["x"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"1 c2", None}


def test_zh_tokens_evaluates_each_rule_once(spark):
    rows = spark.createDataFrame([(" a ,b..中 (x) ",), ("",), (None,), ("、",), ("1-2 .5,",)], "x string")
    out = rows.select(TX.zh_tokens("x").alias("t"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1 + len(TX.ZH_PUNCT_RULES)
    assert [r["t"] for r in out.collect()] == [["a", ",", "b", ".", ".", "中", "(", "x", ")"], [], None, ["、"], ["1", "-", "2", ".", "5,"]]
