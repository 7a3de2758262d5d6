"""Array operators: wrap/pad, EOS cut, masks, transpose; decode."""

from pyspark.sql import functions as F

from tandem.functions import arrays as A
from tandem.operators import batch as B
from tandem.operators import encode as E


def test_wrap_and_pad(spark):
    df = spark.createDataFrame([([7, 8], 7)], "ids array<int>, m int")
    assert df.select(A.pad_to(A.wrap_ids("ids"), F.col("m"))).first()[0] == [2, 7, 8, 3, 1, 1, 1]


def test_cut_eos(spark):
    df = spark.createDataFrame([([7, 8, 3, 9],), ([7, 8],)], "ids array<int>")
    assert [r[0] for r in df.select(A.cut_at_eos("ids")).collect()] == [[7, 8], [7, 8]]


def test_causal_mask(spark):
    df = spark.createDataFrame([(3,)], "n int")
    inf = float("-inf")
    assert df.select(A.causal_mask("n")).first()[0] == [[0.0, inf, inf], [0.0, 0.0, inf], [0.0, 0.0, 0.0]]


def test_shift_and_masks(spark):
    df = spark.createDataFrame([([2, 5, 6, 3, 1],)], "t array<int>")
    r = df.select(A.decoder_input("t"), A.decoder_target("t"), A.padding_mask("t")).first()
    assert r[0] == [2, 5, 6, 3] and r[1] == [5, 6, 3, 1] and r[2] == [False] * 4 + [True]


def test_square_masks_of_a_batch(spark):
    df = spark.createDataFrame([("train", 0, [4, 5], [6]), ("train", 0, [4], [6, 7]), ("val", 0, [], [])],
                               "split string, batch_id long, s array<int>, t array<int>")
    m = {r["split"]: r for r in B.batch_masks(B.model_batches(df, "s", "t"), "s").collect()}
    inf = float("-inf")
    assert m["train"]["src_mask"] == [[False] * 4] * 4 and m["train"]["src_len"] == 4
    assert m["train"]["tgt_mask"] == [[0.0, inf, inf], [0.0, 0.0, inf], [0.0, 0.0, 0.0]]
    assert m["val"]["src_mask"] == [[False] * 2] * 2 and m["val"]["tgt_mask"] == [[0.0]]


def test_batches_transpose_and_pad(spark):
    rows = [("train", i, list(range(4, 4 + (i % 3) + 1))) for i in range(10)]
    df = spark.createDataFrame(rows, "split string, k long, ids array<int>") \
        .withColumn("shuffle_key", F.col("k"))
    b = B.assign_batches(df, ["k"], size=4)
    got = {r["k"]: (r["batch_id"], r["row_in_batch"], r["n_batches"]) for r in b.collect()}
    assert got[0] == (0, 0, 3) and got[5] == (1, 1, 3) and got[9] == (2, 1, 3)
    p = B.pad_batches(b, "ids").where(F.col("batch_id") == 0).collect()
    assert {len(r["ids"]) for r in p} == {3}
    t = B.transpose_batches(B.pad_batches(b, "ids"), "ids").where(
        (F.col("batch_id") == 0) & (F.col("t") == 0)).first()
    assert t["ids"] == [4, 4, 4, 4]


def test_collate_udf_equals_builtin(spark):
    rows = [("train", i // 3, i % 3, list(range(i % 4 + 1))) for i in range(12)]
    df = spark.createDataFrame(rows, "split string, batch_id long, row_in_batch int, ids array<int>")
    udf = B.collate_with(df, B.pad_collate("ids"), df.schema.simpleString()[7:-1].replace(":", " "))
    a = sorted(map(tuple, udf.collect()))
    b = sorted(map(tuple, B.pad_batches(df, "ids").collect()))
    assert a == b


def test_decode_skips_specials(spark):
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(["<unk>", "<pad>", "<bos>", "<eos>", "a", "b"])],
                                  "token string, id int")
    df = spark.createDataFrame([(1, [2, 4, 0, 5, 3, 1])], "pair_id long, ids array<int>")
    assert E.decode_ids(df, "ids", vocab).first()["text"] == "a b"


def test_empty_refs_neighbours(spark):
    from tandem.operators.clean import empty_refs
    rows = [("val", 0, 0, "a"), ("val", 0, 1, "  "), ("val", 0, 2, "c"), ("val", 1, 0, ""),
            ("test", 0, 1, "x")]
    df = spark.createDataFrame(rows, "split string, batch_id long, pos int, ref string")
    got = sorted(map(tuple, empty_refs(df).collect()))
    assert got == [("val", 0, 1, "  ", "a", "c"), ("val", 1, 0, "", None, None)]


def test_pairing_and_unmatched_sides(spark):
    import pytest
    from tandem.operators import pairing as P
    en = spark.createDataFrame([(1, [4]), (2, [5]), (3, [6])], "pair_id long, en_ids array<int>")
    zh = spark.createDataFrame([(1, [7]), (2, [8]), (4, [9])], "pair_id long, zh_ids array<int>")
    assert sorted(r["pair_id"] for r in P.pair_sides(en, zh).collect()) == [1, 2]
    got = sorted(map(tuple, P.unmatched_sides(en, zh, "en", "zh").collect()))
    assert got == [(3, True, False), (4, False, True)]
    with pytest.raises(ValueError):
        P.assert_paired(en, zh)
    P.assert_paired(en.where("pair_id < 3"), zh.where("pair_id < 3"))


def test_transpose_groups_rows_and_not_tokens(spark):
    df = spark.createDataFrame([("a", 0, 1, [4, 5]), ("a", 0, 0, [6]), ("a", 0, 0, [3]), ("b", 0, 0, []), ("b", 1, 0, None)],
                               "split string, batch_id long, row_in_batch int, ids array<int>")
    got = {(r["split"], r["t"]): r["ids"] for r in B.transpose_batches(df, "ids").collect()}
    assert got == {("a", 0): [3, 6, 4], ("a", 1): [5]}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = B.transpose_batches(B.pad_batches(df, "ids"), "ids")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange ") == 1
    assert plan.index("Generate") < plan.index("Aggregate")           # tokens are rows only after the batch is turned
