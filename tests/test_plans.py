"""Plan checks: pruning and push-down reach the scan, joins are broadcast where bounded."""

import os

from pyspark.sql import functions as F

from tandem.operators import encode as E
from tandem.sources import encoded as ENC
from tests.conftest import SF01


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_load_split_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", [4]), (2, "val", [5]), (3, "test", [6])],
                               "pair_id long, split string, en_ids array<int>")
    path = os.path.join(str(tmp_path), "enc")
    ENC.write_encoded(df, path, model="word")
    v = ENC.load_split(spark, path, "eval", model="word")
    assert [r["pair_id"] for r in v.collect()] == [2]
    plan = _plan(v)
    assert "PartitionFilters" in plan and "split" in plan
    import pytest
    with pytest.raises(ValueError):
        ENC.load_split(spark, path, "dev", model="word")


def test_word_ids_are_looked_up_in_the_row(spark):
    vocab = spark.createDataFrame([("<unk>", 0), ("b", 5), ("a", 4)], "token string, id int")
    rows = [(1, ["a", "c", "b"]), (2, []), (3, None), (4, [None, "a"]), (5, ["a"] * 3)]
    df = spark.createDataFrame(rows, "pair_id long, t array<string>").repartition(2)
    want = {1: [4, 0, 5], 2: [], 3: [], 4: [0, 4], 5: [4, 4, 4]}
    out = E.word_ids(df, "t", vocab)
    assert {r["pair_id"]: r["ids"] for r in out.collect()} == want
    assert "Generate" not in _plan(out) and "Join" not in _plan(out)
    large = E.word_ids(df, "t", vocab, max_bytes=0)          # joined by shuffle, salted
    assert {r["pair_id"]: r["ids"] for r in large.collect()} == want and "Join" in _plan(large)
    sides = {"x": F.col("t"), "y": F.reverse("t")}
    both = [{r["pair_id"]: (r["x"], r["y"]) for r in E.word_ids_sides(df, ["pair_id"], sides, vocab, max_bytes=m).collect()}
            for m in (0, E.SHIP_BYTES)]
    assert both[1] == {k: (v, v[::-1]) for k, v in want.items()}
    assert {k: v for k, v in both[0].items() if k != 3} == {k: v for k, v in both[1].items() if k != 3}


def test_ids_are_decoded_in_the_row(spark):
    vocab = spark.createDataFrame([("<eos>", 3), ("a", 4), ("b", 7)], "token string, id int")
    rows = [(1, [2, 7, 5, 4, 3]), (2, []), (3, None), (4, [3]), (5, [4, 4])]
    df = spark.createDataFrame(rows, "pair_id long, i array<int>").repartition(2)
    want = {1: "b a", 2: "", 3: "", 4: "", 5: "a a"}
    for m in (0, E.SHIP_BYTES):
        assert {r["pair_id"]: r["text"] for r in E.decode_ids(df, "i", vocab, max_bytes=m).collect()} == want
    from tandem.operators.scoring import parallel_decode
    assert {r["pair_id"]: r["text"] for r in parallel_decode(df, "i", vocab).collect()} == want
    none = vocab.limit(0)
    assert {r["text"] for r in E.decode_ids(df, "i", none).collect()} == {""}


def test_scan_prunes_columns(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where(F.col("lang") == "en").select("doc_id")
    plan = _plan(docs)
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_registered_plans_have_no_cartesian_or_row_udfs(spark):
    """No cartesian product, nested-loop join or row-at-a-time Python UDF in the main pipelines;
    a single-partition exchange only appears under a global aggregate of already-partial sums."""
    import __spark_entry__ as E
    from tests.conftest import SF001
    qs = E.queries()
    for k in ["prepare_bitext", "word_ids", "bleu_stats", "model_batches", "log_series",
              "normalize_text", "assign_batches", "pad_batches"]:
        plan = _plan(qs[k](spark, SF001))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in plan, (k, bad)
        assert "SinglePartition" not in plan, k
