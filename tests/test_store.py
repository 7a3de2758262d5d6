"""Published versions: whole or not at all, models and splits together."""

import os

import pytest
from pyspark.sql import functions as F

from tandem.operators import bpe as BP, unigram as UG
from tandem.plans import pipelines as PL
from tandem.sources import store


def pairs(spark, n=120):
    rows = [("news", i, f"low lower number {i} <eos>", f"ab abc {i} caf\u00e9", ["train", "train", "val", "test"][i % 4]) for i in range(n)]
    return spark.createDataFrame(rows, "corpus string, pair_id long, en string, zh string, split string")


def test_bpe_version_is_written_and_read_back(spark, tmp_path):
    base, df = str(tmp_path / "s"), pairs(spark)
    number = PL.encode_bitext_bpe(df, base, vocab_size=60)
    train = df.where("split = 'train'")
    for side in ("en", "zh"):
        direct = BP.train_bpe(train, side, side, vocab_size=60)
        again = PL.load_bpe_model(spark, base, side, number)
        assert (again.tokens, again.merges) == (direct.tokens, direct.merges)
        want = {r["pair_id"]: r["ids"] for r in BP.bpe_encode(df, side, direct).collect()}
        got = {}
        for typ, split in (("train", "train"), ("eval", "val"), ("test", "test")):
            part = store.load_published(spark, base, typ)
            assert {r["split"] for r in part.collect()} == {split}
            got |= {r["pair_id"]: r[f"{side}_ids"] for r in part.collect()}
        assert got == want


def test_pieces_version_is_written_and_read_back(spark, tmp_path):
    base, df = str(tmp_path / "s"), pairs(spark)
    pieces = spark.createDataFrame([("\u2581low", -1.0, 3), ("er", -2.0, 4), ("\u2581ab", -1.5, 5), ("c", -3.0, 6), ("\u2581", -4.0, 7)],
                                   "piece string, score double, id int")
    PL.encode_bitext_pieces(df, base, pieces, max_ids=6)
    back = {r["pair_id"]: r for r in store.load_published(spark, base, "val").collect()}
    for r in UG.unigram_encode(df.where("split = 'val'"), "zh", pieces, max_ids=6).collect():
        assert back[r["pair_id"]]["zh_ids"] == r["input_ids"] and back[r["pair_id"]]["zh_mask"] == r["attention_mask"]
    assert len(back) == 30 and store.load_table(spark, base, "pieces").count() == 5


def test_versions_are_whole(spark, tmp_path):
    base = str(tmp_path / "s")
    with pytest.raises(ValueError, match="no published version"):
        store.published(spark, base)
    one = spark.range(3).withColumn("split", F.lit("train"))
    assert store.publish_encoded(spark, base, {"t": spark.range(1)}, one) == 1

    def dies(folder):
        spark.range(9).write.parquet(f"{folder}/tables/t")
        raise RuntimeError("writer lost")

    with pytest.raises(RuntimeError):
        store.publish(spark, base, dies)
    assert store.versions(spark, base) == [1] and len(os.listdir(base)) == 2          # its folder is gone
    open(f"{base}/_commits/000000002", "w").close()                                   # a commit that was never finished
    assert store.published(spark, base)[0] == 1
    assert store.publish_encoded(spark, base, {"t": spark.range(5)}, one.limit(1)) == 3
    assert store.load_table(spark, base, "t").count() == 5 and store.load_table(spark, base, "t", 1).count() == 1
    assert store.load_published(spark, base, "train").count() == 1 and store.load_published(spark, base, "train", 1).count() == 3
    with pytest.raises(ValueError, match="unknown split"):
        store.load_published(spark, base, "dev")


def test_reading_a_split_prunes_the_others(spark, tmp_path):
    base = str(tmp_path / "s")
    store.publish_encoded(spark, base, {}, spark.range(30).withColumn("split", F.element_at(
        F.array(*map(F.lit, ("train", "val", "test"))), (F.col("id") % 3 + 1).cast("int"))))
    plan = store.load_published(spark, base, "eval")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "(split#" in plan.split("PartitionFilters")[1]
