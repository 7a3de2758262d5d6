"""Batch and stream give the same rows."""

import pytest
from pyspark.sql import functions as F

from tandem.plans import catalog as C
from tandem.plans import inputs as I
from tandem.streaming import streams as ST
from tests.conftest import SF001


def test_clean_stream_equals_batch(spark):
    streamed = C.q_stream_clean(spark, SF001)
    lines = I.raw_bad(spark, SF001)
    batch = ST.clean_stream(lines)
    a = sorted(map(tuple, streamed.select("pair_id", "en", "zh", "split").collect()))
    b = sorted(map(tuple, batch.select("pair_id", "en", "zh", "split").collect()))
    assert a == b and len(a) > 0


def test_stream_bleu_equals_batch(spark):
    s = {r["n"]: (r["matches"], r["total"]) for r in C.q_stream_bleu_stats(spark, SF001).collect()}
    b = {r["n"]: (r["matches"], r["total"]) for r in C.q_bleu_stats(spark, SF001).collect()}
    assert s == b


def _published(spark, base, corpus):
    from tandem.operators import bpe as BP
    from tandem.sources import store
    m = BP.train_bpe(spark.createDataFrame([(1, corpus)], "k int, en string"), "en", "en")
    n = store.publish_encoded(spark, base, {"en_vocab": m.vocab_frame(spark), "en_merges": m.merges_frame(spark)})
    return m, n


def test_bpe_stream_survives_a_failure_and_takes_new_models(spark, tmp_path):
    """The sink fails after it wrote a batch; the restarted stream has every row once, and batches after a new
    version use its model."""
    from tandem.operators import bpe as BP
    base, src, out, ckpt = (str(tmp_path / n) for n in ("store", "src", "out", "ckpt"))
    first, n1 = _published(spark, base, "low lower lowest")

    def land(lo, hi):
        rows = [(i, f"low lowest <eos> w{i}") for i in range(lo, hi)]
        spark.createDataFrame(rows, "pair_id long, t string").coalesce(1).write.mode("append").parquet(src)

    for i in range(3):
        land(10 * i, 10 * i + 10)
    sentences = spark.readStream.schema("pair_id long, t string").option("maxFilesPerTrigger", 1).parquet(src)
    seen = []

    def failing(rows):
        seen.append(1)
        if len(seen) == 2:
            rows.write.mode("overwrite").parquet(f"{out}/batch=1")
            raise RuntimeError("lost after the write")
        return BP.bpe_encode(rows, "t", first).withColumn("model_version", F.lit(n1))

    with pytest.raises(Exception, match="lost after the write"):
        ST.run_to_batches(sentences, out, ckpt, failing)
    ST.encode_bpe_stream(sentences, base, "en", out, ckpt, text="t")
    second, n2 = _published(spark, base, "w1 w11 w21 w1 lowest")
    land(30, 40)
    ST.encode_bpe_stream(sentences, base, "en", out, ckpt, text="t")
    got = {r["pair_id"]: (r["ids"], r["model_version"]) for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).count() == 40 and sorted(got) == list(range(40)) and (n1, n2) == (1, 2)
    every = spark.createDataFrame([(i, f"low lowest <eos> w{i}") for i in range(40)], "pair_id long, t string")
    for model, number, keys in ((first, n1, range(30)), (second, n2, range(30, 40))):
        want = {r["pair_id"]: r["ids"] for r in BP.bpe_encode(every, "t", model).collect()}
        assert all(got[k] == (want[k], number) for k in keys)
