"""Loss extraction (T21-T23) and the epoch axis."""

import pytest
from pyspark.sql import functions as F

from tandem.functions import logs as L
from tandem.operators import logs as LO
from tests.conftest import SF01


def test_loss_line_goldens(spark):
    lines = ["batch loss at 1 = 6.2345", "batch loss at 1 = 10.123", "batch loss at 1 = 6",
             "batch loss at 1 = 1.5e-05", "x batch loss at 2 = 1.5"]
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    got = [r[0] for r in df.select(L.loss_from_line("v")).collect()]
    assert got == [6.2, 10.1, None, 1.5, None]


def test_loss_dict(spark):
    df = spark.createDataFrame([("{'loss': 3.21, 'learning_rate': 1e-05, 'epoch': 0.1}",),
                                ("{'eval_loss': 3.1}",), ("{'train_loss': 3.1}",)], "v string")
    assert [r[0] for r in df.select(L.loss_from_dict("v")).collect()] == [3.21, None, None]
    bad = spark.createDataFrame([("{'loss': oops}",)], "v string")
    with pytest.raises(Exception):
        bad.select(L.loss_from_dict("v")).collect()


def test_epoch_axis(spark):
    one = spark.createDataFrame([("m", 1, 2.0)], "model string, seq long, loss double")
    assert [r["epoch"] for r in LO.epoch_axis(one, ["seq"]).collect()] == [0.0]
    three = spark.createDataFrame([("m", i, 1.0) for i in range(3)], "model string, seq long, loss double")
    assert sorted(r["epoch"] for r in LO.epoch_axis(three, ["seq"]).collect()) == [0.0, 2.5, 5.0]


def test_own_log_series_golden(spark):
    from tandem.plans import inputs as I
    s = LO.loss_series(I.log_own(spark, SF01).withColumn("model", F.lit("RNN")),
                       dict_format=F.lit(False))
    r = s.agg(F.count("*").alias("n"), F.sum("loss").alias("l"), F.sum("epoch").alias("e")).first()
    assert r["n"] == 7975 and round(r["l"], 6) == 395990.0 and round(r["e"], 6) == 19937.5
