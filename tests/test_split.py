"""Exact split sizes (T8), disjointness, determinism and partition-count independence."""

from pyspark.sql import functions as F

from tandem.operators import split as S


def _split_counts(spark, n):
    df = spark.range(n).withColumnRenamed("id", "pair_id")
    out = S.exact_split(df, ["pair_id"])
    return {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}, out


def test_split_sizes(spark):
    c, _ = _split_counts(spark, 1000)
    assert (c["test"], c["val"], c["train"]) == (200, 100, 700)
    c, out = _split_counts(spark, 233)
    assert (c["test"], c["val"], c["train"]) == (47, 24, 162)
    parts = {s: out.where(F.col("split") == s).select("pair_id") for s in ("train", "val", "test")}
    assert parts["train"].intersect(parts["test"]).count() == 0
    assert parts["val"].intersect(parts["test"]).count() == 0
    assert out.select("pair_id").distinct().count() == 233


def test_split_deterministic(spark):
    _, a = _split_counts(spark, 500)
    _, b = _split_counts(spark, 500)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_dense_position_independent_of_partitions(spark):
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("k"), F.col("id"))
    expected = sorted((r["k"], r["id"]) for r in df.collect())
    rank = {t: i for i, t in enumerate(expected)}
    for n in (1, 4, 17):
        out = S.dense_position(df.repartition(n), ["k", "id"], num_partitions=n).collect()
        assert all(rank[(r["k"], r["id"])] == r["pos"] for r in out)
        assert len(out) == 2000


def test_dense_position_by_group(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("g"), F.col("id"))
    out = S.dense_position(df, ["id"], by=["g"], total="n").collect()
    for r in out:
        assert r["pos"] == r["id"] // 3 and r["n"] == 100


def test_positions_are_a_scan_of_written_rows(spark):
    """What is returned reads two written tables: no shuffle of rows, no single partition, nothing persisted, at any
    number of partitions."""
    df = spark.range(1000).withColumnRenamed("id", "pair_id")
    for n in (200, 2000):
        ordered = df.withColumn("k", S.seeded_key(1, "pair_id"))
        out = S.dense_position(ordered, ["k", "pair_id"], num_partitions=n, bucket=S.hash_key_buckets("k", n), total="n")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        for bad in ("hashpartitioning", "rangepartitioning", "SinglePartition", "InMemoryTableScan"):
            assert bad not in plan, bad
        assert sorted(r["pos"] for r in out.collect()) == list(range(1000))


def test_places_in_the_split(spark):
    df = spark.range(503).withColumnRenamed("id", "pair_id")
    rows = S.exact_split(df, ["pair_id"], pos="p", total="n").collect()
    again = S.dense_position(S.exact_split(df, ["pair_id"]).withColumn("k", S.seeded_key(1, "pair_id")),
                             ["k", "pair_id"], by=["split"], total="n").collect()
    assert {(r["pair_id"], r["split"], r["p"], r["n"]) for r in rows} == {
        (r["pair_id"], r["split"], r["pos"], r["n"]) for r in again}
    assert S.exact_split(df.limit(0), ["pair_id"], pos="p", total="n").collect() == []


def test_hash_split_rates(spark):
    df = spark.range(20000).withColumnRenamed("id", "pair_id")
    c = {r["split"]: r["count"] for r in S.hash_split(df, ["pair_id"]).groupBy("split").count().collect()}
    assert abs(c["test"] / 20000 - 0.2) < 0.02 and abs(c["val"] / 20000 - 0.1) < 0.02


def test_exact_split_independent_of_shuffle_partitions(spark):
    df = spark.range(700).withColumnRenamed("id", "pair_id")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(map(tuple, S.exact_split(df, ["pair_id"]).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]


def test_many_groups_null_group_and_clashing_columns(spark):
    """Any number of groups, null as a group of its own, a column named like the result, the written tables
    deleted on release."""
    import os

    from tandem import session
    df = spark.range(3000).select(F.when(F.col("id") % 10 > 0, F.col("id") % 1000).alias("g"), "id", F.lit("x").alias("pos"))
    out = S.dense_position(df, ["id"], by=["g"], total="n").collect()
    groups = {}
    for r in sorted(out, key=lambda r: r["id"]):
        groups.setdefault(r["g"], []).append((r["pos"], r["n"]))
    assert len(out) == 3000 and len(groups) == 901 and len(groups[None]) == 300
    assert all(v == [(i, len(v)) for i in range(len(v))] for v in groups.values())
    large = S.dense_position(df, ["id"], by=["g"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # offsets too large to broadcast
    try:
        assert sorted((r["id"], r["pos"]) for r in large.collect()) == sorted((r["id"], r["pos"]) for r in out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    written = list(session._WRITTEN)
    session.release(spark)
    assert written and not any(os.path.exists(w) for w in written)


def test_word_vocab_golden(spark):
    from tandem.plans import catalog as C
    from tests.conftest import SF01
    v = C.doc_word_vocab(spark, SF01)
    r = v.agg(F.count("*").alias("n"), F.max("id").alias("m")).first()
    assert r["n"] - 4 == 12515 and r["m"] == 12518
    first = {row["id"]: row["token"] for row in v.where(F.col("id") < 4).collect()}
    assert first == {0: "<unk>", 1: "<pad>", 2: "<bos>", 3: "<eos>"}


def test_hot_first_key_is_split_across_partitions(spark):
    """A third of the rows share one first key or one group: ranges are of whole key tuples, so its rows still spread
    over several partitions, and the positions stay exact."""
    n = 3000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id"))
    dealt = df.repartitionByRange(8, "k", "id").withColumn("b", F.spark_partition_id())
    assert max(r["count"] for r in dealt.groupBy("b").count().collect()) < n / 4
    assert dealt.where(F.col("k") == 0).select("b").distinct().count() >= 2
    expected = {t: i for i, t in enumerate(sorted((r["k"], r["id"]) for r in df.collect()))}
    out = S.dense_position(df, ["k", "id"]).collect()
    assert all(expected[(r["k"], r["id"])] == r["pos"] for r in out)
    grouped = S.dense_position(df, ["id"], by=["k"]).where("k = 0").collect()
    assert sorted(r["pos"] for r in grouped) == list(range(n // 3))
