import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tandem.llm import token_store
from tandem.llm.common import written
from tandem.llm.queries import tokenizer_file
from tests.conftest import SF001
from tests.llm import fixture
from tests.llm.test_minhash import brute as brute_components
from tests.llm.test_native import brute_mix
from tests.llm.test_scans import brute_contamination, words


def test_stages_equal_brute_force(spark):
    """Each stage on its own input, then the files against the tokenizer."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn("score", F.lit(1))
    columns = docs.columns
    docs = docs.unionByName(spark.createDataFrame([(9001, None, "en", "a", 0, 1), (9002, "12 %%", "en", "a", 5, 1)], docs.schema))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]

    def step(name, docs):
        out = written(stages[name](spark, docs, SF001), name)
        if name != "token_store":
            assert out.columns == columns
        return out

    known = step("language_id", docs)
    ids = lambda d: sorted(r[0] for r in d.select("doc_id").collect())
    assert set(ids(docs)) - set(ids(known)) == {9001, 9002}
    once = step("near_dedup", known)
    comp, _ = brute_components([(r.doc_id, r.text) for r in known.collect()])
    assert ids(once) == sorted(set(comp.values()))
    clean = step("decontaminate", once)
    dirty = {r[0] for r in brute_contamination([(r.doc_id, r.text) for r in once.collect()], bench) if r[5]}
    assert dirty and ids(clean) == sorted(set(ids(once)) - dirty)
    mixed = step("mix", clean)
    want = Counter({r[0]: r[4] // r[1] for r in brute_mix([(r.doc_id, r.text, r.source) for r in clean.collect()]) if r[4]})
    assert Counter(ids(mixed)) == want and max(want.values()) > 1
    stored = step("token_store", mixed).orderBy("start").collect()
    tok, start = token_store.encoder(tokenizer_file()).tokenizer, 0
    for g, r in zip(stored, mixed.orderBy("doc_id").collect(), strict=True):
        got = [*tok.encode(r.text, add_special_tokens=False).ids, 2]
        assert tuple(g) == (r.doc_id, start, len(got), zlib.crc32(np.array(got, "<u4").tobytes()))
        start += len(got)
    assert words("A b") == ["a", "b"]


def test_run_on_odd_rows(spark, tmp_path):
    fixture.documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "one two")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_run_on_an_empty_table(spark, tmp_path):
    fixture.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_repeated_id_keeps_the_smallest_text_in_any_row_order(spark):
    rows = [(1, "b text", "x"), (1, "a text", "z"), (1, "a text", "y"), (2, "two", "x"), (None, "t", "x"), (None, "t", "x")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string")
        out = corpus_pipeline.near_dedup(spark, docs, SF001)
        assert out.columns == docs.columns
        got = sorted(map(tuple, out.collect()), key=str)
        assert got == sorted([(1, "a text", "y"), (2, "two", "x"), (None, "t", "x"), (None, "t", "x")], key=str)
    empty = docs.limit(0)
    assert corpus_pipeline.near_dedup(spark, empty, SF001).count() == 0
