"""Training-corpus pipeline over ``documents``: language ID, near-dedup, benchmark decontamination,
mixing to target weights, token store.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as
the next stage's docs; all but the last return the columns of ``docs``, whatever further columns it has.

* language_id keeps documents of a known language (``und``: null text, no letter, goes);
* near_dedup keeps the smallest doc_id of each component, one row per doc_id (of several, the one whose text is the
  smallest by bytes, a null before all; of equal texts, the smallest row as JSON, so reruns agree);
* decontaminate drops contaminated documents;
* mix repeats each document as often as the mix takes it (0 to 3 times);
* token_store encodes what is left and returns one row per document from the files.

Rows with a null doc_id have no identity: near_dedup and decontaminate keep them, mix takes them once.
Empty tables stay empty.  Rows of one doc_id but different texts count as one document from near_dedup on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm import decontaminate as decontamination
from tandem.llm import langid, minhash, mixing, token_store
from tandem.llm.common import written
from tandem.llm.queries import END_ID, remainder, tokenizer_file
from tandem.session import read_table, scratch_path, ship_package

KEY = "doc_id"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    langs, table = langid.train(docs.where(remainder(KEY, 4) != 2).select("text", "lang"))
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*(F.col(c).alias(n) for c, n in names.items()))
    found = langid.identify(plain, langs, table, names[KEY], names["text"],
                            tuple(n for c, n in names.items() if c != KEY))
    found = found.where(F.col("lang_pred") != langid.UNKNOWN)
    return found.select(*(F.col(n).alias(c) for c, n in names.items()))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return docs.join(keys.select(KEY).distinct(), KEY, "left_anti").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = written(minhash.near_duplicates(docs), "deduped").where(F.col(KEY).isNotNull())
    gone = found.groupBy(KEY).agg(F.max("kept").alias("kept")).where("not kept")
    again = written(found.groupBy(KEY).agg(F.count("*").alias("n")).where("n > 1").select(KEY), "repeated")
    kept = _without(docs, gone)
    if again.isEmpty():
        return kept
    row = F.struct(*docs.columns)
    once = kept.join(again, KEY, "left_semi").groupBy(KEY).agg(
        F.min_by(row, F.struct("text", F.to_json(row))).alias("_row")).select("_row.*")
    return _without(kept, again).unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = decontamination.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    taken = mixing.mix(docs).where("size > 0").groupBy(KEY).agg(
        F.floor(F.avg(F.col("taken") / F.col("size"))).cast("int").alias("_times")).where("_times > 0")
    cols = [F.col(c) for c in docs.columns]
    once = docs.where(F.col(KEY).isNull())
    named = docs.where(F.col(KEY).isNotNull()).join(taken.withColumnRenamed(KEY, "_key"), F.col(KEY) == F.col("_key"))
    return named.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*cols).unionByName(once)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(docs, path, tokenizer_file(), END_ID)
    return token_store.read_documents(spark, path)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix", mix), ("token_store", tokens)]

#: No SQL states the learned languages or the tokenizer; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage_{name}")
    return docs
