"""Composite pipelines a user calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import MAX_IDS
from ..operators import bpe as BP, unigram as UG
from ..operators.clean import (clean_pairs, convert_script, convert_where, margin_filter,
                               prefix_source)
from ..operators.split import SEED, exact_split, union_corpora
from ..sources import store
from ..sources.tsv import read_mined, read_pairs, read_titles


def prepare_bitext(news_lines: DataFrame | None = None, titles_lines: DataFrame | None = None,
                   mined_lines: DataFrame | None = None, *, seed: int = SEED,
                   convert: str = "all", chars=None, phrases=None, prefix: str = "",
                   min_margin: float | None = None, mode: str = "FAILFAST",
                   positions: bool = False, sides: Sequence[str] = ("en", "zh")) -> DataFrame:
    """Raw corpora -> parse (S1-S3, P4) -> script conversion (F3, P3) -> union
    -> strip + non-empty (P1, P2) -> prefix (P6) -> exact seeded split (U2).

    Inputs are line frames (``pair_id, value``), e.g. from ``read_text_lines``.  Output:
    ``corpus, pair_id, en, zh, split`` (only those of the two texts that are named in ``sides``; rows and splits are the
    same); with ``positions`` also ``split_pos`` and ``split_size``, from which
    batches follow without another shuffle (:func:`tandem.operators.batch.batches_at`).
    """
    frames = {}
    if news_lines is not None:
        frames["news"] = read_pairs(news_lines, mode)
    if titles_lines is not None:
        t = read_titles(titles_lines, mode)
        frames["titles"] = t.withColumn("zh", convert_script("zh", chars, phrases))
    if mined_lines is not None:
        m = read_mined(mined_lines, mode)
        if min_margin is not None:
            m = margin_filter(m, min_margin)
        frames["mined"] = convert_where(m, mode=convert, chars=chars, phrases=phrases) \
            .select("pair_id", "en", "zh")
    united = union_corpora(frames)
    cleaned = prefix_source(clean_pairs(united), prefix).drop(*{"en", "zh"}.difference(sides))
    more = ("split_pos", "split_size") if positions else (None, None)
    return exact_split(cleaned, ["corpus", "pair_id"], seed=seed, pos=more[0], total=more[1]).select(
        "corpus", "pair_id", *sides, "split", *(more if positions else ()))


def split_summary(df: DataFrame) -> DataFrame:
    """The one-query view of C1: rows and mean side lengths per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.round(F.avg(F.length("en")), 6).alias("avg_en_chars"),
        F.round(F.avg(F.length("zh")), 6).alias("avg_zh_chars"))


def encode_bitext_bpe(pairs: DataFrame, base: str, key: Sequence[str] = ("corpus", "pair_id"),
                      vocab_size: int = BP.VOCAB_SIZE) -> int:
    """Learn a model per side on the train split, encode every split with them, and publish models and splits as one
    version below ``base`` (its number is returned)."""
    spark = pairs.sparkSession
    train = pairs.where(F.col("split") == "train")
    models = {side: BP.train_bpe(train, side, side, vocab_size=vocab_size) for side in ("en", "zh")}
    coded = BP.bpe_encode(pairs, "en", models["en"], key=[*key, "split", "zh"], out="en_ids")
    coded = BP.bpe_encode(coded, "zh", models["zh"], key=[*key, "split", "en_ids"], out="zh_ids")
    tables = {f"{side}_{kind}": frame for side, m in models.items()
              for kind, frame in (("vocab", m.vocab_frame(spark)), ("merges", m.merges_frame(spark)))}
    return store.publish_encoded(spark, base, tables, coded)


def encode_bitext_pieces(pairs: DataFrame, base: str, pieces: DataFrame, key: Sequence[str] = ("corpus", "pair_id"),
                         max_ids: int = MAX_IDS, byte_fallback: bool = False) -> int:
    """Encode both sides of every split with given pieces and publish the pieces and the splits as one version."""
    keys = list(key)
    both = UG.unigram_encode_sides(pairs, {"en": "en", "zh": "zh"}, pieces, [*keys, "split"], max_ids, byte_fallback)
    return store.publish_encoded(pairs.sparkSession, base, {"pieces": pieces}, both)


def load_bpe_model(spark: SparkSession, base: str, side: str, number: int | None = None) -> BP.BpeModel:
    """The model of one side of a published version."""
    number, _ = store.published(spark, base, number)
    return BP.BpeModel.from_frames(side, *(store.load_table(spark, base, f"{side}_{kind}", number) for kind in ("vocab", "merges")))
