"""Batched calls over a dataset: parallel decode (X2) and a caller's predictor.

Both run per partition in Python with Arrow batches; the dictionary or model is shipped once per
executor (broadcast / ``make_predict_fn``), never per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import SPECIALS
from .encode import decode_ids, decode_lists, shipped


def parallel_decode(df: DataFrame, ids: str, vocab: DataFrame, key: str = "pair_id",
                    out: str = "text", sep: str = " ") -> DataFrame:
    """Ids -> text per partition (``mapInArrow``) with the id -> token table sent once, specials skipped; a table too
    large to send (:func:`tandem.operators.encode.shipped`) is joined instead."""
    sent = shipped(vocab)
    if sent is None:
        return decode_ids(df, ids, vocab, key=key, out=out, sep=sep, max_bytes=0)
    key_type = df.schema[key].dataType.simpleString()
    decode = decode_lists(sent, len(SPECIALS), sep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(key), decode(b.column(ids))], names=[key, out])

    return df.select(key, ids).mapInArrow(run, f"{key} {key_type}, {out} string")


def predict_batches(df: DataFrame, ids: str, make_predict_fn: Callable, seq_len: int,
                    batch_size: int = 2048, out: str = "pred") -> DataFrame:
    """The caller's predictor over fixed-length id rows in batches of ``batch_size``
    (``predict_batch_udf``); rows must already be padded to ``seq_len``."""
    from pyspark.ml.functions import predict_batch_udf
    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.IntegerType()),
                            batch_size=batch_size, input_tensor_shapes=[[seq_len]])
    return df.withColumn(out, udf(F.col(ids)))


def substitution_predictor(vocab_size: int, mult: int = 7, add: int = 3):
    """A stand-in predictor for tests: every non-special id ``x`` becomes
    ``(x * mult + add) % vocab_size`` (specials kept)."""
    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            x = x.astype(np.int64)
            y = (x * mult + add) % vocab_size
            return np.where(x < len(SPECIALS), x, y).astype(np.int32)
        return predict
    return make
