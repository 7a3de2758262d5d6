"""Training logs -> loss series.

A log is a text file; the parser is chosen by its path (``mt5`` in the name -> one dict per line,
otherwise the ``batch loss at`` pattern).  Missing and zero losses are dropped (F26), and each loss
gets its epoch coordinate ``5 * i / (n - 1)`` by order within its log (W3; n = 1 gives 0).  Line
order comes from :func:`dense_position`, never from a single-partition window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.logs import loss_from_dict, loss_from_line
from .split import dense_position

EPOCHS = 5
DICT_LOG_MARKER = "mt5"


def parse_losses(lines: DataFrame, value: str = "value", dict_format=None,
                 full: bool = False) -> DataFrame:
    """F24 / F25 chosen per row: ``dict_format`` is a boolean Column (default: the ``file``
    column contains ``mt5``, as the reference decides by file name)."""
    if dict_format is None:
        dict_format = F.col("file").contains(DICT_LOG_MARKER)
    loss = F.when(dict_format, loss_from_dict(value)).otherwise(loss_from_line(value, full))
    return lines.withColumn("loss", loss)


def drop_missing(df: DataFrame) -> DataFrame:
    """``if x:`` -- no null and no zero loss."""
    return df.where(F.col("loss").isNotNull() & (F.col("loss") != 0))


def epoch_axis(df: DataFrame, order: Sequence[str], by: Sequence[str] = ("model",),
               epochs: int = EPOCHS) -> DataFrame:
    """``idx`` (0-based) and ``epoch = epochs * idx / (n - 1)`` within each log."""
    pos = dense_position(df, list(order), by=list(by), out="idx", total="_n")
    n = F.col("_n")
    epoch = F.when(n > 1, F.lit(float(epochs)) * F.col("idx") / (n - 1)).otherwise(F.lit(0.0))
    return pos.withColumn("epoch", epoch).drop("_n")


def loss_series(lines: DataFrame, order: Sequence[str] = ("seq",), by: Sequence[str] = ("model",),
                dict_format=None, epochs: int = EPOCHS) -> DataFrame:
    """C6 on line frames: ``by..., order..., loss, idx, epoch``."""
    parsed = drop_missing(parse_losses(lines, dict_format=dict_format))
    return epoch_axis(parsed, order, by, epochs)


def read_logs(spark: SparkSession, files: Mapping[str, str]) -> DataFrame:
    """``{legend: path}`` -> ``model, file, block, line, value`` where ``(file, block, line)``
    is the order of lines inside a log (file path, split start, row inside the split)."""
    frames = []
    for legend, path in files.items():
        f = (spark.read.text(path)
             .select(F.lit(legend).alias("model"), F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"), "value"))
        frames.append(f)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def log_series(spark: SparkSession, files: Mapping[str, str], epochs: int = EPOCHS) -> DataFrame:
    """Logs by legend -> ``model, idx, epoch, loss``."""
    lines = read_logs(spark, files)
    s = loss_series(lines, order=("file", "block", "line"), epochs=epochs)
    return s.select("model", "idx", "epoch", "loss")
