"""Tab-separated corpora (S1-S4) with the field-count check.

A corpus line has no quoting rules, so the CSV reader is not used: lines come from
``spark.read.text`` (or any frame with a ``value`` column) and are split on the tab with empty
fields kept.  A wrong field count stops the job (``FAILFAST``, the reference's behaviour) or is
routed to a rejects frame (``QUARANTINE``) or dropped (``DROPMALFORMED``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import split_fields
from ..operators.encode import sized_broadcast

PAIR_FIELDS = ("en", "zh")                                  # S1
TITLE_FIELDS = ("zh", "en")                                 # S2: reversed on input (T2)
MINED_FIELDS = ("score", "en", "zh", "from_lang", "to_lang")  # S3

MODES = ("FAILFAST", "DROPMALFORMED", "QUARANTINE")


FILE_BITS = 40              # a line id is the file's number in path order, then the line's byte offset in the file


def _offsets(rows: DataFrame) -> DataFrame:
    """Adds ``inside``: bytes of the lines before a line in its split; a task reads the lines of a split in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = None, 0
        for b in batches:
            size = pc.binary_length(b.column("value")).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            start = b.column("start").to_numpy()
            file = b.column("file").dictionary_encode()
            code = file.indices.to_numpy(zero_copy_only=False)
            new = np.ones(len(size), bool)
            new[1:] = (code[1:] != code[:-1]) | (start[1:] != start[:-1])
            if len(size):
                new[0] = last != (file.dictionary[int(code[0])].as_py(), int(start[0]))
            total = np.cumsum(size)
            before = total - size
            first = np.flatnonzero(new)
            base = np.zeros(len(size), np.int64)
            cut = int(first[0]) if len(first) else len(size)
            base[:cut] = done
            base[cut:] = -np.repeat(before[first], np.diff(np.append(first, len(size))))
            inside = before + base
            if len(size):
                last, done = (file.dictionary[int(code[-1])].as_py(), int(start[-1])), int(inside[-1] + size[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(inside)], names=[*b.schema.names, "inside"])

    return rows.mapInArrow(run, "file string, start long, value string, inside long")


def read_text_lines(spark: SparkSession, paths: str | Sequence[str], folders: bool = False) -> DataFrame:
    """Lines of text files: ``pair_id, file, offset, value``.

    ``offset`` is the byte at which a line begins in its file and ``pair_id`` the file's number in path order with the
    offset behind it (``FILE_BITS``), so ids, and the seeded split that keys on them, are the same for every layout of
    the scan.  A file is read in splits by many tasks: one pass sums the bytes of the lines of every split (in the JVM, one
    row a split), whose running sum is the offset of the split's first line; the other numbers the lines behind it.  Lines end at a
    line feed; a carriage return before it is dropped.  Files beyond 1 TB or 8M files are refused.  With ``folders`` the files of
    a folder count as one, its parts in name order: the text that many tasks wrote there."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = (spark.read.option("lineSep", "\n").text(paths)
           .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"))
    whole = F.regexp_replace("file", "/[^/]*$", "") if folders else F.col("file")
    before = Window.partitionBy(whole).orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (raw.groupBy("file", "start").agg(F.sum(F.octet_length("value") + 1).cast("long").alias("size"))
              .withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))))
    files = F.broadcast(_file_numbers(spark, raw.select(whole.alias("whole"))))       # the listing the driver holds anyway
    heads = sized_broadcast(splits.join(files, whole == F.col("whole")).select("file", "start", "base", "number"))
    offset = F.col("base") + F.col("inside")
    checked = F.when((offset < 1 << FILE_BITS) & (F.col("number") < 1 << 63 - FILE_BITS), F.col("number")).otherwise(
        F.raise_error(F.lit("too many files or too large a file for line ids")).cast("long"))
    return _offsets(raw).join(heads, ["file", "start"]).select(
        (F.shiftleft(checked, FILE_BITS) + offset).alias("pair_id"), "file", offset.alias("offset"),
        F.regexp_replace("value", "\r$", "").alias("value"))


def _file_numbers(spark: SparkSession, raw: DataFrame) -> DataFrame:
    found = sorted(r["whole"] for r in raw.distinct().collect())
    return spark.createDataFrame([(f, i) for i, f in enumerate(found)], "whole string, number long")


def _arity_ok(fields, k: int):
    return F.size(fields) == k


def parse_fields(lines: DataFrame, names: Sequence[str], mode: str = "FAILFAST",
                 value_col: str = "value", keep: Sequence[str] = ("pair_id",)) -> DataFrame:
    """Split each line into ``names``.  ``mode`` as in the module doc; QUARANTINE returns only the
    good rows here -- use :func:`arity_rejects` for the others."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")
    k = len(names)
    fields = split_fields(F.col(value_col))
    keep = [c for c in keep if c in lines.columns]
    if mode == "FAILFAST":
        def checked(f):
            wrong = F.raise_error(F.format_string("expected %d tab-separated fields, got %d: %s", F.lit(k), F.size(f), F.col(value_col)))
            return F.when(~_arity_ok(f, k), wrong.cast("array<string>")).otherwise(f)
        # a generator: the line is split once, however often later columns and filters name a field
        parts = F.transform(F.transform(F.array(fields), checked), lambda f: F.struct(*[f[i].alias(n) for i, n in enumerate(names)]))
        return lines.select(*keep, F.inline(parts))
    parsed = lines.select(*keep, fields.alias("_f")).where(_arity_ok(F.col("_f"), k))
    return parsed.select(*keep, *[F.col("_f")[i].alias(n) for i, n in enumerate(names)])


def arity_rejects(lines: DataFrame, k: int, value_col: str = "value",
                  keep: Sequence[str] = ("pair_id",)) -> DataFrame:
    """P4 quarantine side: lines whose field count is not ``k``, with the count found."""
    keep = [c for c in keep if c in lines.columns]
    n = F.size(split_fields(F.col(value_col)))
    return lines.where(n != k).select(*keep, F.col(value_col).alias("line"),
                                      n.cast("int").alias("n_fields"))


def read_pairs(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``en<TAB>zh`` lines -> ``pair_id, en, zh``."""
    return parse_fields(lines, PAIR_FIELDS, mode)


def read_titles(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``zh<TAB>en`` lines -> ``pair_id, en, zh`` (order fixed on output)."""
    return parse_fields(lines, TITLE_FIELDS, mode).select("pair_id", "en", "zh")


def read_mined(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """S3: 5-field mined lines -> ``pair_id, score double, en, zh, from_lang, to_lang``.
    The margin score is kept (P9 needs it); Catalyst prunes whatever a caller does not select."""
    parsed = parse_fields(lines, MINED_FIELDS, mode)
    return parsed.withColumn("score", F.col("score").cast("double"))


def pairs_to_lines(df: DataFrame, first: str = "en", second: str = "zh") -> DataFrame:
    """S4 body: one ``first<TAB>second`` line per row."""
    return df.select(F.concat_ws("\t", F.col(first), F.col(second)).alias("value"))


def write_pairs_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``en<TAB>zh`` text files."""
    pairs_to_lines(df).write.mode(mode).text(path)
