"""Pair cleaning: strip (P1), non-empty filter (P2), script conversion (P3, J5, F3), task prefix
(P6), margin-score filter (P9) and the empty-reference check with neighbours (P10, W2)."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import bound, is_ascii, py_strip
from .encode import SHIP_BYTES

# A few Traditional -> Simplified entries, enough for tests and examples.  Real
# dictionaries are passed in as tables (the full public dictionaries are not shipped).
SAMPLE_T2S_CHARS = {"電": "电", "腦": "脑", "軟": "软", "體": "体", "語": "语", "漢": "汉",
                    "國": "国", "們": "们", "學": "学", "書": "书", "時": "时", "東": "东"}
SAMPLE_T2S_PHRASES = {"軟體": "软件", "資訊": "信息"}


def strip_pairs(df: DataFrame, cols: Sequence[str] = ("en", "zh")) -> DataFrame:
    """Python ``strip()`` on each side."""
    return df.withColumns({c: py_strip(c) for c in cols})


def nonempty_pairs(df: DataFrame, cols: Sequence[str] = ("en", "zh")) -> DataFrame:
    """Keep rows whose sides are all non-empty (after strip)."""
    cond = None
    for c in cols:
        e = F.length(F.col(c)) > 0
        cond = e if cond is None else cond & e
    return df.where(cond)


def clean_pairs(df: DataFrame, cols: Sequence[str] = ("en", "zh")) -> DataFrame:
    """P1 then P2, as the corpus loop does.  A row gives one pair or none: as a filter over the stripped columns the texts
    would be cut out of their line and stripped once for the filter and again for the columns."""
    pair = F.array(F.struct(*[py_strip(c).alias(c) for c in cols]))
    kept = F.filter(pair, lambda p: functools.reduce(lambda a, b: a & b, [F.length(p[c]) > 0 for c in cols]))
    return df.select(*[c for c in df.columns if c not in cols], F.inline(kept)).select(*df.columns)


def prefix_source(df: DataFrame, prefix: str = "", col: str = "en") -> DataFrame:
    """Constant task prefix on the source side (empty by default, as in the reference)."""
    return df.withColumn(col, F.concat(F.lit(prefix), F.col(col))) if prefix else df


def margin_filter(df: DataFrame, threshold: float, col: str = "score") -> DataFrame:
    """Keep mined pairs whose margin score is at least ``threshold``."""
    return df.where(F.col(col) >= F.lit(threshold))


# ---------------------------------------------------------------------------------------------
# Script conversion
# ---------------------------------------------------------------------------------------------

def _as_mapping(table, max_bytes: int = SHIP_BYTES) -> dict[str, str]:
    """A dictionary given as a mapping or as a DataFrame (source, target).  Of several targets of a source the smallest
    is taken; rows with a null are left out.  A table is sized before it is brought over: more than
    ``max_bytes`` is refused."""
    if table is None:
        return {}
    if isinstance(table, Mapping):
        return dict(table)
    rows = table.toDF("src", "dst").dropna().groupBy("src").agg(F.min("dst").alias("dst")).persist()
    size = rows.agg(F.sum(F.octet_length("src") + F.octet_length("dst") + 16)).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"a dictionary of {size} bytes; at most {max_bytes} are sent to the tasks")
    found = rows.orderBy("src").toArrow()
    rows.unpersist()
    return dict(zip(found["src"].to_pylist(), found["dst"].to_pylist()))


def convert_chars(col: Column | str, chars) -> Column:
    """Single-character dictionary as one JVM ``translate``, which ASCII text skips if no character of it is mapped."""
    mapping = {k: v for k, v in _as_mapping(chars).items() if len(k) == 1 and len(v) == 1}
    c = F.col(col) if isinstance(col, str) else col
    if not mapping:
        return c
    def converted(c):
        return F.translate(c, "".join(mapping), "".join(mapping.values()))
    if any(ch.isascii() for ch in mapping):
        return converted(c)
    return bound(c, lambda t: F.when(is_ascii(t), t).otherwise(converted(t)))


_BUILT: dict[str, ahocorasick.Automaton] = {}


def _automaton(name: str, phrases: dict[str, str]) -> ahocorasick.Automaton:
    """The automaton of a dictionary, built once a worker process (the one in use is kept)."""
    if name not in _BUILT:
        auto = ahocorasick.Automaton()
        for src, dst in phrases.items():
            auto.add_word(src, (len(src), dst))
        auto.make_automaton()
        _BUILT.clear()
        _BUILT[name] = auto
    return _BUILT[name]


def replace_phrases(text: str, auto: ahocorasick.Automaton) -> str:
    """``text`` with its leftmost-longest phrases replaced.  The automaton names all occurrences by rising end, so the last
    one of a start is its longest."""
    longest = {end - n + 1: (n, dst) for end, (n, dst) in auto.iter(text)}
    out, at = [], 0
    for start in sorted(longest):
        if start >= at:
            n, dst = longest[start]
            out += [text[at: start], dst]
            at = start + n
    return "".join([*out, text[at:]]) if out else text


def convert_phrases(col: Column | str, phrases) -> Column:
    """phrases of a dictionary (mapping or table) replaced leftmost-longest by one automaton over all of them, Arrow
    batches in the row, for batch and streaming frames alike.  A null stays null; an empty dictionary changes nothing; time
    grows with the text and the occurrences in it, not with the dictionary or the length of its phrases."""
    c = F.col(col) if isinstance(col, str) else col
    phrase_map = {k: v for k, v in _as_mapping(phrases).items() if k}
    if not phrase_map:
        return c
    sent = SparkSession.getActiveSession().sparkContext.broadcast(phrase_map)
    name = uuid.uuid4().hex

    @F.arrow_udf("string")
    def convert(rows: pa.Array) -> pa.Array:
        auto = _automaton(name, sent.value)
        return pa.array([x if x is None else replace_phrases(x, auto) for x in rows.to_pylist()], pa.string())

    return convert(c)


def convert_script(col: Column | str, chars=None, phrases=None) -> Column:
    """F3 then J5: phrases by leftmost-longest match, then the character table (JVM).  Without phrases everything stays in
    the JVM."""
    phrase_map = {k: v for k, v in _as_mapping(phrases).items() if len(k) > 1}
    return convert_chars(convert_phrases(col, phrase_map), chars)


def convert_where(df: DataFrame, col: str = "zh", tag_col: str = "to_lang",
                  mode: str = "all", chars=None, phrases=None) -> DataFrame:
    """Conditional conversion.  ``mode="all"`` is the reference's effective behaviour (its
    tag test never holds, T1); ``"non_simplified"`` converts only rows not tagged ``zh-Hans``."""
    conv = convert_script(col, chars, phrases)
    if mode == "all":
        return df.withColumn(col, conv)
    if mode == "non_simplified":
        return df.withColumn(col, F.when(F.col(tag_col) != "zh-Hans", conv).otherwise(F.col(col)))
    raise ValueError(f"unknown convert mode {mode!r}")


# ---------------------------------------------------------------------------------------------
# Empty decoded references with their neighbours
# ---------------------------------------------------------------------------------------------

def empty_refs(df: DataFrame, ref: str = "ref", batch: str | Sequence[str] = ("split", "batch_id"),
               pos: str = "pos", fail: bool = False) -> DataFrame:
    """Rows whose reference is empty after strip, with the previous and next reference of the same
    batch (null at the edges, T26).  Batches have a bounded size, so the window per batch is
    bounded too.  ``fail=True`` stops the job on the first such row."""
    cols = [batch] if isinstance(batch, str) else list(batch)
    w = Window.partitionBy(*cols).orderBy(pos)
    ctx = df.select(*cols, pos, ref, F.lag(ref).over(w).alias("prev_ref"),
                    F.lead(ref).over(w).alias("next_ref"))
    bad = ctx.where(F.length(py_strip(ref)) == 0)
    if fail:
        where = F.concat_ws("/", *[F.col(c).cast("string") for c in cols])
        bad = bad.withColumn(ref, F.raise_error(F.format_string(
            "empty reference at batch %s position %s", where, F.col(pos))).cast("string"))
    return bad
