"""Column functions for text: strip, split, normalise, pre-tokenise, byte-level codec, BLEU tokeniser.

All are ``Column -> Column`` so the same call serves batch and streaming frames.  Everything stays
in the JVM except the rare characters whose normal form is longer than one character (F2), which
go through an Arrow-batched pandas UDF; the other rows send a null across.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's library behaviour)
# ---------------------------------------------------------------------------------------------

# Characters removed by Python's str.strip() / split(): U+0009-000D, 001C-0020, 0085, 00A0, 1680,
# 2000-200A, 2028, 2029, 202F, 205F, 3000 (29 code points).
PY_WHITESPACE = "".join(chr(cp) for cp in [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
])

# Special symbols of the BPE models: ids 0..3.
SPECIALS = ["<unk>", "<pad>", "<bos>", "<eos>"]
UNK_ID, PAD_ID, BOS_ID, EOS_ID = 0, 1, 2, 3

# Word pre-tokeniser (library "Whitespace"): words or runs of other non-space characters.
WORD_PATTERN = r"(?U)\w+|[^\w\s]+"
WORD_PATTERN_ASCII = r"\w+|[^\w\s]+"                 # the same on ASCII text

# GPT-2 byte-level pre-tokeniser pattern (library "ByteLevel").
BYTE_LEVEL_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTE_LEVEL_PATTERN_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

# Chinese BLEU tokeniser: CJK ranges (inclusive) and the four punctuation rules, in order.
CJK_RANGES = [
    (0x3400, 0x4DB5), (0x4E00, 0x9FBB), (0xF900, 0xFA2D), (0xFA30, 0xFA6A), (0xFA70, 0xFAD9),
    (0x20000, 0x2A6D6), (0x2F800, 0x2FA1D), (0xFF00, 0xFFEF), (0x2E80, 0x2EFF), (0x3000, 0x303F),
    (0x31C0, 0x31EF), (0x2F00, 0x2FDF), (0x2FF0, 0x2FFF), (0x3100, 0x312F), (0x31A0, 0x31BF),
    (0xFE10, 0xFE1F), (0xFE30, 0xFE4F), (0x2600, 0x27BF), (0x3200, 0x33FF),
]
ZH_PUNCT_RULES = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]

# Clean-up of decoded text (library clean_up_tokenization_spaces), applied in this order.
CLEANUP_REPLACEMENTS = [
    (" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"),
    (" n't", "n't"), (" 'm", "'m"), (" 's", "'s"), (" 've", "'ve"), (" 're", "'re"),
]


def _class_escape(cp: int) -> str:
    return f"\\x{{{cp:X}}}"


def _ranges_class(cps) -> str:
    """Character class of code points, consecutive runs written as ranges (faster to match)."""
    cps = sorted(cps)
    parts, start, prev = [], None, None
    for cp in cps + [None]:
        if start is not None and cp == prev + 1:
            prev = cp
            continue
        if start is not None:
            parts.append(_class_escape(start) if start == prev
                         else f"{_class_escape(start)}-{_class_escape(prev)}")
        start = prev = cp
    return "[" + "".join(parts) + "]"


PY_WS_CLASS = _ranges_class(ord(c) for c in PY_WHITESPACE)


# ---------------------------------------------------------------------------------------------
# Strip and split
# ---------------------------------------------------------------------------------------------

def py_strip(col: Column | str) -> Column:
    """Python ``str.strip()``: both ends, the 29 Unicode whitespace code points (T3).  Trimming lays out the places of the
    whole text; a text that neither begins nor ends with one of them is passed on as it is."""
    ends = F.lit(PY_WHITESPACE)
    return bound(_c(col), lambda c: F.when(
        ends.contains(F.left(c, F.lit(1))) | ends.contains(F.right(c, F.lit(1))), F.btrim(c, ends)).otherwise(c))


def split_fields(col: Column | str, sep: str = "\t") -> Column:
    """Python ``str.split(sep)``: empty fields kept, trailing ones too (F1)."""
    return F.split(_c(col), _regex_quote(sep), -1)


def py_split_ws(col: Column | str) -> Column:
    """Python ``str.split()`` with no argument: runs of Unicode whitespace, no empty tokens."""
    stripped = py_strip(col)
    return F.when(F.length(stripped) == 0, F.array().cast("array<string>")).otherwise(
        F.split(stripped, PY_WS_CLASS + "+", -1))


# ---------------------------------------------------------------------------------------------
# NFD -> per-character lower case -> drop every M* character
# ---------------------------------------------------------------------------------------------

def _normal_form_char(ch: str) -> str:
    low = "".join(c.lower() for c in unicodedata.normalize("NFD", ch))
    return "".join(c for c in unicodedata.normalize("NFD", low)
                   if not unicodedata.category(c).startswith("M"))


def normalize_py(text: str | None) -> str | None:
    """Reference-equivalent normaliser in plain Python (used inside the UDF and by tests)."""
    if text is None:
        return None
    nfd = unicodedata.normalize("NFD", text)
    low = "".join(c.lower() for c in nfd)
    return "".join(c for c in unicodedata.normalize("NFD", low)
                   if not unicodedata.category(c).startswith("M"))


class _NormalForms(dict):
    """Code point -> normal form; marks go and nothing is composed again, so a text's form is that of its characters."""

    def __missing__(self, cp: int) -> str:
        form = self[cp] = _normal_form_char(chr(cp))
        return form


_FORMS = _NormalForms()


def normalize_fast(text: str) -> str:
    """:func:`normalize_py` of a text, character by character from a table that fills as characters come."""
    return text.lower() if text.isascii() else text.translate(_FORMS)


def _build_normal_tables() -> tuple[str, str, str]:
    """Per-character rule over the BMP: characters whose normal form is one character (or none)
    go into a ``translate`` table; the others (Hangul syllables and a few more) form the class of
    characters that need the UDF."""
    mapped_from, mapped_to, deleted, complex_cps = [], [], [], []
    for cp in range(0x10000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        out = _normal_form_char(ch)
        if out == ch:
            continue
        if len(out) == 1:
            mapped_from.append(ch)
            mapped_to.append(out)
        elif len(out) == 0:
            deleted.append(ch)
        else:
            complex_cps.append(cp)
    # compress the complex class into ranges
    ranges, start, prev = [], None, None
    for cp in complex_cps:
        if start is None:
            start = prev = cp
        elif cp == prev + 1:
            prev = cp
        else:
            ranges.append((start, prev))
            start = prev = cp
    if start is not None:
        ranges.append((start, prev))
    cls = "".join(_class_escape(a) if a == b else f"{_class_escape(a)}-{_class_escape(b)}"
                  for a, b in ranges)
    cls = "[" + cls + _class_escape(0x10000) + "-" + _class_escape(0x10FFFF) + "]"
    return "".join(mapped_from) + "".join(deleted), "".join(mapped_to), cls


_NORMAL_FROM, _NORMAL_TO, _NORMAL_COMPLEX_CLASS = _build_normal_tables()


@F.pandas_udf(T.StringType())
def _normalize_udf(s: pd.Series) -> pd.Series:
    return s.map(normalize_py, na_action="ignore")


def is_ascii(c: Column) -> Column:
    """As many bytes as characters."""
    return F.octet_length(c) == F.length(c)


def normalize(col: Column | str) -> Column:
    """F2.  ASCII rows are lower-cased; JVM ``translate`` for rows without multi-character normal forms; the UDF only sees
    the other rows (a null is sent for the rest, so Arrow carries almost nothing)."""
    c = _c(col)
    needs_udf = ~is_ascii(c) & c.rlike(_NORMAL_COMPLEX_CLASS)
    fast = F.translate(c, _NORMAL_FROM, _NORMAL_TO)
    slow = _normalize_udf(F.when(needs_udf, c))
    return (F.when(c.isNull(), F.lit(None).cast("string")).when(is_ascii(c), F.lower(c))
            .when(needs_udf, slow).otherwise(fast))


# ---------------------------------------------------------------------------------------------
# Pre-tokenisers and the byte-level codec
# ---------------------------------------------------------------------------------------------

def _matches(c: Column, pattern: str, ascii_pattern: str) -> Column:
    """All matches; the Unicode classes, which test a character against one range after the other, only where a row needs them."""
    return F.when(is_ascii(c), F.regexp_extract_all(c, F.lit(ascii_pattern), 0)).otherwise(
        F.regexp_extract_all(c, F.lit(pattern), 0))


def bound(c: Column, use) -> Column:
    """``use(c)`` with ``c`` evaluated once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(c), use), 1)


def pretok_words(col: Column | str) -> Column:
    """``\\w+|[^\\w\\s]+`` with Unicode classes."""
    return bound(_c(col), lambda c: _matches(c, WORD_PATTERN, WORD_PATTERN_ASCII))


def _byte_alphabet() -> list[int]:
    """Byte -> code point map of the byte-level alphabet (public GPT-2 rule): printable Latin-1
    bytes map to themselves, the other 68 to 256, 257, ... in byte order."""
    keep = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    out, extra = [], 0
    for b in range(256):
        if b in keep:
            out.append(b)
        else:
            out.append(256 + extra)
            extra += 1
    return out


BYTE_TO_CHAR = [chr(cp) for cp in _byte_alphabet()]
_BYTE_FROM = "".join(chr(b) for b in range(256) if ord(BYTE_TO_CHAR[b]) != b)
_BYTE_TO = "".join(BYTE_TO_CHAR[b] for b in range(256) if ord(BYTE_TO_CHAR[b]) != b)


def bytes_to_symbols(col: Column | str) -> Column:
    """Text -> its UTF-8 bytes, each shown as one alphabet character."""
    latin1 = F.decode(F.encode(_c(col), "UTF-8"), "ISO-8859-1")
    return F.translate(latin1, _BYTE_FROM, _BYTE_TO)


def byte_pieces(col: Column | str, add_prefix_space: bool = True) -> Column:
    """F5 before its bytes are mapped: prefix a space when missing, split by the GPT-2 pattern."""
    c = _c(col)
    if add_prefix_space:
        c = bound(c, lambda t: F.when(t.startswith(" "), t).otherwise(F.concat(F.lit(" "), t)))
    return bound(c, lambda t: _matches(t, BYTE_LEVEL_PATTERN, BYTE_LEVEL_PATTERN_ASCII))


def pretok_bytes(col: Column | str, add_prefix_space: bool = True) -> Column:
    """the pieces with their bytes as symbols.  In printable ASCII only the space has another symbol."""
    return F.transform(byte_pieces(col, add_prefix_space), lambda p: F.when(
        is_ascii(p) & ~p.rlike(r"[\x00-\x1F\x7F]"), F.replace(p, F.lit(" "), F.lit(BYTE_TO_CHAR[32]))).otherwise(bytes_to_symbols(p)))


# classes of a code point, as bits
_IS_SPACE, _IS_WORD, _IS_LETTER, _IS_NUMBER = 1, 2, 4, 8
_CLASSES: dict[str, bytes] = {}


def char_classes(spark) -> bytes:
    """The classes of every code point by the JVM's regular expressions, which cut the words that are counted; found once a session."""
    app = spark.sparkContext.applicationId
    if app not in _CLASSES:
        ch = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        bits = sum((F.when(ch.rlike(pattern), bit).otherwise(0) for bit, pattern in (
            (_IS_SPACE, r"(?U)\s"), (_IS_WORD, r"(?U)\w"), (_IS_LETTER, r"(?U)\p{L}"), (_IS_NUMBER, r"(?U)\p{N}"))), F.lit(0))
        points = spark.range(0x80, 0x110000, numPartitions=8).where("id NOT BETWEEN 55296 AND 57343")
        found = points.select(F.col("id").cast("int").alias("id"), bits.cast("byte").alias("bits")).where("bits > 0").toArrow()
        table = np.zeros(0x110000, np.uint8)
        table[found["id"].to_numpy()] = found["bits"].to_numpy()
        _CLASSES.clear()
        _CLASSES[app] = table.tobytes()
    return _CLASSES[app]


SPACE_KIND = 0
_STANDS = "\t!a0"            # an ASCII character of each kind


class WordCutter:
    """F4 (``en``) or F5 before its bytes are mapped (``zh``) of a normalised text, in Python: a text that is not ASCII is cut
    where the same text with an ASCII character of its kind for each other one is.  ``kinds`` has the kind of every code point."""

    def __init__(self, lang: str, classes: bytes):
        self.bytes = lang == "zh"
        self.pattern = re.compile(BYTE_LEVEL_PATTERN_ASCII if self.bytes else WORD_PATTERN_ASCII, re.ASCII)
        bits = np.frombuffer(classes, np.uint8).copy()
        for cp in range(0x80):
            c = chr(cp)
            bits[cp] = (_IS_SPACE if c in "\t\n\v\f\r " else 0) | (_IS_WORD if c.isalnum() or c == "_" else 0) \
                | (_IS_LETTER if c.isalpha() else 0) | (_IS_NUMBER if c.isdigit() else 0)
        self.spaces = np.flatnonzero(bits & _IS_SPACE).tolist()
        self.kinds = np.ones(len(bits), np.uint8)
        for kind, bit in ((3, _IS_NUMBER), (2, _IS_LETTER)) if self.bytes else ((2, _IS_WORD),):
            self.kinds[bits & bit > 0] = kind
        self.kinds[bits & _IS_SPACE > 0] = SPACE_KIND

    def __call__(self, text: str) -> list[str]:
        if self.bytes and not text.startswith(" "):
            text = " " + text
        if text.isascii():
            return self.pattern.findall(text)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        stand = np.where(codes < 0x80, codes, _STAND_CODES[self.kinds[codes]])
        return [text[m.start(): m.end()] for m in self.pattern.finditer(stand.astype(np.uint8).tobytes().decode("ascii"))]


_STAND_CODES = np.array([*map(ord, _STANDS)], np.uint32)


def symbols_to_text(col: Column | str) -> Column:
    """inverse of ``bytes_to_symbols``; broken UTF-8 sequences become U+FFFD."""
    latin1 = F.translate(_c(col), _BYTE_TO, _BYTE_FROM)
    raw = F.encode(latin1, "ISO-8859-1")
    return F.make_valid_utf8(raw.cast("string"))


# ---------------------------------------------------------------------------------------------
# Decoded-text clean-up and the Chinese BLEU tokeniser
# ---------------------------------------------------------------------------------------------

def cleanup_spaces(col: Column | str) -> Column:
    out = _c(col)
    for old, new in CLEANUP_REPLACEMENTS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


# the characters of the first punctuation rule but the space
_ZH_MARKS = r"[\x21-\x26\x28-\x2B\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
CJK_CLASS = "[" + "".join(f"{_class_escape(a)}-{_class_escape(b)}" for a, b in CJK_RANGES) + "]"


def zh_tokens(col: Column | str) -> Column:
    """strip, space each CJK character, apply the punctuation rules, split on whitespace.

    The rules are evaluated once a row: the result is bound before it is tested and split.  Rows without a character from the
    first CJK range on skip that rule, and spaces are left out of the first punctuation rule, which only doubled them."""
    line = py_strip(col)
    line = F.when(_c(col).rlike(f"[{_class_escape(min(CJK_RANGES)[0])}-\\x{{10FFFF}}]"),
                  F.regexp_replace(line, CJK_CLASS, " $0 ")).otherwise(line)
    for pattern, repl in [(_ZH_MARKS, " $0 "), *ZH_PUNCT_RULES[1:]]:
        line = F.regexp_replace(line, pattern, repl)
    one = F.transform(F.array(py_strip(line)), lambda s: F.when(F.length(s) == 0, F.array().cast("array<string>")).otherwise(
        F.split(s, PY_WS_CLASS + "+", -1)))
    return F.element_at(one, 1)


# ---------------------------------------------------------------------------------------------

def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)
