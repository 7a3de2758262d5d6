"""License scans (5): Aho-Corasick over normalised words, shunting-yard over licence expressions.

A text is lower-cased (A-Z) and written as its words, one blank before each; phrases are found by one
Aho-Corasick automaton over that string, whole words only.  Where the identifier tag occurs, the raw
text after it is parsed as a licence expression (``and``, ``or``, ``with``, parentheses).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tandem.llm.common import ALNUM_WORDS, LOWER, slices, text_bytes

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notice phrases of our own.
NOTICES = {
    "permission is hereby granted free of charge to any person": "mit",
    "gnu general public license": "gpl", "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3", "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl", "mozilla public license": "mpl",
    "eclipse public license": "epl", "redistribution and use in source and binary forms": "bsd",
    "bsd 2 clause": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause", "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd", "creative commons attribution": "cc-by", "cc0 1 0 universal": "cc0",
    "released into the public domain": "public-domain", "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
#: To the line end, the first foreign character or the next tag.
TAGGED = re.compile(r"SPDX-License-Identifier:[ \t]*((?:(?!SPDX-License-Identifier:)[A-Za-z0-9.+()\- \t])*)", re.I)
#: How freely a text under a label may be used, by the first part of the label; others 0.5.
FREEDOM = {"cc0": 1.0, "public": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "apache": 0.9, "cc": 0.7,
           "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "gpl": 0.3, "agpl": 0.2, "all": 0.05}
PRIORITY = {"or": 1, "and": 2, "with": 3}
#: Names an expression may hold: a family with its numbers and qualifiers, or a reference of one's own.  Fixed values.
FAMILIES = """0bsd aal afl agpl apache apl apsl artistic beerware blessing bsd bsl cc cc0 cddl cecill cpl curl ecl efl epl eupl
ftl gfdl gpl hpnd icu ijg imlib2 ipl isc jasper lgpl libpng lppl lpl mit mpl ms mulanpsl ncsa nist nposl ntp odbl odc oftl ofl
openssl osl pddl php postgresql psf python ql qpl rpl rpsl ruby sgi sissl sleepycat smlnj spl ssh sspl tcl unicode unlicense
upl vim w3c watcom wtfpl x11 xfree86 xnet zend zlib zpl""".split()
NAME = re.compile(r"(?:licenseref-[a-z0-9.-]+|none|noassertion|"
                  r"(?:%s)(?:-[a-z0-9.]+)*\+?)" % "|".join(sorted(FAMILIES, key=len, reverse=True)))
#: An exception after ``with``.
EXCEPTION = re.compile(r"[a-z0-9.]+(?:-[a-z0-9.]+)*-exception(?:-[a-z0-9.]+)*|additionref-[a-z0-9.-]+|linux-syscall-note")


def freedom(label: str) -> float:
    if label.startswith("cc-by-n"):
        return 0.3
    return FREEDOM.get(label.split("-")[0], 0.5)


def parse_expression(text: str) -> tuple[list[str], float | None]:
    """Shunting-yard: the longest valid expression at the start of ``text`` as (lower-case licence
    ids in order, value): ``or`` takes the freer side, ``and`` the stricter, ``with`` an exception
    that moves the left side half way to free.  A name is of a known family, ``LicenseRef-...``, ``NONE`` or
    ``NOASSERTION``, after ``with`` an exception; any other word is prose and ends the expression.  Nothing valid:
    ([], None).  One pass, no length limit."""
    ids: list[str] = []
    values: list[tuple[int, float]] = []               # (place of its first id, value)
    ops: list[str] = []
    best, operand, depth = None, True, 0

    def reduce_once() -> None:
        op = ops.pop()
        (start, b), (first, a) = values.pop(), values.pop()
        if op == "with":
            del ids[start:]
            values.append((first, (1 + a) / 2))
        else:
            values.append((first, max(a, b) if op == "or" else min(a, b)))

    for m in re.finditer(r"[()]|[A-Za-z0-9.+-]+", text):
        low = m[0].lower()
        if low in PRIORITY:
            if operand:
                break
            while ops and ops[-1] != "(" and PRIORITY[ops[-1]] >= PRIORITY[low]:
                reduce_once()
            ops.append(low)
            operand = True
        elif low == "(":
            if not operand or ops and ops[-1] == "with":
                break
            ops.append(low)
            depth += 1
        elif low == ")":
            if operand or not depth:
                break
            while ops[-1] != "(":
                reduce_once()
            ops.pop()
            depth -= 1
        else:
            known = EXCEPTION if ops and ops[-1] == "with" else NAME
            if not operand or not known.fullmatch(low):
                break
            values.append((len(ids), freedom(low)))
            ids.append(low)
            operand = False
        if not operand and not depth:                  # a valid end: at most three operators are open
            n, value = len(ids), values[-1][1]
            for op, (_, left) in zip(reversed(ops), reversed(values[:-1])):
                if op == "with":
                    n, value = values[-1][0], (1 + left) / 2
                else:
                    value = max(left, value) if op == "or" else min(left, value)
            best = n, value
    return ([], None) if best is None else (ids[: best[0]], best[1])


@functools.lru_cache(maxsize=1)
def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG}:
        a.add_word(f" {phrase} ", phrase)
    a.make_automaton()
    return a


def _normalised(texts: pa.Array) -> tuple[str, np.ndarray, np.ndarray]:
    """(one character per byte: each document as " w1 w2 ... wn " and a line end, start of every
    word's blank in it, words per document as bounds)."""
    data, off = text_bytes(texts)
    low = LOWER[data]
    isw = ALNUM_WORDS[low]
    first = isw.copy()
    first[1:] &= ~isw[:-1]
    begin = off[:-1][off[:-1] < len(low)]
    first[begin] = isw[begin]
    doc = np.searchsorted(np.flatnonzero(first), off)
    in_word = first[isw]
    word_of = np.cumsum(in_word)                       # 1-based word of each word byte
    doc_of = np.searchsorted(doc, word_of - 1, side="right") - 1
    n_bytes, n_words, n_docs = len(in_word), int(in_word.sum()), len(texts)
    out = np.full(n_bytes + n_words + 2 * n_docs, 0x20, np.uint8)
    place = np.arange(n_bytes) + word_of + 2 * doc_of
    out[place] = low[isw]
    bytes_before = np.append(np.flatnonzero(in_word), n_bytes)[doc]
    out[(bytes_before + doc)[1:] + 2 * np.arange(1, n_docs + 1) - 1] = 0x0A
    return out.tobytes().decode("latin-1"), place[in_word] - 1, doc


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, n_base (places of base phrases, overlaps included), first_word, last_word
    (their smallest and largest start, null without), base_labels, labels (with notices and
    expressions; both distinct, sorted, comma-joined), expressions (raw), score.

    score: 0 without labels, else the freedom of the strictest statement found (0.05 to 1).  Null
    and empty texts have no words; repeated rows give repeated rows; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = automaton()
        for b in slices(batches, text):
            joined, starts, doc = _normalised(b.column(text))
            n = b.num_rows
            found: dict[int, list[tuple[int, str]]] = {}
            for end, phrase in find.iter(joined):
                at = int(np.searchsorted(starts, end - len(phrase) - 1))
                d = int(np.searchsorted(doc, at, side="right")) - 1
                found.setdefault(d, []).append((at - int(doc[d]), phrase))
            cols = {"n_base": [0] * n, "first": [None] * n, "last": [None] * n, "base": [""] * n,
                    "labels": [""] * n, "expr": [[] for _ in range(n)], "score": [0.0] * n}
            for d, places in found.items():
                base = [(at, BASE[p]) for at, p in places if p in BASE]
                values = {BASE[p] if p in BASE else NOTICES[p]: None for _, p in places if p != TAG}
                values = {label: freedom(label) for label in values}
                if any(p == TAG for _, p in places):
                    for m in TAGGED.finditer(b.column(text)[d].as_py()):
                        ids, value = parse_expression(m[1])
                        if value is not None:
                            cols["expr"][d].append(m[1].strip())
                            values |= {i: value for i in ids if i not in values}
                cols["n_base"][d] = len(base)
                if base:
                    cols["first"][d] = min(at for at, _ in base)
                    cols["last"][d] = max(at for at, _ in base)
                cols["base"][d] = ",".join(sorted({x for _, x in base}))
                cols["labels"][d] = ",".join(sorted(values))
                cols["score"][d] = min(values.values(), default=0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column(key), pa.array(np.diff(doc).astype(np.int64)), pa.array(cols["n_base"], pa.int64()),
                 pa.array(cols["first"], pa.int64()), pa.array(cols["last"], pa.int64()),
                 pa.array(cols["base"], pa.string()), pa.array(cols["labels"], pa.string()),
                 pa.array(cols["expr"], pa.list_(pa.string())), pa.array(cols["score"], pa.float64())],
                names=[key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                       "expressions", "score"])

    return docs.select(key, text).mapInArrow(
        run, f"{key} {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, expressions array<string>, score double")
