"""Token counts (1): greedy longest-match word pieces, counted by a linear automaton.

The vocabulary is a byte trie.  Every node holds a failure link and the number of pieces popped
when it is taken (the pieces of the longest matches that end the node's string), so a word of m
bytes is counted in O(m) steps and no piece is ever built.  A word w is matched as the string
``prefix + w`` (the word-start mark of the vocabulary).  A word that the vocabulary cannot cover is one
unknown piece.

Counting is per distinct word of a slice (exact Arrow dictionary encoding) and vectorised over
words: all words take their k-th byte together.  The last words left over, the longest, go on alone.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tandem.llm.common import SPACE_WORDS, segment_sum, slices, split_words, text_bytes

FEW = 128   # fewer words than this are counted faster one by one than by array passes


def byte_alphabet() -> dict[str, int]:
    """Characters of a byte-level vocabulary -> bytes (printable bytes stand for themselves, the
    others are moved up from 256 in order)."""
    # fixed values: the byte ranges of the public byte-level alphabet
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_level_vocab(path: str) -> list[bytes]:
    """Pieces of a byte-level tokenizer file as byte strings (special tokens left out)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    table = byte_alphabet()
    return [bytes(table[c] for c in t) for t in spec["model"]["vocab"] if t not in special]


class Automaton:
    """Longest-match automaton over byte strings; ``popped`` counts, ``fail`` links (-1: none)."""

    def __init__(self, vocab: list[bytes]):
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in vocab:
            node = 0
            for b in piece:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = len(children)
                    children[node][b] = nxt
                    children.append({})
                    final.append(False)
                node = nxt
            final[node] = bool(piece)
        fail = np.full(len(children), -1, np.int64)
        popped = np.zeros(len(children), np.int64)
        queue = [0]
        for v in queue:
            for b, c in children[v].items():
                queue.append(c)
                if final[c]:
                    fail[c], popped[c] = 0, 1
                    continue
                z, n = fail[v], popped[v]
                while z >= 0 and b not in children[z]:
                    n += popped[z]
                    z = fail[z]
                if z >= 0:
                    fail[c], popped[c] = children[z][b], n
        keys = np.array([(v << 8) | b for v, kids in enumerate(children) for b in kids], np.int64)
        to = np.array([c for kids in children for c in kids.values()], np.int64)
        order = np.argsort(keys)
        self.keys, self.to, self.fail, self.popped = keys[order], to[order], fail, popped

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Child per (state, byte), -1 where there is none."""
        if len(self.keys) == 0:
            return np.full(len(state), -1, np.int64)
        key = (state << 8) | byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    @functools.cached_property
    def moves(self) -> tuple[dict[int, int], list[int], list[int]]:
        """The same tables for one word at a time: (state << 8 | byte) -> child, failure links, popped counts."""
        return dict(zip(self.keys.tolist(), self.to.tolist())), self.fail.tolist(), self.popped.tolist()

    def follow(self, state: int, total: int, rest: bytes) -> tuple[int, int]:
        """State and count after ``rest``; state -1 if no piece covers it."""
        to, fail, popped = self.moves
        for b in rest:
            nxt = to.get(state << 8 | b)
            while nxt is None:
                total += popped[state]
                state = fail[state]
                if state < 0:
                    return -1, total
                nxt = to.get(state << 8 | b)
            state = nxt
        return state, total

    def count(self, data: np.ndarray, off: np.ndarray, prefix: bytes = b"") -> np.ndarray:
        """Pieces of each string ``prefix + data[off[i]:off[i+1]]``; an uncoverable one counts 1."""
        lens = np.diff(off)
        n = len(lens)
        state, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        unknown = np.zeros(n, bool)

        def feed(who: np.ndarray, byte: np.ndarray) -> None:
            while len(who):
                nxt = self.step(state[who], byte)
                ok = nxt >= 0
                state[who[ok]] = nxt[ok]
                who, byte = who[~ok], byte[~ok]
                f = self.fail[state[who]]
                dead = f < 0
                unknown[who[dead]] = True
                who, byte, f = who[~dead], byte[~dead], f[~dead]
                total[who] += self.popped[state[who]]
                state[who] = f

        for b in prefix:
            who = np.flatnonzero(~unknown)
            feed(who, np.full(len(who), b, np.int64))
        order = np.argsort(-lens, kind="stable")
        ordered = -lens[order]
        for k in range(int(lens.max(initial=0))):
            who = order[: np.searchsorted(ordered, -k, side="left")]
            who = who[~unknown[who]]
            if len(who) < FEW:
                for i in who.tolist():
                    at, pieces = self.follow(int(state[i]), int(total[i]), data[off[i] + k: off[i + 1]].tobytes())
                    unknown[i] = at < 0
                    state[i], total[i] = max(at, 0), pieces
                break
            feed(who, data[off[who] + k].astype(np.int64))
        who = np.flatnonzero(~unknown & (state != 0))
        while len(who):
            f = self.fail[state[who]]
            dead = f < 0
            unknown[who[dead]] = True
            who, f = who[~dead], f[~dead]
            total[who] += self.popped[state[who]]
            state[who] = f
            who = who[f != 0]
        return np.where(unknown, 1, total)


@functools.lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(byte_level_vocab(path))


def token_counts(docs: DataFrame, vocab_path: str, prefix: bytes = b" ", key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, n_words, n_tokens (pieces of all words), max_word_tokens.

    Words are ``[^\\x20\\x09-\\x0D]+``, case kept.  Null and empty texts: 0, 0, 0.  Repeated rows
    give repeated rows, an empty table an empty one; other columns are not read.  Very long texts and words are
    counted whole in time linear in their length.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(vocab_path)
        for b in slices(batches, text):
            w = split_words(b.column(text), SPACE_WORDS, lower=False)
            data, off = text_bytes(w.uniq)
            per = auto.count(data, off, prefix)[w.codes] if len(w.codes) else np.zeros(0, np.int64)
            n = w.counts()
            most = np.zeros(len(n), np.int64)
            full = np.flatnonzero(n)
            if len(full):
                most[full] = np.maximum.reduceat(per, w.doc[full])
            yield pa.RecordBatch.from_arrays(
                [b.column(key), pa.array(n), pa.array(segment_sum(per, w.doc)), pa.array(most)],
                names=[key, "n_words", "n_tokens", "max_word_tokens"])

    return docs.select(key, text).mapInArrow(
        run, f"{key} {kind}, n_words long, n_tokens long, max_word_tokens long")
