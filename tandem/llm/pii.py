"""PII (9): base patterns plus a linear-chain conditional random field over word-shape features.

The CRF is trained on the driver from the small labelled table in ``pii_labels`` (gradient ascent on the
regularised log-likelihood by forward-backward) and its weights (a few thousand numbers) go to the tasks.
Labels are O and B-/I- of every kind.  A token can only carry a span label if it holds a
digit or an ``@`` (a constraint of the model, in training and decoding alike), so only runs of
such tokens with their neighbours are decoded; Viterbi runs over padded batches of runs in numpy.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tandem.llm.common import slices
from tandem.llm.pii_labels import LABELLED

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "secret"]
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
CONTEXT = 2
BATCH = 4096

TOKEN = re.compile(r"\S+")
TRIGGER = re.compile(r"[0-9@]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: the look-behind only saves work: a start inside a run of digits fails where the run's start does
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, leftmost and non-overlapping per kind; a match that fails its
    check is dropped without another try.  Ordered by start, then kind."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if TRIGGER.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            d = _digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def shape(token: str) -> str:
    """Word shape: letters to x/X, digits to d, runs of one class cut at three."""
    s = re.sub(r"[0-9]", "d", re.sub(r"[^\W\d_]", lambda m: "X" if m[0].isupper() else "x", token))
    return re.sub(r"(.)\1{3,}", r"\1\1\1", s)[:24]


def token_features(token: str) -> list[str]:
    d = sum("0" <= c <= "9" for c in token)
    core = token.strip(".,;:!?\"'<>[]{}")
    f = ["bias", f"shape={shape(core)}", f"classes={re.sub(r'(.)\1+', r'\1', shape(core))}",
         f"digits={min(d, 20) if d < 6 else d // 2 * 2 if d < 20 else 20}"]
    if "@" in core:
        f.append("at-inside" if core[0] != "@" and core[-1] != "@" else "at-edge")
    if core.count(".") == 3 and d:
        f.append("three-dots")
    for mark, name in (("+", "plus"), ("(", "open"), ("AKIA", "akia")):
        if core.startswith(mark):
            f.append(name)
    if "=" in core:
        left, right = core.split("=", 1)
        f.append("secret-pair" if len(right) >= 12 and re.search(r"pass|token|key|secret", left, re.I) else "pair")
    if len(core) >= 16 and re.fullmatch(r"[A-Z0-9]+", core) and re.search(r"[A-Z]", core):
        f.append("long-capitals")
    if len(core) >= 16 and d >= 3 and re.search(r"[A-Za-z]", core):
        f.append("long-mixed")
    if not d and "@" not in core:
        f.append("word")
    return f


def sequence_features(tokens: list[str]) -> Iterator[list[str]]:
    """Features of every token with its neighbours'; at most three tokens' are held at a time."""
    before, own = "edge", token_features(tokens[0]) if tokens else []
    for i in range(len(tokens)):
        after = token_features(tokens[i + 1]) if i + 1 < len(tokens) else None
        yield [*own, f"prev:{before}", f"next:{after[2] if after else 'edge'}"]
        before, own = own[2], after


def allowed(token: str) -> np.ndarray:
    ok = np.ones(len(LABELS), bool)
    if not TRIGGER.search(token):
        ok[1:] = False
    return ok


def _transitions() -> np.ndarray:
    """0 where allowed, -inf for I-kind after anything but B-/I- of the same kind."""
    t = np.zeros((len(LABELS), len(LABELS)))
    for j, to in enumerate(LABELS):
        if to[0] == "I":
            for i, a in enumerate(LABELS):
                if a[2:] != to[2:]:
                    t[i, j] = -np.inf
    return t


BLOCKED = _transitions()
START = np.where([x[0] == "I" for x in LABELS], -np.inf, 0.0)


def parse_labelled(line: str) -> tuple[list[str], list[int]]:
    """Tokens and label ids of one marked line."""
    plain, spans, at = "", [], 0
    for m in re.finditer(r"\{(\w+)\|([^}]*)\}", line):
        plain += line[at: m.start()]
        spans.append((m[1], len(plain), len(plain) + len(m[2])))
        plain += m[2]
        at = m.end()
    plain += line[at:]
    tokens, labels = [], []
    for m in TOKEN.finditer(plain):
        label = 0
        for kind, s, e in spans:
            if m.start() < e and m.end() > s:
                label = LABELS.index(("B-" if m.start() <= s else "I-") + kind)
        tokens.append(m[0])
        labels.append(label)
    return tokens, labels


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Crf:
    def __init__(self, index: dict[str, int], emit: np.ndarray, trans: np.ndarray):
        self.index, self.emit, self.trans = index, emit, trans

    @classmethod
    def train(cls, lines: list[str], rounds: int = 150, rate: float = 0.3, decay: float = 0.02) -> Crf:
        data = [parse_labelled(x) for x in lines]
        index: dict[str, int] = {}
        seqs = []
        for tokens, labels in data:
            feats = [[index.setdefault(f, len(index)) for f in fs] for fs in sequence_features(tokens)]
            mask = np.where([allowed(t) for t in tokens], 0.0, -np.inf)
            seqs.append((feats, labels, mask))
        emit, trans = np.zeros((len(index), len(LABELS))), np.zeros_like(BLOCKED)
        sq_e, sq_t = np.full_like(emit, 1e-6), np.full_like(trans, 1e-6)
        for _ in range(rounds):
            ge, gt = -decay * emit, -decay * trans
            for feats, labels, mask in seqs:
                score = np.array([emit[f].sum(axis=0) for f in feats]) + mask
                full = trans + BLOCKED
                n = len(labels)
                fw, bw = np.empty_like(score), np.zeros_like(score)
                fw[0] = START + score[0]
                for i in range(1, n):
                    fw[i] = _lse(fw[i - 1][:, None] + full, 0) + score[i]
                for i in range(n - 2, -1, -1):
                    bw[i] = _lse(full + (score[i + 1] + bw[i + 1])[None, :], 1)
                z = _lse(fw[-1], 0)
                p = np.exp(fw + bw - z)
                for i, f in enumerate(feats):
                    ge[f, labels[i]] += 1
                    ge[f] -= p[i]
                    if i:
                        gt[labels[i - 1], labels[i]] += 1
                        gt -= np.exp(fw[i - 1][:, None] + full + (score[i] + bw[i])[None, :] - z)
            sq_e += ge * ge
            sq_t += gt * gt
            emit = emit + rate * ge / np.sqrt(sq_e)
            trans = trans + rate * gt / np.sqrt(sq_t)
        return cls(index, emit, trans)

    def viterbi(self, runs: list[list[str]]) -> list[np.ndarray]:
        """Best label sequence of every token run, decoded in padded batches of like length."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(runs)
        order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
        full = self.trans + BLOCKED
        at = 0
        while at < len(order):
            size = max(1, BATCH // max(1, len(runs[order[min(at + 255, len(order) - 1)]])))
            part = order[at: at + min(size, 256)]
            at += len(part)
            n = np.array([len(runs[i]) for i in part])
            score = np.zeros((len(part), int(n.max(initial=0)), len(LABELS)))
            for r, i in enumerate(part):
                for k, fs in enumerate(sequence_features(runs[i])):
                    known = [self.index[f] for f in fs if f in self.index]
                    score[r, k] = self.emit[known].sum(axis=0)
                    score[r, k][~allowed(runs[i][k])] = -np.inf
            best = START + score[:, 0]
            back = np.zeros(score.shape, np.int8)
            back[:, 0] = np.arange(len(LABELS))
            for k in range(1, score.shape[1]):
                cand = best[:, :, None] + full[None]
                step, value = cand.argmax(axis=1), cand.max(axis=1) + score[:, k]
                live = (k < n)[:, None]
                back[:, k] = np.where(live, step, np.arange(len(LABELS)))
                best = np.where(live, value, best)
            path = np.zeros(score.shape[:2], np.int64)
            path[:, -1] = best.argmax(axis=1)
            for k in range(score.shape[1] - 1, 0, -1):
                path[:, k - 1] = back[np.arange(len(part)), k, path[:, k]]
            for r, i in enumerate(part):
                out[i] = path[r, : n[r]]
        return out


@functools.lru_cache(maxsize=1)
def trained() -> Crf:
    return Crf.train(LABELLED)


def _runs(text: str) -> list[list[tuple[str, int, int]]]:
    """Runs of tokens around trigger tokens: each trigger with CONTEXT tokens either side of the
    same line, overlapping runs joined."""
    out: list[list[tuple[str, int, int]]] = []
    begin = 0
    for line in text.split("\n"):
        if TRIGGER.search(line):
            tokens = [(m[0], begin + m.start(), begin + m.end()) for m in TOKEN.finditer(line)]
            want = [i for i, t in enumerate(tokens) if TRIGGER.search(t[0])]
            s = e = None
            for i in want:
                if e is not None and i - CONTEXT <= e:
                    e = min(len(tokens), i + CONTEXT + 1)
                    continue
                if e is not None:
                    out.append(tokens[s:e])
                s, e = max(0, i - CONTEXT), min(len(tokens), i + CONTEXT + 1)
            if e is not None:
                out.append(tokens[s:e])
        begin += len(line) + 1
    return out


def _trim(text: str, s: int, e: int) -> tuple[int, int]:
    while s < e and text[s] in "\"'<[{,;:":
        s += 1
    while s < e and text[e - 1] in ".,;:!?\"'>]}":
        e -= 1
    return s, e


def plausible(kind: str, span: str) -> bool:
    """Whether a span of the model can be what it is called: a card has 12 to 19 digits that pass the checksum, a phone
    7 to 15 digits."""
    d = _digits(span)
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d)
    return kind != "phone" or 7 <= len(d) <= 15


def crf_spans(texts: list[str], crf: Crf) -> list[list[tuple[str, int, int]]]:
    runs, owner = [], []
    for d, t in enumerate(texts):
        for r in _runs(t):
            runs.append(r)
            owner.append(d)
    paths = crf.viterbi([[t for t, _, _ in r] for r in runs])
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for d, run, path in zip(owner, runs, paths):
        k = 0
        while k < len(path):
            label = LABELS[path[k]]
            if label[0] == "B":
                e = k + 1
                while e < len(path) and LABELS[path[e]] == "I-" + label[2:]:
                    e += 1
                s_at, e_at = _trim(texts[d], run[k][1], run[e - 1][2])
                if s_at < e_at and plausible(label[2:], texts[d][s_at:e_at]):
                    out[d].append((label[2:], s_at, e_at))
                k = e
            else:
                k += 1
    return out


def clear_of(spans: list[tuple[str, int, int]], taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """``spans`` that overlap none of ``taken`` (which may overlap each other): of those that start before a
    span's end, the farthest end decides."""
    taken = sorted((s, e) for _, s, e in taken)
    starts = [s for s, _ in taken]
    far = list(itertools.accumulate((e for _, e in taken), max))
    out = []
    for x in spans:
        at = bisect.bisect_left(starts, x[2])
        if at == 0 or far[at - 1] <= x[1]:
            out.append(x)
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_pii(docs: DataFrame, crf: Crf | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_email, n_ip, n_card, n_phone (base patterns), base_sha256 (of
    "kind:start:end,..."), spans (base spans and the CRF's that overlap none of them, by start and
    kind), n_crf (spans the CRF added).  Offsets are code points, ends exclusive.

    Null and empty texts have no spans; repeated rows give repeated rows; an empty table gives an empty
    one; other columns are not read.  A very long text is read whole in time about linear in its length; of a
    run of tokens its scores are held (88 bytes a token).
    """
    kind = docs.schema[key].dataType.simpleString()
    model = crf or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            n = b.num_rows
            counts = {k: np.zeros(n, np.int64) for k in [*BASE_KINDS, "crf"]}
            base, spans = [""] * n, [""] * n
            mask = pc.match_substring_regex(b.column(text), "[0-9@]").to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(mask.astype(bool))
            texts = [b.column(text)[int(i)].as_py() for i in rows]
            for i, t, more in zip(rows, texts, crf_spans(texts, model)):
                own = base_spans(t)
                extra = clear_of(more, own)
                for k, _, _ in own:
                    counts[k][i] += 1
                counts["crf"][i] = len(extra)
                base[i] = _joined(own)
                spans[i] = _joined(sorted(own + extra, key=lambda x: (x[1], KINDS.index(x[0]))))
            sha = [hashlib.sha256(x.encode()).hexdigest() for x in base]
            yield pa.RecordBatch.from_arrays(
                [b.column(key), *(pa.array(counts[k]) for k in BASE_KINDS), pa.array(sha),
                 pa.array(spans, pa.string()), pa.array(counts["crf"])],
                names=[key, *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_crf"])

    return docs.select(key, text).mapInArrow(
        run, f"{key} {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, n_crf long")
