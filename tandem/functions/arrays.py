"""Column functions on id and score arrays: truncate, wrap, pad, shift, masks, EOS cut, argmax,
log-softmax.  All built-in higher-order functions, so they run inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BOS_ID, EOS_ID, PAD_ID

# mT5 convention (fixed values of the pre-trained vocabulary): pad 0, end 1, unknown 2;
# collator label fill -100.
T5_PAD_ID, T5_EOS_ID, T5_UNK_ID = 0, 1, 2
LABEL_IGNORE = -100
MAX_IDS = 128


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def truncate_ids(col, n: int = MAX_IDS) -> Column:
    """first ``n`` ids (``x[:n]``)."""
    return F.slice(_c(col), 1, n)


def wrap_ids(col, bos: int = BOS_ID, eos: int = EOS_ID) -> Column:
    """``[BOS] + ids + [EOS]``."""
    return F.concat(F.array(F.lit(bos)), _c(col), F.array(F.lit(eos)))


def pad_to(col, length, fill: int = PAD_ID) -> Column:
    """right-pad to ``length`` (a Column, e.g. the batch maximum)."""
    c = _c(col)
    n = F.greatest(F.lit(0), _c(length) - F.size(c))
    return F.concat(c, F.array_repeat(F.lit(fill), n))


def unmask_labels(col, sentinel: int = LABEL_IGNORE, pad: int = T5_PAD_ID) -> Column:
    """label sentinel back to the pad id."""
    return F.transform(_c(col), lambda x: F.when(x == sentinel, F.lit(pad)).otherwise(x))


def decoder_input(col) -> Column:
    """``trg[:-1]``."""
    c = _c(col)
    return F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0)))


def decoder_target(col) -> Column:
    """``trg[1:]``."""
    c = _c(col)
    return F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))


def padding_mask(col, pad: int = PAD_ID) -> Column:
    """True where the id is padding."""
    return F.transform(_c(col), lambda x: x == pad)


def all_false_mask(n) -> Column:
    """one row of the source mask, all false."""
    return F.array_repeat(F.lit(False), _c(n))


def source_mask(n) -> Column:
    """the source mask, n x n, all false (every position sees every other)."""
    return F.array_repeat(all_false_mask(n), _c(n))


def causal_mask(n) -> Column:
    """F16: square mask, 0 on and below the diagonal, -inf above."""
    n = _c(n)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda j: F.when(j <= i, F.lit(0.0)).otherwise(F.lit(float("-inf")))))


def cut_at_eos(col, eos: int = EOS_ID) -> Column:
    """ids before the first EOS (all ids when there is none)."""
    c = _c(col)
    p = F.array_position(c, eos)
    return F.when(p > 0, F.slice(c, 1, F.greatest(p - 1, F.lit(0)))).otherwise(c)


def argmax(col) -> Column:
    """O2: index (0-based) of the largest score; ties go to the lowest index."""
    c = _c(col)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element ``transform``), so a
    lambda over an array does not recompute an outer expression for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _lse(c: Column) -> Column:
    return let(F.array_max(c).cast("double"), lambda m: F.log(
        F.aggregate(c, F.lit(0.0), lambda acc, x: acc + F.exp(x - m))) + m)


def log_softmax(col) -> Column:
    """numerically stable ``x - max - ln(sum(exp(x - max)))``."""
    c = _c(col)
    return let(_lse(c), lambda lse: F.transform(c, lambda x: x - lse))


def softmax(col) -> Column:
    """``exp(log_softmax)``."""
    return F.transform(log_softmax(col), lambda x: F.exp(x))


def nll(col_scores, col_label) -> Column:
    """Cross-entropy of one score vector: ``ln(sum(exp(s))) - s[label]`` (label 0-based)."""
    s = _c(col_scores)
    return _lse(s) - F.element_at(s, _c(col_label) + 1).cast("double")
