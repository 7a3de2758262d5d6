"""Column functions that pull a loss value out of one training-log line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's loss pattern (anchored at the start, as ``re.match``).  The lazy
# last group keeps one decimal (T21).  ``LOSS_PATTERN_FULL`` is the opt-in full-number form.
LOSS_PATTERN = r"^batch loss at \d+ = (\d+\.?\d+?)"
LOSS_PATTERN_FULL = r"^batch loss at \d+ = (\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)"
DICT_MARKER = "'loss'"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def loss_from_line(col, full: bool = False) -> Column:
    """loss of a ``batch loss at <i> = <x>`` line, null when the line does not match."""
    hit = F.regexp_extract(_c(col), LOSS_PATTERN_FULL if full else LOSS_PATTERN, 1)
    return F.when(hit != "", hit.cast("double"))


def loss_from_dict(col) -> Column:
    """``json.loads(line.replace("'", '"'))['loss']`` for lines containing ``'loss'``.

    Null for lines without the marker; a marked line that does not parse raises (the reference
    re-raises), so a bad log fails the job instead of producing a silent gap.
    """
    c = _c(col)
    marked = c.contains(DICT_MARKER)
    value = F.get_json_object(F.replace(c, F.lit("'"), F.lit('"')), "$.loss").cast("double")
    return F.when(marked, F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit("unparsable loss line: "), c)).cast("double")))
