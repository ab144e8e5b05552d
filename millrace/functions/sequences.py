"""Length, padding, masks and labels of token lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label that the loss skips.
IGNORED_LABEL = -100


def truncate(ids: Column, n: int) -> Column:
    """The first ``n`` ids."""
    return F.slice(ids, 1, n)


def pad(ids: Column, n: int | Column, pad_id: int | Column) -> Column:
    """``ids`` filled up on the right to ``n``; longer lists stay as they are."""
    missing = F.greatest(_as_column(n) - F.size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(_as_column(pad_id), missing))


def attention_mask(ids: Column, n: int | Column) -> Column:
    """1 for every id and 0 for every position that ``pad`` adds."""
    missing = F.greatest(_as_column(n) - F.size(ids), F.lit(0))
    return F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), missing))


def causal_labels(ids: Column, pad_id: int | Column) -> Column:
    """A copy of ``ids`` with every pad id ignored, wherever it stands.

    Where padding reuses the end-of-text id, real end-of-text ids are ignored too.
    """
    pad_column = _as_column(pad_id)
    return F.transform(ids, lambda x: F.when(x == pad_column, F.lit(IGNORED_LABEL)).otherwise(x))


def add_special(ids: Column, bos: int | Column | None, eos: int | Column | None) -> Column:
    """``ids`` with the given start and end ids around them."""
    parts = [ids]
    if bos is not None:
        parts.insert(0, F.array(_as_column(bos)))
    if eos is not None:
        parts.append(F.array(_as_column(eos)))
    return F.concat(*parts)


def stop_at(ids: Column, eos: int | Column, n: int) -> Column:
    """``ids`` up to and with the first ``eos``, and at most ``n`` of them."""
    end = F.array_position(ids, _as_column(eos)).cast("int")
    return F.slice(ids, F.lit(1), F.when(end > 0, F.least(end, F.lit(n))).otherwise(F.lit(n)))


def _as_column(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
