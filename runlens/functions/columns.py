"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ntz() -> Column:
    """``1970-01-01 00:00:00`` as a zone-free timestamp."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_ms(ts: ColumnOrName) -> Column:
    """Milliseconds since the epoch of a ``timestamp_ntz`` (no session zone)."""
    return F.timestamp_diff("MILLISECOND", epoch_ntz(), _c(ts))


def ms_of(value) -> Column:
    """Epoch ms of a literal: an int is taken as ms, a string or a datetime as
    a zone-free wall-clock time."""
    if isinstance(value, Column):
        return value
    if isinstance(value, int):
        return F.lit(value).cast("long")
    return epoch_ms(F.lit(str(value)).cast("timestamp_ntz"))


def millis_to_ts(ms: ColumnOrName, ntz: bool = False) -> Column:
    """Epoch ms to a timestamp. ``ntz=True`` gives a zone-free value that is
    the same in any session zone."""
    if ntz:
        return F.timestamp_add("MILLISECOND", _c(ms), epoch_ntz())
    return F.timestamp_millis(_c(ms))


def zero_to_null(c: ColumnOrName) -> Column:
    return F.nullif(_c(c), F.lit(0))


def ms_to_sec(c: ColumnOrName) -> Column:
    """Whole seconds of a ms duration, rounded down; NULL stays NULL."""
    return F.floor(_c(c) / 1000)


def total(cols: Iterable[ColumnOrName]) -> Column:
    """Sum of columns; any NULL part gives NULL, as SQL ``+`` does."""
    cols = [_c(c) for c in cols]
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def trim_lower(c: ColumnOrName) -> Column:
    return F.trim(F.lower(_c(c)))


def trim_upper(c: ColumnOrName) -> Column:
    return F.trim(F.upper(_c(c)))


def in_list(c: ColumnOrName, values: Iterable[str]) -> Column:
    return _c(c).isin(list(values))
