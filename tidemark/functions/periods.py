"""Half-open period predicates ``[start, end)`` and time literals.

All helpers return Catalyst expressions, so they run inside whole-stage codegen
and act as residual conditions of equi-joins on the key.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Open ends of the two time axes (must equal the reference's).
#   system axis open end     9999-12-31 23:59:59.999
#   business axis open from  9999-12-31 (any end at or after it is open)
SYS_OPEN_END = "9999-12-31 23:59:59.999"
BUS_OPEN_FROM = "9999-12-31 00:00:00"


def ts_lit(value: str | _dt.datetime | _dt.date, dtype: T.DataType | None = None) -> Column:
    """A timestamp literal typed like ``dtype`` (default ``timestamp_ntz``).

    Strings are cast, never parsed through Python, so the value does not move with
    the session time zone for NTZ columns.
    """
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    target = dtype if dtype is not None else T.TimestampNTZType()
    return F.lit(str(value)).cast(T.TimestampNTZType()).cast(target)


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """``[s1,e1)`` and ``[s2,e2)`` share an instant."""
    return (s1 < e2) & (e1 > s2)


def contains_point(s: Column, e: Column, p: Column) -> Column:
    """``p`` lies in ``[s,e)``."""
    return (p >= s) & (p < e)


def contains_between(s: Column, e: Column, s2: Column, e2: Column) -> Column:
    """Both ends of ``[s2,e2]`` lie in ``[s,e]``, ends inclusive (P10, ``BETWEEN``)."""
    return s2.between(s, e) & e2.between(s, e)


def within(s: Column, e: Column, s2: Column, e2: Column) -> Column:
    """``[s,e)`` lies inside ``[s2,e2)``."""
    return (s2 <= s) & (e2 >= e)


def null_or_before(bound: Column, start: Column) -> Column:
    """Left neighbour guard: no previous input, or it ended before ``start``."""
    return bound.isNull() | (bound < start)


def null_or_not_meeting(bound: Column, end: Column) -> Column:
    """Right neighbour guard: no next input, or it does not start at ``end``."""
    return bound.isNull() | (bound != end)
