"""NULL defaults per column type and the NULL-or-default equality built on them.

The merges compare ``coalesce(x, default)`` on both sides, so a NULL equals the
type's default value as well as another NULL.  That relation is weaker than
``<=>`` (``NULL <=> 0`` is false, here it is true).  Everything is decided at plan
time from the schema; no UDF runs per row.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The NULL default of each type family (must equal the reference's).
#   TEXT           ''
#   DATE           0001-01-01
#   TIME           00:00:00
#   TIMESTAMP_NTZ  0000-01-01
#   anything else  0
TEXT_DEFAULT = ""
DATE_DEFAULT = "0001-01-01"
TIME_DEFAULT = "00:00:00"
TIMESTAMP_DEFAULT = "0000-01-01 00:00:00"
OTHER_DEFAULT = 0

_TIME_TYPE = getattr(T, "TimeType", None)


def null_default(dtype: T.DataType) -> Column | None:
    """The default that stands in for NULL in comparisons, typed like ``dtype``.

    Returns ``None`` for types without a scalar default (binary, arrays, maps,
    structs, variant); callers compare those with ``<=>`` instead.
    """
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit(TEXT_DEFAULT)
    if isinstance(dtype, T.DateType):
        return F.lit(DATE_DEFAULT).cast(T.DateType())
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(TIMESTAMP_DEFAULT).cast(T.TimestampNTZType())
    if isinstance(dtype, T.TimestampType):
        return F.lit(TIMESTAMP_DEFAULT).cast(T.TimestampNTZType()).cast(T.TimestampType())
    if _TIME_TYPE is not None and isinstance(dtype, _TIME_TYPE):
        return F.lit(TIME_DEFAULT).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.NumericType):
        return F.lit(OTHER_DEFAULT).cast(dtype)
    return None


def columntype_default(type_name: str) -> str:
    """SQL text of the default for a warehouse type-family name (TEXT, DATE, ...)."""
    name = (type_name or "").upper()
    if name == "TEXT":
        return "''"
    if name == "DATE":
        return f"DATE'{DATE_DEFAULT}'"
    if name == "TIME":
        return f"TIME'{TIME_DEFAULT}'"
    if name == "TIMESTAMP_NTZ":
        return f"TIMESTAMP_NTZ'{TIMESTAMP_DEFAULT}'"
    return str(OTHER_DEFAULT)


def canonical(col: str | Column, dtype: T.DataType) -> Column:
    """``coalesce(col, default)``; the raw column when the type has no default."""
    c = F.col(col) if isinstance(col, str) else col
    d = null_default(dtype)
    return c if d is None else F.coalesce(c, d)


def default_eq(left: Column, right: Column, dtype: T.DataType) -> Column:
    """NULL-or-default equality of two columns of the same type."""
    d = null_default(dtype)
    if d is None:
        return left.eqNullSafe(right)
    return F.coalesce(left, d) == F.coalesce(right, d)


def all_default_eq(pairs: list[tuple[Column, Column, T.DataType]]) -> Column:
    """Conjunction of :func:`default_eq` over column pairs; ``true`` when empty."""
    if not pairs:
        return F.lit(True)
    return reduce(and_, [default_eq(a, b, t) for a, b, t in pairs])


def with_canonical(df: DataFrame, cols: list[str], prefix: str, dtypes: dict[str, T.DataType]) -> DataFrame:
    """Append hidden canonical columns ``{prefix}{i}`` for ``cols`` (one projection)."""
    return df.select(
        "*", *[canonical(c, dtypes[c]).alias(f"{prefix}{i}") for i, c in enumerate(cols)]
    )


def null_default_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Join two frames on column pairs with NULL-or-default equality.

    The condition is a plain equality of ``coalesce`` expressions, so Catalyst
    plans it as a hash / sort-merge equi-join on the coalesced values.
    """
    lt = {f.name: f.dataType for f in left.schema.fields}
    pairs = [(left[a], right[b], lt[a]) for a, b in on]
    return left.join(right, all_default_eq(pairs), how)
