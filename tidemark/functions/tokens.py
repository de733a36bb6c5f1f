"""Delimited text -> rows (U29), the table-function splitter re-aimed at a text column."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the delimiter set of the role-list splitter (must equal the reference's):
# comma, space, "[" and "]".
ROLE_DELIMITERS = ", []"


def delimiter_regex(delims: str = ROLE_DELIMITERS) -> str:
    """Character class matching one or more of the delimiter characters."""
    return "[" + "".join(re.escape(c) for c in delims) + "]+"


def token_array(col: str | Column, delims: str = ROLE_DELIMITERS, upper: bool = True) -> Column:
    """Non-empty trimmed tokens of ``col`` as ``array<string>`` (JVM-side, no UDF)."""
    c = F.col(col) if isinstance(col, str) else col
    if upper:
        c = F.upper(c)
    parts = F.split(c, delimiter_regex(delims))
    trimmed = F.transform(parts, lambda t: F.trim(t))
    return F.filter(trimmed, lambda t: t != F.lit(""))


def explode_tokens(
    df: DataFrame,
    col: str,
    delims: str = ROLE_DELIMITERS,
    upper: bool = True,
    pos_col: str = "token_no",
    token_col: str = "token",
    distinct_col: str | None = None,
) -> DataFrame:
    """One row per non-empty token of ``col``: all other columns, 1-based position, token.

    ``distinct_col``: a column with how many different tokens the row's text has, so that counting them needs no shuffle.

    A narrow transformation: splitting and exploding happen inside the scan's
    partition, with no shuffle; the whole text of every row is tokenised.
    """
    keep = [F.col(c) for c in df.columns if c != col]
    tokens = token_array(col, delims, upper)
    if distinct_col is not None:
        df = df.select(*keep, tokens.alias("__tokens")).withColumn(distinct_col, F.size(F.array_distinct("__tokens")))
        keep, tokens = [*keep, F.col(distinct_col)], F.col("__tokens")
    return df.select(*keep, F.posexplode(tokens).alias(pos_col, token_col)).withColumn(pos_col, F.col(pos_col) + F.lit(1))
