"""Rows out of computed arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(df: DataFrame, keep: Sequence[str], arr: Column | str, pos: str, item: str) -> DataFrame:
    """One row per element with its 0-based position.

    For an inner explode the optimizer infers a test that the array is not
    empty and pushes it to the scan, so that a costly array is computed once for
    the test and again for the rows.  The outer form has no such test; the row
    of an empty array is dropped behind it.
    """
    rows = df.select(*keep, F.posexplode_outer(arr).alias(pos, item))
    return rows.filter(F.col(pos).isNotNull())


def once(df: DataFrame, keep: Sequence[str], value: Column, name: str) -> DataFrame:
    """``keep`` and a costly value that a later filter can use without computing it again."""
    return df.select(*keep, F.explode_outer(F.array(value)).alias(name))
