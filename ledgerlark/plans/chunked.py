"""Ordered computations over groups of any size.

A plain ``Window.partitionBy(key).orderBy(...)`` sorts a whole group in one
task, which fails when a single key holds a third of the table.  Here each
group is cut into *chunks*: a chunk expression that never decreases in the
sort order (``id div 65536``, a page range, a value band).  The window runs per
(key, chunk); one small row per chunk is aggregated with map-side combine, its
prefix over the chunks of the key is taken, and the prefix is joined back.

The chunk is a function of the row alone, so a task that is run again after
an executor loss puts every row into the same chunk, and results do not depend
on partitioning.  Null keys are a group of their own; order columns must be unique
within a key for a defined result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
CARRY = "_carry"

# Rows per chunk where the order column is a dense unique number.
DENSE_CHUNK = 65_536


def dense_chunk(order: Column, size: int = DENSE_CHUNK) -> Column:
    """At most ``size`` rows of the whole table fall into one chunk."""
    return F.floor(order / F.lit(size)).cast("bigint")


def _cut(df: DataFrame, chunk: Column) -> DataFrame:
    """Rows without an order value form the first chunk, as nulls sort first."""
    return df.withColumn(CHUNK, F.coalesce(chunk.cast("bigint"), F.lit(-(2**63)).cast("bigint")))


def _prefix(df: DataFrame, keys: Sequence[str], per_chunk: Column, prefix) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, CHUNK).agg(per_chunk.alias(CARRY))
    return totals.select(*keys, CHUNK, prefix(F.col(CARRY)).over(before).alias(CARRY))


def _with_carry(cut: DataFrame, carries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with its chunk's prefix; null keys are equal to each other."""
    names = [*keys, CHUNK]
    right = carries.select(*[F.col(k).alias(f"_carry_{i}") for i, k in enumerate(names)], CARRY)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_carry_{i}")) for i, k in enumerate(names)])
    return cut.join(right, same).drop(*[f"_carry_{i}" for i in range(len(names))])


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    chunk: Column,
    value: Column,
    name: str,
) -> DataFrame:
    """Sum of ``value`` from the start of the group up to this row."""
    cut = _cut(df, chunk)
    here = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carries = _prefix(cut, keys, F.sum(value), F.sum)
    return (
        _with_carry(cut.withColumn(name, F.sum(value).over(here)), carries, keys)
        .withColumn(name, F.col(name) + F.coalesce(F.col(CARRY), F.lit(0)))
        .drop(CHUNK, CARRY)
    )


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunk: Column, name: str
) -> DataFrame:
    """1-based position of each row in its group."""
    return running_sum(df, keys, order, chunk, F.lit(1).cast("bigint"), name)


def last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    chunk: Column,
    value: Column,
    name: str,
    own: bool = True,
) -> DataFrame:
    """Last non-null ``value`` at or before this row (forward fill); without ``own``, before it."""
    cut = _cut(df, chunk)
    here = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if own else -1)
    )
    newest = F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    carries = _prefix(cut, keys, newest, lambda c: F.last(c, ignorenulls=True))
    return (
        _with_carry(cut.withColumn(name, F.last(value, ignorenulls=True).over(here)), carries, keys)
        .withColumn(name, F.coalesce(F.col(name), F.col(CARRY)))
        .drop(CHUNK, CARRY)
    )
