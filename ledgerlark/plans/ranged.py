"""Positions inside groups of any size, by ranges of the whole sort order.

Rows are dealt to partitions by ranges of (keys, order); Spark draws the splitters
from a sample of the rows themselves.  A partition is therefore as large as any other,
whether one key holds a third of all rows or most values of the order are equal:
the order goes on with its later columns.  Sorted partitions are written once, each
row with a number that rises along its partition.  The position of a row in its group
is then arithmetic: its number, less the first number of its group in that partition,
plus the rows of the group in earlier partitions.  Only one row for each group and
partition is aggregated; a group is never sorted in one task, and what reads the result
twice reads the written rows.  Columns that follow from a row alone are best added
behind the rank: all columns given are shuffled and written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.session import landed

_AT = "_range_at"
_PART_BITS = 33  # monotonically_increasing_id: the partition above, the row below


def ranks_by_range(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, partitions: int | None = None
) -> DataFrame:
    """All rows with ``name``, the 1-based position (bigint) in their group.

    ``order`` must be unique within a group for a defined result; nulls come first in
    ascending and last in descending order.  Null keys are one group.  A column that
    bears the name of the result is replaced.  ``partitions`` is the number of ranges,
    by default ``spark.sql.shuffle.partitions``; the result does not depend on it.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [*(F.col(k).asc() for k in keys), *order]
    ranged = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    out = [c for c in df.columns if c != name]
    rows = landed(ranged.select(*out, F.monotonically_increasing_id().alias(_AT)), "ranges")
    part = F.shiftright(_AT, _PART_BITS)

    counts = rows.groupBy(*keys, part.alias("_part")).agg(F.min(_AT).alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    starts = counts.select(
        *[F.col(k).alias(f"_start_{i}") for i, k in enumerate(keys)], "_part", (ahead + 1 - F.col("_first")).alias("_shift")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_start_{i}")) for i, k in enumerate(keys)]
    placed = rows.join(starts, reduce(and_, same, part == F.col("_part")))
    return placed.select(*out, (F.col(_AT) + F.col("_shift")).alias(name))
