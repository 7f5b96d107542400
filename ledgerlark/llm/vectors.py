"""Vectors in blocks, for operators that hold a query set or an index against all rows.

A block is one row of a table: up to ``BLOCK_ROWS`` vectors as the bytes of a numpy
matrix, with their ids.  :func:`met` deals blocks and the other side's parts (tiles
of anchors, shards of an index) to small groups, each of one part and a few blocks,
so that no task holds more than that whatever the tables' sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
GROUP_BLOCKS = 32
LEAST_GROUPS = 8


def matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Doubles (n, width) of an Arrow column of arrays, shorter vectors followed by zeros, and which rows are usable:
    not null, without null or non-finite components."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.list_(pa.float64()))
    n = len(column)
    out = np.zeros((n, width))
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)  # a null component comes as NaN
    owner = np.repeat(np.arange(n), sizes)
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    usable = column.is_valid().to_numpy(zero_copy_only=False).copy()
    usable[owner[~np.isfinite(values)]] = False
    out[owner, at] = values
    return out, usable


def packed(vectors: np.ndarray) -> tuple[bytes, int]:
    """The matrix's bytes and bytes a component: four where these hold every component exactly."""
    with np.errstate(over="ignore"):
        small = vectors.astype(np.float32)
    exact = np.array_equal(small.astype(np.float64), vectors)
    return (small.tobytes(), 4) if exact else (vectors.tobytes(), 8)


def unpacked(data: bytes, component: int, width: int) -> np.ndarray:
    return np.frombuffer(data, np.float32 if component == 4 else np.float64).reshape(-1, max(1, width)).astype(np.float64)


def rows_a_block(width: int) -> int:
    return max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, width))))


def width_of(rows: DataFrame, vector: str) -> int:
    """Components of the longest vector, at least one."""
    return max(1, rows.agg(F.max(F.size(vector))).first()[0] or 0)


def numbered_blocks(batches: Iterator[pa.RecordBatch], make: Callable, limit: int) -> Iterator[pa.RecordBatch]:
    """``make(rows, block number)`` of every ``limit`` rows of a task; numbers are unique and the same if a task is run again."""
    from pyspark import TaskContext

    task, k, held, have = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            taken = batch.slice(at, limit - have)
            held.append(taken)
            have, at = have + taken.num_rows, at + taken.num_rows
            if have == limit:
                yield make(pa.Table.from_batches(held).combine_chunks(), (task << 32) + k)
                k, held, have = k + 1, [], 0
    if held:
        yield make(pa.Table.from_batches(held).combine_chunks(), (task << 32) + k)


def met(blocks: DataFrame, parts: DataFrame, n_parts: int, work: Callable, schema: str) -> DataFrame:
    """``work(blocks, part)`` over Arrow tables of every part (column ``part``, 0 to ``n_parts`` - 1) and every group of
    about ``GROUP_BLOCKS`` blocks (column ``block``); of fewer where there would be less than ``LEAST_GROUPS`` pairs."""
    n_blocks = blocks.count()
    n_groups = max(1, -(-n_blocks // GROUP_BLOCKS), min(n_blocks, -(-LEAST_GROUPS // n_parts)))
    dealt = blocks.withColumn("deal", F.pmod(F.xxhash64("block"), F.lit(n_groups)).cast("int"))
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    copied = parts.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return work(left, right)

    return dealt.groupBy("part", "deal").cogroup(copied.groupBy("part", "deal")).applyInArrow(run, schema)
