"""Proportional stratified interleaving of documents into shards, in DataFrame operations only.

The rows of each source are shuffled by a seeded hash and ranked; row r of n gets
the fractional rank (r - 1 + u) / n, where u in [0, 1) is the source's own start.
Sorted by fractional rank, sources interleave in proportion to their sizes, so
contiguous cuts of equal row counts all match the mixture.  Law ``rows``: shard
sizes differ by one row at most.

No source and no global order is sorted in one task.  Hashes are uniform, so
ranks come from (source, hash chunk) windows plus the sums of the chunks before;
positions come from windows over narrow bands of the fractional rank plus the
sums of the bands before.  Both cuts get finer with the number of rows.  Only
ids, sizes and checksums are shuffled, never text.

A null source is a stratum of its own.  A null text has size 1 and the checksum
of the empty text.  Rows with one doc_id are ordered by checksum and size; full
duplicates are interchangeable.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.session import landed

SHARDS = 8
SEED = 20
CUT_ROWS = 20_000
LEAST_CUTS = 1024


def _hash60(text):
    """The first 60 bits of md5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, text_crc32, law, shard, slot, grown_shard), one row for each document."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    base = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("stratum"),
        _hash60(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("n")))).alias("h"),
    )
    base = landed(base, "shard_base")
    n = base.count()
    cuts = max(LEAST_CUTS, -(-n // CUT_ROWS))
    last = ["doc_id", "text_crc32", "size"]

    base = base.withColumn("chunk", F.floor(F.col("h") / F.lit(2.0**60) * cuts).cast("bigint"))
    counts = base.groupBy("stratum", "chunk").agg(F.count("*").alias("c"))
    whole = Window.partitionBy("stratum")
    before = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "stratum",
        "chunk",
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("ahead"),
        F.sum("c").over(whole).alias("n_s"),
    )
    here = Window.partitionBy("stratum", "chunk").orderBy("h", *last)
    start = _hash60(F.concat_ws(":", F.lit(f"start {seed}"), "stratum")) / F.lit(2.0**60)
    ranked = (
        base.withColumn("rn", F.row_number().over(here))
        .join(counts, ["stratum", "chunk"])
        .withColumn("frac", (F.col("ahead") + F.col("rn") - 1 + start) / F.col("n_s"))
        .withColumn("band", F.floor(F.col("frac") * cuts).cast("bigint"))
        .drop("chunk", "rn", "ahead", "n_s")
    )
    ranked = landed(ranked, "shard_ranks")
    bands = ranked.groupBy("band").agg(F.count("*").alias("c"))
    bands = bands.select(
        "band",
        F.coalesce(F.sum("c").over(Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(
            "ahead"
        ),
    )
    in_band = Window.partitionBy("band").orderBy("frac", "stratum", "h", *last)
    placed = (
        ranked.withColumn("rn", F.row_number().over(in_band))
        .join(bands, "band")
        .withColumn("position", F.col("ahead") + F.col("rn") - 1)
        .withColumn("shard", F.expr(f"int(position * {shards} div {max(1, n)})"))
    )
    # The first position p with p * shards div n = shard.
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("position") - first).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
