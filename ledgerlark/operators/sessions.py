"""Session history, response cache, user memory, incremental loading."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_n_runs(conv: DataFrame, n: int) -> DataFrame:
    """Rows of the last ``n`` runs per session; a run starts at each user turn.

    Rows ahead of the first user turn form a run of their own.  Only the n
    newest user turns of a session take part in the ranking (each task keeps
    ``n`` per session ahead of the shuffle); the session's rows are then
    filtered by the turn found.
    """
    newest = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    starts = (
        conv.filter(F.col("role") == "user")
        .select("conv_id", "turn")
        .withColumn("_n", F.row_number().over(newest))
        .filter(F.col("_n") <= n)
    )
    from_turn = starts.groupBy("conv_id").agg(
        # Fewer than n user turns: everything is recent, also what precedes them.
        F.when(F.count("*") == n, F.min("turn")).alias("_from")
    )
    joined = conv.join(from_turn, "conv_id", "left")
    return joined.filter(F.col("_from").isNull() | (F.col("turn") >= F.col("_from"))).drop("_from")


def memory_state(ops: DataFrame) -> DataFrame:
    """(user_id, memory_id, text, seq) that hold after all operations.

    The latest add or delete after the user's last clear decides.  Both steps
    are aggregations with map-side combine; no user's history is sorted.
    """
    cleared = ops.filter(F.col("op") == "clear").groupBy("user_id").agg(F.max("seq").alias("_cleared"))
    live = ops.filter(F.col("op") != "clear").join(cleared, "user_id", "left")
    live = live.filter(F.col("_cleared").isNull() | (F.col("seq") > F.col("_cleared")))
    last = live.groupBy("user_id", "memory_id").agg(
        F.max(F.struct("seq", "op", "text")).alias("_last")
    )
    return last.filter(F.col("_last.op") == "add").select(
        "user_id", "memory_id", F.col("_last.text").alias("text"), F.col("_last.seq").alias("seq")
    )


def cache_split(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests with ``status`` hit or miss and the cached ``content``.

    The cache holds one content per message; an empty content is a miss.
    Callers filter on the status; ``to_process`` gives the distinct misses.
    """
    usable = cache.filter(F.length("content") > 0).select("message", "content")
    out = requests.join(usable, "message", "left")
    return out.withColumn("status", F.when(F.col("content").isNotNull(), "hit").otherwise("miss"))


def to_process(split: DataFrame) -> DataFrame:
    """Each missing message once: a repeated request is answered by the first."""
    return split.filter(F.col("status") == "miss").select("message").distinct()


def append_cache(cache: DataFrame, answers: DataFrame) -> DataFrame:
    """Cache after the answers were stored; an answer replaces an empty entry."""
    kept = cache.join(answers.select("message"), "message", "left_anti")
    return kept.select("message", "content").unionByName(answers.select("message", "content"))


def load_docs(
    new: DataFrame,
    existing: DataFrame | None,
    recreate: bool = False,
    key: str = "doc_id",
    text: str = "text",
    hashed: bool = False,
) -> DataFrame:
    """Documents of ``new`` to add: contents not yet stored, each once (lowest key).

    Copies are reduced to one row per content hash on both sides before they
    meet, so a text that fills a third of the table is one row per task.  With
    ``recreate`` nothing counts as stored.  ``hashed``: ``existing`` has a column
    content_hash in place of texts.
    """
    with_hash = new.withColumn("content_hash", F.sha2(text, 256))
    firsts = with_hash.groupBy("content_hash").agg(F.min(key).alias(key))
    if not recreate:
        content = F.col("content_hash") if hashed else F.sha2(text, 256)
        stored = existing.select(content.alias("content_hash")).distinct()
        firsts = firsts.join(stored, "content_hash", "left_anti")
    return firsts


def request_stats(log: DataFrame, message: str = "message") -> DataFrame:
    """Per status: requests, timed requests, total and mean seconds, from request lines."""
    from ledgerlark.functions.logs import parse_request_line

    fields = parse_request_line(F.col(message))
    rows = log.select(*[c.alias(n) for n, c in fields.items()]).filter("status IS NOT NULL")
    return rows.groupBy("status").agg(
        F.count("*").alias("requests"),
        F.count("seconds").alias("timed"),
        F.round(F.sum("seconds"), 2).alias("total_seconds"),
        F.round(F.avg("seconds"), 4).alias("mean_seconds"),
        F.max("seconds").alias("max_seconds"),
    )


ERROR = 0.01  # of a quantile, relative to its value


def request_sketches(log: DataFrame, message: str = "message", ts: str = "ts", error: float = ERROR) -> DataFrame:
    """(day, status, bucket, requests, seconds): mergeable sketches of request times, one for each day and status.

    Bucket b holds times in (g**(b-1), g**b] with g = (1 + error) / (1 - error), so the
    bucket's middle is within ``error`` of each of them, relative to its size.  Sketches
    of any days merge by adding up buckets; their number grows with the logarithm of the
    largest time only.  Bucket null counts times of zero.
    """
    from ledgerlark.functions.logs import parse_request_line

    fields = parse_request_line(F.col(message))
    rows = log.select(F.to_date(ts).alias("day"), fields["status"].alias("status"), fields["seconds"].alias("_s"))
    bucket = F.when(F.col("_s") > 0, F.ceil(F.ln("_s") / F.lit(math.log((1 + error) / (1 - error)))).cast("int"))
    return rows.filter("_s IS NOT NULL AND status IS NOT NULL").groupBy("day", "status", bucket.alias("bucket")).agg(
        F.count("*").alias("requests"), F.sum("_s").alias("seconds")
    )


def sketch_quantiles(sketches: DataFrame, shares: Sequence[float], keys: Sequence[str] = ("status",), error: float = ERROR) -> DataFrame:
    """(keys, p..): quantiles of the merged sketches, each within ``error`` of the time of that rank.

    The rank of share q among n times is ceil(q n).  A key has few hundred buckets, whatever
    the number of requests.
    """
    merged = sketches.groupBy(*keys, "bucket").agg(F.sum("requests").alias("n"))
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("bucket"))
    upto = merged.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    growth = (1 + error) / (1 - error)
    middle = F.coalesce(F.lit(2.0) * F.pow(F.lit(growth), F.col("bucket")) / F.lit(growth + 1), F.lit(0.0))
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * q), middle)) for q in shares]
    return upto.groupBy(*keys).agg(*[F.round(c, 6).alias(f"p{round(100 * q)}") for c, q in zip(at, shares, strict=True)])
