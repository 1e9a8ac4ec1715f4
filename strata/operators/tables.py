"""DataFrame -> DataFrame table operators: audit stamp, column moves, dedup."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.fixed import AUDIT_COLUMN
from strata.session import scratch_path

#: Up to this many hashes of repeated keys are broadcast (a long each), if they are at most this share
#: of all hashes; beyond it all rows are sorted. One in ``PROBE`` hashes is counted first to see that.
REPEATED_LIMIT, REPEATED_SHARE, PROBE = 1 << 21, 0.05, 64


def with_audit(df: DataFrame, at: datetime | str | None = None, column: str = AUDIT_COLUMN) -> DataFrame:
    """Append the ingestion timestamp as the last column.

    ``at`` pins the value (reruns and tests are reproducible); by default the
    query's ``current_timestamp()`` is used, one value for the whole query.
    """
    value: Column = F.lit(at).cast("timestamp") if at is not None else F.current_timestamp()
    return df.withColumn(column, value)


def move_to_end(df: DataFrame, column: str) -> DataFrame:
    """Same columns, ``column`` last (a single Project, no data movement)."""
    return df.select(*[c for c in df.columns if c != column], column)


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the least row in a declared total order.

    The survivor is the row whose ``order_by`` columns (default: all non-key
    columns in schema order) are smallest, NULLs first; remaining columns
    break ties, so the result never depends on partitioning or retries.

    Plan: ``min(struct)`` is an ordinary aggregate, so Spark pre-aggregates
    on the map side before the shuffle on ``keys``; a key holding a large
    share of all rows collapses to one row per map task instead of landing
    whole in one reducer (a ``row_number`` window would shuffle it whole).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    ordered = list(order_by) if order_by else list(rest)
    ordered += [c for c in rest if c not in ordered]
    winner = F.min(F.struct(*[F.col(f"`{c}`").alias(c) for c in ordered])).alias("__winner")
    return (
        df.groupBy(*[F.col(f"`{k}`") for k in keys])
        .agg(winner)
        .select(*[F.col(f"`{k}`") for k in keys], *[F.col("__winner").getField(c).alias(c) for c in ordered])
        .select(*[F.col(f"`{c}`") for c in df.columns])
    )


def dedup_repeated(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    limit: int = REPEATED_LIMIT,
) -> DataFrame:
    """``dedup_by_key`` for a written frame: only rows whose key may repeat are sorted.

    ``min(struct)`` sorts every row before the shuffle and once more after
    it, though few keys may repeat. Here the keys' 64-bit hashes are counted
    first (a hash aggregate over longs, combined map-side) and those that
    occur twice or more are written. Rows of another hash have a key of
    their own: they pass in their order, unsorted and unshuffled. The
    others, and those that merely share a hash, go through
    ``dedup_by_key``. With more than ``limit`` such hashes, or where they
    are no small share, all rows do.

    The counts run at once and ``df`` is gone through up to four times, so
    it should be read from files and has to give the same rows each time.
    """
    keys = list(keys)
    key_hash = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    hashes = df.select(key_hash.alias("__hash"))

    def counted(some: DataFrame) -> DataFrame:
        return some.groupBy("__hash").agg(F.count(F.lit(1)).alias("__rows"))

    probe = counted(hashes.filter(F.pmod("__hash", F.lit(PROBE)) == 0))
    seen = probe.agg(F.count(F.lit(1)).alias("hashes"), F.count_if(F.col("__rows") > 1).alias("repeated")).first()
    if seen["repeated"] > min(2 * limit / PROBE, REPEATED_SHARE * seen["hashes"]):
        return dedup_by_key(df, keys, order_by)
    at, found = scratch_path(df.sparkSession, "repeated"), Observation()
    repeated = counted(hashes).filter(F.col("__rows") > 1).select("__hash")
    repeated.observe(found, F.count(F.lit(1)).alias("hashes")).write.parquet(at)
    if found.get["hashes"] == 0:
        return df
    if found.get["hashes"] > limit:
        return dedup_by_key(df, keys, order_by)
    again = F.broadcast(df.sparkSession.read.schema("__hash long").parquet(at))
    hashed = df.withColumn("__hash", key_hash)
    single = hashed.join(again, "__hash", "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
    rest = hashed.join(again, "__hash", "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
    return single.unionByName(dedup_by_key(rest, keys, order_by))


def distinct_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``SELECT DISTINCT columns`` (map-side partial aggregation, then shuffle)."""
    return df.select(*columns).distinct()

