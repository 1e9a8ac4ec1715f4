"""Position of every row in a total order, without sorting in one place."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

#: ``monotonically_increasing_id`` holds the partition above this many bits of row number.
_ROW_BITS = 33


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with the position (from 1) of each row in ``order``; rows that tie get different positions.

    ``order`` names the columns (``F.col``). The rows are written as they
    come: dealing them in ranges looks at them twice, for the cuts and for
    the rows, and ``df`` is not worked out twice for that. They are dealt in
    ranges of ``order`` and sorted within each range, and written so with
    their place in it; the ranges' sizes (one number for each partition)
    give every range its offset. No task sees more than a range, unlike a
    window over all rows. Ranges are cut between values: end ``order`` with
    keys that tell rows apart, else a value held by many rows is one range.
    """
    spark = df.sparkSession
    at = scratch_path(spark, "ranked")
    unranked = scratch_path(spark, "unranked")
    df.write.parquet(unranked)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = spark.read.schema(df.schema).parquet(unranked).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    dealt.withColumn("__place", F.monotonically_increasing_id()).write.parquet(at)
    placed = spark.read.parquet(at).withColumn("__range", F.shiftright("__place", _ROW_BITS))
    sizes = placed.groupBy("__range").count().orderBy("__range").collect()
    before = [0, *accumulate(r["count"] for r in sizes)]
    # values of the plan: a frame of Python rows would start Python workers to hand them over
    offsets = spark.createDataFrame(pa.table({"__range": pa.array([r["__range"] for r in sizes], pa.int64()), "__before": pa.array(before[:-1], pa.int64())}))
    row = F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(offsets, "__range").select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__before") + row + 1).alias(name))
