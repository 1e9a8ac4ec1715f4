"""Incremental raw landing with Structured Streaming.

The batch raw layer is a full refresh. When source files keep arriving in
a folder, the same landing (all-string columns + audit stamp) runs as a
streaming query over the file source: each trigger picks up only files not
seen before, the checkpoint records which, and a restarted or retried run
neither loses nor duplicates a file. ``availableNow`` processes everything
present and stops, so a scheduler can run it like a batch job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata import fixed
from strata.sources.files import QUOTING, all_string_schema


def raw_csv_stream(spark: SparkSession, folder: str, columns: Sequence[str],
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the CSV files of ``folder`` (all string)."""
    # enforceSchema=false: a file whose header differs from ``columns`` fails the query;
    # multiLine: an arriving file is read by one task, its quoted fields may hold line breaks
    reader = spark.readStream.schema(all_string_schema(columns)).options(**QUOTING, header="true", enforceSchema="false", multiLine="true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(folder)


def land_stream(
    spark: SparkSession,
    folder: str,
    table: str,
    target: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Land new files of ``folder`` into ``target``, stamped on arrival.

    The checkpoint records which files were landed. By default it lives in
    the target (``_landing``, which readers skip), so every landing into one
    target resumes the one before; a fresh checkpoint beside an old target
    would take new batches for landed ones and lose their files.
    """
    stream = raw_csv_stream(spark, folder, fixed.RAW_COLUMNS[table])
    stamped = stream.withColumn(fixed.AUDIT_COLUMN, F.current_timestamp())
    writer = (stamped.writeStream.format(fmt)
              .option("checkpointLocation", checkpoint or f"{target.rstrip('/')}/_landing")
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(target)


def land_folder_now(spark: SparkSession, folder: str, table: str, target: str,
                    checkpoint: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Run one ``availableNow`` landing to completion and read the target back."""
    query = land_stream(spark, folder, table, target, checkpoint, True, fmt)
    query.awaitTermination()  # raises what stopped the query
    return spark.read.format(fmt).load(target)
