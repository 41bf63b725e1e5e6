"""Incremental ingest of new files (the periodic copy job, re-aimed).

A Structured Streaming file source with ``trigger(availableNow=True)`` takes
every file that arrived since the last run exactly once; the checkpoint
records which files were taken, so a rerun after a lost executor or driver
resumes without copying twice. Each run ends when the backlog is done, so it
fits a scheduler the way the cron copy did.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ingest_available(spark: SparkSession, source_dir: str, target_dir: str, checkpoint_dir: str,
                     schema: StructType, fmt: str = "parquet", max_age_seconds: int | None = None,
                     now: dt.datetime | None = None, clean_names: bool = False) -> None:
    """Copy the rows of every new file under ``source_dir``, folders within it
    included, to ``target_dir`` (Parquet) once.

    ``max_age_seconds`` takes only files modified within that time before
    ``now`` (an instant, naive values count as UTC; default: the start of this
    run), whatever the age of the newest file; older ones are passed over for
    good. ``clean_names`` records each row's cleaned source file name (S14); names
    with a colon cannot be read by Hadoop file systems and must be cleaned where
    the files are made."""
    stream = (spark.readStream.schema(schema).format(fmt)
              .option("recursiveFileLookup", "true").load(source_dir))
    if max_age_seconds is not None:
        now = now or dt.datetime.now(dt.timezone.utc)
        if now.tzinfo is None:
            now = now.replace(tzinfo=dt.timezone.utc)
        oldest = F.timestamp_micros(F.lit(int((now.timestamp() - max_age_seconds) * 1_000_000)))
        stream = stream.where(F.col("_metadata.file_modification_time") >= oldest)
    if clean_names:
        from ..operators.selection import clean_name
        stream = stream.withColumn("source_file", clean_name(F.col("_metadata.file_path")))
    q = (stream.writeStream.format("parquet")
         .option("path", target_dir)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def read_ingested(spark: SparkSession, target_dir: str) -> DataFrame:
    return spark.read.parquet(target_dir)
