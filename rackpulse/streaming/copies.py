"""New files copied as files, byte for byte, under clean names.

A run lists the source folder, leaves out what is older than an age or already
in the ledger, and copies the rest in tasks, a file at a time in pieces, so
that a file's size is no matter. The ledger (Parquet, appended when all copies
of a run are done) says what was copied; a run that ends early is repeated
whole and writes the same bytes. A file is written under a name of its own and
then moved to its place, so a lost executor leaves no half file under a target
name (at most a hidden ``.part`` file).

Names that Hadoop cannot read (with a colon) are the reason for the cleaning, so
folders are listed and files copied through ``pyarrow.fs``: any file system it
knows by URI, seen by driver and executors alike. The driver lists the topmost
folder only; each folder in it is walked by a task.

Defined results: folders keep their names and places; a file that changed since it
was copied (other time stamp) is copied again; of several files that clean to one
name the first by path has it, the others are in the ledger with status ``clash``
and are not copied; an empty file is copied, an empty folder is not.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.selection import clean_name

FILES = "source string, folder string, modified long, bytes long"
LEDGER = "source string, target string, modified long, bytes long, md5 string, status string, run string"
PIECE = 8 << 20


def _opened(folder: str) -> tuple[pafs.FileSystem, str]:
    where, path = pafs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)
    return where, path.rstrip("/")


def listed(spark: SparkSession, source_dir: str) -> DataFrame:
    """(source, folder below ``source_dir``, modified in microseconds, bytes) of all files within."""
    where, root = _opened(source_dir)
    top = [(x.path, x.type == pafs.FileType.Directory) for x in where.get_file_info(pafs.FileSelector(root))]
    tops = spark.createDataFrame(top, "path string, is_dir boolean")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, _ = _opened(source_dir)
        for batch in batches:
            for path, is_dir in zip(batch.path, batch.is_dir, strict=True):
                found = where.get_file_info(pafs.FileSelector(path, recursive=True) if is_dir else [path])
                rows = [(x.path, x.path[len(root):].rpartition("/")[0], x.mtime_ns // 1000, x.size) for x in found if x.type == pafs.FileType.File]
                yield pd.DataFrame(rows, columns=["source", "folder", "modified", "bytes"])

    return tops.repartition(max(1, len(top)), "path").mapInPandas(walk, FILES)


def read_ledger(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """What all runs did; empty before the first."""
    where, path = _opened(ledger_dir)
    if where.get_file_info(path).type == pafs.FileType.NotFound:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger_dir)


def copy_files(spark: SparkSession, source_dir: str, target_dir: str, ledger_dir: str,
               max_age_seconds: int | None = None, now: dt.datetime | None = None) -> DataFrame:
    """Copy every new file under ``source_dir`` to ``target_dir``; the ledger's rows of this run.

    ``max_age_seconds`` passes over files modified longer than that before
    ``now`` (an instant, naive values count as UTC; default: the start of this run)."""
    run, (_, root) = uuid.uuid4().hex, _opened(target_dir)
    files = listed(spark, source_dir)
    if max_age_seconds is not None:
        now = now or dt.datetime.now(dt.timezone.utc)
        now = now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)
        files = files.where(F.col("modified") >= int((now.timestamp() - max_age_seconds) * 1_000_000))
    ledger = read_ledger(spark, ledger_dir)
    new = (files.withColumn("target", F.concat(F.lit(root), "folder", F.lit("/"), clean_name(F.col("source"))))
           .join(ledger.select("source", "modified"), ["source", "modified"], "left_anti"))
    held = ledger.where("status = 'copied'").groupBy("target").agg(F.min("source").alias("holder"))
    first = F.min("source").over(Window.partitionBy("target"))  # as many as clean to one name in one folder
    new = (new.join(held, "target", "left").withColumn("status", F.when(F.col("source") == F.coalesce("holder", first), "copied").otherwise("clash"))
           .select("source", "target", "modified", "bytes", "status"))

    def copied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (read, _), (write, _) = _opened(source_dir), _opened(target_dir)

        def one(source: str, target: str) -> tuple[int, str]:
            folder, digest, size = target.rpartition("/")[0], hashlib.md5(), 0
            write.create_dir(folder, recursive=True)
            part = f"{folder}/.{uuid.uuid4().hex}.part"
            with read.open_input_stream(source, compression=None) as given, write.open_output_stream(part, compression=None) as taken:
                while piece := given.read(PIECE):
                    taken.write(piece)
                    digest.update(piece)
                    size += len(piece)
            write.move(part, target)
            return size, digest.hexdigest()

        for batch in batches:
            done = [one(*x) if status == "copied" else (None, None) for *x, status in zip(batch.source, batch.target, batch.status, strict=True)]
            sizes = [n if n is not None else old for (n, _), old in zip(done, batch.bytes, strict=True)]
            yield batch.assign(bytes=sizes, md5=[d for _, d in done], run=run)[["source", "target", "modified", "bytes", "md5", "status", "run"]]

    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    new.repartition(spread, "source").mapInPandas(copied, LEDGER).write.mode("append").parquet(ledger_dir)
    return read_ledger(spark, ledger_dir).where(F.col("run") == run)
