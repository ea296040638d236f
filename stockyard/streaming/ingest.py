"""Incremental bronze -> silver refresh with Structured Streaming.

A raw folder that keeps receiving CSV files is watched by a stream of its file
names. Each micro-batch reads the files that arrived with the same reader as
the batch path (columns bound by the header of each file, the raw text of rows
that do not parse), cleans them with the same silver function and writes them
as one partition of the output folder, ``_batch=<number>``. With
``trigger(availableNow=True)`` a run takes everything that arrived since the
last run and stops - a daily scheduled refresh that never re-reads old files.

Exactly-once comes from the checkpoint folder, which fixes the files of a
micro-batch before it runs, and from the partition: a batch that is run again
after a failure replaces its own partition and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import bronze, silver

BATCH = "_batch"
_FILE = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
              partitioned: bool = False) -> DataFrame:
    """Stream of the paths of a folder's files (their content is not read),
    with their ``_batch`` if the folder is an output of this module."""
    schema = _FILE + (f", {BATCH} long" if partitioned else "")
    r = spark.readStream.format("binaryFile").schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder).select("path", *([BATCH] if partitioned else []))


def read_refreshed(spark: SparkSession, path: str) -> DataFrame:
    """The rows that the refreshes into ``path`` have written so far."""
    return spark.read.parquet(path).drop(BATCH)


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
           available_now: bool) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _refresh(spark: SparkSession, raw_dir: str, dataset: str, out_path: str, checkpoint: str,
             available_now: bool, max_files_per_trigger: int | None,
             clean: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    def handle(names: DataFrame, number: int) -> None:
        files = [r.path for r in names.collect()]  # names only, of one micro-batch
        if not files:
            return
        rows = bronze.bronze_dataset(names.sparkSession, raw_dir, dataset, path=files)
        clean(rows).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/{BATCH}={number}")

    return _start(new_files(spark, raw_dir, max_files_per_trigger), handle, checkpoint, available_now)


def refresh_silver(spark: SparkSession, raw_dir: str, dataset: str, out_path: str,
                   checkpoint: str, available_now: bool = True,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental refresh of one silver data set; returns the
    running query (``awaitTermination()`` to wait for an availableNow run).
    ``max_files_per_trigger`` bounds each micro-batch (an availableNow run
    then processes the backlog in several batches). Read the output with
    :func:`read_refreshed`."""
    return _refresh(spark, raw_dir, dataset, out_path, checkpoint, available_now,
                    max_files_per_trigger, silver.DATASETS[dataset])


def refresh_bronze(spark: SparkSession, raw_dir: str, dataset: str, out_path: str,
                   checkpoint: str, available_now: bool = True,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Raw CSV folder -> bronze parquet folder (rows as read, plus the text of
    unparsable ones and the lineage columns), only the files that arrived since
    the last run."""
    return _refresh(spark, raw_dir, dataset, out_path, checkpoint, available_now,
                    max_files_per_trigger, lambda rows: rows)


def refresh_silver_from_bronze(spark: SparkSession, bronze_path: str, dataset: str, out_path: str,
                               checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Bronze parquet folder (as written by :func:`refresh_bronze`) -> silver,
    reading only the bronze partitions written since the last run; the two steps
    chain into an incremental bronze -> silver pipeline. A silver partition
    replaces the one of its bronze partition, so that one written again after
    a failure is taken once."""
    def handle(names: DataFrame, number: int) -> None:
        batches = [r[BATCH] for r in names.select(BATCH).distinct().collect()]
        if not batches:
            return
        rows = names.sparkSession.read.parquet(bronze_path).where(F.col(BATCH).isin(batches))
        clean = silver.DATASETS[dataset]
        for b in batches:
            clean(rows.where(F.col(BATCH) == b).drop(BATCH)).write.mode("overwrite") \
                .parquet(f"{out_path.rstrip('/')}/{BATCH}={b}")

    return _start(new_files(spark, bronze_path, partitioned=True), handle, checkpoint, available_now)
