"""File sources: CSV scans (inferred or explicit schema), lineage columns,
and the batch loader that moves a list of files into tables."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType


def csv_scan(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = True) -> DataFrame:
    """CSV with a header row. Without ``schema`` the types are inferred
    (an extra pass over the data, and e.g. a zip prefix ``01037`` becomes
    the integer 1037); prefer an explicit schema at scale."""
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", infer)
    return r.csv(path)


CORRUPT_RECORD = "_corrupt_record"
SOURCE_FILE, INGESTION_TIME = "_source_file", "_ingestion_time"


def _file_lineage() -> list:
    return [F.col("_metadata.file_path").alias(SOURCE_FILE),
            F.col("_metadata.file_modification_time").alias(INGESTION_TIME)]


def csv_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The data files under a path (or several), from the folder listing alone."""
    listed = spark.read.format("binaryFile").load(path).select("path").inputFiles()
    return sorted(unquote(f) for f in listed)


def _header_line(spark: SparkSession, file: str, encoding: str) -> str:
    """The header record of one file: its first line, or more of them while a
    quote is open. Only the beginning of the file is read."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    conf = spark._jsc.hadoopConfiguration()
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec else stream, encoding))
        line = reader.readLine()
        while line is not None and line.count('"') % 2:
            more = reader.readLine()
            if more is None:
                break
            line += "\n" + more
        return (line or "").lstrip("\ufeff")
    finally:
        stream.close()


def file_headers(spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8",
                 threads: int = 16) -> dict[tuple[str, ...], list[str]]:
    """Column names of each file's header row, and the files that have them.
    Reads one line a file, some files at a time; an empty file has no columns."""
    def names(file):
        return tuple(next(csv.reader(_header_line(spark, file, encoding).splitlines(True)), ()))

    out: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(threads) as pool:
        for file, header in zip(files, pool.map(names, files), strict=True):
            out.setdefault(header, []).append(file)
    return out


def bound_by_header(header: Sequence[str], schema: StructType) -> StructType:
    """``schema`` in the column order of a header row. Spark binds an explicit
    CSV schema by position; with this one each value meets the column of its
    name (case and surrounding blanks aside; the first of two of one name).
    Header columns that the schema lacks are read as strings, under names that
    it does not have."""
    named = {f.name.lower(): f for f in schema.fields}
    fields = []
    for k, name in enumerate(header):
        found = named.pop(name.strip().lower(), None)
        fields.append(found or StructField(f"__other_{k}", StringType()))
    return StructType(fields)


def csv_scan_permissive(spark: SparkSession, path: str | Sequence[str],
                        schema: StructType | str | None = None,
                        multiline: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """CSV read in PERMISSIVE mode, UTF-8. With a ``schema``, columns are bound
    by header name, file by file: the files of a folder may hold them in
    different orders, have columns that the schema lacks (left out) and lack
    some that it has (NULL). Files that share a header are one scan. A row with
    a field that does not parse, or with more or fewer fields than its file's
    header, keeps its raw text in ``_corrupt_record``. Empty files give no rows.
    ``multiline`` keeps quoted values with line breaks in one record; it makes
    each file one split, so it is only set for data sets that need it
    (reviews): write those as many files."""
    opts = {"encoding": encoding, "quote": '"', "escape": '"', "multiLine": multiline}
    r = spark.read.options(header=True, mode="PERMISSIVE", **opts)
    if schema is None:
        return r.option("inferSchema", True).csv(path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    groups = file_headers(spark, csv_files(spark, path), encoding)
    out = None
    for header, files in sorted(groups.items()):
        if not header:
            continue
        found = bound_by_header(header, schema)
        df = r.option("columnNameOfCorruptRecord", CORRUPT_RECORD) \
            .schema(StructType([*found.fields, StructField(CORRUPT_RECORD, StringType())])).csv(files)
        there = set(found.names)
        df = df.select(*[F.col(f.name) if f.name in there else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in schema.fields], CORRUPT_RECORD, *_file_lineage())
        out = df if out is None else out.unionByName(df)
    if out is None:
        fields = [*schema.fields, StructField(CORRUPT_RECORD, StringType()),
                  StructField(SOURCE_FILE, StringType()), StructField(INGESTION_TIME, TimestampType())]
        return spark.createDataFrame([], StructType(fields))
    return out


def lineage_columns(df: DataFrame) -> DataFrame:
    """``*`` plus ``_source_file`` (file path), ``_ingestion_time`` (the
    file's modification time) and ``_processed_at`` (load time), from the
    file source's hidden ``_metadata`` column, unless the scan took the first
    two along."""
    taken = (SOURCE_FILE, INGESTION_TIME)
    cells = [F.col(c) for c in taken] if set(taken) <= set(df.columns) else _file_lineage()
    return df.select(*[c for c in df.columns if c not in ("_metadata", *taken)], *cells,
                     F.current_timestamp().alias("_processed_at"))


def batch_load(spark: SparkSession, items: Iterable[tuple[str, str]],
               write: Callable[[DataFrame, str], None],
               read: Callable[[SparkSession, str], DataFrame] | None = None) -> list[str]:
    """Load each (file path, table name) pair: read the file (CSV with
    inferred schema by default) and hand it to ``write``. The loop only
    walks the list of files on the driver; each item is its own Spark job."""
    read = read or (lambda s, p: csv_scan(s, p))
    done = []
    for path, table in items:
        write(read(spark, path), table)
        done.append(table)
    return done
