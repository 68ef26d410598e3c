"""Bulk weather files: header-less, gzipped CSV, one or more files per station."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.scratch import remove_folder
from stationlake.values import Frequency

_IN_FOLDER = r"/station=([^/]+)/[^/]+$"
_IN_FILE_NAME = r"/([^/]+?)\.csv(\.gz)?$"

# Holds a line with too few or too many fields, or with text in place of a number.
REJECTED = "_rejected"
#: Fixed value: how a gzip member begins.
GZIP = b"\x1f\x8b"
#: Signs that Spark does not leave in the name of a partition's folder.
UNSAFE = "\"#%'*/:=?\\\x7f{[]^"
#: Files that a Python worker holds at a time, and bytes of one that are unpacked at a time.
FAULT_FILES, FAULT_BYTES = 16, 1 << 20
#: Tasks for each core that look at the paths of a reader.
LISTING_TASKS = 4


def station_of_path(path: Column) -> Column:
    """Station id of a file ``{station}.csv.gz`` or ``station={station}/part-*.csv.gz``."""
    folder = F.regexp_extract(path, _IN_FOLDER, 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(path, _IN_FILE_NAME, 1))


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """``station, path, modified`` of every file in a landing folder, without opening any.

    A folder that is not there has no files.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv*")
    )
    try:
        files = reader.load(landing)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return schemas.empty(spark, {"station": "string", "path": "string", "modified": "timestamp"})
    return files.select(
        station_of_path(F.col("path")).alias("station"), "path", F.col("modificationTime").alias("modified")
    )


def fault_of_gzip(content: bytes) -> str | None:
    """Why a gzip stream of one or more members can't be read to its end; null if it can."""
    at = 0
    while at < len(content):
        if content[at : at + 2] != GZIP:
            return "no gzip stream"
        stream = zlib.decompressobj(wbits=31)
        try:
            while at < len(content) and not stream.eof:
                part = content[at : at + FAULT_BYTES]
                stream.decompress(part)
                at += len(part) - len(stream.unused_data)
        except zlib.error:
            return "a damaged gzip stream"
        if not stream.eof:
            return "a gzip stream that ends early"
    return None


@contextmanager
def _setting(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few_files_at_a_time(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs begun inside hand :data:`FAULT_FILES` rows at a time to Python."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", FAULT_FILES)


def many_paths_at_a_time(spark: SparkSession) -> AbstractContextManager[None]:
    """Readers made inside look at their paths in a few tasks for each core; else Spark takes a task for each of up to 10,000."""
    tasks = LISTING_TASKS * spark.sparkContext.defaultParallelism
    return _setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)


def broken_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``station, path, reason`` of gzipped files that can't be read to their end.

    Each file is read as a whole and unpacked piece by piece; write the result :func:`few_files_at_a_time`.
    """
    with many_paths_at_a_time(spark):
        files = spark.read.format("binaryFile").load(list(paths)).select("path", "content")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                path = batch.column("path")[row].as_py()
                reason = fault_of_gzip(batch.column("content")[row].as_py()) if path.endswith(".gz") else None
                if reason is not None:
                    yield pa.RecordBatch.from_pydict({"path": [path], "reason": [reason]})

    broken = files.mapInArrow(look, "path string, reason string")
    return broken.select(station_of_path(F.col("path")).alias("station"), "path", "reason")


def scan_raw(
    spark: SparkSession,
    frequency: Frequency,
    paths: str | Sequence[str],
    mode: str = "FAILFAST",
) -> DataFrame:
    """The files as they are, with a leading ``station``.

    A row with too few or too many fields fails the read; for that the parser has to see every
    field, so column pruning is off. Text in place of a number fails when its column is read.
    ``mode="PERMISSIVE"`` or ``"DROPMALFORMED"`` lets such rows through or drops them.
    """
    return _read(spark, schemas.FILE_COLUMNS[frequency], paths, mode)


def _read(
    spark: SparkSession, columns: schemas.Columns, paths: str | Sequence[str], mode: str
) -> DataFrame:
    reader = (
        spark.read.schema(schemas.ddl(columns))
        .option("header", "false")
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", REJECTED)
        .option("columnPruning", "false")
        .option("recursiveFileLookup", "true")
    )
    with many_paths_at_a_time(spark):
        rows = reader.csv(paths)
    return rows.select(
        station_of_path(F.col("_metadata.file_path")).alias("station"),
        *columns,
        *([F.col("_metadata.file_path").alias("path")] if REJECTED in columns else []),
    )


def typed(raw: DataFrame, frequency: Frequency) -> DataFrame:
    """Parse dates and turn integer-valued measures into integers.

    Text that is no date gives null. Fractions are cut off; NaN and values beyond the range
    of a bigint give null.
    """
    columns = {name: F.col(name).try_cast("bigint") for name in schemas.INTEGER_MEASURES[frequency]}
    if frequency in (Frequency.HOURLY, Frequency.DAILY):
        day = F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).cast("date")
    if frequency is Frequency.DAILY:
        columns["date"] = day
    if frequency is Frequency.HOURLY:
        columns["datetime"] = F.timestamp_add("HOUR", F.col("hour"), day.cast("timestamp_ntz"))
    return raw.withColumns(columns)


def scan(
    spark: SparkSession,
    frequency: Frequency,
    paths: str | Sequence[str],
    mode: str = "FAILFAST",
) -> DataFrame:
    """Typed rows of bulk files, in the columns of :func:`schemas.table_columns`."""
    return typed(scan_raw(spark, frequency, paths, mode), frequency)


def scan_checked(
    spark: SparkSession, frequency: Frequency, paths: str | Sequence[str]
) -> DataFrame:
    """As :func:`scan`, with the ``path`` and, for a line that does not fit, its text in ``_rejected``."""
    columns = schemas.FILE_COLUMNS[frequency] | {REJECTED: "string"}
    return typed(_read(spark, columns, paths, "PERMISSIVE"), frequency)


def _folder_text(station: str | None) -> str:
    """A station as part of a path, written as Spark writes the value of a partition."""
    if not station:
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if c < " " or c in UNSAFE else c for c in station)


def _file_of(station: str | None) -> str:
    name = _folder_text(station)
    # Readers pass over files whose name begins with one of these signs.
    return f"station={name}/rows.csv.gz" if name[0] in "._" else f"{name}.csv.gz"


def write_files(rows: DataFrame, frequency: Frequency, landing: str) -> None:
    """Write a typed table back as bulk files, below a folder for each task.

    Lines are made by Spark; a task only packs those of a station, which come one after the other, into its file, so that
    a file costs little more than its bytes. The driver moves the folders of tasks that ended, not files. The rebalance
    splits a station that holds much of the data over several tasks. The folder has to be one that ``pyarrow.fs`` knows.
    """
    spark, names = rows.sparkSession, schemas.FILE_COLUMNS[frequency]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(landing)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(folder):
        raise FileExistsError(landing)
    files.mkdirs(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = uuid.uuid4().hex
        system, root = fs.FileSystem.from_uri(f"{landing}/_attempts/{attempt}")
        system.create_dir(root)
        at, out, packer = None, None, None

        def close() -> None:
            if out is not None:
                out.write(packer.flush())
                out.close()

        for batch in batches:
            lines = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for station, some in groupby(lines, itemgetter(0)):
                if out is None or station != at:
                    close()
                    path = f"{root}/{_file_of(station)}"
                    if path.count("/") > root.count("/") + 1:
                        system.create_dir(path.rpartition("/")[0])
                    at, out, packer = station, system.open_output_stream(path, compression=None), zlib.compressobj(wbits=31)
                out.write(packer.compress("".join(f"{line}\n" for _, line in some).encode()))
        close()
        yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    lines = rows.select(F.col("station").cast("string").alias("station"), F.to_csv(F.struct(*names)).alias("line"))
    dealt = lines.hint("rebalance", "station").sortWithinPartitions("station")
    for part, row in enumerate(dealt.mapInArrow(write, "attempt string").collect()):  # one row per task
        files.rename(hadoop.Path(f"{landing}/_attempts/{row.attempt}"), hadoop.Path(f"{landing}/part={part}"))
    remove_folder(spark, f"{landing}/_attempts")
