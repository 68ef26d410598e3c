"""The store: weather tables as a log of commits, the catalogue, and what was left out.

A commit holds all rows of the stations it writes, below ``{frequency}/commit=…/bucket=…/year_part=…``, and its part of the
status log: which station was written on which day, or dropped. Nothing is ever changed in place. A commit counts once
its one row stands in the manifest, ``commits``; what a lost job has left is never read. Of two commits that
write one station the later wins, for the whole station. Commits are ordered by a version, which is one more than the
greatest one seen, and by their id: writers that run at the same time need no lock and come in an order that all
readers agree on.

Reading merges: the folders of live commits are read, less the stations that a later commit has written or dropped. If no commit
did, which the manifest knows, there is nothing to merge and no join. :meth:`Store.compact` writes what is live as
one commit, also into another number of buckets; :meth:`Store.vacuum` then removes the folders it stands for.

Rows are dealt by a hash bucket of the station and by year, so that a station, a time range, or both are some folders; in
a folder rows are sorted by month, station and time, so that row groups know their station and their time.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.functions.inventory import required_end_date
from stationlake.scratch import remove_folder, scratch_folder
from stationlake.sizing import broadcast_if_small
from stationlake.sources import bulk, catalogue
from stationlake.values import Frequency, NoSuchStore, UnreadableFile

DEFAULT_BUCKETS = 16


def stale_stations(needs: DataFrame, status: DataFrame, today: dt.date) -> DataFrame:
    """Stations of ``needs`` whose stored rows are too old for what is needed.

    ``needs`` holds ``station, frequency, end_date``: the last day a requirement asks for, null
    when any data will do. Nothing is stale for a day that is still to come; a station that was
    never written is stale; otherwise it is stale when the day lies after the day it was written.
    The last day alone decides, so needs are first reduced to one row per station.
    """
    due = F.when(F.col("end_date") <= F.lit(today), F.col("end_date"))
    latest = needs.groupBy("station", "frequency").agg(F.max(due).alias("end_date"))
    stored = status.groupBy("station", "frequency").agg(F.max("written_on").alias("written_on"))
    return (
        latest.filter(F.col("end_date").isNotNull())
        .join(stored, ["station", "frequency"], "left")
        .filter(F.col("written_on").isNull() | (F.col("end_date") > F.col("written_on")))
        .select("station", "frequency", "end_date", "written_on")
    )


def with_end_date(needs: DataFrame) -> DataFrame:
    """Add ``end_date`` to requirements given as columns ``kind, date, end, year``."""
    return needs.withColumn(
        "end_date",
        required_end_date(F.col("kind"), F.col("date"), F.col("end"), F.col("year")),
    )


class Commit(NamedTuple):
    """A row of the manifest."""

    commit: str
    frequency: str
    #: ``append`` of stations not stored before, ``refresh``, ``drop``, ``clear`` of everything, or ``compact``.
    kind: str
    version: int
    #: The greatest version that the writer had seen when it decided what to write.
    base: int
    buckets: int
    #: Commits that this one stands for.
    replaces: list[str]

    @property
    def order(self) -> tuple[int, bool, str]:
        """A compaction comes where the last commit it replaces stood, before others of that version."""
        return self.version, self.kind != "compact", self.commit

    @property
    def has_rows(self) -> bool:
        return self.kind not in ("drop", "clear")


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """Open the store below ``root``; with ``buckets``, lay out a new one if there is none.

        The number of buckets is kept with the data and changed by :meth:`compact` only; for an existing
        store the argument is ignored. Choose it so that a bucket of a year is a file of 128 MB or more.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        row = self._read(f"{self.root}/layout", {"buckets": "int"}).first()
        if row is None:
            if buckets is None:
                raise NoSuchStore(self.root)
            spark.range(1).select(F.lit(buckets).cast("int").alias("buckets")).write.mode(
                "overwrite"
            ).parquet(f"{self.root}/layout")
        self.buckets = buckets if row is None else row.buckets
        for commit in sorted(self._commits(), key=lambda c: c.order):
            if commit.kind == "compact":
                self.buckets = commit.buckets

    # -- layout

    def path(self, frequency: Frequency) -> str:
        return f"{self.root}/{frequency.value}"

    def bucket_of(self, station: Column) -> Column:
        return F.pmod(F.xxhash64(station), F.lit(self.buckets)).cast("int")

    def _read(self, path: str | list[str], columns: schemas.Columns, base: str | None = None) -> DataFrame:
        """A table, or an empty one when nothing was written yet."""
        reader = self.spark.read.schema(schemas.ddl(columns))
        if base is not None:
            reader = reader.option("basePath", base)
        try:
            return reader.parquet(path) if isinstance(path, str) else reader.parquet(*path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._nothing(columns)

    def _nothing(self, columns: schemas.Columns) -> DataFrame:
        return schemas.empty(self.spark, columns)

    # -- the manifest

    def _manifest(self) -> DataFrame:
        return self._read(f"{self.root}/commits", schemas.COMMITS)

    def _commits(self, frequency: Frequency | None = None) -> list[Commit]:
        """The manifest; one row per write, of which vacuum leaves those that are live."""
        rows = self._manifest()
        if frequency is not None:
            rows = rows.filter(F.col("frequency") == frequency.value)
        return [Commit(**row.asDict()) for row in rows.select(*Commit._fields).collect()]

    def live(self, frequency: Frequency) -> list[Commit]:
        """Commits that no other stands for, in order."""
        commits = self._commits(frequency)
        replaced = {name for commit in commits for name in commit.replaces}
        return sorted((c for c in commits if c.commit not in replaced), key=lambda c: c.order)

    @staticmethod
    def _overlap(live: Sequence[Commit]) -> bool:
        """Whether a station may be in more than one commit."""
        stored = [c for c in live if c.kind != "clear"]
        for i, commit in enumerate(stored):
            # An append left out what was stored; it can't have known commits made at the same time.
            if i and (commit.kind in ("refresh", "drop") or any(c.version > commit.base for c in stored[:i])):
                return True
        return False

    def _publish(
        self, commit: str, frequency: Frequency, kind: str, base: int, version: int | None = None, replaces: Sequence[str] = ()
    ) -> None:
        """Make a commit count: one row in one file of a folder of its own."""
        if version is None:
            version = 1 + max((c.version for c in self._commits(frequency)), default=0)
        row = Commit(commit, frequency.value, kind, version, base, self.buckets, list(replaces))
        values = [
            F.array(*map(F.lit, row.replaces)).cast("array<string>") if name == "replaces" else F.lit(getattr(row, name))
            for name in schemas.COMMITS
            if name != "commit"
        ]
        names = [name for name in schemas.COMMITS if name != "commit"]
        (
            self.spark.range(1, numPartitions=1)
            .select(*(v.cast(schemas.COMMITS[n]).alias(n) for n, v in zip(names, values, strict=True)))
            .write.parquet(f"{self.root}/commits/commit={commit}")
        )

    @staticmethod
    def _base(live: Sequence[Commit]) -> int:
        return max((c.version for c in live), default=0)

    # -- reading

    def _log(self, frequency: Frequency, live: Sequence[Commit]) -> DataFrame:
        """station, written_on, commit of the live commits' part of the status log."""
        folder = f"{self.root}/log/frequency={frequency.value}"
        paths = [f"{folder}/commit={c.commit}" for c in live if c.kind != "clear"]
        return self._read(paths, schemas.STATUS_LOG, folder) if paths else self._nothing(schemas.STATUS_LOG)

    def _latest(self, frequency: Frequency, live: Sequence[Commit]) -> DataFrame:
        """station, written_on, commit: the last word on every station, also that it was dropped."""
        log = self._log(frequency, live)
        if not self._overlap(live):
            return log
        return self._ranked(log, live).groupBy("station").agg(
            F.max_by(F.struct("written_on", "commit"), "place").alias("last")
        ).select("station", "last.*")

    @staticmethod
    def _ranked(log: DataFrame, live: Sequence[Commit]) -> DataFrame:
        """The log with the place of its commit among the live ones."""
        names = F.array(*(F.lit(c.commit) for c in live))
        return log.withColumn("place", F.array_position(names, F.col("commit")))

    def scan(self, frequency: Frequency) -> DataFrame:
        """All rows of a frequency, lazily, with ``bucket`` and ``year_part`` last: see schemas.LAYOUT."""
        live = self.live(frequency)
        columns = schemas.table_columns(frequency)
        stored = columns | schemas.LAYOUT | {"commit": "string"}
        parts = []
        for buckets in sorted({c.buckets for c in live if c.has_rows}):
            paths = [f"{self.path(frequency)}/commit={c.commit}" for c in live if c.has_rows and c.buckets == buckets]
            part = self._read(paths, stored, self.path(frequency))
            if buckets != self.buckets:  # written while a compaction dealt the rows anew
                part = part.withColumn("bucket", self.bucket_of(F.col("station")))
            parts.append(part)
        if not parts:
            return self._nothing(columns | schemas.LAYOUT)
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        if self._overlap(live):
            ranked = self._ranked(self._log(frequency, live), live)
            last = ranked.groupBy("station").agg(F.max("place").alias("last"))
            old = ranked.join(last, "station").filter("place < last").select("station", "commit")
            rows = rows.join(broadcast_if_small(old), ["station", "commit"], "left_anti")
        return rows.select(*columns, *schemas.LAYOUT)

    def scan_station(self, frequency: Frequency, station: str) -> DataFrame:
        """Rows of one station: the folders of one bucket, and a pushed equality inside them."""
        return self.scan_station_layout(frequency, station).drop(*schemas.LAYOUT)

    def scan_station_layout(self, frequency: Frequency, station: str) -> DataFrame:
        """As :meth:`scan_station`, with the columns of the layout."""
        wanted = (F.col("station") == station) & (F.col("bucket") == self.bucket_of(F.lit(station)))
        return self.scan(frequency).filter(wanted)

    def scan_stations(self, frequency: Frequency, stations: DataFrame) -> DataFrame:
        """Rows of every station in ``stations``; the bucket lets Spark prune at run time."""
        return self.only_stations(self.scan(frequency), stations).drop(*schemas.LAYOUT)

    def only_stations(self, rows: DataFrame, stations: DataFrame) -> DataFrame:
        """Rows of a scan whose station is listed in column ``station`` of another table."""
        wanted = self._in_buckets(stations).distinct()
        return rows.join(broadcast_if_small(wanted), ["bucket", "station"], "left_semi")

    def status(self) -> DataFrame:
        """``station, frequency, written_on`` of everything stored: the last word of the log."""
        parts = [
            self._latest(frequency, self.live(frequency))
            .filter(F.col("written_on").isNotNull())
            .select("station", F.lit(frequency.value).alias("frequency"), "written_on")
            for frequency in Frequency
        ]
        status = parts[0]
        for part in parts[1:]:
            status = status.unionByName(part)
        return status

    def available(self, frequency: Frequency) -> DataFrame:
        """Stations that have rows of a frequency, from the status log alone."""
        latest = self._latest(frequency, self.live(frequency))
        return latest.filter(F.col("written_on").isNotNull()).select("station")

    def stations(self) -> DataFrame:
        """The catalogue."""
        return self._read(f"{self.root}/stations", schemas.CATALOGUE)

    # -- writing

    def _in_buckets(self, stations: DataFrame) -> DataFrame:
        """Stations with their bucket.

        The comparison is always true; it makes Spark see that a list of stations may narrow the
        buckets, so that a join with it prunes folders.
        """
        bucket = self.bucket_of(F.col("station")).alias("bucket")
        return stations.select("station", bucket).filter("bucket >= 0")

    def _write_rows(self, rows: DataFrame, frequency: Frequency, commit: str) -> DataFrame:
        """Write the rows of a commit, which does not count yet, and read them back.

        The rebalance sends a bucket of a year to few tasks, and adaptive execution splits those that
        are much larger than the others, such as that of a station with a large share of all rows.
        """
        folder = f"{self.path(frequency)}/commit={commit}"
        month = schemas.month_of(frequency)
        (
            rows.select(*schemas.table_columns(frequency))
            .withColumns({"bucket": self.bucket_of(F.col("station")), "year_part": schemas.year_part(frequency)})
            .hint("rebalance", "bucket", "year_part")
            .sortWithinPartitions("bucket", "year_part", *month, "station", *schemas.TIME_COLUMNS[frequency])
            .write.partitionBy(*schemas.LAYOUT)
            .option("compression", "snappy")
            .parquet(folder)
        )
        return self._read(folder, schemas.table_columns(frequency) | schemas.LAYOUT)

    def _write_log(self, log: DataFrame, frequency: Frequency, commit: str) -> None:
        """Write a commit's part of the status log: ``station`` and ``written_on``, null for a dropped one."""
        log.select("station", F.col("written_on").cast("date").alias("written_on")).hint("rebalance").write.parquet(
            f"{self.root}/log/frequency={frequency.value}/commit={commit}"
        )

    def _commit(
        self, rows: DataFrame, frequency: Frequency, written_on: dt.date, kind: str, live: Sequence[Commit]
    ) -> None:
        """Write rows, all rows of their stations, as one commit; without rows there is none."""
        commit = uuid.uuid4().hex
        stored = self._write_rows(rows, frequency, commit)
        stations = stored.groupBy("station").agg(F.lit(written_on).alias("written_on"))
        if stored.isEmpty():
            return
        self._write_log(stations, frequency, commit)
        self._publish(commit, frequency, kind, self._base(live))

    def stage(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows written once to the shared folder, so that later steps do not compute them again."""
        return self._written(rows, scratch_folder(self.spark, name))

    def _written(self, rows: DataFrame, folder: str) -> DataFrame:
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def append(self, rows: DataFrame, frequency: Frequency, written_on: dt.date) -> None:
        """Add typed rows of stations that are not stored yet; stored stations stay as they are."""
        live = self.live(frequency)
        stored = self._latest(frequency, live).filter(F.col("written_on").isNotNull()).select("station")
        fresh = rows.join(broadcast_if_small(stored), "station", "left_anti") if live else rows
        # A station that was dropped is in the log: its rows come after that.
        kind = "refresh" if any(c.kind == "drop" for c in live) else "append"
        self._commit(fresh, frequency, written_on, kind, live)

    def _paths(self, files: DataFrame) -> list[str]:
        """Paths for the reader: one text per file, which Spark's own file listing holds too."""
        return [row.path for row in files.select("path").collect()]

    def _rejected(self, rejects: DataFrame, frequency: Frequency, files: DataFrame, seen_on: dt.date) -> None:
        """Put down rejected stations (station, path, line, lines, reason), with the time their file was changed."""
        (
            rejects.join(files.select("path", "modified"), "path", "left")
            .withColumns({"frequency": F.lit(frequency.value), "seen_on": F.lit(seen_on)})
            .select(*schemas.REJECTS)
            .write.mode("append")
            .parquet(f"{self.root}/rejects")
        )

    def _parse(
        self, files: DataFrame, frequency: Frequency, seen_on: dt.date, strict: bool
    ) -> tuple[DataFrame | None, list[str]]:
        """Typed rows of landed files, parsed once and staged, and the folders to remove when they are done with.

        A station with a line that does not fit, or with a file that is no gzip or ends early, gives no rows;
        it is put down in the rejects. With ``strict`` it raises an error instead. The files are only looked at
        one by one when reading them all has failed.
        """
        folders: list[str] = []

        def staged(rows: DataFrame, name: str) -> DataFrame:
            folders.append(scratch_folder(self.spark, name))
            return self._written(rows, folders[-1])

        def refuse(rejects: DataFrame) -> None:
            if strict:
                first = rejects.orderBy("path").first()
                raise UnreadableFile(first.station, first.path, first.reason)
            self._rejected(rejects, frequency, files, seen_on)

        try:
            # The files of a landing folder are looked at for each use else, and joined with what is stored.
            files = staged(files, "files")
            paths = self._paths(files)
            if not paths:
                return None, folders
            try:
                landed = staged(bulk.scan_checked(self.spark, frequency, paths), "landed")
            except (PySparkException, Py4JError):
                with bulk.few_files_at_a_time(self.spark):
                    broken = staged(bulk.broken_files(self.spark, paths), "broken")
                if broken.isEmpty():
                    raise
                nothing = {"line": F.lit(None).cast("string"), "lines": F.lit(0)}
                refuse(broken.withColumns(nothing))
                bad = broken.select("station").distinct()
                paths = self._paths(files.join(broadcast_if_small(bad), "station", "left_anti"))
                if not paths:
                    return None, folders
                landed = staged(bulk.scan_checked(self.spark, frequency, paths), "landed")
            line = F.col(bulk.REJECTED)
            rejects = staged(
                landed.filter(line.isNotNull())
                .groupBy("station")
                .agg(F.min(F.struct("path", line.alias("line"))).alias("first"), F.count("*").alias("lines"))
                .select("station", "first.path", "first.line", "lines", F.lit("a line does not fit").alias("reason")),
                "rejects",
            )
            rows = landed.drop("path", bulk.REJECTED)
            if rejects.isEmpty():
                return rows, folders
            refuse(rejects)
            return rows.join(broadcast_if_small(rejects.select("station")), "station", "left_anti"), folders
        except BaseException:
            self._remove(folders)
            raise

    def _remove(self, folders: Sequence[str]) -> None:
        for folder in folders:
            remove_folder(self.spark, folder)

    def rejects(self) -> DataFrame:
        """Stations left out by ``ingest`` or ``refresh``: file, reason, first line that does not fit, how many.

        One row for each version of a file that was met.
        """
        return self._read(f"{self.root}/rejects", schemas.REJECTS)

    def _unknown(self, files: DataFrame, frequency: Frequency) -> DataFrame:
        """Files that were not rejected before as they are now."""
        known = self.rejects().filter(F.col("frequency") == frequency.value).select("path", "modified").distinct()
        return files.join(broadcast_if_small(known), ["path", "modified"], "left_anti")

    def ingest(
        self,
        landing: str,
        frequency: Frequency,
        written_on: dt.date,
        only: DataFrame | None = None,
        strict: bool = False,
    ) -> None:
        """Add the landed files of stations that are not stored yet; other files stay closed.

        ``only`` restricts this to the stations it lists. A station with a malformed line or a broken file stays
        out and is listed in :meth:`rejects`, and is not read again until its file changes; with
        ``strict`` it fails the job.
        """
        live = self.live(frequency)
        files = bulk.landed_files(self.spark, landing)
        if only is not None:
            files = files.join(only.select("station"), "station", "left_semi")
        missing = files.join(self.available(frequency), "station", "left_anti")
        if not strict:
            missing = self._unknown(missing, frequency)
        rows, folders = self._parse(missing, frequency, written_on, strict)
        try:
            if rows is not None:
                kind = "refresh" if any(c.kind == "drop" for c in live) else "append"
                self._commit(rows, frequency, written_on, kind, live)
        finally:
            self._remove(folders)

    def refresh(
        self,
        landing: str,
        frequency: Frequency,
        needs: DataFrame,
        today: dt.date,
        strict: bool = False,
    ) -> None:
        """Read the files of stale stations again; their rows count instead of the old ones. See stale_stations.

        Rows of other stations are neither read nor written. A station whose landed file is missing, empty,
        malformed or broken keeps its rows and stays stale.
        """
        live = self.live(frequency)
        stale = stale_stations(
            needs.filter(F.col("frequency") == frequency.value), self.status(), today
        )
        files = bulk.landed_files(self.spark, landing).join(stale, "station", "left_semi")
        if not strict:
            files = self._unknown(files, frequency)
        rows, folders = self._parse(files, frequency, today, strict)
        try:
            if rows is not None:
                self._commit(rows, frequency, today, "refresh", live)
        finally:
            self._remove(folders)

    def drop_stations(self, frequency: Frequency, stations: DataFrame) -> None:
        """Forget all rows of some stations of a frequency, by a note in the log."""
        live = self.live(frequency)
        commit = uuid.uuid4().hex
        self._write_log(
            stations.select("station").distinct().withColumn("written_on", F.lit(None)), frequency, commit
        )
        self._publish(commit, frequency, "drop", self._base(live))

    def drop_station(self, frequency: Frequency, station: str) -> None:
        self.drop_stations(frequency, self.spark.range(1).select(F.lit(station).alias("station")))

    def drop_all(self) -> None:
        """Forget the weather rows of every frequency; the catalogue stays."""
        for frequency in Frequency:
            live = self.live(frequency)
            if live:
                self._publish(
                    uuid.uuid4().hex, frequency, "clear", self._base(live), replaces=[c.commit for c in live]
                )

    # -- upkeep

    def compact(self, frequency: Frequency, buckets: int | None = None) -> None:
        """Write everything live as one commit, in ``buckets`` buckets if given.

        Commits made meanwhile stay and come after it. With a single commit in as many buckets there is nothing to do.
        Other frequencies keep their buckets until they are compacted as well; they are read all the same.
        """
        live = self.live(frequency)
        same = buckets is None or buckets == self.buckets
        if not live or (len(live) == 1 and same and live[0].buckets == self.buckets):
            return
        rows = self.scan(frequency)
        log = self._latest(frequency, live).filter(F.col("written_on").isNotNull()).select("station", "written_on")
        self.buckets = self.buckets if buckets is None else buckets
        commit = uuid.uuid4().hex
        self._write_rows(rows, frequency, commit)
        self._write_log(log, frequency, commit)
        self._publish(
            commit, frequency, "compact", self._base(live), self._base(live), [c.commit for c in live]
        )

    def vacuum(self, frequency: Frequency) -> list[str]:
        """Remove the folders of commits that another stands for; returns their names.

        Readers that began before the compaction must be done. Folders of commits that do not count may belong to writers
        at work and stay.
        """
        live = {c.commit for c in self.live(frequency)}
        gone = sorted({c.commit for c in self._commits(frequency)} - live)
        for commit in gone:
            self._remove(
                [
                    f"{self.path(frequency)}/commit={commit}",
                    f"{self.root}/log/frequency={frequency.value}/commit={commit}",
                    f"{self.root}/commits/commit={commit}",
                ]
            )
        return gone

    # -- catalogue

    def rebuild_catalogue(self, source: str) -> None:
        """Replace the catalogue table by what the JSON files below ``source`` say."""
        self.save_catalogue(catalogue.scan_catalogue(self.spark, source))

    def save_catalogue(self, stations: DataFrame) -> None:
        stations.select(*schemas.CATALOGUE).write.mode("overwrite").parquet(
            f"{self.root}/stations"
        )

    def clear_catalogue(self) -> None:
        self.save_catalogue(self._nothing(schemas.CATALOGUE))
