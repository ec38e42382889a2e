"""Versioned, date-partitioned Parquet archive.

Layout under the root:
    data/commit=<n>/date=<day>/*.parquet   rows written by commit n
    commits/<n>.json                       one short file per published commit

A commit becomes visible when its file appears in commits/, after all its data
is written. An overwrite or compact commit hides every earlier one. One writer
at a time is assumed.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from meterlake.functions.filters import date_range, optional_user
from meterlake.schemas import ARCHIVE_COLUMNS, ARCHIVE_RETENTION_HOURS

COMMIT = StructType([
    StructField("version", IntegerType()),
    StructField("mode", StringType()),
    StructField("committed_at", TimestampNTZType()),
    StructField("row_count", LongType()),
    StructField("schema_json", StringType()),
    StructField("readable_from", IntegerType()),
])



class Commit(NamedTuple):
    version: int
    mode: str
    committed_at: datetime
    row_count: int
    schema_json: str
    readable_from: int


ROWS_PER_FILE = 2_000_000
# Modes after which earlier commits are no longer part of the table.
BASE_MODES = ("overwrite", "compact")


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class VersionedTable:
    """A partitioned Parquet table whose commits can be read back by number."""

    def __init__(self, spark: SparkSession, root: str, partition_by: str | None = "date"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = partition_by
        self._seen: dict[str, Commit] = {}

    # -- commits -----------------------------------------------------------

    def _path(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def history(self) -> DataFrame:
        """One row per commit, oldest first."""
        return self.spark.createDataFrame(self._commits(), COMMIT)

    def _commits(self) -> list[Commit]:
        """The commits, oldest first. Each is one short file that never changes, so
        only files not seen before are read."""
        folder = f"{self.root}/commits"
        fs, path = self._path(folder)
        if not fs.exists(path):
            return []
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.endswith(".json") and name not in self._seen:
                stream = fs.open(status.getPath())
                try:
                    fields = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
                finally:
                    stream.close()
                fields["committed_at"] = datetime.fromisoformat(fields["committed_at"])
                self._seen[name] = Commit(**fields)
        return sorted(self._seen.values(), key=lambda c: c.version)

    def _publish(self, version, mode, rows, schema, readable_from) -> None:
        """Make a commit visible: its file is written aside and then renamed."""
        fields = dict(version=version, mode=mode, committed_at=_utc_now().isoformat(), row_count=rows,
                      schema_json=schema.json(), readable_from=readable_from)
        fs, final = self._path(f"{self.root}/commits/{version:010d}.json")
        _, aside = self._path(f"{self.root}/commits/{version:010d}.writing")
        if fs.exists(final):
            raise RuntimeError(f"version {version} was committed by another writer")
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps(fields).encode()))
        out.close()
        if not fs.rename(aside, final):
            raise RuntimeError(f"version {version} could not be committed")

    # -- write -------------------------------------------------------------

    def _merged(self, commits, schema: StructType) -> StructType:
        fields = {}
        for known in [StructType.fromJson(json.loads(c.schema_json)) for c in commits] + [schema]:
            for f in known:
                if f.name in fields and fields[f.name].dataType != f.dataType:
                    raise ValueError(
                        f"column {f.name} is {f.dataType.simpleString()}, "
                        f"the table has {fields[f.name].dataType.simpleString()}"
                    )
                fields.setdefault(f.name, StructField(f.name, f.dataType, True))
        return StructType(list(fields.values()))

    def write(self, df: DataFrame, mode: str = "append") -> int | None:
        """Write one commit and return its version; None when df has no rows.

        New columns are merged into the table schema. A commit folder that was
        never published (a job that died) is written over.
        """
        if mode not in ("append", *BASE_MODES):
            raise ValueError(f"unknown mode {mode}")
        commits = self._commits()
        schema = self._merged(commits, df.schema)
        version = commits[-1].version + 1 if commits else 0
        readable = commits[-1].readable_from if commits else 0
        if self.partition_by and mode != "compact":
            # One exchange into partitions of a target size: few files per day, and
            # adaptive execution splits a day that holds much of the data.
            df = df.hint("rebalance", F.col(self.partition_by))
        counted = Observation()
        writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(self.partition_by)
        writer.parquet(f"{self.root}/data/commit={version}")
        rows = counted.get["rows"]
        if rows == 0:
            return None
        self._publish(version, mode, rows, schema, readable)
        return version

    # -- read --------------------------------------------------------------

    def _visible(self, version: int | None) -> list:
        commits = self._commits()
        if version is None:
            chosen = commits
        else:
            if version not in {c.version for c in commits}:
                raise ValueError(f"no version {version}")
            if version < commits[-1].readable_from:
                raise ValueError(f"version {version} is past its retention")
            chosen = [c for c in commits if c.version <= version]
        if not chosen:
            return []
        base = max((c.version for c in chosen if c.mode in BASE_MODES), default=0)
        return [c for c in chosen if c.version >= base]

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of the table, now or as of a version. Filters on the partition
        column prune folders; the schema comes from the commits, not from files."""
        visible = self._visible(version)
        if not visible:
            raise ValueError(f"nothing has been written to {self.root}")
        schema = self._merged(visible[:-1], StructType.fromJson(json.loads(visible[-1].schema_json)))
        paths = [f"{self.root}/data/commit={c.version}" for c in visible if c.mode != "expire"]
        df = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)
        return df.select(*[f.name for f in schema])

    def read_commit(self, version: int) -> DataFrame:
        """Only the rows that one commit wrote."""
        commit = next(c for c in self._commits() if c.version == version)
        schema = StructType.fromJson(json.loads(commit.schema_json))
        path = f"{self.root}/data/commit={version}"
        return self.spark.read.schema(schema).option("basePath", path).parquet(path)

    def row_count(self, version: int | None = None) -> int:
        return sum(c.row_count for c in self._visible(version) if c.mode != "expire")

    # -- upkeep ------------------------------------------------------------

    def compact(self, sort_by=("user_id",), rows_per_file: int = ROWS_PER_FILE) -> int | None:
        """Rewrite the current rows into few, sorted files.

        Ranges of (partition, sort columns) are cut by sampled size, so a day
        that holds a third of the rows is spread over as many tasks as it needs.
        """
        if not self._visible(None):
            return None
        files = max(1, -(-self.row_count() // rows_per_file))
        df = self.read()
        order = [c for c in (self.partition_by, *sort_by) if c and c in df.columns]
        if order:
            # A random last key lets one repeated key be cut as well.
            df = df.repartitionByRange(files, *order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)
        else:
            df = df.repartition(files)
        return self.write(df, "compact")

    def expire(self, now: datetime | None = None, retention_hours: int = ARCHIVE_RETENTION_HOURS) -> int:
        """Drop data that only versions older than the retention need.

        Returns the number of commit folders removed. The rows of the current
        version always stay.
        """
        commits = self._commits()
        if not commits:
            return 0
        limit = (now or _utc_now()) - timedelta(hours=retention_hours)
        # The newest version already current at the limit must stay readable.
        kept = max((c.version for c in commits if c.committed_at <= limit), default=None)
        if kept is None or kept <= commits[-1].readable_from:
            return 0
        base = max((c.version for c in commits if c.version <= kept and c.mode in BASE_MODES), default=0)
        schema = StructType.fromJson(json.loads(commits[-1].schema_json))
        self._publish(commits[-1].version + 1, "expire", 0, schema, kept)
        removed = 0
        for c in commits:
            if c.version < base:
                fs, path = self._path(f"{self.root}/data/commit={c.version}")
                removed += int(fs.delete(path, True))
        return removed


class Archive(VersionedTable):
    """Interaction archive: fixed columns, partitioned by date."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, "date")

    def write_interactions(self, df: DataFrame, mode: str = "append") -> int | None:
        """Columns of the archive first, then any new ones (metadata is not kept)."""
        extra = [c for c in df.columns if c not in ARCHIVE_COLUMNS and c != "metadata"]
        return self.write(df.select(*ARCHIVE_COLUMNS, *extra), mode)

    def read_interactions(self, start=None, end=None, user_id=None, limit: int | None = None) -> DataFrame:
        """Inclusive date range, optional user, optional unordered limit (0 = none)."""
        df = optional_user(date_range(self.read(), start, end), user_id)
        return df.limit(limit) if limit else df

    def time_travel(self, version: int) -> DataFrame:
        return self.read(version)

    def optimize(self, now: datetime | None = None, retention_hours: int = ARCHIVE_RETENTION_HOURS) -> int | None:
        version = self.compact(("user_id", "timestamp"))
        self.expire(now, retention_hours)
        return version
