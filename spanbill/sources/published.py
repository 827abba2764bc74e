"""Result tables that are published as a whole.

A write goes to a folder of its own. Only when it is complete does an empty marker file with the version's name
appear, and the largest marker is the table. A marker carries nothing but its name, so it appears at once on any store, and a
write that dies on the way leaves the old version in place. A DataFrame read from a version is pinned: later
versions have other folders. ``prune`` removes old versions and what died.

    table/data/<version>/...      the rows
    table/files/<version>/...     first row number of each file, for sorted tables
    table/versions/<version>      the markers
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

FILE, PLACE, NUMBER = "file_no", "place_no", "row_no"
_PLACE_BITS = 33  # of monotonically_increasing_id: the row within its partition


class Store:
    """The few file operations that publication needs, on whatever store Spark writes to."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.conf), place

    def names(self, path: str) -> list[str]:
        fs, place = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def mark(self, path: str) -> None:
        fs, place = self._at(path)
        if not fs.createNewFile(place):
            raise FileExistsError(path)

    def remove(self, path: str) -> None:
        fs, place = self._at(path)
        fs.delete(place, True)


class Published:
    """One table under a root folder."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.path, self.store = spark, f"{root}/{name}", Store(spark)

    def versions(self) -> list[str]:
        return self.store.names(f"{self.path}/versions")

    def version(self) -> str | None:
        """The version that readers get; None before the first one."""
        known = self.versions()
        return known[-1] if known else None

    def replace(self, df: DataFrame, order: list[str] | None = None) -> str:
        """Write ``df`` as the next version; it may read the table's current one.

        With ``order`` the rows are range partitioned on those columns by bounds that Spark samples, and sorted within each
        file, so files follow one another in that order and no task sorts more than its range. A column that ends in
        ``desc`` sorts downwards. NULL comes first upwards and last downwards.
        """
        number = int(self.version().split("-")[0]) + 1 if self.versions() else 1
        version = f"{number:012d}-{uuid.uuid4().hex[:12]}"
        data = f"{self.path}/data/{version}"
        if order is None:
            df.write.parquet(data)
        else:
            keys = [F.col(c.split()[0]).desc() if c.endswith(" desc") else F.col(c).asc() for c in order]
            place = F.monotonically_increasing_id()
            parts = {FILE: F.shiftright(place, _PLACE_BITS), PLACE: place.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))}
            df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns(parts).write.parquet(data)
            counts = self.spark.read.parquet(data).groupBy(FILE).count().collect()  # one row for each file
            starts, at = [], 0
            for file, count in sorted(map(tuple, counts)):
                starts.append((file, at))
                at += count
            self.spark.createDataFrame(starts, f"{FILE} long, first_row long").coalesce(1).write.parquet(f"{self.path}/files/{version}")
        self.store.mark(f"{self.path}/versions/{version}")
        return version

    def folder(self, version: str | None = None) -> str:
        version = version or self.version()
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version")
        return f"{self.path}/data/{version}"

    def read(self, version: str | None = None) -> DataFrame:
        """The rows of a version, the current one by default."""
        return self.spark.read.parquet(self.folder(version))

    def _starts(self, version: str) -> DataFrame:
        return self.spark.read.schema(f"{FILE} long, first_row long").parquet(f"{self.path}/files/{version}")

    def numbered(self, version: str | None = None) -> DataFrame:
        """The rows of a sorted version with ``row_no``, from 1; one small join on the file, no sort."""
        version = version or self.version()
        rows = self.read(version).join(F.broadcast(self._starts(version)), FILE)  # one row for each file
        return rows.withColumn(NUMBER, F.col("first_row") + F.col(PLACE) + 1).drop(FILE, PLACE, "first_row")

    def in_order(self, version: str | None = None) -> Iterator[Row]:
        """The rows of a sorted version one after another; the driver holds a part of one file at a time."""
        version = version or self.version()
        rows = self.read(version)
        for (file,) in sorted(map(tuple, self._starts(version).select(FILE).collect())):
            yield from rows.filter(F.col(FILE) == file).sort(PLACE).drop(FILE, PLACE).toLocalIterator()

    def prune(self, keep: int = 1) -> None:
        """Remove all but the last versions, and folders that never got a marker (no writer may be at work)."""
        known = self.versions()
        last = set(known[len(known) - keep :])
        for name in known:
            if name not in last:
                self.store.remove(f"{self.path}/versions/{name}")
        for part in ("data", "files"):
            for name in self.store.names(f"{self.path}/{part}"):
                if name not in last:
                    self.store.remove(f"{self.path}/{part}/{name}")


class Runs:
    """A table that grows by runs: each run is published whole, and the same run again takes its own place.

    So a run that is repeated, after a failure or by mistake, adds no row twice.
    """

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.path, self.store = spark, f"{root}/{name}", Store(spark)

    def run(self, run_id: int | str) -> Published:
        return Published(self.spark, self.path, f"run={run_id}")

    def append(self, df: DataFrame, run_id: int | str, order: list[str] | None = None) -> str:
        return self.run(run_id).replace(df, order)

    def ids(self) -> list[str]:
        """Runs that are complete."""
        found = [n.removeprefix("run=") for n in self.store.names(self.path) if n.startswith("run=")]
        return [n for n in found if self.run(n).version()]

    def read(self, run_ids: list | None = None) -> DataFrame:
        """Rows of some runs, or of all; one scan over the current versions."""
        wanted = [str(r) for r in (self.ids() if run_ids is None else run_ids)]
        return self.spark.read.parquet(*[self.run(r).folder() for r in wanted]).drop(FILE, PLACE)
