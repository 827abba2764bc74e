"""Cutting lineage where a derived table is read more than once."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Rows of a stage's file where their number is known beforehand.
FILE_ROWS = 50_000


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a temporary folder, which goes
    with the process.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="spanbill-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


class Stages:
    """The stages of one job.

    Within a job equal plans share one stage, and a stage is not written again; ``readers`` counts how often each
    was asked for. ``remove`` deletes all of them, once nothing that reads them runs any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{ensure_checkpoint_dir(spark)}/job-{uuid.uuid4().hex}"
        self.known: dict[tuple, list[tuple[DataFrame, str, DataFrame]]] = defaultdict(list)
        self.readers: Counter[str] = Counter()
        self.tables: list[str] = []

    def settle(self, df: DataFrame, by: str | None = None) -> DataFrame:
        if by is None and any(stage is df for found in self.known.values() for _, _, stage in found):
            return df
        same = self.known[df.semanticHash(), by]
        for plan, name, stage in same:
            if plan.sameSemantics(df) and plan.columns == df.columns:
                self.readers[name] += 1
                return stage
        name = f"stage_{uuid.uuid4().hex}"
        if by is None:
            stage = _written(df, f"{self.folder}/{name}")
        else:
            self.tables.append(name)
            stage = _bucketed(df, f"{self.folder}/{name}", name, by)
        self.readers[name] += 1
        same.append((df, name, stage))
        return stage

    def remove(self) -> None:
        """Delete the job's stages."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.known.clear()
        self.tables.clear()


_JOB: ContextVar[Stages | None] = ContextVar("spanbill_job", default=None)


@contextmanager
def planning(stages: Stages) -> Iterator[Stages]:
    """Stages written inside belong to this job; they stay until ``remove``, since the frames made here still read them."""
    token = _JOB.set(stages)
    try:
        yield stages
    finally:
        _JOB.reset(token)


@contextmanager
def job(spark: SparkSession) -> Iterator[Stages]:
    """A job from planning to its last action: its stages are shared inside and gone at the end."""
    with planning(Stages(spark)) as stages:
        try:
            yield stages
        finally:
            stages.remove()


def finish(df: DataFrame) -> None:
    """Remove the stages of a query's result (see ``catalog.queries``) after its last action."""
    stages = getattr(df, "stages", None)
    if stages is not None:
        stages.remove()


def settle(df: DataFrame) -> DataFrame:
    """Write a stage to the checkpoint folder and continue from the files.

    Used where several branches read the same shuffled stage: the branches
    then share one computation, and a lost executor costs a re-read instead of
    a re-run. The stage is a parquet table, so each branch reads only the
    columns and rows it needs and its size is known to the planner.
    """
    stages = _JOB.get()
    if stages is not None:
        return stages.settle(df)
    return _written(df, f"{ensure_checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}")


def settle_few(df: DataFrame, rows: int, each: int = FILE_ROWS) -> DataFrame:
    """As ``settle``, for a stage of at most so many rows: one file for each core, or for `each` rows where that is more.

    A small stage would else be as many files as there are shuffle partitions, and each file costs the executor
    several calls to the store. Without a shuffle; a stage of fewer partitions stays as it is.
    """
    return settle(df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each))))


def settle_by(df: DataFrame, key: str) -> DataFrame:
    """As ``settle``, bucketed and sorted by a key: later joins, groups and windows on that key need no exchange.

    Two stages of a session have the same number of buckets, that of its shuffle
    partitions, and so meet bucket by bucket.
    """
    stages = _JOB.get()
    if stages is not None:
        return stages.settle(df, key)
    name = f"stage_{uuid.uuid4().hex}"
    return _bucketed(df, f"{ensure_checkpoint_dir(df.sparkSession)}/{name}", name, key)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucketed(df: DataFrame, path: str, name: str, key: str) -> DataFrame:
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(buckets, key)
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)
