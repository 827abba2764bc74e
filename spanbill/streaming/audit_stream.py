"""The change audit over a feed of updates, and a log that holds each change once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from spanbill.plans.audit import STAMPS, audit_rows
from spanbill.sources.published import Published, Runs


def audit_stream(
    feed: DataFrame,
    key: str,
    table: str,
    columns: list[str] | None = None,
    exclude=STAMPS,
    mode: str = "null_safe",
    changed_at: Column | None = None,
    changed_by: Column | str | None = None,
    ignore_case: bool = True,
    change_id: str | None = None,
) -> DataFrame:
    """Audit rows of a change feed whose rows carry ``old`` and ``new`` structs.

    Stateless, so it needs no watermark and runs in append mode. The result
    equals the batch audit over the same changes. ``change_id`` names a column of the feed that tells changes
    apart; it comes along for :class:`AuditLog`.
    """
    fields = feed.schema["new"].dataType.names
    names = [c for c in (columns or fields) if c not in exclude]
    return audit_rows(feed, key, table, names, mode, changed_at, changed_by, ignore_case, keep=[change_id] if change_id else [])


class AuditLog:
    """A log in which each change stands once, however often a stream is restarted.

    A micro-batch is filed as a run under its epoch and batch number, published whole: a batch that is delivered again, after a
    crash between filing it and noting the progress, takes its own place. The epoch belongs to the stream's progress folder. A
    stream that has lost that folder starts from the beginning of its feed with batches cut in another way, so it opens a new epoch, in
    which changes that earlier epochs have filed are left out: an anti join on the change's id and column. In the first
    epoch there is no join. The log is complete at any time, also during a replay.
    """

    def __init__(self, spark: SparkSession, root: str, change_id: str, name: str = "audit_log"):
        self.spark, self.change_id = spark, change_id
        self.batches = Runs(spark, root, name)
        self.epochs = Published(spark, root, f"{name}_epochs")

    def epoch(self, checkpoint: str) -> int:
        """Number of the epoch that a progress folder belongs to; a folder without progress opens a new one."""
        known = [tuple(r) for r in self.epochs.read().collect()] if self.epochs.version() else []
        started = bool(self.epochs.store.names(f"{checkpoint}/offsets"))
        mine = [n for n, folder in known if folder == checkpoint]
        if mine and started:
            return max(mine)
        number = max((n for n, _ in known), default=-1) + 1
        self.epochs.replace(self.spark.createDataFrame([*known, (number, checkpoint)], "epoch int, checkpoint string").coalesce(1))
        return number

    def _of_earlier(self, epoch: int) -> list[str]:
        return [r for r in self.batches.ids() if int(r.split("-")[0]) < epoch]

    def file(self, rows: DataFrame, epoch: int, batch: int) -> None:
        """File one micro-batch."""
        earlier = self._of_earlier(epoch)
        if earlier:
            keys = [self.change_id, "column_name"]
            rows = rows.join(self.batches.read(earlier).select(*keys), keys, "left_anti")
        self.batches.append(rows, f"{epoch:06d}-{batch:012d}")

    def read(self) -> DataFrame:
        return self.batches.read()

    def write(self, rows: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Start filing a stream of audit rows; ``trigger`` as for ``DataStreamWriter.trigger``."""
        epoch = self.epoch(checkpoint)
        writer = rows.writeStream.foreachBatch(lambda df, batch: self.file(df, epoch, batch)).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()


def write_audit(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append audit rows to parquet files; ``trigger`` as for ``DataStreamWriter.trigger``."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start(path) if trigger else writer.start(path)
