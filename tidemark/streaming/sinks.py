"""Streaming sinks and control. Every query has its own checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import keep_first
from tidemark.sinks.tables import drop_versions, version_path, versions
from tidemark.sources.storage import read_text, write_text
from tidemark.streaming.ledger import EPOCH, Ledger

_MARK = "_batch"  # beside the data files, which readers don't take for one


def _trigger(every: str | None) -> dict:
    """Processing-time trigger, or one pass over what is available when ``every`` is None."""
    return {"processingTime": every} if every else {"availableNow": True}


def start_batches(df: DataFrame, mode: str, checkpoint: str, publish: Callable[[DataFrame, int], None], every: str | None) -> StreamingQuery:
    """Start a query that hands each batch to ``publish``."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(publish).trigger(**_trigger(every)).start()


def _run_only(batch: DataFrame) -> None:
    """Run a replayed batch without a result: the query's window state must move on with it."""
    batch.write.format("noop").mode("overwrite").save()


def daily_files(
    bars: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds", partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append closed windows to Parquet; a window appears once the watermark passes its end.

    Without partition folders, so that a trigger writes few files however many series it closes.
    """
    writer = bars.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint).partitionBy(*partition_by)
    return writer.trigger(**_trigger(every)).start()


def console_monitor(
    messages: DataFrame,
    every: str | None = "30 seconds",
    rows: int = 10,
    columns: Sequence[str] = ("symbol", "price", "volume", "price_change_percent", "event_timestamp"),
) -> StreamingQuery:
    """Print the newest rows of the raw stream."""
    writer = messages.select(*columns).writeStream.outputMode("append").format("console")
    return writer.option("truncate", "false").option("numRows", rows).trigger(**_trigger(every)).start()


def memory_table(bars: DataFrame, name: str, every: str | None = "10 seconds") -> StreamingQuery:
    """All windows so far as a SQL table in driver memory: for small key sets and dashboards."""
    return bars.writeStream.outputMode("complete").format("memory").queryName(name).trigger(**_trigger(every)).start()


def snapshot_table(
    bars: DataFrame, root: str, checkpoint: str, every: str | None = "10 seconds", keep: int = 2
) -> StreamingQuery:
    """All windows so far as a versioned Parquet table, written by the executors.

    The form of :func:`memory_table` that needs no driver memory; it writes every window again
    in each batch. :func:`update_table` writes only what changed.

    Versions are numbered on from those stored, whatever the batch number: a query with a new
    checkpoint folder, whose batches start at 0, goes on behind the old one. Each version
    records its checkpoint and batch, so a batch that is replayed finds its own output and
    leaves it to its readers.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark, mark = batch.sparkSession, f"{checkpoint}#{batch_id}"
        known = versions(spark, root)
        if known and read_text(spark, f"{version_path(root, known[-1])}/{_MARK}") == mark:
            _run_only(batch)
            return
        number = known[-1] + 1 if known else 0
        batch.write.mode("overwrite").parquet(version_path(root, number))
        write_text(spark, f"{version_path(root, number)}/{_MARK}", mark)
        drop_versions(spark, root, keep)

    return start_batches(bars, "complete", checkpoint, publish, every)


UPDATES = "updates"


def update_table(
    bars: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = "10 seconds",
    keys: Sequence[str] = ("date", "symbol"),
    replaces: bool = False,
    fold_after: int = 50,
) -> StreamingQuery:
    """Windows that changed in each batch, appended as one folder per batch (update mode).

    Work per batch follows the changed windows, not all of them, and state ends with the
    watermark. :func:`read_updates` gives the latest row of each window. Batches are committed in
    an epoch ledger: a replayed batch counts once, and a query with a new checkpoint folder is a
    new run, whose rows win over those of the runs before; with ``replaces`` earlier runs count no
    longer at all. After ``fold_after`` batches they are folded.
    """
    run = Ledger(bars.sparkSession, root).start_run(checkpoint, replaces)

    def publish(batch: DataFrame, batch_id: int) -> None:
        ledger = Ledger(batch.sparkSession, root)
        epoch = ledger.epoch(run, batch_id)
        if ledger.is_committed(epoch):
            _run_only(batch)
            return
        ledger.commit(epoch, {UPDATES: ledger.write(epoch, UPDATES, batch)})
        if ledger.open_epochs(UPDATES) >= fold_after:
            compact_updates(batch.sparkSession, root, keys)

    return start_batches(bars, "update", checkpoint, publish, every)


def _latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return keep_first(rows, keys, [F.desc(EPOCH)])


def read_updates(spark: SparkSession, root: str, keys: Sequence[str] = ("date", "symbol")) -> DataFrame | None:
    """The latest row of each key of an :func:`update_table`; ``None`` before its first batch."""
    rows = Ledger(spark, root).read(UPDATES)
    return None if rows is None else _latest(rows, keys).drop(EPOCH)


def compact_updates(
    spark: SparkSession, root: str, keys: Sequence[str] = ("date", "symbol"), grace_seconds: float = 3600.0, now: float | None = None
) -> int:
    """Fold all committed batches into one folder; returns how many folders it stands for.

    Readers see either form. The old folders stay for ``grace_seconds``, for readers that list them.
    """
    return Ledger(spark, root).fold(UPDATES, lambda rows: _latest(rows, keys), grace_seconds, now)


def stop_all(spark: SparkSession) -> list[str]:
    """Stop every active query and return their names (or ids)."""
    stopped = []
    for query in spark.streams.active:
        stopped.append(query.name or str(query.id))
        query.stop()
    return stopped


def run_streams(spark: SparkSession, timeout: float | None = None) -> list[str]:
    """Wait for any active query to end (or the timeout), then stop the others."""
    try:
        if timeout is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout)
    finally:
        stopped = stop_all(spark)
        spark.streams.resetTerminated()
    return stopped
