"""One query that feeds every sink of the message stream.

Each batch is read and parsed once, kept while its sinks write, and committed once in an epoch
ledger (``ledger``): rejects, late rows, window statistics and closed windows of a batch all
count, or none does. Statistics are stored as partial sums per batch that add up on reading, so the
query holds no window state: a restart has nothing to restore, and runs that continue one another may share a
window.

The watermark is the newest event time of the run's committed batches minus the delay. A row whose
window has ended by then is late: it goes to a table of its own with its window, and to no total.
So every row of the input is accepted, late or rejected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.resample import merge_ticks, partial_ticks
from tidemark.sources.messages import accepted, rejects
from tidemark.streaming.ledger import EPOCH, Ledger
from tidemark.streaming.sinks import start_batches

STATS, CLOSED, LATE, REJECTS = "stats", "daily", "late", "rejects"
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}
START, END = "window_start", "window_end"


def seconds_of(span: str) -> int:
    """'1 hour' and the like in seconds."""
    number, unit = span.split()
    return round(float(number) * _SECONDS[unit.rstrip("s")])


def _fold_partials(rows: DataFrame, key: str) -> DataFrame:
    return merge_ticks(rows, [START, END, key], more=[F.max(EPOCH).alias(EPOCH)], finish=False)


def fan_out(
    parsed: DataFrame,
    root: str,
    checkpoint: str,
    size: str = "1 day",
    delay: str = "1 hour",
    every: str | None = "10 seconds",
    key: str = "symbol",
    order_by: Sequence[str | Column] = ("event_timestamp",),
    volume_mode: str = "sum",
    scale: int | None = None,
    time: str = "event_timestamp",
    replaces: bool = False,
    monitor_rows: int = 0,
    fold_after: int = 50,
) -> StreamingQuery:
    """Feed all sinks below ``root`` from one stream of :func:`parse_messages` rows.

    Sinks: ``stats`` (:func:`read_stats`), ``daily`` (windows the watermark has passed, appended once), ``late``
    and ``rejects``. ``monitor_rows`` newest rows of each batch are printed. After ``fold_after``
    batches the folders of a sink are folded. ``replaces`` is for a new checkpoint folder whose stream
    begins anew: earlier runs then count no longer.
    """
    spark = parsed.sparkSession
    run = Ledger(spark, root).start_run(checkpoint, replaces)
    behind = seconds_of(delay) * 1_000_000

    def publish(batch: DataFrame, batch_id: int) -> None:
        ledger = Ledger(batch.sparkSession, root)
        epoch = ledger.epoch(run, batch_id)
        if ledger.is_committed(epoch):
            return
        last = ledger.last(run)
        mark = last["notes"]["mark"] if last else None
        batch = batch.withColumn(time, F.col(time).cast("timestamp"))
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            window = F.window(time, size)
            good = accepted(batch).withColumn(START, window["start"]).withColumn(END, window["end"])
            limit = None if mark is None else F.timestamp_micros(F.lit(mark - behind))
            is_late = F.lit(False) if limit is None else F.col(END) <= limit
            good = good.withColumn("_late", is_late)
            count = lambda c: F.count_if(c)
            seen = good.agg(F.unix_micros(F.max(time)).alias("newest"), F.count("*").alias("n"), count(F.col("_late")).alias("late")).first()
            bad = rejects(batch)
            n_bad = bad.count()
            sinks = {}
            if n_bad:
                sinks[REJECTS] = ledger.write(epoch, REJECTS, bad)
            if seen["late"]:
                lag = (F.unix_micros(limit) - F.unix_micros(END)) / 1_000_000
                sinks[LATE] = ledger.write(epoch, LATE, good.filter("_late").drop("_late").withColumn("seconds_late", lag))
            if seen["n"] > seen["late"]:
                on_time = good.filter("not _late")
                sinks[STATS] = ledger.write(epoch, STATS, on_time.groupBy(START, END, key).agg(*partial_ticks(order_by, volume_mode, scale)))
            newest = max((m for m in (mark, seen["newest"]) if m is not None), default=None)
            closed = _closed(ledger, epoch, sinks, mark, newest, behind, key) if newest is not None else None
            if closed is not None:
                sinks[CLOSED] = ledger.write(epoch, CLOSED, closed)
            if monitor_rows:
                newest_first = good.drop("_late", START, END).orderBy(F.desc(time)).limit(monitor_rows)
                newest_first.show(monitor_rows, truncate=False)
            ledger.commit(epoch, sinks, {"mark": newest, "rows": seen["n"] + n_bad, "late": seen["late"], "rejected": n_bad})
        finally:
            batch.unpersist()
        for sink in sinks:
            if ledger.open_epochs(sink) >= fold_after:
                ledger.fold(sink, (lambda rows: _fold_partials(rows, key)) if sink == STATS else None)

    return start_batches(parsed, "append", checkpoint, publish, every)


def fold_sinks(spark: SparkSession, root: str, key: str = "symbol", grace_seconds: float = 3600.0) -> dict[str, int]:
    """Fold the folders of every sink; returns how many each fold stands for. Safe beside a running query."""
    ledger = Ledger(spark, root)
    return {
        sink: ledger.fold(sink, (lambda rows: _fold_partials(rows, key)) if sink == STATS else None, grace_seconds)
        for sink in (STATS, CLOSED, LATE, REJECTS)
    }


def _closed(ledger: Ledger, epoch: str, sinks: dict, mark: int | None, newest: int, behind: int, key: str) -> DataFrame | None:
    """Totals of the windows that the watermark passes with this batch, over all committed batches and this one."""
    edge = lambda m: F.timestamp_micros(F.lit(m - behind))
    passed = F.col(END) <= edge(newest)
    if mark is not None:
        if newest == mark:
            return None
        passed &= F.col(END) > edge(mark)
    parts = ledger.read(STATS)
    parts = None if parts is None else parts.drop(EPOCH).filter(passed)
    if STATS in sinks:
        own = ledger.spark.read.parquet(f"{ledger.root}/{sinks[STATS]['folder']}").filter(passed)
        parts = own if parts is None else parts.unionByName(own, allowMissingColumns=True)
    if parts is None:
        return None
    bars = merge_ticks(parts, [START, END, key])
    return None if bars.isEmpty() else bars


def _named(bars: DataFrame, daily: bool) -> DataFrame:
    if daily:
        return bars.select(F.to_date(START).alias("date"), *[c for c in bars.columns if c not in (START, END)])
    return bars.drop(END)


def read_stats(spark: SparkSession, root: str, key: str = "symbol", daily: bool = True) -> DataFrame | None:
    """Totals of every window so far, open ones too; columns as :func:`windowed_bars`."""
    parts = Ledger(spark, root).read(STATS)
    return None if parts is None else _named(merge_ticks(parts.drop(EPOCH), [START, END, key]), daily)


def read_closed(spark: SparkSession, root: str, daily: bool = True) -> DataFrame | None:
    """Windows the watermark has passed, as they were appended."""
    bars = Ledger(spark, root).read(CLOSED)
    return None if bars is None else _named(bars.drop(EPOCH), daily)


def read_late(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows behind the watermark with their window and how late they were."""
    found = Ledger(spark, root).read(LATE)
    return None if found is None else found.drop(EPOCH)


def read_rejects(spark: SparkSession, root: str) -> DataFrame | None:
    found = Ledger(spark, root).read(REJECTS)
    return None if found is None else found.drop(EPOCH)


def read_batches(spark: SparkSession, root: str) -> list[dict]:
    """What each committed batch read: epoch, rows, late, rejected and mark."""
    ledger = Ledger(spark, root)
    return [{"epoch": e, **ledger.record(e)["notes"]} for e in ledger.epochs()]
