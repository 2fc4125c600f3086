"""The speed layer: messages to daily bars, bounded or continuous."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.resample import daily_ticks
from tidemark.plans.layout import Layout
from tidemark.sinks import write_clustered
from tidemark.sources import parse_messages, read_first_available, read_topic
from tidemark.sources.messages import accepted, rejects
from tidemark.streaming import (
    console_monitor,
    daily_files,
    fan_out,
    memory_table,
    read_closed,
    snapshot_table,
    windowed_bars,
    with_event_watermark,
)

ARRIVAL = ("kafka_timestamp", "kafka_partition", "kafka_offset")
ORDER = ("event_timestamp", "kafka_partition", "kafka_offset")


def messages_to_daily(raw: DataFrame, layout: Layout, volume_mode: str = "sum") -> None:
    """A bounded set of broker rows to daily bars; unreadable rows go to a reject table."""
    parsed = parse_messages(raw, keep=ARRIVAL)
    table = daily_ticks(accepted(parsed), ORDER, volume_mode=volume_mode)
    write_clustered(table, layout.speed_daily[0], ("symbol", "date"))
    rejects(parsed).write.mode("overwrite").parquet(layout.path("speed_rejects"))


def topic_to_daily(spark: SparkSession, layout: Layout, servers: str, topic: str, volume_mode: str = "sum") -> None:
    messages_to_daily(read_topic(spark, servers, topic), layout, volume_mode)


def start_speed_layer(
    raw: DataFrame,
    layout: Layout,
    window: str = "1 day",
    delay: str = "1 hour",
    every: str | None = "10 seconds",
    stats: str = "table",
    monitor: bool = True,
    volume_mode: str = "sum",
    replaces: bool = False,
) -> list[StreamingQuery]:
    """Start the file sink, the reject sink, the statistics and the console monitor on one message stream.

    ``stats="table"`` is one query: each batch is read and parsed once and feeds closed windows,
    statistics, late rows, rejects and the monitor, all committed together (:func:`fan_out`). ``"snapshot"`` writes all windows as a new
    version of a table per batch, ``"memory"`` all windows to a SQL table on the driver named
    ``daily_stats``; these are several queries, which drop late rows. Unreadable messages go to files of their own, none is lost.
    """
    parsed = parse_messages(raw, keep=ARRIVAL)
    checkpoints = layout.path("speed_stream", "checkpoints")
    if stats == "table":
        options = {"order_by": ORDER, "volume_mode": volume_mode, "replaces": replaces, "monitor_rows": 10 if monitor else 0}
        return [fan_out(parsed, layout.speed_sinks, f"{checkpoints}/sinks", window, delay, every, **options)]
    arrived = accepted(parsed)
    bars = windowed_bars(with_event_watermark(arrived, delay), window, order_by=ORDER, volume_mode=volume_mode)
    started = [
        daily_files(bars, layout.speed_daily[1], f"{checkpoints}/daily", every),
        daily_files(rejects(parsed), layout.path("speed_stream", "rejects"), f"{checkpoints}/rejects", every, partition_by=()),
    ]
    if stats == "memory":
        started.append(memory_table(bars, "daily_stats", every))
    else:
        started.append(snapshot_table(bars, layout.path("speed_stream", "stats"), f"{checkpoints}/stats", every))
    if monitor:
        started.append(console_monitor(arrived, every and "30 seconds"))
    return started


def read_speed_layer(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """Daily rows of the speed layer: the bounded reader's table, else what the stream has closed."""
    bounded, appended = layout.speed_daily
    found = read_first_available(spark, [bounded])
    found = read_closed(spark, layout.speed_sinks) if found is None else found
    return read_first_available(spark, [appended]) if found is None else found
