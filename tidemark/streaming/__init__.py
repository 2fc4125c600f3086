"""Structured Streaming: windowed bars and their sinks."""

from tidemark.streaming.fanout import fan_out, fold_sinks, read_batches, read_closed, read_late, read_rejects, read_stats
from tidemark.streaming.sinks import (
    compact_updates,
    console_monitor,
    daily_files,
    memory_table,
    read_updates,
    run_streams,
    snapshot_table,
    stop_all,
    update_table,
)
from tidemark.streaming.windows import with_event_watermark, windowed_bars

__all__ = [
    "compact_updates",
    "console_monitor",
    "daily_files",
    "fan_out",
    "fold_sinks",
    "memory_table",
    "read_batches",
    "read_closed",
    "read_late",
    "read_rejects",
    "read_stats",
    "read_updates",
    "run_streams",
    "snapshot_table",
    "stop_all",
    "update_table",
    "windowed_bars",
    "with_event_watermark",
]
