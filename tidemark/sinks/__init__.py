"""Batch writers. Streaming sinks are in ``tidemark.streaming``."""

from tidemark.sinks.manifest import PublishConflict, publish, read_manifest, read_published
from tidemark.sinks.tables import (
    BAR_LAYOUT,
    DAILY_LAYOUT,
    DAILY_ORDER,
    append_staging,
    materialize,
    read_partitioned,
    read_version,
    versions,
    write_clustered,
    write_csv,
    write_partitioned,
    write_version,
)

__all__ = [
    "BAR_LAYOUT",
    "DAILY_LAYOUT",
    "DAILY_ORDER",
    "PublishConflict",
    "append_staging",
    "materialize",
    "publish",
    "read_manifest",
    "read_partitioned",
    "read_published",
    "read_version",
    "versions",
    "write_clustered",
    "write_csv",
    "write_partitioned",
    "write_version",
]
