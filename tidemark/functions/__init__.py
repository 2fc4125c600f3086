"""Column expressions; nothing here starts a job."""

from tidemark.functions.numeric import (
    clip_lower,
    exact_mean,
    exact_sum,
    pct_change,
    pct_error,
)
from tidemark.functions.times import (
    day_of,
    epoch_day,
    epoch_to_timestamp,
    ordering,
    with_calendar_parts,
)

__all__ = [
    "clip_lower",
    "day_of",
    "epoch_day",
    "epoch_to_timestamp",
    "exact_mean",
    "exact_sum",
    "ordering",
    "pct_change",
    "pct_error",
    "with_calendar_parts",
]
