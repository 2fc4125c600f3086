"""End-to-end jobs: operators wired to stored tables, in the order they are run."""

from tidemark.plans.batch import backfill, clean, convert, convert_folder, daily, fill, merge
from tidemark.plans.layout import Layout
from tidemark.plans.serving import merge_daily, publish_daily, read_daily, read_marks, read_model_input
from tidemark.plans.speed import read_speed_layer, start_speed_layer, topic_to_daily
from tidemark.plans.training import train

__all__ = [
    "Layout",
    "backfill",
    "clean",
    "convert",
    "convert_folder",
    "daily",
    "fill",
    "merge",
    "merge_daily",
    "publish_daily",
    "read_daily",
    "read_marks",
    "read_model_input",
    "read_speed_layer",
    "start_speed_layer",
    "topic_to_daily",
    "train",
]
