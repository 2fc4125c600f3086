"""Readers: files, landed API pages, ticker snapshots, message topics."""

from tidemark.sources.files import csv_families, csv_types, read_bars, read_csv_text, read_csv_typed, read_first_available, read_parquet
from tidemark.sources.klines import kline_rejects, klines_to_bars, read_kline_pages
from tidemark.sources.messages import parse_messages, ticker_to_messages
from tidemark.sources.topics import read_topic, stream_topic, topic_options

__all__ = [
    "csv_families",
    "csv_types",
    "kline_rejects",
    "klines_to_bars",
    "parse_messages",
    "read_bars",
    "read_csv_text",
    "read_csv_typed",
    "read_first_available",
    "read_kline_pages",
    "read_parquet",
    "read_topic",
    "stream_topic",
    "ticker_to_messages",
    "topic_options",
]
