"""tidemark: time-series bars, calendars, layers, streams and forecasts as Spark jobs."""

__version__ = "0.1.0"
