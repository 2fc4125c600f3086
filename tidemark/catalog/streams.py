"""Streaming queries over the events table, run once over what is available."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.daily import TICK_DAILY
from tidemark.catalog.inputs import MESSAGE_ORDER, MONEY, messages, sql_with, ticks
from tidemark.catalog.registry import Tables, query
from tidemark.sinks.tables import read_version
from tidemark.sources import parse_messages
from tidemark.sources.storage import is_directory, scratch_dir
from tidemark.streaming import (
    compact_updates,
    daily_files,
    fan_out,
    read_batches,
    read_closed,
    read_late,
    read_rejects,
    read_stats,
    read_updates,
    snapshot_table,
    update_table,
    windowed_bars,
    with_event_watermark,
)


class StreamTables(Tables):
    """The same tables as unbounded file sources."""

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        folder = self.folder.rstrip("/")
        path = f"{folder}/{name}.parquet"
        reader = self.spark.readStream.schema(self.spark.read.parquet(path).schema)
        if is_directory(self.spark, path):
            return reader.parquet(path)
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def _stream(t: Tables) -> DataFrame:
    return messages(StreamTables(t.spark, t.folder)).drop("date")


def _append_to_files(t: Tables, bars: DataFrame, label: str) -> DataFrame:
    out = scratch_dir(t.spark, label)
    query = daily_files(bars, f"{out}/table", f"{out}/checkpoint", every=None)
    query.awaitTermination()
    return t.spark.read.schema(bars.schema).parquet(f"{out}/table")


# Append mode emits a window once the watermark, newest event minus the delay, passes its end.
CLOSED_DAYS = f"""select * from ({TICK_DAILY})
where cast(date as timestamp) + interval 1 day <= (select max(ts) - interval 1 hour from ticks)"""


@query("stream_daily_ohlcv", sql_with("ticks", body=CLOSED_DAYS))
def stream_daily_ohlcv(t: Tables) -> DataFrame:
    bars = windowed_bars(with_event_watermark(_stream(t), "1 hour"), "1 day", order_by=MESSAGE_ORDER, scale=MONEY)
    return _append_to_files(t, bars, "stream-daily")


@query(
    "stream_5min_ohlcv",
    sql_with(
        "ticks",
        body="select * from ("
        + TICK_DAILY.replace("cast(ts as date) as date", "time_bucket(interval 5 minutes, ts) as window_start")
        + """)
where window_start + interval 5 minutes <= (select max(ts) - interval 1 minute from ticks)""",
    ),
)
def stream_5min_ohlcv(t: Tables) -> DataFrame:
    marked = with_event_watermark(_stream(t), "1 minute")
    bars = windowed_bars(marked, "5 minutes", order_by=MESSAGE_ORDER, scale=MONEY, daily=False)
    stored = _append_to_files(t, bars, "stream-5min")
    return stored.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_stats_table", sql_with("ticks", body=TICK_DAILY))
def stream_stats_table(t: Tables) -> DataFrame:
    bars = windowed_bars(with_event_watermark(_stream(t), "1 hour"), "1 day", order_by=MESSAGE_ORDER, scale=MONEY)
    out = scratch_dir(t.spark, "stream-stats")
    snapshot_table(bars, f"{out}/table", f"{out}/checkpoint", every=None).awaitTermination()
    read_version(t.spark, f"{out}/table").createOrReplaceTempView("daily_stats")
    return t.spark.sql("select * from daily_stats")


@query("stream_update_table", sql_with("ticks", body=TICK_DAILY))
def stream_update_table(t: Tables) -> DataFrame:
    """Changed windows per batch, folded and read back as the latest row of each."""
    bars = windowed_bars(with_event_watermark(_stream(t), "1 hour"), "1 day", order_by=MESSAGE_ORDER, scale=MONEY)
    out = scratch_dir(t.spark, "stream-updates")
    update_table(bars, f"{out}/table", f"{out}/checkpoint", every=None).awaitTermination()
    compact_updates(t.spark, f"{out}/table")
    return read_updates(t.spark, f"{out}/table").select(*bars.columns)


# The second run begins with the day in the middle of which the first one ended.
FIRST_RUN_ENDS, SECOND_RUN_BEGINS = "2024-01-15 12:00:00", "2024-01-15"


@query("stream_two_runs", sql_with("ticks", body=TICK_DAILY))
def stream_two_runs(t: Tables) -> DataFrame:
    """Two runs with a checkpoint folder each; of the day both have seen, the later run's row counts."""
    out = scratch_dir(t.spark, "two-runs")
    at = F.col("event_timestamp")
    halves = (at < F.lit(FIRST_RUN_ENDS).cast("timestamp"), at >= F.lit(SECOND_RUN_BEGINS).cast("timestamp"))
    for run, half in enumerate(halves):
        seen = with_event_watermark(_stream(t).filter(half), "1 hour")
        bars = windowed_bars(seen, "1 day", order_by=MESSAGE_ORDER, scale=MONEY)
        update_table(bars, f"{out}/table", f"{out}/checkpoint-{run}", every=None).awaitTermination()
    return read_updates(t.spark, f"{out}/table").select(*bars.columns)


# Every 13th message arrives 40 hours after the event; messages land in four parts by arrival.
DELAYED, DELAY_HOURS, UNREADABLE = 13, 40, 97
LANDINGS = ("2024-01-08", "2024-01-16", "2024-01-23")


def _land_and_feed(t: Tables, label: str) -> str:
    """Messages as they arrive, part by part, and all sinks after each; returns the sinks' root.

    The query ends and starts again from its checkpoint between the parts.
    """
    out = scratch_dir(t.spark, label)
    message = F.to_json(
        F.struct(
            "symbol",
            F.unix_millis("event_timestamp").alias("event_time"),
            *[F.col("price").alias(c) for c in ("price", "open", "high", "low")],
            "volume",
            (F.col("price") * F.col("volume")).alias("quote_volume"),
            F.col("volume").cast("int").alias("number_trades"),
        )
    )
    value = F.when(F.col("event_id") % UNREADABLE == 0, F.concat(F.lit("{unreadable "), "event_id")).otherwise(message)
    delay = F.when(F.col("event_id") % DELAYED == 0, F.expr(f"interval {DELAY_HOURS} hours")).otherwise(F.expr("interval 0 hours"))
    arrived = F.col("event_timestamp") + delay
    rows = ticks(t).select("event_id", value.alias("value"), arrived.alias("arrived"))
    edges = (None, *LANDINGS, None)
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = rows if low is None else rows.filter(F.col("arrived") >= F.lit(low).cast("timestamp"))
        part = part if high is None else part.filter(F.col("arrived") < F.lit(high).cast("timestamp"))
        part.select("event_id", "value").write.mode("append").parquet(f"{out}/landed")
        landed = t.spark.readStream.schema("event_id bigint, value string").parquet(f"{out}/landed")
        parsed = parse_messages(landed, keep=("event_id",))
        fan_out(parsed, f"{out}/sinks", f"{out}/checkpoint", every=None, order_by=MESSAGE_ORDER, scale=MONEY).awaitTermination()
    return f"{out}/sinks"


_PARTS = " + ".join(f"cast(arrived >= timestamp '{day}' as integer)" for day in LANDINGS)
_JUDGED = f""", arrivals as (
  select *, event_id % {UNREADABLE} = 0 as bad, ts + case when event_id % {DELAYED} = 0 then interval {DELAY_HOURS} hour else interval 0 hour end as arrived
  from ticks),
parts as (select *, {_PARTS} as part from arrivals),
marks as (
  select part, max(max(ts) filter (not bad)) over (order by part rows between unbounded preceding and 1 preceding) - interval 1 hour as mark,
         max(max(ts) filter (not bad)) over (order by part rows between unbounded preceding and current row) - interval 1 hour as next_mark
  from parts group by part),
judged as (
  select p.*, cast(ts as date) as date, coalesce(cast(cast(ts as date) as timestamp) + interval 1 day <= mark, false) as late
  from parts p join marks using (part))"""


@query(
    "stream_late_rows",
    sql_with(
        "ticks",
        body=f"""{_JUDGED}
select symbol, date, count(*) filter (not late) as accepted, count(*) filter (late) as late
from judged where not bad group by all""",
    ),
)
def stream_late_rows(t: Tables) -> DataFrame:
    """Rows behind the watermark are kept apart with their window; accepted and late rows are all there are."""
    root = _land_and_feed(t, "late-rows")
    accepted = read_stats(t.spark, root).select("symbol", "date", F.col("tick_count").alias("accepted"))
    late = read_late(t.spark, root)
    if late is None:
        return accepted.withColumn("late", F.lit(0).cast("bigint"))
    late = late.groupBy("symbol", F.to_date("window_start").alias("date")).agg(F.count("*").alias("late"))
    both = accepted.join(late, ["symbol", "date"], "full")
    return both.na.fill(0, ["accepted", "late"])


_FANNED = TICK_DAILY.replace("from ticks", "from judged where not bad and not late")


@query(
    "stream_fanout",
    sql_with(
        "ticks",
        body=f"""{_JUDGED}, totals as ({_FANNED})
select 'stats' as sink, symbol, date, tick_count as n, daily_open, daily_close, avg_price, daily_quote_volume from totals
union all
select 'daily', symbol, date, tick_count, daily_open, daily_close, avg_price, daily_quote_volume from totals
where cast(date as timestamp) + interval 1 day <= (select max(next_mark) from marks)
union all select 'rejects', null, null, count(*), null, null, null, null from judged where bad
union all select 'late', null, null, count(*), null, null, null, null from judged where late and not bad
union all select 'input', null, null, count(*), null, null, null, null from judged""",
    ),
)
def stream_fanout(t: Tables) -> DataFrame:
    """One query for statistics, closed windows, late rows and rejects; each row of the input is read once."""
    root = _land_and_feed(t, "fan-out")
    columns = ("symbol", "date", F.col("tick_count").alias("n"), "daily_open", "daily_close", "avg_price", "daily_quote_volume")
    out = read_stats(t.spark, root).select(F.lit("stats").alias("sink"), *columns)
    out = out.unionByName(read_closed(t.spark, root).select(F.lit("daily").alias("sink"), *columns))
    for sink, rows in (("rejects", read_rejects(t.spark, root)), ("late", read_late(t.spark, root))):
        rows = t.spark.range(0) if rows is None else rows
        out = out.unionByName(rows.agg(F.lit(sink).alias("sink"), F.count("*").alias("n")), allowMissingColumns=True)
    read = sum(batch["rows"] for batch in read_batches(t.spark, root))
    given = t.spark.range(1).select(F.lit("input").alias("sink"), F.lit(read).cast("bigint").alias("n"))
    return out.unionByName(given, allowMissingColumns=True)
