"""Sources, normalisation, messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.inputs import line_bars, sql_with, ticks
from tidemark.catalog.registry import Tables, query
from tidemark.functions import epoch_to_timestamp
from tidemark.operators.normalize import normalize_bars
from tidemark.sources.klines import klines_to_bars
from tidemark.sources.messages import parse_messages, ticker_to_messages


@query(
    "scan_ticks",
    sql_with("ticks", body="select event_id, symbol, ts as event_timestamp, price, volume from ticks"),
)
def scan_ticks(t: Tables) -> DataFrame:
    return ticks(t).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@query(
    "kline_normalize",
    """select o_orderkey, o_orderpriority as symbol, cast(epoch(o_orderdate) as bigint) as "timestamp",
       cast(o_orderdate as date) as date, o_totalprice as open, o_totalprice as high,
       o_totalprice as low, o_totalprice as close, o_totalprice as volume
from orders""",
)
def kline_normalize(t: Tables) -> DataFrame:
    open_ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    price = F.col("o_totalprice").cast("string")
    kline = F.array(
        open_ms.cast("string"), price, price, price, price, price, (open_ms + 59_999).cast("string"),
        price, F.col("o_custkey").cast("string"), F.lit("0"), F.lit("0"), F.lit("0"),
    )
    pages = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("symbol"), F.to_json(F.array(kline)).alias("page"))
    bars = klines_to_bars(pages, keep=("o_orderkey", "symbol"))
    return bars.withColumn("date", F.to_date("datetime")).drop("datetime")


@query(
    "ticker_normalize",
    sql_with(
        "ticks",
        body="""select event_id, symbol, epoch_us(ts) // 1000 as event_time, price, price as open, price as high,
       price as low, volume, price as quote_volume, cast(volume as integer) as number_trades,
       price as price_change, price as price_change_percent
from ticks""",
    ),
)
def ticker_normalize(t: Tables) -> DataFrame:
    price = F.col("price").cast("string")
    ticker = F.struct(
        "symbol",
        F.unix_millis("event_timestamp").alias("closeTime"),
        *[
            price.alias(c)
            for c in ("lastPrice", "openPrice", "highPrice", "lowPrice", "quoteVolume", "priceChange", "priceChangePercent")
        ],
        F.col("volume").cast("string").alias("volume"),
        F.col("volume").cast("int").alias("count"),
    )
    raw = ticks(t).select("event_id", F.to_json(ticker).alias("value"))
    return ticker_to_messages(raw, keep=("event_id",)).drop("timestamp")


@query(
    "parse_messages",
    sql_with(
        "ticks",
        body="""select event_id, symbol, epoch_us(ts) // 1000 as event_time, price, volume, cast(volume as integer) as number_trades,
       cast(ts as date) as date, cast(hour(ts) as integer) as hour, true as is_valid
from ticks""",
    ),
)
def parse_message_rows(t: Tables) -> DataFrame:
    message = F.struct(
        "symbol",
        F.unix_millis("event_timestamp").alias("event_time"),
        *[F.col("price").alias(c) for c in ("price", "open", "high", "low")],
        "volume",
        F.col("volume").cast("int").alias("number_trades"),
        F.col("event_timestamp").cast("string").alias("timestamp"),
    )
    raw = ticks(t).select("event_id", F.to_json(message).cast("binary").alias("value"))
    parsed = parse_messages(raw, keep=("event_id",))
    return parsed.select("event_id", "symbol", "event_time", "price", "volume", "number_trades", "date", "hour", "is_valid")


@query(
    "normalize_bars",
    sql_with(
        "line_bars",
        body="""select "timestamp", cast(to_timestamp("timestamp") at time zone 'UTC' as date) as date,
       price as open, price as high, price as low, price as close, volume, symbol,
       cast(year(to_timestamp("timestamp") at time zone 'UTC') as integer) as year,
       cast(month(to_timestamp("timestamp") at time zone 'UTC') as integer) as month, l_orderkey, l_linenumber
from line_bars""",
    ),
)
def normalize_bar_rows(t: Tables) -> DataFrame:
    stamp = F.col("timestamp").cast("double").cast("string")  # text with a fraction, as CSV delivers it
    raw = line_bars(t).select(
        stamp.alias("Unix"),
        F.col("open").cast("string").alias("Open_"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").cast("string").alias("Close"),
        F.col("volume").alias("Volume_BTC"),
        F.col("symbol").alias("Symbol"),
        "l_orderkey",
        "l_linenumber",
    )
    bars = normalize_bars(raw, epoch_unit="s")
    return bars.withColumn("date", F.to_date("datetime")).drop("datetime")


@query(
    "scalar_dates",
    """select event_id, cast(ts as date) as date, cast(year(ts) as integer) as year,
       cast(month(ts) as integer) as month, cast(hour(ts) as integer) as hour, strftime(ts, '%Y-%m') as year_month,
       cast(floor(epoch(ts)) as bigint) as epoch_s, epoch_us(ts) // 1000 as epoch_ms,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as from_s, cast(cast(ts as date) + 1 as date) as next_day,
       cast(date_diff('day', date '2024-01-01', cast(ts as date)) as integer) as days_since, true as ms_round_trip
from events""",
)
def scalar_dates(t: Tables) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    seconds, millis = F.unix_seconds(ts), F.unix_millis(ts)
    return t.events.select(
        "event_id",
        F.to_date(ts).alias("date"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.hour(ts).alias("hour"),
        F.date_format(ts, "yyyy-MM").alias("year_month"),
        seconds.alias("epoch_s"),
        millis.alias("epoch_ms"),
        F.from_unixtime(seconds).alias("from_s"),
        F.date_add(F.to_date(ts), 1).alias("next_day"),
        F.datediff(F.to_date(ts), F.lit("2024-01-01").cast("date")).alias("days_since"),
        (F.unix_millis(epoch_to_timestamp(millis, "ms")) == millis).alias("ms_round_trip"),
    )
