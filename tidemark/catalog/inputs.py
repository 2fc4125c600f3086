"""The test tables under the column names the operators use, in Spark and in SQL.

Series are event types (ticks, sub-day), users (sparse), order priorities (long daily
history) and return-flag/status pairs (many repeated stamps). Every mapping keeps all rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import Tables
from tidemark.forecast import Event
from tidemark.operators.calendar import fill_calendar, moving_averages
from tidemark.operators.resample import daily_bars

MONEY = 2  # decimals of the price columns, for exact sums
MIN_QUOTE = 5.0  # a quote below this is treated as a missing reading
BATCH_END = "2001-06-30"
SPEED_START = "2001-06-15"
AS_OF = "2001-08-31"
EVENTS = (
    Event("1-URGENT", "halving", dt.date(1996, 7, 9)),
    Event("1-URGENT", "halving", dt.date(2000, 5, 11)),
    Event("3-MEDIUM", "halving", dt.date(1998, 4, 20)),
)


def ticks(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    )


def tick_bars(t: Tables) -> DataFrame:
    """Ticks as bars stamped to the second; readings below the minimum quote are NULL."""
    valid = F.col("price") >= F.lit(MIN_QUOTE)
    price = F.when(valid, F.col("price"))
    return ticks(t).select(
        F.col("event_id").alias("bar_id"),
        "symbol",
        F.unix_seconds("event_timestamp").alias("timestamp"),
        *[price.alias(c) for c in ("open", "high", "low", "close")],
        F.when(valid, F.col("volume")).alias("volume"),
    )


def order_bars(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return t.orders.select(
        F.col("o_orderkey").alias("bar_id"),
        F.col("o_orderpriority").alias("symbol"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("timestamp"),
        F.to_date("o_orderdate").alias("day"),
        *[price.alias(c) for c in ("open", "high", "low", "close", "volume")],
    )


def line_bars(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    return t.lineitem.select(
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        "l_orderkey",
        "l_linenumber",
        *[price.alias(c) for c in ("open", "high", "low", "close")],
        F.col("l_quantity").alias("volume"),
    )


LINE_ORDER = ("l_orderkey", "l_linenumber", "close", "volume")


def messages(t: Tables) -> DataFrame:
    """Ticks under the message columns, with the event id as arrival order."""
    return ticks(t).select(
        "event_id",
        "symbol",
        "event_timestamp",
        F.to_date("event_timestamp").alias("date"),
        "price",
        *[F.col("price").alias(c) for c in ("open", "high", "low")],
        "volume",
        (F.col("price") * F.col("volume")).alias("quote_volume"),
        F.col("volume").cast("int").alias("number_trades"),
    )


MESSAGE_ORDER = ("event_timestamp", "event_id")


def daily(t: Tables) -> DataFrame:
    # Orders carry a date only, so inside a day the order key alone decides first and last.
    return daily_bars(order_bars(t), F.col("day"), ["bar_id"], scale=MONEY)


def daily_filled(t: Tables) -> DataFrame:
    return moving_averages(fill_calendar(daily(t)), scale=MONEY)


def batch_layer(t: Tables) -> DataFrame:
    return daily_filled(t).filter(F.col("date") <= F.lit(BATCH_END).cast("date"))


def speed_layer(t: Tables) -> DataFrame:
    """Later days with shifted values, overlapping the batch layer by two weeks."""
    late = daily(t).filter(F.col("date") >= F.lit(SPEED_START).cast("date"))
    return late.withColumns({c: F.col(c) + 1.0 for c in ("daily_open", "daily_high", "daily_low", "daily_close")})


CTE = {
    "ticks": """ticks as (
  select event_id, event_type as symbol, ts, value as price,
         cast(json_extract_string(props, '$.k') as double) as volume
  from events)""",
    "tick_bars": f"""tick_bars as (
  select event_id as bar_id, event_type as symbol, cast(floor(epoch(ts)) as bigint) as "timestamp",
         case when value >= {MIN_QUOTE} then value end as price,
         case when value >= {MIN_QUOTE} then cast(json_extract_string(props, '$.k') as double) end as volume
  from events)""",
    "line_bars": """line_bars as (
  select l_returnflag || l_linestatus as symbol, cast(epoch(l_shipdate) as bigint) as "timestamp",
         l_orderkey, l_linenumber, l_extendedprice as price, l_quantity as volume
  from lineitem)""",
    "daily": """daily as (
  select o_orderpriority as symbol, cast(o_orderdate as date) as date,
         arg_min(o_totalprice, o_orderkey) as daily_open, max(o_totalprice) as daily_high,
         min(o_totalprice) as daily_low, arg_max(o_totalprice, o_orderkey) as daily_close,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) as daily_volume, count(*) as cnt
  from orders group by 1, 2)""",
    "filled": """spine as (
  select symbol, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
  from daily group by 1),
filled as (
  select symbol, date,
         last_value(daily_open ignore nulls) over w as daily_open,
         last_value(daily_high ignore nulls) over w as daily_high,
         last_value(daily_low ignore nulls) over w as daily_low,
         last_value(daily_close ignore nulls) over w as daily_close,
         coalesce(daily_volume, 0) as daily_volume, coalesce(cnt, 0) as cnt, cnt is null as is_filled
  from spine left join daily using (symbol, date)
  window w as (partition by symbol order by date rows unbounded preceding))""",
    "filled_ma": """filled_ma as (
  select *,
         cast(sum(cast(daily_close as decimal(18,2))) over w7 as double) / count(*) over w7 as ma7,
         cast(sum(cast(daily_close as decimal(18,2))) over w30 as double) / count(*) over w30 as ma30
  from filled
  window w7 as (partition by symbol order by date rows 6 preceding),
         w30 as (partition by symbol order by date rows 29 preceding))""",
    "layers": f"""batch as (select * from filled_ma where date <= date '{BATCH_END}'),
speed as (
  select symbol, date, daily_open + 1.0::double as daily_open, daily_high + 1.0::double as daily_high,
         daily_low + 1.0::double as daily_low, daily_close + 1.0::double as daily_close, daily_volume
  from daily where date >= date '{SPEED_START}')""",
}


def sql_with(*names: str, body: str) -> str:
    """A statement over the named common table expressions, in dependency order."""
    return "with " + ",\n".join(CTE[n] for n in names) + "\n" + body


DAILY = ("daily",)
FILLED = ("daily", "filled")
FILLED_MA = ("daily", "filled", "filled_ma")
LAYERS = (*FILLED_MA, "layers")
