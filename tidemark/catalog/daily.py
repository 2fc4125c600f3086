"""Daily bars, calendars, fills and averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import inputs
from tidemark.catalog.inputs import AS_OF, DAILY, FILLED, FILLED_MA, MESSAGE_ORDER, MONEY, sql_with
from tidemark.catalog.registry import Tables, query
from tidemark.operators import calendar
from tidemark.operators.normalize import model_input
from tidemark.operators.resample import daily_ticks


@query("daily_ohlcv", sql_with(*DAILY, body="select * from daily"))
def daily_ohlcv(t: Tables) -> DataFrame:
    return inputs.daily(t)


TICK_DAILY = """select cast(ts as date) as date, symbol,
       arg_min(price, row(ts, event_id)) as daily_open, max(price) as daily_high, min(price) as daily_low,
       arg_max(price, row(ts, event_id)) as daily_close,
       cast(sum(cast(volume as decimal(18,2))) as double) as daily_volume,
       cast(sum(cast(price * volume as decimal(18,2))) as double) as daily_quote_volume,
       cast(sum(cast(volume as integer)) as bigint) as total_trades, count(*) as tick_count,
       cast(sum(cast(price as decimal(18,2))) as double) / count(*) as avg_price
from ticks group by 1, 2"""


@query("tick_daily", sql_with("ticks", body=TICK_DAILY))
def tick_daily(t: Tables) -> DataFrame:
    return daily_ticks(inputs.messages(t), MESSAGE_ORDER, scale=MONEY)


@query("calendar_spine", sql_with(*FILLED, body="select symbol, date from spine"))
def calendar_spine(t: Tables) -> DataFrame:
    return calendar.calendar_spine(inputs.daily(t))


@query("fill_calendar", sql_with(*FILLED, body="select * from filled"))
def fill_calendar(t: Tables) -> DataFrame:
    return calendar.fill_calendar(inputs.daily(t))


@query("moving_averages", sql_with(*FILLED_MA, body="select * from filled_ma"))
def moving_averages(t: Tables) -> DataFrame:
    return inputs.daily_filled(t)


@query(
    "backfill_fill",
    sql_with(
        *DAILY,
        body=f""", spine as (
  select symbol, cast(d as date) as date
  from (select distinct symbol from daily), generate_series(date '1995-01-01', date '{AS_OF}', interval 1 day) g(d)),
carried as (
  select symbol, date,
         last_value(daily_open ignore nulls) over w as daily_open, last_value(daily_high ignore nulls) over w as daily_high,
         last_value(daily_low ignore nulls) over w as daily_low, last_value(daily_close ignore nulls) over w as daily_close,
         last_value(daily_volume ignore nulls) over w as daily_volume, cnt is null as is_filled
  from spine left join daily using (symbol, date)
  window w as (partition by symbol order by date rows unbounded preceding))
select * from carried where daily_close is not null""",
    ),
)
def backfill_fill(t: Tables) -> DataFrame:
    fetched = inputs.daily(t).drop("cnt")
    return calendar.fill_calendar(fetched, volume_policy="carry", until=F.lit(AS_OF).cast("date"))


@query("model_input", sql_with(*FILLED, body="select date as ds, daily_close as y, symbol from filled"))
def model_input_rows(t: Tables) -> DataFrame:
    return model_input(calendar.fill_calendar(inputs.daily(t)))
