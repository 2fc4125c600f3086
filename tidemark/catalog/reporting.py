"""Report tables over the gap-free daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.catalog.inputs import FILLED, FILLED_MA, MONEY, daily, daily_filled, sql_with
from tidemark.catalog.registry import Tables, query
from tidemark.operators import reports
from tidemark.operators.calendar import fill_calendar

PCT_SCALE = 6  # decimals kept when percentages are averaged exactly


@query(
    "top_price_change_days",
    sql_with(
        *FILLED,
        body="""select symbol, date, round(abs((daily_close - daily_open) / daily_open) * 100.0::double, 6) as price_change_percent
from filled order by 3 desc, 1, 2 limit 10""",
    ),
)
def top_price_change_days(t: Tables) -> DataFrame:
    return reports.top_price_change_days(fill_calendar(daily(t)))


@query(
    "top_volume_days",
    sql_with(*FILLED, body="select symbol, date, daily_volume from filled order by 3 desc, 1, 2 limit 10"),
)
def top_volume_days(t: Tables) -> DataFrame:
    return reports.top_volume_days(fill_calendar(daily(t)))


@query(
    "avg_volume_per_month",
    sql_with(
        *FILLED,
        body="""select symbol, strftime(date, '%Y-%m') as month,
       cast(sum(cast(daily_volume as decimal(18,2))) as double) / count(*) as avg_volume
from filled group by 1, 2""",
    ),
)
def avg_volume_per_month(t: Tables) -> DataFrame:
    return reports.avg_volume_per_month(fill_calendar(daily(t)), scale=MONEY)


@query(
    "avg_return_per_year",
    sql_with(
        *FILLED,
        body="""select symbol, cast(year(date) as integer) as year,
       cast(sum(cast((daily_close - daily_open) / daily_open * 100.0::double as decimal(18,6))) as double) / count(*) as avg_return
from filled group by 1, 2""",
    ),
)
def avg_return_per_year(t: Tables) -> DataFrame:
    return reports.avg_return_per_year(fill_calendar(daily(t)), scale=PCT_SCALE)


@query(
    "last_n_days",
    sql_with(
        *FILLED_MA,
        body="""select symbol, date, daily_close, daily_volume, ma7, ma30 from filled_ma
qualify row_number() over (partition by symbol order by date desc) <= 90""",
    ),
)
def last_n_days(t: Tables) -> DataFrame:
    newest = reports.last_n(daily_filled(t), 90)
    return newest.select("symbol", "date", "daily_close", "daily_volume", "ma7", "ma30")
