"""Duplicates, gaps, coverage, fills on raw bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.inputs import (
    DAILY,
    FILLED,
    LINE_ORDER,
    MONEY,
    daily,
    daily_filled,
    line_bars,
    order_bars,
    sql_with,
    tick_bars,
    ticks,
)
from tidemark.catalog.registry import Tables, query
from tidemark.functions.times import epoch_day
from tidemark.operators import calendar, fill, quality
from tidemark.operators.normalize import union_sources
from tidemark.operators.resample import daily_bars_by_join

UNIQUE_TICK_BARS = """uniq as (
  select * from tick_bars qualify row_number() over (partition by symbol, "timestamp" order by bar_id) = 1)"""


@query(
    "dedup_bars",
    sql_with(
        "line_bars",
        body="""select symbol, "timestamp", l_orderkey, l_linenumber, price as open, price as high, price as low,
       price as close, volume
from line_bars
qualify row_number() over (partition by symbol, "timestamp" order by l_orderkey, l_linenumber, price, volume) = 1""",
    ),
)
def dedup_bars(t: Tables) -> DataFrame:
    return quality.keep_first(line_bars(t), ["symbol", "timestamp"], LINE_ORDER)


@query(
    "duplicate_keys",
    sql_with(
        "line_bars",
        body='select symbol, "timestamp", count(*) as count from line_bars group by 1, 2 having count(*) > 1',
    ),
)
def duplicate_keys(t: Tables) -> DataFrame:
    return quality.duplicate_keys(line_bars(t), ["symbol", "timestamp"])


@query(
    "per_day_counts",
    sql_with("ticks", body="select symbol, cast(ts as date) as date, count(*) as count from ticks group by 1, 2"),
)
def per_day_counts(t: Tables) -> DataFrame:
    return quality.per_day_counts(ticks(t), ts="event_timestamp")


@query(
    "day_bounds",
    sql_with(
        "tick_bars",
        body="""select symbol, cast(to_timestamp("timestamp") at time zone 'UTC' as date) as date,
       min("timestamp") as min_ts, max("timestamp") as max_ts
from tick_bars group by 1, 2""",
    ),
)
def day_bounds(t: Tables) -> DataFrame:
    return quality.day_bounds(tick_bars(t), day=F.date_from_unix_date(epoch_day("timestamp").cast("int")))


@query(
    "large_gaps",
    sql_with(
        "tick_bars",
        body=f""", {UNIQUE_TICK_BARS},
lagged as (select *, lag("timestamp") over (partition by symbol order by "timestamp") as prev_ts from uniq)
select bar_id, symbol, "timestamp", price as open, price as high, price as low, price as close, volume,
       prev_ts, "timestamp" - prev_ts as gap
from lagged where "timestamp" - prev_ts > 60
order by gap desc, symbol, "timestamp" limit 100""",
    ),
)
def large_gaps(t: Tables) -> DataFrame:
    return quality.large_gaps(tick_bars(t), threshold=60, top=100, order_by=["bar_id"])


@query(
    "missing_days",
    """with daily as (select user_id, cast(ts as date) as date from events group by 1, 2),
spine as (
  select user_id, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
  from daily group by 1)
select user_id, date from spine anti join daily using (user_id, date)""",
)
def missing_days(t: Tables) -> DataFrame:
    days = t.events.select("user_id", F.to_date("ts").alias("date")).distinct()
    return calendar.missing_days(days, key="user_id")


@query(
    "coverage",
    sql_with(
        *DAILY,
        body="select symbol, count(*) as rows, min(date) as first_date, max(date) as last_date from daily group by 1",
    ),
)
def coverage(t: Tables) -> DataFrame:
    return quality.coverage(daily(t))


@query("high_water_mark", sql_with(*DAILY, body="select symbol, max(date) as last_date from daily group by 1"))
def high_water_mark(t: Tables) -> DataFrame:
    return quality.high_water_mark(daily(t))


@query(
    "stage_audit",
    sql_with(
        "tick_bars",
        body="""select symbol, count(*) as rows_in, count(*) filter (price is null or volume is null) as rows_with_null,
       count(*) - count(distinct "timestamp") as rows_repeated, count(distinct "timestamp") as rows_unique
from tick_bars group by 1""",
    ),
)
def stage_audit(t: Tables) -> DataFrame:
    return quality.stage_audit(tick_bars(t), "symbol", "timestamp", ("open", "high", "low", "close", "volume"))


@query(
    "dataset_profile",
    sql_with(
        *FILLED,
        body="\nunion all\n".join(
            f"""select '{c}' as column_name, '{"bigint" if c == "cnt" else "double"}' as data_type, count(*) as row_count, count(*) - count({c}) as null_count,
       cast(min({c}) as double) as min_value, cast(max({c}) as double) as max_value,
       round(avg({c}), 4) as mean_value, round(stddev_samp({c}), 4) as std_value,
       cast(null as varchar) as first_value, cast(null as varchar) as last_value from filled"""
            for c in ("daily_open", "daily_high", "daily_low", "daily_close", "daily_volume", "cnt")
        )
        + "".join(
            f"""
union all
select '{c}', '{kind}', count(*), count(*) - count({c}), null, null, null, null, cast(min({c}) as varchar), cast(max({c}) as varchar) from filled"""
            for c, kind in (("date", "date"), ("symbol", "string"))
        ),
    ),
)
def dataset_profile(t: Tables) -> DataFrame:
    columns = ("daily_open", "daily_high", "daily_low", "daily_close", "daily_volume", "cnt", "date", "symbol")
    profile = quality.dataset_profile(daily_filled(t), columns)
    return profile.withColumns({c: F.round(c, 4) for c in ("mean_value", "std_value")})


FILLED_TICK_BARS = f"""{UNIQUE_TICK_BARS},
carried as (
  select symbol, "timestamp", bar_id, last_value(price ignore nulls) over w as price,
         coalesce(last_value(volume ignore nulls) over w, 0) as volume
  from uniq window w as (partition by symbol order by "timestamp" rows unbounded preceding))"""


@query(
    "ffill_bars",
    sql_with(
        "tick_bars",
        body=f""", {FILLED_TICK_BARS}
select symbol, "timestamp", bar_id, price as open, price as high, price as low, price as close, volume from carried""",
    ),
)
def ffill_bars(t: Tables) -> DataFrame:
    unique = quality.keep_first(tick_bars(t), ["symbol", "timestamp"], ["bar_id"])
    return fill.fill_bars(unique)


@query(
    "clean_bars",
    f"""with tick_bars as (
  select event_id as bar_id, event_type as symbol, cast(floor(epoch(ts)) as bigint) as "timestamp",
         case when value >= 5.0 then value end as price,
         case when value >= 5.0 then cast(json_extract_string(props, '$.k') as double) end as volume
  from events
  union all
  select o_orderkey, o_orderpriority, cast(epoch(o_orderdate) as bigint), o_totalprice, o_totalprice from orders),
{FILLED_TICK_BARS}
select symbol, "timestamp", bar_id, price as open, price as high, price as low, price as close, volume
from carried where price is not null""",
)
def clean_bars(t: Tables) -> DataFrame:
    both = union_sources([tick_bars(t), order_bars(t).drop("day")])
    return fill.clean_bars(both, ["bar_id"])


@query(
    "ohlcv_by_join",
    sql_with(
        "tick_bars",
        body=f""", {UNIQUE_TICK_BARS}
select symbol, cast(to_timestamp("timestamp") at time zone 'UTC' as date) as date,
       arg_min_null(price, "timestamp") as daily_open, max(price) as daily_high, min(price) as daily_low,
       arg_max_null(price, "timestamp") as daily_close, cast(sum(cast(volume as decimal(18,2))) as double) as daily_volume,
       count(*) as cnt
from uniq group by 1, 2""",
    ),
)
def ohlcv_by_join(t: Tables) -> DataFrame:
    unique = quality.keep_first(tick_bars(t), ["symbol", "timestamp"], ["bar_id"])
    day = F.date_from_unix_date(epoch_day("timestamp").cast("int"))
    return daily_bars_by_join(unique, day, scale=MONEY)
