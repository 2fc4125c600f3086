"""Incremental loads and layer merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import plans
from tidemark.catalog.inputs import DAILY, LAYERS, MONEY, batch_layer, daily, speed_layer, sql_with
from tidemark.catalog.registry import Tables, query
from tidemark.operators import layers
from tidemark.sources.storage import scratch_dir


@query(
    "merge_layers",
    sql_with(
        *LAYERS,
        body=""", merged as (
  select symbol, date, daily_open, daily_high, daily_low, daily_close, daily_volume
  from (select *, 0 as r from batch union all by name select *, 1 as r from speed)
  qualify row_number() over (partition by symbol, date order by r) = 1)
select *,
       cast(sum(cast(daily_close as decimal(18,2))) over w7 as double) / count(*) over w7 as ma7,
       cast(sum(cast(daily_close as decimal(18,2))) over w30 as double) / count(*) over w30 as ma30
from merged
window w7 as (partition by symbol order by date rows 6 preceding),
       w30 as (partition by symbol order by date rows 29 preceding)""",
    ),
)
def merge_layers(t: Tables) -> DataFrame:
    return layers.merge_layers([batch_layer(t), speed_layer(t)], scale=MONEY)


PRICES = ("daily_open", "daily_high", "daily_low", "daily_close")


@query(
    "merge_incremental",
    sql_with(
        *LAYERS,
        body=f""", merged as (
  select symbol, date, daily_open, daily_high, daily_low, daily_close, daily_volume, coalesce(is_filled, false) as is_filled
  from (select *, 0 as r from batch union all by name select *, 1 as r from speed)
  qualify row_number() over (partition by symbol, date order by r) = 1),
days as (select symbol, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date from merged group by 1),
served as (
  select symbol, date, {", ".join(f"last_value({c} ignore nulls) over w as {c}" for c in PRICES)},
         coalesce(daily_volume, 0) as daily_volume, coalesce(is_filled, true) as is_filled
  from days left join merged using (symbol, date) window w as (partition by symbol order by date rows unbounded preceding))
select *,
       cast(sum(cast(daily_close as decimal(18,2))) over w7 as double) / count(*) over w7 as ma7,
       cast(sum(cast(daily_close as decimal(18,2))) over w30 as double) / count(*) over w30 as ma30
from served
window w7 as (partition by symbol order by date rows 6 preceding),
       w30 as (partition by symbol order by date rows 29 preceding)""",
    ),
)
def merge_incremental(t: Tables) -> DataFrame:
    """The batch layer, published, and the speed layer merged into it in two steps, each writing only what it changes."""
    layout = plans.Layout(scratch_dir(t.spark, "merge-incremental"))
    plans.publish_daily(t.spark, layout, batch_layer(t).drop("cnt"))
    speed = speed_layer(t).drop("cnt")
    for last in ("2001-07-20", "9999-12-31"):
        plans.merge_daily(t.spark, layout, speed.filter(F.col("date") <= F.lit(last).cast("date")), scale=MONEY)
    return plans.read_daily(t.spark, layout).drop("year", "month")


@query(
    "layer_overlap",
    sql_with(*LAYERS, body="select symbol, date from batch intersect select symbol, date from speed"),
)
def layer_overlap(t: Tables) -> DataFrame:
    return layers.layer_overlap(batch_layer(t), speed_layer(t))


@query(
    "incremental_slice",
    sql_with(
        *DAILY,
        body=""", marks as (
  select symbol, max(date) as last_date from daily where cnt >= 2 and date <= date '2001-03-31' group by 1)
select d.* from daily d left join marks using (symbol)
where d.date <= date '2001-07-15' and (last_date is null or d.date > last_date)""",
    ),
)
def incremental_slice(t: Tables) -> DataFrame:
    fresh = daily(t)
    loaded = fresh.filter((F.col("cnt") >= 2) & (F.col("date") <= F.lit("2001-03-31").cast("date")))
    return layers.incremental_slice(fresh, loaded, F.lit("2001-07-15").cast("date"))
