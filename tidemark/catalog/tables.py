"""Stored tables and jobs: written below the shared scratch folder, read back, compared with SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import plans
from tidemark.catalog.inputs import DAILY, LAYERS, batch_layer, daily, line_bars, order_bars, speed_layer, sql_with, tick_bars
from tidemark.catalog.registry import Tables, query
from tidemark.functions import with_calendar_parts
from tidemark.operators import layers
from tidemark.operators.calendar import moving_averages
from tidemark.operators.normalize import with_derived
from tidemark.operators.types import FORMS
from tidemark.sinks import append_staging, read_version, write_csv, write_partitioned, write_version
from tidemark.sources import csv_types, read_csv_text, read_first_available
from tidemark.sources.storage import scratch_dir

AS_OF = dt.date(2001, 8, 31)


@query(
    "csv_roundtrip",
    sql_with("line_bars", body='select l_orderkey, l_linenumber, symbol, "timestamp", price as close, volume from line_bars'),
)
def csv_roundtrip(t: Tables) -> DataFrame:
    out = scratch_dir(t.spark, "csv")
    source = line_bars(t).select("l_orderkey", "l_linenumber", "symbol", "timestamp", "close", "volume")
    write_csv(source, out)
    return read_csv_text(t.spark, out).select(*[F.col(c).cast(k).alias(c) for c, k in source.dtypes])


# Readings that no sensor wrote, and stamps of no day, in every so many rows.
ODD_VALUE, ODD_STAMP = 101, 367
_FORMS = {name: form for name, (form, _) in FORMS.items()}
_IS = {
    "integer": f"regexp_matches(v, '{_FORMS['integer']}')",
    "double": f"regexp_matches(v, '{_FORMS['double']}')",
    "stamp": f"(regexp_matches(v, '{_FORMS['stamp']}') and try_cast(v as timestamp) is not null)",
}
_LEAST = "case " + " ".join(f"when {{}} then '{name}'" for name in _IS) + " else 'text' end"


@query(
    "csv_inferred_types",
    f"""with raw as (
  select event_id, cast(event_id as varchar) as id, strftime(ts, '%Y-%m-%d %H:%M:%S') as "at", event_type as kind,
         case when event_id % {ODD_VALUE} = 0 then 'n/a' when event_id % 3 = 0 then '' else cast(cast(floor(value * 100) / 100 as decimal(18,2)) as varchar) end as value,
         case when event_id % {ODD_STAMP} = 0 then '2024-02-30' else cast(cast(ts as date) as varchar) end as day
  from events),
cells as (
  select 'id,at,kind' as header, unnest(['id', 'at', 'kind']) as "column", unnest([id, "at", kind]) as v from raw where event_id % 2 = 0
  union all
  select 'day,value,id', unnest(['day', 'value', 'id']), unnest([day, value, id]) from raw where event_id % 2 = 1),
judged as (
  select header, "column", nullif(v, '') as v, {", ".join(f"{form} as is_{name}" for name, form in _IS.items())} from cells),
counted as (
  select header, "column", count(*) as rows, count(v) as n, {", ".join(f"count(*) filter (v is not null and is_{t}) as n_{t}, min(v) filter (v is not null and not is_{t}) as not_{t}" for t in _IS)}
  from judged group by 1, 2),
typed as (
  select *, {_LEAST.format(*[f"n_{t} = n and n > 0" for t in _IS])} as inferred, {_LEAST.format(*[f"2 * n_{t} > n" for t in _IS])} as leaning from counted)
select header, "column", inferred, leaning, rows, rows - n as nulls,
       n - case leaning {" ".join(f"when '{t}' then n_{t}" for t in _IS)} else n end as conflicts,
       case leaning {" ".join(f"when '{t}' then not_{t}" for t in _IS)} end as offender
from typed""",
)
def csv_inferred_types(t: Tables) -> DataFrame:
    """Two header families of CSV files, some values of the wrong kind: types of all columns, conflicts and first offenders."""
    out = scratch_dir(t.spark, "csv-types")
    at, key = F.col("ts").cast("timestamp"), F.col("event_id")
    money = (F.floor(F.col("value") * 100) / 100).cast("decimal(18,2)").cast("string")
    rows = t.events.select(
        "event_id",
        key.cast("string").alias("id"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.col("event_type").alias("kind"),
        F.when(key % ODD_VALUE == 0, "n/a").when(key % 3 == 0, "").otherwise(money).alias("value"),
        F.when(key % ODD_STAMP == 0, "2024-02-30").otherwise(F.to_date(at).cast("string")).alias("day"),
    )
    write_csv(rows.filter("event_id % 2 = 0").select("id", "at", "kind"), f"{out}/even")
    write_csv(rows.filter("event_id % 2 = 1").select("day", "value", "id"), f"{out}/odd")
    return csv_types(t.spark, [f"{out}/even", f"{out}/odd"])


@query(
    "partitioned_roundtrip",
    """select l_orderkey, lpad(cast(l_linenumber as varchar), 3, '0') as symbol, cast(year(l_shipdate) as varchar) as year,
       cast(month(l_shipdate) as varchar) as month, l_extendedprice as close from lineitem""",
)
def partitioned_roundtrip(t: Tables) -> DataFrame:
    """Series named 001, 002, ... come back as written."""
    out = scratch_dir(t.spark, "bars")
    bars = with_derived(line_bars(t).withColumn("symbol", F.lpad(F.col("l_linenumber").cast("string"), 3, "0")))
    write_partitioned(bars, out)
    text = ", ".join(f"`{n}` {'string' if n in ('symbol', 'year', 'month') else k}" for n, k in bars.dtypes)
    return t.spark.read.schema(text).parquet(out).select("l_orderkey", "symbol", "year", "month", "close")


@query(
    "overwrite_touched",
    sql_with(
        *DAILY,
        body="select symbol, date, case when year(date) = 1997 then -daily_close else daily_close end as daily_close from daily",
    ),
)
def overwrite_touched(t: Tables) -> DataFrame:
    """Only the partitions of 1997 are replaced."""
    out = scratch_dir(t.spark, "touched")
    table = with_calendar_parts(daily(t).select("symbol", "date", "daily_close"), "date").drop("month")
    write_partitioned(table, out, ("year",))
    changed = table.filter("year = 1997").withColumn("daily_close", -F.col("daily_close"))
    write_partitioned(changed, out, ("year",), only_touched=True)
    return t.spark.read.parquet(out).select("symbol", "date", "daily_close")


@query(
    "versioned_update",
    sql_with(
        *DAILY,
        body="""select symbol, date, daily_close * 2 as daily_close, 1 as back from daily where date <= date '2000-12-31'
union all select symbol, date, case when date <= date '2000-12-31' then daily_close * 2 else daily_close end, 0 from daily""",
    ),
)
def versioned_update(t: Tables) -> DataFrame:
    """A table computed from its own last version; the version before it stays readable."""
    out = scratch_dir(t.spark, "versions")
    table = daily(t).select("symbol", "date", "daily_close")
    early = F.col("date") <= F.lit("2000-12-31").cast("date")
    write_version(table.filter(early), out, (), cluster_by=("symbol",))
    write_version(read_version(t.spark, out).withColumn("daily_close", F.col("daily_close") * 2), out, (), cluster_by=("symbol",))
    write_version(read_version(t.spark, out).unionByName(table.filter(~early)), out, (), cluster_by=("symbol",))
    both = [read_version(t.spark, out, back).withColumn("back", F.lit(back)) for back in (0, 1)]
    return both[0].unionByName(both[1])


@query("staged_batches", "select o_orderkey, o_orderpriority as symbol, o_totalprice as close from orders")
def staged_batches(t: Tables) -> DataFrame:
    """Fetch batches by key, one of them fetched twice."""
    out = scratch_dir(t.spark, "staging")
    rows = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("symbol"), F.col("o_totalprice").alias("close"))
    for batch in (0, 1, 2, 1):
        append_staging(rows.filter(F.col("o_orderkey") % 3 == batch), out, f"batch-{batch}")
    return t.spark.read.parquet(*[f"{out}/batch-{b}" for b in range(3)])


@query("first_available", sql_with(*DAILY, body="select symbol, date, daily_close from daily"))
def first_available(t: Tables) -> DataFrame:
    out = scratch_dir(t.spark, "available")
    daily(t).select("symbol", "date", "daily_close").write.parquet(f"{out}/second")
    return read_first_available(t.spark, [f"{out}/first", f"{out}/second"])


@query(
    "clean_job",
    sql_with(
        "tick_bars",
        body=""", uniq as (
  select * from tick_bars
  qualify row_number() over (partition by symbol, "timestamp" order by price nulls first, volume nulls first) = 1),
carried as (
  select symbol, "timestamp", last_value(price ignore nulls) over w as close,
         coalesce(last_value(volume ignore nulls) over w, 0) as volume
  from uniq window w as (partition by symbol order by "timestamp" rows unbounded preceding))
select * from carried where close is not null""",
    ),
)
def clean_job(t: Tables) -> DataFrame:
    """The stored cleaning job, from a bar table on disk to one on disk."""
    layout = plans.Layout(scratch_dir(t.spark, "clean-job"))
    write_partitioned(with_derived(tick_bars(t).drop("bar_id")), layout.bars)
    plans.clean(t.spark, layout)
    return t.spark.read.parquet(layout.bars_clean).select("symbol", "timestamp", "close", "volume")


def _served_sql(fresh: str, until: str) -> str:
    """The merged table computed anew: stored days, fresh days behind them, holes filled, plain averages."""
    return f""", fresh as ({fresh}), merged as (
  select symbol, date, daily_open, daily_high, daily_low, daily_close, daily_volume
  from (select *, 0 as r from batch union all by name select *, 1 as r from fresh)
  qualify row_number() over (partition by symbol, date order by r) = 1),
days as (select symbol, cast(unnest(generate_series(min(date), {until}, interval 1 day)) as date) as date from merged group by 1),
served as (
  select symbol, date, last_value(daily_open ignore nulls) over w as daily_open, last_value(daily_high ignore nulls) over w as daily_high,
         last_value(daily_low ignore nulls) over w as daily_low, last_value(daily_close ignore nulls) over w as daily_close,
         last_value(daily_volume ignore nulls) over w as daily_volume
  from days left join merged using (symbol, date) window w as (partition by symbol order by date rows unbounded preceding))
select *, round(avg(daily_close) over (partition by symbol order by date rows 6 preceding), 3) as ma7,
       round(avg(daily_close) over (partition by symbol order by date rows 29 preceding), 3) as ma30 from served"""


def _served(t: Tables, layout: plans.Layout) -> DataFrame:
    columns = ("symbol", "date", "daily_open", "daily_high", "daily_low", "daily_close", "daily_volume")
    return plans.read_daily(t.spark, layout).select(*columns, F.round("ma7", 3).alias("ma7"), F.round("ma30", 3).alias("ma30"))


def _stored_batch(t: Tables, label: str) -> plans.Layout:
    layout = plans.Layout(scratch_dir(t.spark, label))
    plans.publish_daily(t.spark, layout, moving_averages(batch_layer(t)), volume_policy="carry")
    return layout


@query(
    "backfill_job",
    sql_with(
        *LAYERS,
        body=_served_sql(
            """select symbol, date, p as daily_open, p as daily_high, p as daily_low, p as daily_close, p as daily_volume
  from (select o_orderpriority as symbol, cast(o_orderdate as date) as date, arg_min(o_totalprice, o_orderkey) as p
        from orders where o_orderdate >= date '2001-07-10' group by 1, 2)""",
            f"date '{AS_OF}'",
        ),
    ),
)
def backfill_job(t: Tables) -> DataFrame:
    """Pages that start ten days behind the stored end: the hole and the tail are filled."""
    layout = _stored_batch(t, "backfill-job")
    firsts = order_bars(t).filter("day >= '2001-07-10'").groupBy("symbol", "timestamp").agg(F.min_by("close", "bar_id").alias("p"))
    kline = F.array((F.col("timestamp") * 1000).cast("string"), *[F.col("p").cast("string")] * 5)
    pages = firsts.select(F.regexp_replace("symbol", " ", "_").alias("series"), F.to_json(F.array(kline)).alias("value"))
    pages.write.partitionBy("series").text(layout.path("pages"))
    symbol = F.regexp_replace(F.regexp_extract("source_file", "series=([^/]+)/", 1), "_", " ")
    plans.backfill(t.spark, layout, layout.path("pages"), str(AS_OF), symbol=symbol)
    return _served(t, layout)


@query("merge_job", sql_with(*LAYERS, body=_served_sql("select * from speed", "max(date)")))
def merge_job(t: Tables) -> DataFrame:
    layout = _stored_batch(t, "merge-job")
    write_partitioned(speed_layer(t).drop("cnt"), layout.speed_daily[0], ("symbol",))
    plans.merge(t.spark, layout)
    return _served(t, layout)


@query(
    "backfill_ranges",
    sql_with(
        *DAILY,
        body=f"""select symbol, cast(max(date) + 1 as date) as first_day, date '{AS_OF}' as last_day,
       cast(date_diff('day', max(date), date '{AS_OF}') as integer) as days
from daily where date <= case when symbol = '5-LOW' then date '2001-09-30' else date '2001-03-31' end
group by 1 having date_diff('day', max(date), date '{AS_OF}') > 0""",
    ),
)
def backfill_ranges(t: Tables) -> DataFrame:
    end = F.when(F.col("symbol") == "5-LOW", F.lit("2001-09-30")).otherwise(F.lit("2001-03-31")).cast("date")
    return layers.backfill_ranges(daily(t).filter(F.col("date") <= end), F.lit(str(AS_OF)).cast("date"))
