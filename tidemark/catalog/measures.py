"""Sketches, footers, positions and event tables over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.forecasts import FRAME, _frame
from tidemark.catalog.inputs import FILLED_MA, line_bars, sql_with
from tidemark.catalog.registry import Tables, query
from tidemark.forecast import event_table_features
from tidemark.operators.normalize import with_derived
from tidemark.operators.positions import with_positions
from tidemark.operators.quality import series_marks
from tidemark.operators.sketches import DISTINCT_ERROR, QUANTILES, RANK_ERROR, read_sketches, sketch_profile, store_sketches
from tidemark.sinks import write_partitioned
from tidemark.sources.storage import scratch_dir

SKETCHED = ("l_extendedprice", "l_partkey", "l_shipdate")
CHANGED_YEAR = "1995"


def _all_of(columns: tuple[str, ...]) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", count(*) as rows, count(*) - count({c}) as nulls, true as ranks_within, true as distinct_within from lineitem"""
        for c in columns
    )


@query("profile_sketches", _all_of(SKETCHED))
def profile_sketches(t: Tables) -> DataFrame:
    """Merged sketches of all years, one of them made again after its rows changed, against exact ranks and counts."""
    path = f"{scratch_dir(t.spark, 'sketches')}/table"
    rows, year = t.lineitem, F.year("l_shipdate")
    is_late = year.cast("string") == CHANGED_YEAR
    store_sketches(rows.filter(~is_late | (F.col("l_orderkey") % 2 == 0)), path, SKETCHED, year)
    store_sketches(rows.filter(is_late), path, SKETCHED, year)
    profile = sketch_profile(read_sketches(t.spark, path))
    # One row per column.
    found = {r["column"]: r for r in profile.collect()}
    exact = []
    for c in SKETCHED:
        exact.append(F.count_distinct(c).alias(f"{c}|d"))
        for i, _ in enumerate(QUANTILES, start=1):
            at = found[c][f"q{i}"]
            if at is not None:
                exact += [F.count_if(F.col(c) < at).alias(f"{c}|lt{i}"), F.count_if(F.col(c) <= at).alias(f"{c}|le{i}")]
    true = rows.agg(*exact).first()
    out = []
    for c in SKETCHED:
        n = found[c]["rows"] - found[c]["nulls"]
        off = [
            max(true[f"{c}|lt{i}"] / n - p, p - true[f"{c}|le{i}"] / n, 0.0)
            for i, p in enumerate(QUANTILES, start=1)
            if found[c][f"q{i}"] is not None
        ]
        near = abs(found[c]["distinct"] - true[f"{c}|d"]) <= DISTINCT_ERROR * true[f"{c}|d"]
        out.append((c, max(off, default=0.0) <= RANK_ERROR, near))
    judged = t.spark.createDataFrame(out, "column string, ranks_within boolean, distinct_within boolean")
    return profile.select("column", "rows", "nulls").join(judged, "column")


@query(
    "footer_marks",
    sql_with("line_bars", body='select symbol, min("timestamp") as first, max("timestamp") as last, count(*) as rows from line_bars group by 1'),
)
def footer_mark_rows(t: Tables) -> DataFrame:
    """Marks of every series of a stored bar table, answered from Parquet footers."""
    path = scratch_dir(t.spark, "footers")
    write_partitioned(with_derived(line_bars(t).drop("l_orderkey", "l_linenumber")), path)
    return series_marks(t.spark, path)


@query(
    "global_positions",
    """select l_orderkey, l_linenumber, l_extendedprice,
       row_number() over (order by l_extendedprice desc, l_orderkey, l_linenumber) as position from lineitem""",
)
def global_positions(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return with_positions(rows, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"])


LARGE_ORDER = 350_000.0


@query(
    "event_table_features",
    sql_with(
        *FILLED_MA,
        body=f""", {FRAME},
found as (
  select o_orderpriority as symbol, 'large_' || o_orderstatus as name, cast(o_orderdate as date) as day, -3 as lower, cast(o_orderkey % 40 as integer) as upper
  from orders where o_totalprice > {LARGE_ORDER}),
keys as (
  select distinct f.symbol, f.ds, e.name || '_' || cast(date_diff('day', e.day, f.ds) as varchar) as k
  from frame f join found e on f.symbol = e.symbol and f.ds between e.day + e.lower and e.day + e.upper)
select f.symbol, f.ds, coalesce(string_agg(k, ',' order by k), '') as event_keys
from frame f left join keys using (symbol, ds) group by 1, 2""",
    ),
)
def event_table_rows(t: Tables) -> DataFrame:
    """Large orders as events of their priority, with windows of many lengths."""
    large = t.orders.filter(F.col("o_totalprice") > LARGE_ORDER)
    events = large.select(
        F.col("o_orderpriority").alias("symbol"),
        F.concat(F.lit("large_"), "o_orderstatus").alias("name"),
        F.to_date("o_orderdate").alias("day"),
        F.lit(-3).alias("lower"),
        (F.col("o_orderkey") % 40).cast("int").alias("upper"),
    )
    marked = event_table_features(_frame(t), events)
    return marked.select("symbol", "ds", F.array_join("event_keys", ",").alias("event_keys"))
