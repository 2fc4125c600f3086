"""Reject tables: what the readers could not use, made from a predicate on the id over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.inputs import line_bars, sql_with, ticks
from tidemark.catalog.registry import Tables, query
from tidemark.operators.normalize import normalize_bars, readable, unreadable
from tidemark.sources.klines import kline_rejects, klines_to_bars
from tidemark.sources.messages import accepted, parse_messages, rejects

# Every seventh row is broken, every eleventh lacks its time.
BROKEN, UNTIMED = 7, 11


@query(
    "message_rejects",
    f"""select case when event_id % {BROKEN} = 0 then '{{broken ' || event_id
                    when event_id % {UNTIMED} = 0 then '{{"symbol":"' || event_type || '"}}' end as raw,
       case when event_id % {BROKEN} <> 0 and event_id % {UNTIMED} <> 0 then event_id end as event_id
from events""",
)
def message_rejects(t: Tables) -> DataFrame:
    """Rejects and accepted rows side by side: together they are the input."""
    good = F.to_json(F.struct("symbol", F.unix_millis("event_timestamp").alias("event_time"), "price"))
    value = (
        F.when(F.col("event_id") % BROKEN == 0, F.concat(F.lit("{broken "), F.col("event_id").cast("string")))
        .when(F.col("event_id") % UNTIMED == 0, F.to_json(F.struct("symbol")))
        .otherwise(good)
    )
    parsed = parse_messages(ticks(t).select("event_id", value.alias("value")), keep=("event_id",))
    lost = rejects(parsed).withColumn("event_id", F.lit(None).cast("bigint"))
    return lost.unionByName(accepted(parsed).select("event_id"), allowMissingColumns=True)


@query(
    "kline_rejects",
    f"""select o_orderkey, case when o_orderkey % {BROKEN} = 0 then 'page' when o_orderkey % {UNTIMED} = 0 then 'row' else 'bar' end as reason
from orders""",
)
def kline_reject_rows(t: Tables) -> DataFrame:
    stamp = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    stamp = F.when(F.col("o_orderkey") % UNTIMED == 0, F.lit("soon")).otherwise(stamp)
    row = F.array(stamp, *[F.col("o_totalprice").cast("string")] * 5)
    page = F.when(F.col("o_orderkey") % BROKEN == 0, F.lit("[broken")).otherwise(F.to_json(F.array(row)))
    pages = t.orders.select("o_orderkey", page.alias("page"))
    bars = klines_to_bars(pages, keep=("o_orderkey",)).select("o_orderkey", F.lit("bar").alias("reason"))
    return kline_rejects(pages, keep=("o_orderkey",)).select("o_orderkey", "reason").unionByName(bars)


@query(
    "bar_rejects",
    sql_with("line_bars", body=f"select l_orderkey, l_linenumber, l_orderkey % {BROKEN} <> 0 as kept from line_bars"),
)
def bar_rejects(t: Tables) -> DataFrame:
    stamp = F.when(F.col("l_orderkey") % BROKEN == 0, F.lit("n/a")).otherwise(F.col("timestamp").cast("string"))
    bars = normalize_bars(line_bars(t).withColumn("timestamp", stamp))
    kept, lost = (f(bars).select("l_orderkey", "l_linenumber", F.lit(flag).alias("kept")) for f, flag in ((readable, True), (unreadable, False)))
    return kept.unionByName(lost)
