"""Headline timings: one JSON line.

Reads ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``. Every query is run to
completion into a no-op sink after one warm-up of the session; the figure of a query is the
best of ``$BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import time

from tidemark import catalog, plans
from tidemark.catalog import inputs
from tidemark.catalog.registry import Tables
from tidemark.functions import day_of
from tidemark.operators.resample import daily_bars
from tidemark.session import build_session
from tidemark.sinks import write_csv
from tidemark.sources.storage import scratch_dir

HEADLINE = (
    "daily_ohlcv",
    "tick_daily",
    "fill_calendar",
    "moving_averages",
    "backfill_fill",
    "merge_layers",
    "dedup_bars",
    "duplicate_keys",
    "ffill_bars",
    "clean_bars",
    "large_gaps",
    "missing_days",
    "ohlcv_by_join",
    "normalize_bars",
    "kline_normalize",
    "parse_messages",
    "top_price_change_days",
    "avg_volume_per_month",
    "stage_audit",
    "dataset_profile",
    "forecast_metrics",
    "stream_daily_ohlcv",
    "stream_stats_table",
    "forecast",
    "cv_metrics",
)

PUBLISHED_ROWS_PER_SEC = {"csv_to_parquet": 96_000, "bars_to_daily": 256_000}


def timed(run, runs: int) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "tidemark-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables, named = Tables(spark, sf_dir), catalog.queries()
    tables.lineitem.write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINE:
        seconds[name] = timed(lambda q=named[name]: q(spark, sf_dir).write.format("noop").mode("overwrite").save(), runs)

    # The stored chain: text bars to Parquet, then minute bars to daily bars.
    rows = tables.lineitem.count()
    layout = plans.Layout(scratch_dir(spark, "bench"))
    text = layout.path("raw")
    bars = inputs.line_bars(tables).select("timestamp", "open", "high", "low", "close", "volume")
    write_csv(bars, text)
    seconds["csv_to_parquet"] = timed(lambda: plans.convert(spark, layout, {"LINES": text}), runs)
    # The other stored jobs, once each: they build on one another.
    seconds["plans_clean"] = timed(lambda: plans.clean(spark, layout), 1)
    seconds["plans_daily"] = timed(lambda: plans.daily(spark, layout), 1)
    seconds["plans_fill"] = timed(lambda: plans.fill(spark, layout), 1)
    seconds["plans_merge"] = timed(lambda: plans.merge(spark, layout), 1)
    seconds["plans_train"] = timed(lambda: plans.train(spark, layout), 1)
    stored = daily_bars(spark.read.parquet(layout.bars), day_of("datetime"), ["timestamp", "close"])
    seconds["bars_to_daily"] = timed(lambda: stored.write.format("noop").mode("overwrite").save(), runs)
    rates = {f"{stage}_rows_per_sec": round(rows / seconds[stage]) for stage in PUBLISHED_ROWS_PER_SEC}

    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rates": rates,
                "published_rows_per_sec": PUBLISHED_ROWS_PER_SEC,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
