import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from tidemark import plans
from tidemark.plans.speed import messages_to_daily
from tidemark.sinks import read_version
from tidemark.streaming import read_closed, read_rejects, read_stats, stop_all

DAY = 86_400
START = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
DAYS = 120


def price(day, k):
    return round(100 + day * 0.3 + 5 * math.sin(day) + k, 2)


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    """Two raw CSV series with different headers; day 7 of the first one is missing."""
    root = tmp_path_factory.mktemp("chain")
    sources = {}
    for symbol, header in (("BTCUSDT", "Timestamp,Open,High,Low,Close,Volume"), ("ETHUSDT", "timestamp,open,high,low,close,volume")):
        lines = [header]
        for day in range(DAYS):
            if symbol == "BTCUSDT" and day == 7:
                continue
            for k in range(3):
                p = price(day, k)
                lines.append(f"{START + day * DAY + k * 3600}.0,{p},{p + 1},{p - 1},{'' if k == 1 else p},2")
        lines.append(lines[-1])  # one exact copy
        sources[symbol] = str(root / f"{symbol}.csv")
        (root / f"{symbol}.csv").write_text("\n".join(lines) + "\n")
    layout = plans.Layout(str(root / "tables"))
    plans.convert(spark, layout, sources)
    return layout


def test_batch_chain(spark, layout, tmp_path):
    counts = plans.clean(spark, layout)
    assert counts == {"rows_in": 3 * (2 * DAYS - 1) + 2, "rows_clean": 3 * (2 * DAYS - 1)}
    plans.daily(spark, layout)
    raw = spark.read.parquet(layout.daily_raw)
    assert raw.count() == 2 * DAYS - 1
    row = raw.filter("symbol = 'BTCUSDT' and date = '2024-01-02'").first()
    assert (row.daily_open, row.daily_close, row.daily_volume, row.cnt) == (price(1, 0), price(1, 2), 6.0, 3)
    gaps = spark.read.option("header", True).csv(layout.report("large_gaps"))
    assert gaps.count() == 100 and int(gaps.agg(F.max(F.col("gap").cast("int"))).first()[0]) == DAY * 2 - 2 * 3600

    plans.fill(spark, layout)
    filled = plans.read_daily(spark, layout)
    assert filled.count() == 2 * DAYS and filled.filter("is_filled").count() == 1
    missing = spark.read.option("header", True).csv(layout.report("missing_days")).collect()
    assert [(r.date, r.symbol) for r in missing] == [("2024-01-08", "BTCUSDT")]
    assert plans.read_model_input(spark, layout).columns == ["ds", "y", "symbol"]
    for name, n in (("top_price_change_days", 10), ("top_volume_days", 10), ("avg_volume_per_month", 8), ("avg_return_per_year", 2)):
        assert spark.read.option("header", True).csv(layout.report(name)).count() == n
    assert spark.sql("select count(*) from daily_series").first()[0] == 2 * DAYS

    # Backfill from landed pages: the last stored day again (ignored), two new days, one hole.
    pages = tmp_path / "pages"
    pages.mkdir()
    for symbol in ("BTCUSDT", "ETHUSDT"):
        bars = [[(START + d * DAY) * 1000, "1", "2", "0.5", "1.5", "3", 0, "0", 1, "0", "0", "0"] for d in (DAYS - 1, DAYS, DAYS + 2)]
        (pages / f"{symbol}_1.json").write_text(json.dumps(bars) + "\n")
    plans.backfill(spark, layout, str(pages), str(dt.date(2024, 1, 1) + dt.timedelta(days=DAYS + 3)))
    grown = plans.read_daily(spark, layout)
    assert grown.count() == 2 * (DAYS + 4)
    assert grown.filter("symbol = 'BTCUSDT'").orderBy(F.desc("date")).first().daily_close == 1.5
    kept = grown.filter(F.col("date") == F.lit(dt.date(2024, 1, 1) + dt.timedelta(days=DAYS - 1))).filter("symbol = 'BTCUSDT'").first()
    assert kept.daily_close == price(DAYS - 1, 2)

    # Speed layer: one overlapping day (batch wins) and one new day.
    assert plans.merge(spark, layout) is False
    messages = [
        json.dumps({"symbol": "BTCUSDT", "event_time": (START + d * DAY + s) * 1000, "price": 50.0 + s, "open": 50.0, "high": 60.0, "low": 40.0, "volume": 1.0})
        for d in (DAYS + 3, DAYS + 4)
        for s in (5, 1)
    ]
    broker = spark.createDataFrame([(m.encode(), i) for i, m in enumerate([*messages, "{bad"])], "value binary, kafka_offset bigint")
    broker = broker.select("value", F.current_timestamp().alias("kafka_timestamp"), F.lit(0).alias("kafka_partition"), "kafka_offset")
    messages_to_daily(broker, layout)
    assert spark.read.parquet(layout.path("speed_rejects")).count() == 1
    assert plans.merge(spark, layout) is True
    served = plans.read_daily(spark, layout)
    assert served.count() == 2 * (DAYS + 4) + 1
    last = served.filter("symbol = 'BTCUSDT'").orderBy(F.desc("date")).limit(2).collect()
    assert [r.daily_close for r in last] == [55.0, 1.5]

    plans.train(spark, layout)
    metrics = spark.read.option("header", True).csv(layout.model("metrics")).collect()
    assert {r.symbol for r in metrics} == {"BTCUSDT", "ETHUSDT"} and all(float(r.cv_mape) >= 0 for r in metrics)
    forecasts = read_version(spark, layout.model("forecasts"))
    assert forecasts.filter("y is null").groupBy("symbol").count().first()["count"] == 30
    assert spark.read.option("header", True).csv(layout.model("actual_vs_pred")).columns == ["symbol", "ds", "yhat", "y", "error", "abs_error", "pct_error"]


def test_speed_layer_queries(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    lines = [json.dumps({"symbol": "A", "event_time": (START + d * DAY) * 1000, "price": float(d), "open": 1.0, "high": 2.0, "low": 0.5, "volume": 1.0}) for d in range(4)]
    (feed / "1.json").write_text("\n".join([*lines, "{broken"]) + "\n")
    raw = spark.readStream.text(str(feed)).select(
        "value", F.current_timestamp().alias("kafka_timestamp"), F.lit(0).alias("kafka_partition"), F.lit(0).cast("bigint").alias("kafka_offset")
    )
    layout = plans.Layout(str(tmp_path / "tables"))
    for stats in ("table", "snapshot"):
        for query in plans.start_speed_layer(raw, layout, every=None, stats=stats):
            query.awaitTermination()
        stop_all(spark)
    sinks = layout.speed_sinks
    assert read_closed(spark, sinks).count() == plans.read_speed_layer(spark, layout).count() == 2
    assert read_stats(spark, sinks).count() == read_version(spark, layout.path("speed_stream", "stats")).count() == 4
    assert spark.read.parquet(layout.speed_daily[1]).count() == 2
    for found in (read_rejects(spark, sinks), spark.read.parquet(layout.path("speed_stream", "rejects"))):
        assert [r.raw for r in found.collect()] == ["{broken"]
