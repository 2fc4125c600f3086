import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import epoch_to_timestamp
from tidemark.operators.normalize import HeaderClash, normalize_bars, normalize_headers
from tidemark.schemas import MissingColumns, require_columns
from tidemark.operators.types import infer_types
from tidemark.sources import csv_families, kline_rejects, klines_to_bars, parse_messages, read_bars, read_csv_typed, read_first_available, read_kline_pages, ticker_to_messages, topic_options
from tidemark.sources.messages import accepted, rejects


@pytest.mark.parametrize("header", ["Timestamp,Open,High,Low,Close,Volume", "unix,open_,high,low,close,volume_btc"])
def test_csv_headers_of_either_spelling(spark, tmp_path, header):
    path = tmp_path / "bars.csv"
    path.write_text(header + "\n1325412060.0,4.5,4.6,4.4,4.5,0.5\n1325412120,bad,1,1,1,1\n")
    rows = read_bars(spark, str(path), "BTC").orderBy("timestamp").collect()
    assert [r.timestamp for r in rows] == [1325412060, 1325412120]
    assert (rows[0].open, rows[0].volume, rows[0].symbol, rows[0].year, rows[0].month) == (4.5, 0.5, "BTC", 2012, 1)
    assert rows[1].open is None and rows[1].close == 1.0


def test_header_order_does_not_matter(spark, tmp_path):
    path = tmp_path / "bars.csv"
    path.write_text("Close,Volume,ts,Low,High,Open\n3,9,60,1,4,2\n")
    row = read_bars(spark, str(path), "A").first()
    assert (row.open, row.high, row.low, row.close, row.volume, row.timestamp) == (2, 4, 1, 3, 9, 60)


def test_epoch_unit_is_explicit(spark):
    df = spark.createDataFrame([(1609459200000, 1609459200, 1609459200000000)], "ms bigint, s bigint, us bigint")
    row = df.select(*[epoch_to_timestamp(c, c).cast("string").alias(c) for c in ("ms", "s", "us")]).first()
    assert set(row) == {"2021-01-01 00:00:00"}
    with pytest.raises(ValueError):
        epoch_to_timestamp("s", "minutes")


def test_millisecond_bars_are_stored_in_seconds(spark):
    raw = spark.createDataFrame([(1609459200000, 1.0, 1.0, 1.0, 1.0, 1.0)], "timestamp bigint, open double, high double, low double, close double, volume double")
    row = normalize_bars(raw, "A", epoch_unit="ms").first()
    assert row.timestamp == 1609459200 and row.year == 2021


def test_two_headers_for_one_column_are_an_error(spark):
    with pytest.raises(HeaderClash):
        normalize_headers(spark.createDataFrame([(1, 2)], "ts int, unix int"))


def test_missing_columns_fail_before_any_job(spark):
    with pytest.raises(MissingColumns):
        require_columns(spark.range(1), ["nope"])


def test_kline_pages_from_files(spark, tmp_path, rows_of):
    good = '[[60000,"1","2","0.5","1.5","10",119999,"15",7,"5","6","0"],[120000,"1.5","3","1","2","x",179999,"1",1,"1","1","0"]]'
    (tmp_path / "ETHUSDT_1.json").write_text(good + "\nnot json\n[]\n")
    pages = read_kline_pages(spark, str(tmp_path)).withColumn("symbol", F.regexp_extract("source_file", r"([A-Z]+)_\d+\.json", 1))
    bars = klines_to_bars(pages)
    assert rows_of(bars, "symbol", "timestamp", "open", "close", "volume") == [
        ("ETHUSDT", 60, 1.0, 1.5, 10.0),
        ("ETHUSDT", 120, 1.5, 2.0, None),
    ]


def test_ticker_snapshot_to_message(spark):
    raw = '{"symbol":"BTC","closeTime":1700000000123,"lastPrice":"37000.5","openPrice":"1","highPrice":"2","lowPrice":"0.5","volume":"9","quoteVolume":"10","count":42,"priceChange":"-1","priceChangePercent":"-2.5"}'
    row = ticker_to_messages(spark.createDataFrame([(raw,), ("{broken",)], "value string")).collect()
    assert (row[0].event_time, row[0].price, row[0].number_trades, row[0].price_change_percent) == (1700000000123, 37000.5, 42, -2.5)
    assert row[1].symbol is None


def test_messages_and_rejects(spark, rows_of):
    lines = ['{"symbol":"A","event_time":1704103200500,"price":2.5}', "{bad", '{"symbol":"A"}']
    parsed = parse_messages(spark.createDataFrame([(x.encode(),) for x in lines], "value binary"))
    row = accepted(parsed).first()
    assert (row.symbol, row.price, row.date, row.hour) == ("A", 2.5, dt.date(2024, 1, 1), 10)
    assert rows_of(rejects(parsed)) == [("{\"symbol\":\"A\"}",), ("{bad",)]


def test_day_boundary_follows_the_zone(spark):
    late = '{"symbol":"A","event_time":1704151800000,"price":1}'  # 2024-01-01 23:30 UTC
    raw = spark.createDataFrame([(late,)], "value string")
    assert parse_messages(raw).first().date == dt.date(2024, 1, 1)
    shifted = parse_messages(raw, tz="Asia/Ho_Chi_Minh").first()
    assert (shifted.date, shifted.hour) == (dt.date(2024, 1, 2), 6)


def test_topic_options():
    bounded = topic_options("h:9092", "t", streaming=False)
    assert bounded == {"kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest", "endingOffsets": "latest"}
    live = topic_options("h:9092", "t", streaming=True)
    assert live["failOnDataLoss"] == "true" and "maxOffsetsPerTrigger" not in live and "endingOffsets" not in live
    capped = topic_options("h", "t", streaming=True, max_offsets_per_trigger=1000, fail_on_data_loss=False)
    assert capped["maxOffsetsPerTrigger"] == "1000" and capped["failOnDataLoss"] == "false"


def test_first_available_source(spark, tmp_path):
    empty, full = tmp_path / "empty", tmp_path / "full"
    empty.mkdir()
    spark.range(3).write.parquet(str(full))
    assert read_first_available(spark, [str(tmp_path / "none"), str(empty), str(full)]).count() == 3
    assert read_first_available(spark, [str(tmp_path / "none")]) is None


def test_files_of_one_folder_with_another_header_order(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "AAA.csv").write_text("timestamp,open,high,low,close,volume\n60,1,2,3,4,5\n")
    (folder / "BBB.csv").write_text("volume,close,low,high,open,timestamp\n9,8,7,6,5,120\n")
    (folder / "CCC.csv").write_text("Unix,open,high,low,close,volume\n180,1,1,1,1,1\n")
    symbol = F.regexp_extract("_metadata.file_path", r"([^/]+)\.csv$", 1)
    rows = {r.symbol: r for r in read_bars(spark, str(folder), symbol).collect()}
    assert (rows["AAA"].timestamp, rows["AAA"].open, rows["AAA"].volume) == (60, 1, 5)
    assert (rows["BBB"].timestamp, rows["BBB"].open, rows["BBB"].volume) == (120, 5, 9)
    assert rows["CCC"].timestamp == 180 and len(csv_families(spark, str(folder))) == 3


def test_kline_rejects_and_bars_are_the_input(spark):
    pages = ["[broken", None, "[]", '[["soon","1","1","1","1","1"],["60000","1","2","0","1","3"]]']
    frame = spark.createDataFrame([(p, "A") for p in pages], "page string, symbol string")
    found = [(r.reason, r.raw) for r in kline_rejects(frame).collect()]
    assert sorted(found, key=str) == sorted([("page", "[broken"), ("page", None), ("row", '["soon","1","1","1","1","1"]')], key=str)
    assert klines_to_bars(frame).count() == 1


def test_headers_are_read_without_reading_rows(spark, tmp_path):
    import gzip

    long = ",".join(f"column_{i}" for i in range(2000))  # longer than one read
    (tmp_path / "a.csv").write_text("ts,open\r\n1,2\r\n")
    (tmp_path / "b.csv").write_text("ts,open\n" + "3,4\n" * 1000)
    (tmp_path / "c.csv").write_text(long + "\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv.gz").write_bytes(gzip.compress(b"open,ts\n5,6\n"))
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup())
    found = dict(csv_families(spark, str(tmp_path)))
    assert len(jobs.getJobIdsForGroup()) == before
    assert set(found) == {"ts,open", "open,ts", long}
    assert [f.rsplit("/", 1)[1] for f in found["ts,open"]] == ["a.csv", "b.csv"]


def test_inferred_types(spark):
    rows = [("1", "1", "2024-01-01", "x", None, "1", "2024-02-30", "٣"), (" 2 ", "2.5", "2024-01-01T10:00", "1", "", "n/a", "2024-02-28", "4"), ("-3", "1e5", "2024-01-01 10:00:01.5", "2", None, "7", "2024-02-29", "5")]
    raw = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string, `h.h` string")
    got = {r["column"]: tuple(r)[1:] for r in infer_types(raw).collect()}
    assert got == {
        "a": ("integer", "integer", 3, 0, 0, None),
        "b": ("double", "double", 3, 0, 0, None),
        "c": ("stamp", "stamp", 3, 0, 0, None),
        "d": ("text", "integer", 3, 0, 1, "x"),
        "e": ("text", "text", 3, 3, 0, None),
        "f": ("text", "integer", 3, 0, 1, "n/a"),
        "g": ("text", "stamp", 3, 0, 1, "2024-02-30"),
        "h.h": ("text", "integer", 3, 0, 1, "٣"),
    }
    none = {r["column"]: r["inferred"] for r in infer_types(raw.limit(0)).collect()}
    assert set(none.values()) == {"text"}


def test_typed_csv_loses_no_value(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,x,at,t\n1,0.5,2024-01-01,7\n,1e3,2024-01-02 03:04:05,z\n")
    (header, df), = read_csv_typed(spark, str(tmp_path))
    assert header == "n,x,at,t" and [k for _, k in df.dtypes] == ["bigint", "double", "timestamp_ntz", "string"]
    assert [tuple(r) for r in df.collect()] == [(1, 0.5, dt.datetime(2024, 1, 1), "7"), (None, 1000.0, dt.datetime(2024, 1, 2, 3, 4, 5), "z")]
