import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.resample import daily_ticks
from tidemark.sinks import read_version
from tidemark.sources import parse_messages
from tidemark.sources.messages import accepted
from tidemark.sinks.tables import version_path, versions
from tidemark.streaming import (
    compact_updates,
    console_monitor,
    daily_files,
    fan_out,
    fold_sinks,
    memory_table,
    read_batches,
    read_closed,
    read_late,
    read_rejects,
    read_stats,
    read_updates,
    run_streams,
    snapshot_table,
    stop_all,
    update_table,
    windowed_bars,
    with_event_watermark,
)
from tidemark.streaming.ledger import Ledger

DAY_MS = 86_400_000
START = 1_704_067_200_000  # 2024-01-01 UTC


def message(symbol, ms, price, volume=1.0):
    return {"symbol": symbol, "event_time": START + ms, "price": price, "open": price, "high": price, "low": price, "volume": volume, "quote_volume": price, "number_trades": 1}


class Feed:
    """A landing folder of JSON-line files, oldest first."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, str(folder), 0
        os.makedirs(self.folder)

    def land(self, *messages):
        self.n += 1
        path = os.path.join(self.folder, f"{self.n:03d}.json")
        with open(path, "w") as out:
            out.writelines((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages)
        os.utime(path, (1_000_000 + self.n, 1_000_000 + self.n))

    def stream(self):
        raw = self.spark.readStream.option("maxFilesPerTrigger", 1).text(self.folder)
        return accepted(parse_messages(raw))

    def batch(self):
        return accepted(parse_messages(self.spark.read.text(self.folder)))


@pytest.fixture
def feed(spark, tmp_path):
    f = Feed(spark, tmp_path / "in")
    f.land(message("A", 3000, 3.0), message("A", 1000, 1.0), message("B", 10, 7.0), "{broken")
    f.land(message("A", DAY_MS + 5, 4.0), message("A", 2000, 9.0))
    f.land(message("A", 3 * DAY_MS, 5.0))
    yield f
    stop_all(spark)
    spark.streams.resetTerminated()


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_closed_windows_equal_the_batch_twin(spark, tmp_path, feed, rows_of):
    bars = windowed_bars(with_event_watermark(feed.stream(), "1 day"))
    finish(daily_files(bars, str(tmp_path / "out"), str(tmp_path / "cp"), every=None))
    stored = spark.read.parquet(str(tmp_path / "out"))
    columns = [c for c in daily_ticks(feed.batch()).columns if c not in ("symbol",)]
    batch = daily_ticks(feed.batch()).filter(F.col("date") < F.lit(dt.date(2024, 1, 3)))
    assert rows_of(stored, "symbol", *columns) == rows_of(batch, "symbol", *columns)
    first = stored.filter("symbol = 'A' and date = '2024-01-01'").first()
    assert (first.daily_open, first.daily_close, first.daily_high, first.tick_count) == (1.0, 3.0, 9.0, 3)


def test_rows_behind_the_watermark_are_dropped_by_the_stream_only(spark, tmp_path, feed):
    # Late rows are judged by the mark known before the previous batch, so one batch lies between.
    feed.land(message("A", 3 * DAY_MS + 1, 1.0))
    feed.land(message("A", 4000, 99.0), message("A", 3 * DAY_MS + 2, 1.0))
    feed.land(message("A", 6 * DAY_MS, 1.0))
    bars = windowed_bars(with_event_watermark(feed.stream(), "1 hour"))
    finish(daily_files(bars, str(tmp_path / "out"), str(tmp_path / "cp"), every=None))
    stored = spark.read.parquet(str(tmp_path / "out")).filter("symbol = 'A' and date = '2024-01-01'")
    assert stored.first().daily_high == 9.0
    assert daily_ticks(feed.batch()).filter("symbol = 'A' and date = '2024-01-01'").first().daily_high == 99.0


def test_restart_from_the_checkpoint_neither_repeats_nor_loses(spark, tmp_path, feed, rows_of):
    def once():
        bars = windowed_bars(with_event_watermark(feed.stream(), "1 day"))
        finish(daily_files(bars, str(tmp_path / "out"), str(tmp_path / "cp"), every=None))

    once()
    feed.land(message("B", 3 * DAY_MS + 7, 2.0))
    once()
    feed.land(message("A", 9 * DAY_MS, 1.0))
    once()
    stored = spark.read.parquet(str(tmp_path / "out"))
    expected = daily_ticks(feed.batch()).filter(F.col("date") < F.lit(dt.date(2024, 1, 10)))
    assert rows_of(stored, "symbol", F.col("date").cast("string"), "tick_count") == rows_of(
        expected, "symbol", F.col("date").cast("string"), "tick_count"
    )


def test_short_windows(spark, tmp_path, feed, rows_of):
    bars = windowed_bars(with_event_watermark(feed.stream(), "1 minute"), "5 minutes", daily=False)
    finish(snapshot_table(bars, str(tmp_path / "t"), str(tmp_path / "cp"), every=None))
    stats = read_version(spark, str(tmp_path / "t"))
    assert rows_of(stats.select("symbol", F.unix_seconds("window_start") % 86400, "tick_count")) == [
        ("A", 0, 1), ("A", 0, 1), ("A", 0, 3), ("B", 0, 1),
    ]


def test_memory_table_holds_open_windows_too(spark, feed):
    bars = windowed_bars(with_event_watermark(feed.stream(), "1 hour"))
    finish(memory_table(bars, "daily_stats_test", every=None))
    assert spark.sql("select count(*) from daily_stats_test").first()[0] == daily_ticks(feed.batch()).count() == 4


def test_several_queries_are_stopped_together(spark, tmp_path, feed):
    bars = windowed_bars(with_event_watermark(feed.stream(), "1 hour"))
    daily_files(bars, str(tmp_path / "out"), str(tmp_path / "cp"), every="1 second")
    console_monitor(feed.stream(), every="1 second", columns=("symbol", "price"))
    assert len(spark.streams.active) == 2
    assert len(run_streams(spark, timeout=3)) == 2
    assert spark.streams.active == []


def test_a_new_checkpoint_goes_on_behind_the_old_versions(spark, tmp_path, feed):
    root = str(tmp_path / "t")

    def once(checkpoint):
        bars = windowed_bars(with_event_watermark(feed.stream(), "1 day"))
        finish(snapshot_table(bars, root, str(tmp_path / checkpoint), every=None))

    for number in (98, 99):
        spark.range(1).write.parquet(version_path(root, number))
    once("first")
    assert versions(spark, root)[-1] > 99 and read_version(spark, root).count() == 4
    before = versions(spark, root)[-1]
    feed.land(message("C", 3 * DAY_MS, 2.0))
    once("second")
    assert versions(spark, root)[-1] > before and read_version(spark, root).count() == 5


def test_a_replayed_batch_replaces_its_own_version(spark, tmp_path, feed):
    root, checkpoint = str(tmp_path / "t"), tmp_path / "cp"

    def once():
        bars = windowed_bars(with_event_watermark(feed.stream(), "1 day"))
        finish(snapshot_table(bars, root, str(checkpoint), every=None))

    once()
    known = versions(spark, root)
    for name in os.listdir(checkpoint / "commits"):  # the last batch was written, but not noted as done
        if name.strip(".").split(".")[0] == max(n for n in os.listdir(checkpoint / "commits") if n[0] != "."):
            os.remove(checkpoint / "commits" / name)
    once()
    assert versions(spark, root)[-1] == known[-1] and read_version(spark, root).count() == 4


def test_updates_hold_the_latest_row_of_each_window(spark, tmp_path, feed, rows_of):
    root = str(tmp_path / "t")
    assert read_updates(spark, root) is None

    def once():
        bars = windowed_bars(with_event_watermark(feed.stream(), "30 days"))
        finish(update_table(bars, root, str(tmp_path / "cp"), every=None))
        return bars.columns

    for i in range(3):
        columns = once()
        feed.land(message("A", DAY_MS + 50 + i, 20.0 + i))
    once()
    expected = rows_of(daily_ticks(feed.batch()), "symbol", F.col("date").cast("string"), "daily_close", "tick_count")
    for _ in range(2):
        got = read_updates(spark, root).select(*columns)
        assert rows_of(got, "symbol", F.col("date").cast("string"), "daily_close", "tick_count") == expected
        compact_updates(spark, root)
    assert compact_updates(spark, root) == 0


def updates(feed, root, checkpoint, **options):
    bars = windowed_bars(with_event_watermark(feed.stream(), "30 days"))
    finish(update_table(bars, root, str(checkpoint), every=None, **options))


def uncommit(checkpoint):
    """Take back Spark's note that the last batch is done, as if the query died before it."""
    names = [n for n in os.listdir(checkpoint / "commits") if n[0] != "."]
    last = max(names, key=int)
    for name in os.listdir(checkpoint / "commits"):
        if name.strip(".").split(".")[0] == last:
            os.remove(checkpoint / "commits" / name)


def closes(df):
    return sorted((r["symbol"], str(r["date"]), r["daily_close"], r["tick_count"]) for r in df.collect())


def test_updates_of_a_new_checkpoint_win_over_those_before(spark, tmp_path, feed):
    root = str(tmp_path / "t")
    updates(feed, root, tmp_path / "first")
    feed.land(message("A", DAY_MS + 60, 100.0))
    updates(feed, root, tmp_path / "second")  # reads everything again
    assert closes(read_updates(spark, root)) == closes(daily_ticks(feed.batch()))
    updates(feed, root, tmp_path / "second")
    assert Ledger(spark, root).epochs()[-1].startswith("000002-")


def test_a_replacing_run_hides_the_runs_before(spark, tmp_path, feed):
    root = str(tmp_path / "t")
    updates(feed, root, tmp_path / "first")
    compact_updates(spark, root)
    other = Feed(spark, tmp_path / "other")
    other.land(message("Z", 5, 1.0))
    updates(other, root, tmp_path / "second", replaces=True)
    assert closes(read_updates(spark, root)) == [("Z", "2024-01-01", 1.0, 1)]


def test_a_replayed_update_counts_once(spark, tmp_path, feed):
    root, checkpoint = str(tmp_path / "t"), tmp_path / "cp"
    updates(feed, root, checkpoint)
    known = Ledger(spark, root).epochs()
    uncommit(checkpoint)
    feed.land(message("B", 3 * DAY_MS, 8.0))
    updates(feed, root, checkpoint)
    assert Ledger(spark, root).epochs()[: len(known)] == known
    assert closes(read_updates(spark, root)) == closes(daily_ticks(feed.batch()))


def test_a_folder_without_a_commit_is_not_read(spark, tmp_path, feed):
    root, checkpoint = str(tmp_path / "t"), tmp_path / "cp"
    updates(feed, root, checkpoint)
    before = closes(read_updates(spark, root))
    ledger = Ledger(spark, root)
    dead = ledger.epoch(1, int(ledger.epochs()[-1].split("-")[1]) + 1)
    ledger.write(dead, "updates", read_updates(spark, root).withColumn("daily_close", F.lit(-1.0)))
    assert closes(read_updates(spark, root)) == before
    feed.land(message("B", 3 * DAY_MS, 8.0))
    updates(feed, root, checkpoint)  # writes over it
    assert closes(read_updates(spark, root)) == closes(daily_ticks(feed.batch()))


def test_a_fold_keeps_what_readers_list_until_its_grace_ends(spark, tmp_path, feed):
    root = str(tmp_path / "t")
    updates(feed, root, tmp_path / "cp")
    reader = read_updates(spark, root)
    want = closes(reader)
    assert compact_updates(spark, root, grace_seconds=60, now=1000) >= 3
    assert closes(reader) == want == closes(read_updates(spark, root))
    for k, (now, left) in enumerate(((1030, True), (1100, False))):
        feed.land(message("C", k, 1.0))
        updates(feed, root, tmp_path / "cp")
        compact_updates(spark, root, grace_seconds=60, now=now)
        assert os.path.exists(f"{root}/updates/epoch=000001-000000000000") == left
    assert closes(read_updates(spark, root)) == closes(daily_ticks(feed.batch()))


def test_updates_fold_themselves(spark, tmp_path, feed):
    root = str(tmp_path / "t")
    updates(feed, root, tmp_path / "cp", fold_after=2)
    assert Ledger(spark, root).open_epochs("updates") < 3
    assert any(n.startswith("fold=") for n in os.listdir(f"{root}/updates"))
    assert closes(read_updates(spark, root)) == closes(daily_ticks(feed.batch()))


def fan(spark, feed, root, checkpoint, **options):
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(feed.folder)
    finish(fan_out(parse_messages(raw), root, str(checkpoint), every=None, **options))


def test_one_query_feeds_all_sinks(spark, tmp_path, feed):
    root = str(tmp_path / "t")
    # Behind the mark of three days: one row of a window that has ended.
    feed.land(message("A", 4000, 99.0), message("A", 3 * DAY_MS + 2, 6.0), "nothing")
    fan(spark, feed, root, tmp_path / "cp", delay="1 hour")
    late = read_late(spark, root).collect()
    assert [(r["symbol"], r["price"]) for r in late] == [("A", 99.0)]
    # The mark is three days less an hour; the window ended a day after the start.
    assert late[0]["seconds_late"] == 2 * 86_400 - 3600
    assert str(late[0]["window_start"]) == "2024-01-01 00:00:00"
    on_time = feed.batch().filter("price <> 99")
    assert closes(read_stats(spark, root)) == closes(daily_ticks(on_time))
    assert closes(read_closed(spark, root)) == closes(daily_ticks(on_time).filter(F.col("date") < F.lit(dt.date(2024, 1, 3))))
    assert sorted(r["raw"] for r in read_rejects(spark, root).collect()) == ["nothing", "{broken"]
    batches = read_batches(spark, root)
    assert [b["rows"] for b in batches] == [4, 2, 1, 3]  # each row of the input once
    assert sum(b["late"] for b in batches) == 1 and sum(b["rejected"] for b in batches) == 2


def test_partial_sums_add_up_like_the_whole(spark, tmp_path, feed):
    for mode in ("sum", "last"):
        root = str(tmp_path / mode)
        fan(spark, feed, root, tmp_path / f"{mode}-cp", delay="30 days", volume_mode=mode, fold_after=2)
        want = daily_ticks(feed.batch(), volume_mode=mode)
        got = read_stats(spark, root)
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
        assert any(n.startswith("fold=") for n in os.listdir(f"{root}/stats"))


def test_runs_that_go_on_share_a_window_and_a_replacing_run_does_not(spark, tmp_path, feed):
    root = str(tmp_path / "t")
    fan(spark, feed, root, tmp_path / "first", delay="30 days")
    more = Feed(spark, tmp_path / "more")
    more.land(message("A", 500, 0.5), message("A", DAY_MS + 9, 44.0))
    fan(spark, more, root, tmp_path / "second", delay="30 days")
    both = feed.batch().unionByName(more.batch())
    assert closes(read_stats(spark, root)) == closes(daily_ticks(both))
    fan(spark, more, root, tmp_path / "third", delay="30 days", replaces=True)
    assert closes(read_stats(spark, root)) == closes(daily_ticks(more.batch()))


def test_a_replayed_batch_of_all_sinks_counts_once(spark, tmp_path, feed):
    root, checkpoint = str(tmp_path / "t"), tmp_path / "cp"
    fan(spark, feed, root, checkpoint, delay="1 hour")
    before = closes(read_stats(spark, root)), closes(read_closed(spark, root))
    uncommit(checkpoint)
    fan(spark, feed, root, checkpoint, delay="1 hour")
    assert (closes(read_stats(spark, root)), closes(read_closed(spark, root))) == before
    feed.land(message("A", 9 * DAY_MS, 1.0))
    fan(spark, feed, root, checkpoint, delay="1 hour")
    assert closes(read_closed(spark, root)) == closes(daily_ticks(feed.batch()).filter("date < '2024-01-09'"))


def test_all_sinks_fold_without_a_change_to_their_readers(spark, tmp_path, feed):
    root = str(tmp_path / "t")
    fan(spark, feed, root, tmp_path / "cp", delay="1 hour")
    before = closes(read_stats(spark, root)), closes(read_closed(spark, root))
    assert fold_sinks(spark, root)["stats"] == 3
    assert fold_sinks(spark, root) == dict.fromkeys(("stats", "daily", "late", "rejects"), 0)
    assert (closes(read_stats(spark, root)), closes(read_closed(spark, root))) == before
    feed.land(message("A", 9 * DAY_MS, 1.0))
    fan(spark, feed, root, tmp_path / "cp", delay="1 hour")
    assert closes(read_stats(spark, root)) == closes(daily_ticks(feed.batch()))
