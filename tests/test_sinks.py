import datetime as dt
import os
import time

import pytest

from tidemark.schemas import MissingColumns
from tidemark.sinks.tables import version_path
from tidemark.sinks import append_staging, read_partitioned, read_version, versions, write_clustered, write_csv, write_partitioned, write_version
from tidemark.sources.storage import scratch_dir, sweep_scratch


def table(spark, months, value=1.0):
    return spark.createDataFrame([("A", 2024, m, value) for m in months], "symbol string, year int, month int, v double")


def test_only_touched_partitions_are_replaced(spark, tmp_path, rows_of):
    path = str(tmp_path / "t")
    write_partitioned(table(spark, [1, 2]), path)
    write_partitioned(table(spark, [2, 3], 9.0), path, only_touched=True)
    assert rows_of(spark.read.parquet(path), "month", "v") == [("1", 1.0), ("2", 9.0), ("3", 9.0)]
    write_partitioned(table(spark, [5]), path)
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(MissingColumns):
        write_partitioned(table(spark, [1]).drop("month"), path)


def test_a_table_computed_from_itself(spark, tmp_path, rows_of):
    root = str(tmp_path / "v")
    assert read_version(spark, root) is None
    write_version(table(spark, [1]), root)
    old = read_version(spark, root)
    write_version(old.unionByName(table(spark, [2])), root)
    assert old.count() == 1 and read_version(spark, root).count() == 2
    assert read_version(spark, root, back=1).count() == 1
    write_version(read_version(spark, root).unionByName(table(spark, [3])), root)
    assert versions(spark, root) == [2, 3] and read_version(spark, root).count() == 3


def test_an_uncommitted_version_is_not_read(spark, tmp_path):
    root = tmp_path / "v"
    write_version(table(spark, [1]), str(root))
    (root / "version=000002").mkdir()
    (root / "version=000002" / "part-0.parquet").write_text("half written")
    assert versions(spark, str(root)) == [1] and read_version(spark, str(root)).count() == 1
    write_version(table(spark, [1, 2]), str(root))
    assert versions(spark, str(root)) == [1, 2] and read_version(spark, str(root)).count() == 2


def test_partitioned_write_rebalances_instead_of_one_task_per_partition(spark):
    from tidemark.sinks.tables import _clustered

    plan = _clustered(table(spark, [1]), ("symbol",))._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_csv_has_few_files_and_a_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(spark.range(100).repartition(16), path)
    parts = [p for p in os.listdir(path) if p.endswith(".csv")]
    assert len(parts) <= 4 and spark.read.option("header", True).csv(path).columns == ["id"]


def test_no_report_of_data_size_passes_a_coalesce(spark, tmp_path, monkeypatch):
    """The last stage of a report keeps its own parallelism."""
    seen = []
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.coalesce", lambda self, n: seen.append(n) or self)
    write_csv(spark.range(1000).repartition(16), str(tmp_path / "csv"))
    assert not seen


def test_version_numbers_of_any_length(spark, tmp_path):
    root = str(tmp_path / "v")
    for number in (999_999, 1_000_000):
        table(spark, [number % 7]).write.parquet(version_path(root, number))
    assert versions(spark, root) == [999_999, 1_000_000]
    write_version(table(spark, [1, 2]), root)
    assert versions(spark, root) == [1_000_000, 1_000_001] and read_version(spark, root).count() == 2


def test_series_names_that_look_like_numbers(spark, tmp_path):
    df = spark.createDataFrame([("007", 2024, 1, 1.0), ("2024-01-01", 2024, 1, 2.0)], "symbol string, year int, month int, v double")
    write_partitioned(df, str(tmp_path / "t"))
    assert sorted(r.symbol for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["007", "2024-01-01"]


def test_series_names_stay_text_in_any_session(spark, tmp_path):
    df = spark.createDataFrame([("007", 2024, 1, 1.0), ("8", 2024, 12, 2.0)], "symbol string, year int, month int, v double")
    write_partitioned(df, str(tmp_path / "t"))
    other = spark.newSession()
    other.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    assert dict(other.read.parquet(str(tmp_path / "t")).dtypes)["symbol"] == "int"
    table = read_partitioned(other, str(tmp_path / "t"))
    assert sorted((r.symbol, r.year, r.month) for r in table.collect()) == [("007", "2024", "1"), ("8", "2024", "12")]


def test_old_scratch_is_swept(spark):
    path = scratch_dir(spark, "sweep-me")
    table(spark, [1]).write.parquet(path)
    name = path.rsplit("/", 1)[1]
    assert name not in sweep_scratch(spark, older_than_hours=1)
    assert name in sweep_scratch(spark, older_than_hours=1, now=time.time() + 7200)


def test_staging_batch_replaces_itself(spark, tmp_path):
    for _ in range(2):
        path = append_staging(table(spark, [1, 2]), str(tmp_path), "batch-1")
    assert spark.read.parquet(path).count() == 2


def test_scratch_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(f"{base}/x-") and scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_dates_survive_partitioning(spark, tmp_path):
    df = spark.createDataFrame([("1-URGENT", dt.date(2024, 2, 1), 2024, 2)], "symbol string, date date, year int, month int")
    write_partitioned(df, str(tmp_path / "d"))
    row = spark.read.parquet(str(tmp_path / "d")).filter("year = 2024 and month = 2").first()
    assert (row.symbol, row.date) == ("1-URGENT", dt.date(2024, 2, 1))


def test_many_series_need_few_folders(spark, tmp_path):
    rows = spark.range(10_000).selectExpr("concat('S', id) as symbol", "date'2024-01-01' as date", "2024 as year", "1.0D as v")
    root = str(tmp_path / "daily")
    write_version(rows, root)
    folders = [name for _, names, _ in os.walk(root) for name in names]
    assert sorted(folders) == ["version=000001", "year=2024"]
    write_clustered(rows, str(tmp_path / "plain"), ("symbol", "date"))
    assert not [n for _, names, _ in os.walk(tmp_path / "plain") for n in names]
