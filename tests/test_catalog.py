import math
import os

import duckdb
import pytest

import __spark_entry__ as entrypoint
from tidemark import catalog

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()
NO_SQL = {"forecast", "cv_metrics"}
ONE_ROW_OR_TOP_N = {"top_price_change_days", "top_volume_days", "large_gaps", "model_kpis", "dataset_profile", "csv_inferred_types"}
# One task sees the sizes of the ranges, one row each; tests/test_measures.py looks at its plan.
ONE_ROW_PER_RANGE = {"global_positions"}
STREAMS = {
    "stream_daily_ohlcv", "stream_5min_ohlcv", "stream_stats_table", "stream_update_table",
    "stream_two_runs", "stream_late_rows", "stream_fanout",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        table = name.removesuffix(".parquet")
        con.sql(f"create view {table} as select * from '{SF}/{name}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else v
        return v if v is None or isinstance(v, (int, bool)) else str(v)

    table = [tuple(cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(table, key=lambda r: [(v is not None, str(v)) for v in r])


def check_plan(name, df):
    """No pairwise joins, no row-at-a-time Python, no window or group of the whole table in one task."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "CollectLimit"):
        assert bad not in plan
    if name not in ONE_ROW_OR_TOP_N | ONE_ROW_PER_RANGE:
        assert "Exchange SinglePartition" not in plan


def test_every_query_has_sql_but_the_fits():
    assert set(QUERIES) - set(ORACLE) == NO_SQL and len(QUERIES) >= 68


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name not in STREAMS:
        check_plan(name, df)
    columns, mine = canonical([tuple(r) for r in df.collect()], df.columns)
    relation = duck.sql(ORACLE[name])
    other_columns, theirs = canonical(relation.fetchall(), relation.columns)
    assert columns == other_columns and len(mine) == len(theirs) > 0
    for a, b in zip(mine, theirs, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or (isinstance(x, float) and x == pytest.approx(y, rel=1e-12)), (a, b)


def test_fitted_queries(spark):
    fits = QUERIES["forecast"](spark, SF)
    assert fits.filter("status <> 'ok'").count() == 0
    assert fits.select("symbol", "config_id").distinct().count() == 30
    scores = QUERIES["cv_metrics"](spark, SF).collect()
    assert len(scores) == 5 and all(r.folds == 3 and r.cv_mape > 0 for r in scores)


def test_entry(spark):
    df = entrypoint.entry(spark)
    assert {"symbol", "date", "ma7", "ma30"} <= set(df.columns) and df.count() > 0


def test_command_line(spark, capsys):
    from tidemark.__main__ import main

    main(["query", "coverage", SF])
    assert "1-URGENT" in capsys.readouterr().out


def test_streams_read_tables_of_many_files(spark, tmp_path, rows_of):
    spark.read.parquet(f"{SF}/events.parquet").repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_daily_ohlcv", "tick_daily"):
        columns = ("symbol", "date", "daily_open", "daily_close", "daily_volume", "tick_count")
        assert rows_of(QUERIES[name](spark, str(tmp_path)), *columns) == rows_of(QUERIES[name](spark, SF), *columns)
