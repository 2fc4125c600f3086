import json

import pytest

from tidemark import __main__ as cli
from tidemark import plans


def test_jobs_parse():
    parse = cli._parser().parse_args
    assert parse(["convert", "--root", "r", "--folder", "in", "--epoch-unit", "ms"]).folder == "in"
    assert parse(["sweep", "--older-than-hours", "48"]).older_than_hours == 48
    assert parse(["compact", "--root", "r"]).job == "compact"
    assert parse(["speed-stream", "--root", "r", "--servers", "s", "--topic", "t", "--replaces"]).replaces
    for wrong in (["convert", "--root", "r", "--epoch-unit", "s"], ["sweep"], ["convert", "--root", "r", "--folder", "a", "--source", "A=b", "--epoch-unit", "s"]):
        with pytest.raises(SystemExit):
            parse(wrong)


def test_convert_a_folder_by_the_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda *a, **k: spark)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "AAA.csv").write_text("timestamp,open,high,low,close,volume\n60,1,2,0.5,1.5,3\n")
    (folder / "007.csv").write_text("unix,open,high,low,close,volume\n120,1,2,0.5,1.5,3\n180,1,2,0.5,1.5,3\n")
    cli.main(["convert", "--root", str(tmp_path / "t"), "--folder", str(folder), "--epoch-unit", "s"])
    bars = spark.read.parquet(plans.Layout(str(tmp_path / "t")).bars)
    assert {r["symbol"]: r["count"] for r in bars.groupBy("symbol").count().collect()} == {"AAA": 1, "007": 2}
    cli.main(["compact", "--root", str(tmp_path / "t")])
    assert json.loads(capsys.readouterr().out.replace("'", '"')) == dict.fromkeys(("stats", "daily", "late", "rejects"), 0)
