"""Result tables by day: reruns replace their own days, reads scan the days asked for."""

import pytest
from pyspark.errors import PySparkException

from gamepulse import jobs
from gamepulse.operators.day_table import DayTable
from gamepulse.sources.fixtures import fixture_tables

SCHEMA = "t string, n bigint"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, table, *days):
    return sorted((r["t"], r["n"], r["day"]) for r in table.read(spark, SCHEMA, *days).collect())


def files(folder):
    return {p.name: p.stat().st_mtime_ns for p in folder.glob("*.parquet")}


def test_rerun_replaces_its_day_only(spark, tmp_path):
    table = DayTable(str(tmp_path / "t"))
    table.write(frame(spark, ("2024-01-01 10", 1), ("2024-01-02 10", 2), ("2024-01-03 10", 3)), "t", "2024-01-01", "2024-01-03")
    kept = files(tmp_path / "t" / "day=2024-01-01")
    table.write(frame(spark, ("2024-01-02 11", 5)), "t", "2024-01-02", "2024-01-02")
    assert files(tmp_path / "t" / "day=2024-01-01") == kept and kept
    assert [r[:2] for r in stored(spark, table)] == [("2024-01-01 10", 1), ("2024-01-02 11", 5), ("2024-01-03 10", 3)]
    table.write(frame(spark, ("2024-01-02 11", 5)), "t", "2024-01-02", "2024-01-02")  # repeated
    assert stored(spark, table, "2024-01-02", "2024-01-02") == [("2024-01-02 11", 5, "2024-01-02")]


def test_days_without_rows_are_emptied(spark, tmp_path):
    table = DayTable(str(tmp_path / "t"))
    table.write(frame(spark, ("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)), "t", "2024-01-01", "2024-01-03")
    table.write(frame(spark, ("2024-01-01", 7)), "t", "2024-01-01", "2024-01-02")
    assert [r[:2] for r in stored(spark, table)] == [("2024-01-01", 7), ("2024-01-03", 3)]
    table.write(frame(spark), "t", "2024-01-03", "2024-01-03")
    assert [r[:2] for r in stored(spark, table)] == [("2024-01-01", 7)]


@pytest.mark.parametrize("time", ["2024-01-04", None])
def test_rows_of_other_days_are_refused_and_nothing_changes(spark, tmp_path, time):
    table = DayTable(str(tmp_path / "t"))
    table.write(frame(spark, ("2024-01-01", 1)), "t", "2024-01-01", "2024-01-01")
    with pytest.raises(PySparkException):
        table.write(frame(spark, ("2024-01-01", 9), (time, 9)), "t", "2024-01-01", "2024-01-03")
    assert [r[:2] for r in stored(spark, table)] == [("2024-01-01", 1)]


def test_a_read_scans_its_days(spark, tmp_path):
    table = DayTable(str(tmp_path / "t"))
    table.write(frame(spark, *[(f"2024-01-{d:02d}", d) for d in range(1, 10)]), "t", "2024-01-01", "2024-01-09")
    read = table.read(spark, SCHEMA, "2024-01-04", "2024-01-05")
    plan = read._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-04" in filters and "2024-01-05" in filters
    assert {f.split("day=")[1][:10] for f in read.select("*", "_metadata.file_path").toPandas().file_path} == {"2024-01-04", "2024-01-05"}


def test_job_by_day_equals_merge_table(spark, sf_dir, tmp_path):
    t = fixture_tables(spark, sf_dir)
    inputs = {"orders": t["fx_order"], "registrations": t["fx_regi"], "publish_games": t["fx_publish_game"], "game_sdk": t["fx_game_sdk"]}
    rows = {}
    for extra in ([], ["--by-day"]):
        out = str(tmp_path / ("days" if extra else "merge"))
        args = jobs.arguments(["base-kpi-offline", "--out", out, "--start", "2024-01-05", "--end", "2024-01-12", "--run-id", "r", *extra])
        jobs.base_kpi_offline(inputs, jobs.results(out), args)
        for name in ("kpi_hour", "kpi_day", "game_day"):
            table = jobs.results(out)[name]
            if extra:
                schema = ", ".join(f"{c} {k}" for c, k in {**table.keys, **table.values}.items())
                df = jobs.by_day(table, args).read(spark, schema).drop("day")
            else:
                df = table.read(spark)
            rows[name, bool(extra)] = sorted(map(str, df.select(*sorted(df.columns)).collect()))
    for name in ("kpi_hour", "kpi_day", "game_day"):
        assert rows[name, True] == rows[name, False] and rows[name, True]
