"""The command-line jobs end to end over warehouse tables made from the test tables."""

import pytest
from pyspark.sql import functions as F

from gamepulse import jobs
from gamepulse.sources.fixtures import fixture_tables, log_lines

WAREHOUSE = {
    "registrations": "fx_regi", "orders": "fx_order", "logins": "fx_login", "channel_events": "fx_channel",
    "publish_games": "fx_publish_game", "game_sdk": "fx_game_sdk", "downloads": "fx_appdownload",
    "sdk_requests": "fx_cp_req", "sdk_accounts": "fx_bgameaccount", "companies": "fx_bgame",
    "receipts": "fx_receipt", "account_bind": "fx_account_bind", "member": "fx_member",
    "game_name": "fx_game_name",
}


@pytest.fixture(scope="module")
def site(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("site")
    t = fixture_tables(spark, sf_dir)
    for name, view in WAREHOUSE.items():
        t[view].write.parquet(str(root / "tables" / name))
    log_lines(t, "request").write.text(str(root / "requests"))
    log_lines(t, "signin", "recharge").write.text(str(root / "points"))
    return root


def run(spark, site, job, *extra, run_id="r1"):
    argv = [job, "--tables", str(site / "tables"), "--out", str(site / "out"), "--run-id", run_id, *extra]
    jobs.run(spark, jobs.arguments(argv))
    return jobs.results(str(site / "out"))


DAYS = ("--start", "2024-01-05", "--end", "2024-01-12")


def test_offline_jobs_share_the_hourly_table(spark, site):
    run(spark, site, "base-kpi-offline", *DAYS)
    out = run(spark, site, "pay-account-offline", *DAYS, "--lines", str(site / "requests"))
    before = sorted(map(str, out["kpi_hour"].read(spark).collect()))
    run(spark, site, "base-kpi-offline", *DAYS, run_id="r2")
    assert sorted(map(str, out["kpi_hour"].read(spark).collect())) == before
    sums = out["kpi_hour"].read(spark).agg(*[F.sum(c).alias(c) for c, t in out["kpi_hour"].values.items() if t != "string"])
    total = sums.first().asDict()
    for name in ("pay_money", "pay_money_new", "regi_account_num", "pay_account_num", "show_num", "download_num",
                 "adpage_click_num", "request_num"):
        assert total[name] > 0, name
    assert total["pay_account_num"] == total["dau_pay_account_num"]
    day = out["kpi_day"].read(spark)
    assert day.agg(F.sum("show_num")).first()[0] == total["show_num"]
    assert day.filter("pay_account_num > 0 and os is null").count() == 0
    assert out["game_day"].read(spark).count() > 0


def test_stale_keys_become_zero_only_on_request(spark, site):
    """A run over a smaller order table no longer has some keys of the first run."""
    few = str(site / "few")
    for name in ("registrations", "publish_games", "game_sdk"):
        spark.read.parquet(str(site / "tables" / name)).write.parquet(f"{few}/{name}")
    spark.read.parquet(str(site / "tables" / "orders")).filter("order_time < '2024-01-08'").write.parquet(f"{few}/orders")
    argv = ["base-kpi-offline", "--out", str(site / "stale"), *DAYS]

    def paid(tables, *extra):
        jobs.run(spark, jobs.arguments([*argv, "--tables", tables, *extra]))
        hours = jobs.results(str(site / "stale"))["kpi_hour"].read(spark)
        return hours.filter("pay_money <> 0").agg(F.min("publish_time"), F.max("publish_time"), F.sum("pay_money")).first()

    first = paid(str(site / "tables"))
    kept = paid(few)
    assert kept == first and first[1] >= "2024-01-12"
    zeroed = paid(few, "--zero-stale")
    assert zeroed[1] < "2024-01-08" and zeroed[0] == first[0] and 0 < zeroed[2] < first[2]


def test_cohort_jobs_do_not_blank_each_other(spark, site):
    run(spark, site, "retention", "--day", "2024-01-20")
    first = run(spark, site, "ltv", "--day", "2024-01-20")["cohort"].read(spark)
    row = first.agg(F.sum("retained_1day"), F.sum("ltv_1day"), F.count("*")).first()
    assert row[0] > 0 and row[1] != 0 and row[2] > 0


def test_bills_and_recommendations(spark, site):
    out = run(spark, site, "sdk-bills", "--start", "1998-01-01", "--end", "1998-02-01")
    assert out["bills"].read(spark).count() > 0
    out = run(spark, site, "co-download", "--alias", "downloads=downloads")
    lists = out["recommend"].read(spark)
    assert lists.count() > 0 and lists.filter("game_id_rs = ''").count() == 0


def test_points_stream(spark, site):
    argv = ["points", "--tables", str(site / "tables"), "--out", str(site / "pts"), "--lines", str(site / "points"),
            "--integral", "50"]
    jobs.run(spark, jobs.arguments(argv))
    jobs.run(spark, jobs.arguments(argv))  # nothing new
    job = jobs.stream_job("points", {"account_bind": None, "member": None, "game_name": None}, jobs.arguments(argv))
    detail = job.detail.read(spark).agg(F.sum("points"), F.max("real_points"), F.count("*")).first()
    assert detail[0] == detail[1] and detail[2] > 0
    assert job.quotas.read(spark).agg(F.sum("points")).first()[0] == detail[0]
