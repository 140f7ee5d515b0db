import pytest
from pyspark.sql import functions as F

from gamepulse.checks import stream_queries as sq
from gamepulse.plans import points
from gamepulse.sources import logs
from gamepulse.sources.fixtures import fixture_tables, log_lines
from gamepulse.sources.streams import file_lines
from gamepulse.streaming.jobs import BaseKpiJob, PointsJob, SideJob
from gamepulse.streaming.run import run_available
from gamepulse.streaming.windows import WindowJob

HEAD = "2024-01-01 00:00:00,000 [INFO] bi: "
HOUR = ["publish_time", "game_id", "parent_channel", "child_channel", "ad_label"]


def text(spark, *lines):
    return spark.createDataFrame([(HEAD + ln,) for ln in lines], "value string")


def regi(account, channel="a_b_c", game=1):
    return f"bi_regi|||{account}|{game}|2024-01-01 08:00:00|1|||||||{channel}"


def order(account, time, amount="5.00", status=4, game=1):
    return f"bi_order||W|||{account}|{time}|{game}|||{amount}|||||||||{status}"


@pytest.fixture
def dims(spark):
    return {
        "game_sdk": spark.createDataFrame([(1, 2, 7, 100)], "old_game_id int, system_type int, group_id int, game_id int"),
        "pkg": spark.createDataFrame([("c", "acct", "feed")], "pkg_code string, medium_account string, promotion_channel string"),
        "pkg_day": spark.createDataFrame(
            [("c", "2024-01-05", "cpc", "who")],
            "pkg_code string, order_date string, promotion_mode string, head_people string",
        ),
    }


def hours(job, spark, *names):
    return {tuple(r[c] for c in HOUR[:1] + HOUR[2:3]): tuple(r[n] for n in names) for r in job.kpi_hour.read(spark).collect()}


def test_one_batch_or_many_give_the_same_tables(spark, sf_dir, dims, tmp_path):
    """Orders arrive split over batches, later hours first."""
    t = fixture_tables(spark, sf_dir)
    one, many = (BaseKpiJob(str(tmp_path / n), dims, keep_rejects=False) for n in ("one", "many"))
    one.process(log_lines(t, "pubgame", "regi", "channel", "order"), 0)
    many.process(log_lines(t, "pubgame", "regi"), 0)
    many.process(log_lines(sq.in_days(t, since="2024-01-11"), "order", "channel"), 1)
    many.process(log_lines(sq.in_days(t, before="2024-01-11"), "order", "channel"), 2)
    many.process(log_lines(sq.in_days(t, before="2024-01-11"), "order", "channel"), 2)  # replay

    def table(df, *drop):
        nonzero = df.filter(" or ".join(f"{c} <> 0" for c, k in df.dtypes if k == "bigint" or k.startswith("decimal")))
        return sorted([tuple(r) for r in nonzero.collect()], key=str)

    for name in ("kpi_hour", "kpi_day"):
        a, b = (getattr(j, name).read(spark) for j in (one, many))
        filled = [df.fillna(0, subset=["pay_account_num"]) for df in (a, b)]
        assert table(filled[0]) == table(filled[1]) and a.count() > 0


def test_account_moves_to_its_earlier_hour(spark, dims, tmp_path):
    job = BaseKpiJob(str(tmp_path), dims)
    job.process(text(spark, "bi_pubgame|1", regi("acc"), order("acc", "2024-01-05 12:00:00")), 0)
    assert hours(job, spark, "pay_account_num")[("2024-01-05 12", "A")] == (1,)
    job.process(text(spark, order("acc", "2024-01-05 09:00:00")), 1)
    got = hours(job, spark, "pay_account_num", "pay_money")
    assert got[("2024-01-05 09", "A")][0] == 1 and got[("2024-01-05 12", "A")][0] == 0
    assert [float(got[(f"2024-01-05 {h}", "A")][1]) for h in ("09", "12")] == [5.0, 5.0]


def test_run_date_limits_first_payments(spark, dims, tmp_path):
    job = BaseKpiJob(str(tmp_path), dims, run_date="2024-01-05")
    lines = [order("acc", f"2024-01-0{d} 12:00:00") for d in (4, 5)]
    job.process(text(spark, "bi_pubgame|1", regi("acc"), *lines), 0)
    got = hours(job, spark, "pay_account_num")
    assert got == {("2024-01-05 12", "A"): (1,), ("2024-01-04 12", "A"): (None,), ("2024-01-01 08", "A"): (None,)}


def test_attributes_rejects_and_days(spark, dims, tmp_path):
    job = BaseKpiJob(str(tmp_path), dims)
    job.process(text(
        spark, "bi_pubgame|1", "bi_pubgame|x", regi("acc"), regi("acc2", "waytoolongname_b_c"), regi("bad", game="x"),
        order("acc", "2024-01-05 12:00:00", "5.00"), order("acc", "2024-01-05 13:00:00", "2.00", status=8),
        "bi_channel|1|a_b_c_d|ip|2024-01-05 12:00:00|1", "bi_channel|3|A_B_C|ip|2024-01-05 12:00:00|1",
        "bi_channel|1|a_b_c|ip|2024-01-05 12:00:00|2",
    ), 0)
    row = job.kpi_hour.read(spark).filter("publish_time = '2024-01-05 12'").first()
    assert (row["show_num"], row["adpage_click_num"], float(row["pay_money"]), row["pay_account_num"]) == (1, 1, 5.0, 1)
    assert (row["os"], row["group_id"], row["parent_game_id"], row["medium_account"], row["promotion_mode"]) == (
        "2", "7", "100", "acct", "cpc",
    )
    day = job.kpi_day.read(spark).filter("publish_date = '2024-01-05'").first()
    assert (day["show_num"], float(day["pay_money"]), day["head_people"]) == (1, 3.0, "who")
    kinds = sorted(r["kind"] for r in job.rejects.read(spark).collect())
    assert kinds == ["channel", "pubgame", "regi"]


def test_compacted_job_goes_on(spark, dims, tmp_path):
    job = BaseKpiJob(str(tmp_path), dims)
    job.process(text(spark, "bi_pubgame|1", regi("acc"), order("acc", "2024-01-05 12:00:00")), 0)
    job.compact(spark)
    job.process(text(spark, order("acc", "2024-01-05 12:30:00")), 1)
    got = hours(job, spark, "pay_account_num", "pay_money", "regi_account_num")
    assert (got[("2024-01-05 12", "A")][0], float(got[("2024-01-05 12", "A")][1])) == (1, 10.0)
    assert got[("2024-01-01 08", "A")][2] == 1


def test_side_job_outputs(spark, sf_dir, tmp_path):
    t = fixture_tables(spark, sf_dir)
    job = SideJob(str(tmp_path / "t"))
    folder = str(tmp_path / "in")
    for i, kinds in enumerate([("pubgame", "login"), ("login", "active"), ("channel",)]):
        log_lines(t, *kinds).write.text(f"{folder}/{i}")
        run_available(file_lines(spark, folder), job.process, str(tmp_path / "c"))
    listed = t["fx_publish_game"].distinct()
    logins = t["fx_login"].join(listed, "game_id", "left_semi").filter("expand_channel not like 'way%'")
    keys = logins.select(F.substring_index("login_time", ":", 1), "game_id", "expand_channel", "game_account")
    assert job.logins.read(spark).count() == keys.distinct().count() > 0
    active = t["fx_active"].join(listed, "game_id", "left_semi").filter("expand_channel not like 'way%'")
    assert job.active.read(spark).count() == active.count() > 0
    shows = t["fx_channel"].join(listed, "game_id", "left_semi").filter("channel_type = 1")
    assert job.os_day.read(spark).agg(F.sum("os_sum")).first()[0] == shows.count() > 0


@pytest.mark.parametrize("quota", ["sum", "count"])
def test_points_job(spark, sf_dir, tmp_path, quota):
    """Two batches and a replay continue one running total."""
    t = fixture_tables(spark, sf_dir)
    dims = {"binds": t["fx_account_bind"], "members": t["fx_member"], "game_names": t["fx_game_name"]}
    job = PointsJob(str(tmp_path), dims, 50, quota)
    signin, recharge = log_lines(t, "signin"), log_lines(t, "recharge")
    for i, lines in enumerate([signin, recharge]):
        job.process(lines, i)
        job.process(lines, i)
    detail = job.detail.read(spark)
    rows = points.points_union(logs.parse(signin, "points_signin"), logs.parse(recharge, "points_recharge"))
    assert detail.count() == rows.count() > 0
    top, total = detail.agg(F.max("real_points"), F.sum("points")).first()
    assert top == total
    want = total if quota == "sum" else rows.count()
    assert job.quotas.read(spark).agg(F.sum("points")).first()[0] == want


def test_empty_batch_writes_nothing(spark, dims, tmp_path):
    BaseKpiJob(str(tmp_path / "b"), dims).process(text(spark), 0)
    assert not (tmp_path / "b").exists()


def test_a_small_batch_writes_only_the_keys_it_touches(spark, dims, tmp_path):
    """Later batches recount the days and games they touch, not all history."""
    job = BaseKpiJob(str(tmp_path / "kpi"), dims)
    lines = ["bi_pubgame|1", *[regi(f"a{i}") for i in range(6)], *[order(f"a{i}", f"2024-01-{10 + i} 05:00:00") for i in range(6)]]
    job.process(text(spark, *lines), 0)
    job.process(text(spark, order("a0", "2024-01-10 03:00:00")), 1)
    spark.catalog.clearCache()
    deltas = job.kpi_hour.deltas(spark).filter("batch_id = '1'")
    assert {r["publish_time"] for r in deltas.collect()} <= {"2024-01-10 03", "2024-01-10 05"} and deltas.count() > 0


def test_window_job_counts_late_rows_and_repeats(spark, tmp_path):
    """A batch is judged by the batches before it, also when it comes again later; bad times are kept."""
    def events(*times):
        return text(spark, *[f"bi_channel|1|a_b_c||{t}|7|x|1" for t in times])

    job = WindowJob(str(tmp_path / "t"), "1 hour")
    first = events("2024-01-01 12:10:00", "2024-01-01 02:00:00")
    second = events("2024-01-01 10:59:00", "2024-01-01 11:00:00", "2024-01-01 10:05:00", "no time")
    job.process(first, 0)
    job.process(second, 1)
    job.process(events("2024-01-03 00:00:00"), 2)
    job.process(second, 1)  # comes again after a later batch
    job.process(text(spark), 3)

    def counts(table):
        return {r["publish_time"]: r["event_num"] for r in table.read(spark).collect()}

    assert counts(job.hours) == {"2024-01-01 12": 1, "2024-01-01 02": 1, "2024-01-01 11": 1, "2024-01-03 00": 1}
    assert counts(job.late) == {"2024-01-01 10": 2}
    assert [r["kind"] for r in job.rejects.read(spark).collect()] == ["time"]
