import pytest
from pyspark.sql import functions as F

from gamepulse.sources import logs

HEAD = "2024-01-01 00:00:00,000 [INFO] bi: "
GOOD = {
    "pubgame": "bi_pubgame|7",
    "channel_hour": "bi_channel|1|a_b_c|ip|2024-01-05 10:11:12|7",
    "channel_os": "bi_channel|1|a_b_c|ip|2024-01-05 10:11:12|7|6.0|2",
    "active_hour": "bi_active|7|||a_b_c|2024-01-05 10:11:12",
    "active_device": "bi_active|7|||a_b_c|2024-01-05 10:11:12|||imei9&x=1",
    "order_hour": "bi_order||W1|||acc|2024-01-05 10:11:12|7|||6.00|3.00|0.00|||||||4",
    "order": "bi_order||W1|||acc|2024-01-05 10:11:12|7|||6.00|3.00|0.00|||||||4",
    "regi": "bi_regi|||acc|7|2024-01-05 10:11:12|1|||||||a_b_c",
    "login_day": "bi_login|||acc|2024-01-05 10:11:12||a_b_c|7|ip",
    "login_hour": "bi_login|||acc|2024-01-05 10:11:12||a_b_c||7|ip",
    "points_signin": "bi_points|10|u1|2024-01-05 10:11:12|||1||4",
    "points_recharge": "bi_order||W1|||acc|2024-01-05 10:11:12|7|||6.00|3.00|5.50|||||||4||||||V2.2",
    "appdownload": "bi_appdownload|7|18|imei9|android",
}
WANT = {
    "pubgame": {"game_id": 7},
    "channel_hour": {"type": 1, "expand_channel": "a_b_c", "game_id": 7, "publish_time": "2024-01-05 10"},
    "channel_os": {"publish_time": "2024-01-05", "os_info": "6.0", "os": 2},
    "active_hour": {"game_id": 7, "publish_time": "2024-01-05 10"},
    "active_device": {"imei": "imei9", "update_time": "2024-01-05 10:11:12"},
    "order_hour": {"game_account": "acc", "order_state": 4, "publish_time": "2024-01-05 10", "game_id": 7},
    "order": {"order_status": 4, "order_time": "2024-01-05 10:11:12"},
    "regi": {"game_account": "acc", "resource_id": 1, "publish_time": "2024-01-05 10"},
    "login_day": {"login_time": "2024-01-05", "game_id": 7},
    "login_hour": {"login_time": "2024-01-05 10", "game_id": 7},
    "points_signin": {"obtain_id": "10", "uid": "u1", "game_id": 0, "points": 1.0, "ori_price": 0.0, "resource": 4},
    "points_recharge": {"obtain_id": "W1", "points": 5.5, "ori_price": 5.5, "order_state": 4, "version": "v2.2"},
    "appdownload": {"imei": "imei9", "game_id": 7},
}


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.mark.parametrize("kind", sorted(GOOD))
def test_good_line(spark, kind):
    df = lines(spark, HEAD + GOOD[kind])
    got = logs.parse(df, kind).collect()
    assert len(got) == 1 and logs.rejects(df, kind).count() == 0
    assert {k: got[0][k] for k in WANT[kind]} == WANT[kind]


@pytest.mark.parametrize("kind", sorted(GOOD))
def test_bad_lines_become_rejects(spark, kind):
    """Short lines and bad numbers are kept as rejects; lines without the tag are neither."""
    tag, good = logs.KINDS[kind].tag, GOOD[kind]
    bad = [HEAD + tag, HEAD + tag + "|x", HEAD + good.replace("|7", "|x7"), HEAD + good.replace("|7", "|2147483648"),
           HEAD + good.replace("|7", "| 7")]
    if kind == "points_signin":
        bad = [HEAD + tag, HEAD + good.replace("||4", "||x"), HEAD + good.replace("|||1|", "|x||1|")]
    if kind == "points_recharge":
        bad = [b for b in bad if b.count("|") >= 25]
    df = lines(spark, *bad, HEAD + good, "", HEAD + "bi_other|7")
    assert logs.parse(df, kind).count() == 1
    assert sorted(r[0] for r in logs.rejects(df, kind).collect()) == sorted(bad)


def test_null_mark_and_blank_channel(spark):
    df = lines(spark, HEAD + "bi_channel|1|\\N|ip|2024-01-05 10:11:12|7", HEAD + "bi_channel|1||ip|2024-01-05 10:11:12|7")
    assert sorted(r[0] for r in logs.parse(df, "channel_hour").select("expand_channel").collect()) == ["21", "pyw"]


def test_short_recharge_is_not_a_recharge_line(spark):
    df = lines(spark, HEAD + GOOD["order"])
    assert logs.parse(df, "points_recharge").count() == 0 and logs.rejects(df, "points_recharge").count() == 0


REQUEST = '192.0.2.1 - - [29/Jun/2017:16:54:53 +0800] "GET /Ssxy/loadComplete?p={p}&g={g} HTTP/1.{v} 43 "-"'


def test_requests(spark):
    df = lines(
        spark,
        REQUEST.format(p="auc_x_1", g="3995&os_info=6.0&os_type=1", v='0" 200'),
        REQUEST.format(p="auc_x_1", g="12", v='0" 404'),
        REQUEST.format(p="auc_x_1", g="13", v='1" 404'),
        REQUEST.format(p="bad-channel", g="14", v='1" 200'),
        REQUEST.format(p="auc", g="99999999999", v='1" 200'),
        REQUEST.format(p="auc", g="15", v='1" 200').replace("Jun", "Foo"),
        REQUEST.format(p="auc", g="16", v='1" 200').replace("/Ssxy/loadComplete", "/index.html"),
    )
    got = sorted(tuple(r) for r in logs.parse_request(df).collect())
    assert got == [("auc_x_1", 13, "2017-06-29 16"), ("auc_x_1", 3995, "2017-06-29 16")]
    assert logs.request_rejects(df).count() == 2
    assert [tuple(r) for r in logs.parse_request(df, drop_all_404=True).collect()] == [("auc_x_1", 3995, "2017-06-29 16")]
    batch = logs.parse_request_batch(df).filter("game_id = 13").first()
    assert tuple(batch) == ("AUC_X_1", 13, "2017-06-29 16:01:10")


def test_line_is_split_once(spark):
    """The null test must not be pushed below the split, where it would repeat it per column."""
    plan = logs.parse(lines(spark, "x").filter(F.rand() < 2), "regi")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1
