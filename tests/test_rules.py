"""Rules that the small fixtures do not reach: repeats, folding keys, refused rows, late retries."""

from decimal import Decimal

from pyspark.sql import functions as F

from gamepulse.functions.channel import fold_channel, split_channel
from gamepulse.plans import kpi_batch, points, recommend
from gamepulse.streaming.store import MergeTable

ORDER = "order_sn string, game_account string, game_id int, order_time string, order_status int, ori_price decimal(18,2), total_amt decimal(18,2), prod_type int"


def test_orders_that_differ_in_any_column_all_count(spark):
    row = ("acc", 1, "2024-01-05 01:00:00", 4, Decimal("10.00"), Decimal("0.00"), 6)
    orders = spark.createDataFrame([("a", *row), ("b", *row), ("b", *row)], ORDER)
    regi = spark.createDataFrame([("acc", 1, "ch", "2024-01-01 00:00:00")], "game_account string, game_id int, expand_channel string, reg_time string")
    games = spark.createDataFrame([(1,)], "game_id int")
    got = kpi_batch.pay_money_hour(orders, regi, games, "2024-01-05", "2024-01-05").collect()
    assert [r["pay_money"] for r in got] == [Decimal("20.00")]
    sdk = spark.createDataFrame([(1, 1, 7, 100), (1, 2, 7, 100)], "old_game_id int, system_type int, group_id int, game_id int")
    got = kpi_batch.pay_money_key_day(orders, regi, sdk, "2024-01-05", "2024-01-05").collect()
    assert [r["pay_money"] for r in got] == [Decimal("20.00")]
    assert kpi_batch.pay_accounts_key_day(orders, regi, sdk, "2024-01-05", "2024-01-05").first()["pay_account_num"] == 1


def test_money_keeps_cents_on_large_totals(spark):
    big = Decimal("9007199254740993.01")
    orders = spark.createDataFrame([(str(i), "a", 1, "2024-01-05 01:00:00", 4, p, Decimal("0.00"), 1) for i, p in enumerate([big, Decimal("0.02")])], ORDER)
    regi = spark.createDataFrame([("a", 1, "ch", "2024-01-01 00:00:00")], "game_account string, game_id int, expand_channel string, reg_time string")
    got = kpi_batch.pay_money_hour(orders, regi, spark.createDataFrame([(1,)], "game_id int"), "2024-01-05", "2024-01-05")
    assert got.first()["pay_money"] == Decimal("9007199254740993.03")


def test_folded_channels_equal_their_key_parts(spark):
    texts = ["a_b_c", "A_b_c_d", "a_b_c__", "a_b", "a_b_", "", "0", "x", None, "_", "a__c"]
    df = spark.createDataFrame([(t,) for t in texts], "expand_channel string")
    both = df.select("expand_channel", fold_channel("expand_channel").alias("f"))
    raw = [tuple(r)[1:] for r in split_channel(both.select("f", "expand_channel"), case="upper").collect()]
    again = [tuple(r)[1:] for r in split_channel(both.select("expand_channel", "f").withColumnRenamed("expand_channel", "x"), "f", case="upper").collect()]
    assert raw == again
    folds = [r["f"] for r in both.collect()]
    assert len({f for f in folds}) == len({p for p in raw})


def test_points_are_whole_and_the_rest_refused(spark):
    rows = spark.createDataFrame([(x,) for x in (3e9, -1.7, float("nan"), float("inf"), 1e300, None)], "points double")
    good, bad = points.points_gate(rows)
    assert sorted(r[0] for r in good.select(points.whole("points")).collect()) == [-1, 3_000_000_000]
    assert bad.count() == 4


def test_pairs_stay_on_one_side(spark):
    ratings = spark.range(3000).select((F.col("id") % 40).cast("int").alias("user_id"), (F.col("id") % 30).cast("int").alias("game_id"), F.lit(1.0).alias("rating"))
    train, test = recommend.split_pairs(ratings)
    assert train.count() + test.count() == 3000 and test.count() > 0
    assert train.join(test, ["user_id", "game_id"]).count() == 0


def test_retry_of_a_dead_commit_survives_compaction(spark, tmp_path):
    table = MergeTable(str(tmp_path / "t"), {"k": "int"}, {"n": "bigint"})
    rows = lambda n: spark.createDataFrame([(1, n)], "k int, n bigint")
    (tmp_path / "t" / "writer=job" / "batch_id=7" / "seq=1").mkdir(parents=True)  # died before it finished
    table.write(rows(5), "other", "1", {"n": "increment"})
    table.compact(spark)
    table.write(rows(5), "job", "7", {"n": "increment"})
    assert table.read(spark).first()["n"] == 10
    table.write(rows(5), "job", "7", {"n": "increment"})  # a replay still changes nothing
    assert table.read(spark).first()["n"] == 10
