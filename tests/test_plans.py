import random
from collections import Counter
from itertools import permutations
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from gamepulse.operators.accounts import account_channels
from gamepulse.operators.dims import enrich_kpi
from gamepulse.operators.ordering import dense_numbers, expand_copies, running_total
from gamepulse.plans import bills, cohort, kpi_batch, points, recommend

REGI = "game_account string, game_id int, expand_channel string, imei string, reg_time string"
LOGIN = "game_account string, login_time string"
ORDER = (
    "order_id bigint, game_account string, game_id int, order_time string, order_status int, "
    "ori_price decimal(18,2), total_amt decimal(18,2), prod_type int"
)


def money_frame(spark, rows, schema):
    from decimal import Decimal

    return spark.createDataFrame([tuple(Decimal(str(v)) if isinstance(v, float) else v for v in r) for r in rows], schema)


def games(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "game_id int")


# --- ordering ---------------------------------------------------------------------------


def brute_running(rows, start):
    total, out = start, []
    for r in sorted(rows):
        total += r[2]
        out.append((*r, total))
    return sorted(out)


def test_running_total_matches_a_plain_loop(spark):
    rng = random.Random(3)
    rows = [(f"t{rng.randint(0, 40):02d}", f"i{rng.randint(0, 5)}", rng.randint(-3, 9)) for _ in range(3000)]
    rows += [("t07", "i1", 4)] * 1500  # a third of the rows are copies of one row
    df = spark.createDataFrame(rows, "t string, i string, v int").repartition(7)
    got = sorted(tuple(r) for r in running_total(df, ["t", "i"], "v", "total", 100).collect())
    assert got == brute_running(rows, 100)


def test_running_total_of_nothing(spark):
    df = spark.createDataFrame([], "t string, v int")
    assert running_total(df, ["t"], "v", "total", 5).count() == 0


def test_running_total_uses_no_single_partition_window(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("t"), F.lit(1).alias("v"))
    out = running_total(df, ["t"], "v", "total")
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [ln for ln in plan.splitlines() if "windowspecdefinition(" in ln]
    assert windows and all("sum(_sum#" in ln and "windowspecdefinition(_part#" in ln for ln in windows)


def test_running_total_moves_rows_once(spark):
    """After the range shuffle, only the totals of the partitions are exchanged."""
    df = spark.range(1000).select(F.col("id").cast("string").alias("t"), F.lit(1).alias("v"))
    plan = running_total(df, ["t"], "v", "total")._jdf.queryExecution().executedPlan().toString()
    moved = [ln for ln in plan.splitlines() if "Exchange " in ln and "BroadcastExchange" not in ln]
    assert moved and "SortMergeJoin" not in plan
    below = plan.splitlines()
    start = next(i for i, ln in enumerate(below) if "BroadcastExchange" in ln)
    assert all(below.index(ln) > start for ln in moved)


def test_running_total_carries_over_batches(spark):
    """Partitions of several record batches, names that need quoting and an empty partition."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(500).select(F.format_string("%04d", "id").alias("a b"), F.col("id").cast("int").alias("v"))
        got = {r["a b"]: r["total"] for r in running_total(df, ["a b"], "v", "total").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {f"{i:04d}": i * (i + 1) // 2 for i in range(500)}


def test_expand_copies_in_blocks(spark):
    df = spark.createDataFrame([("a", 10000), ("b", 1)], "k string, _copies bigint")
    got = expand_copies(df, number="n")
    assert {tuple(r) for r in got.groupBy("k").agg(F.count("*"), F.min("n"), F.max("n")).collect()} == {
        ("a", 10000, 1, 10000), ("b", 1, 1, 1),
    }


def test_dense_numbers(spark):
    keys = [f"d{i % 137:03d}" for i in range(2000)] + [None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    got = dict(tuple(r) for r in dense_numbers(df, "k", "n").collect())
    assert got == {k: i for i, k in enumerate(sorted({k for k in keys if k}))}


# --- warehouse KPIs ---------------------------------------------------------------------


@pytest.fixture
def spelled(spark):
    """One account registered as two spellings and channels, on a listed and an unlisted game."""
    return spark.createDataFrame([
        (" ACC ", 1, "b_b_b", "i1", "2024-01-02 00:00:00"), ("acc", 1, "", "i1", "2024-01-01 00:00:00"),
        ("acc", 1, "", "i1", "2024-01-03 00:00:00"), ("acc", 9, "off", "i1", "2024-01-01 00:00:00"),
    ], REGI)


def sale(order_id, account, price, time="2024-01-05 10:00:00", status=4, game=1, kind=1):
    return (order_id, account, game, time, status, float(price), 0.0, kind)


def test_money_is_credited_per_spelling_and_channel(spark, rows, spelled):
    orders = money_frame(spark, [sale(1, "Acc", 2.5), sale(1, "Acc", 2.5), sale(2, "ACC ", 1.0), sale(3, "x", 9.0)], ORDER)
    got = kpi_batch.pay_money_hour(orders, spelled, games(spark, 1, 1), "2024-01-05", "2024-01-05")
    assert rows(got) == [("2024-01-05 10", 1, "21", 3.5), ("2024-01-05 10", 1, "b_b_b", 3.5)]
    first = kpi_batch.pay_money_hour(orders, spelled, games(spark, 1), "2024-01-05", "2024-01-05", "first")
    assert rows(first) == [("2024-01-05 10", 1, "21", 3.5)]
    with pytest.raises(ValueError):
        account_channels(spelled, "last")


def test_accounts_count_in_their_first_hour(spark, rows, spelled):
    orders = money_frame(spark, [
        sale(1, "acc", 1, "2024-01-05 12:00:00"), sale(2, "ACC", 1, "2024-01-05 09:30:00"),
        sale(3, "acc", 1, "2024-01-06 09:30:00"), sale(4, "acc", 1, "2024-01-05 01:00:00", status=8),
        sale(5, "acc", 1, "2024-01-05 02:00:00", game=None),
    ], ORDER)
    got = kpi_batch.pay_accounts_hour(orders, spelled, games(spark, 1), "2024-01-05", "2024-01-06")
    assert rows(got) == [(f"2024-01-0{d} 09", 1, c, 1) for d in (5, 6) for c in ("21", "b_b_b")]


def test_click_types_are_absent_not_zero(spark, rows):
    events = spark.createDataFrame([
        (1, "a_b_c", 1, "2024-01-05 10:00:00"), (1, "A_B_C", 1, "2024-01-05 11:00:00"), (2, "", 1, "2024-01-05 10:00:00"),
        (4, "x", 1, "2024-01-05 10:00:00"), (1, "x", 2, "2024-01-05 10:00:00"),
    ], "channel_type int, expand_channel string, game_id int, channel_time string")
    hours = kpi_batch.clicks_hour(events, games(spark, 1), "2024-01-05", "2024-01-05")
    assert rows(kpi_batch.click_count(hours, "show_num")) == [("2024-01-05 10", 1, "A_B_C", 1), ("2024-01-05 11", 1, "A_B_C", 1)]
    assert rows(kpi_batch.click_count(hours, "show_num", "day")) == [("2024-01-05", 1, "A_B_C", 2)]
    assert rows(kpi_batch.click_count(hours, "download_num")) == [("2024-01-05 10", 1, "21", 1)]


def test_dimension_defaults(spark):
    rows = spark.createDataFrame(
        [("2024-01-05 10", 1, "A", "", "C"), ("2024-01-06 10", 2, "A", "", "X")],
        "publish_time string, game_id int, parent_channel string, child_channel string, ad_label string",
    )
    sdk = spark.createDataFrame(
        [(1, 2, 9, 101), (1, 1, 3, 100), (1, 7, 3, 102)], "old_game_id int, system_type int, group_id int, game_id int"
    )
    pkg = spark.createDataFrame([("c", "acct", "feed")], "pkg_code string, medium_account string, promotion_channel string")
    pkg_day = spark.createDataFrame(
        [("c", "2024-01-06", "cpc", "who")], "pkg_code string, order_date string, promotion_mode string, head_people string"
    )
    got = {r["game_id"]: r.asDict() for r in enrich_kpi(rows, sdk, pkg, pkg_day).collect()}
    names = ["group_id", "os", "parent_game_id", "medium_account", "promotion_channel", "promotion_mode", "head_people"]
    assert [got[1][n] for n in names] == ["3", "1", "100", "acct", "feed", "", ""]
    assert [got[2][n] for n in names] == ["0", "1", "0", "", "", "", ""]


# --- cohorts ------------------------------------------------------------------------------


@pytest.fixture
def cohort_regi(spark):
    return spark.createDataFrame([
        ("a", 1, "c", "i", "2024-01-01 08:00:00"), ("a", 1, "c", "i", "2024-01-01 09:00:00"),
        ("b", 1, "c", "i", "2024-01-01 08:00:00"), ("z", 1, "", "i", "2024-01-02 08:00:00"),
        ("old", 1, "c", "i", "2023-12-31 08:00:00"), ("off", 5, "c", "i", "2024-01-01 08:00:00"),
    ], REGI)


def test_retention_offsets(spark, rows, cohort_regi):
    seen = [("a", d) for d in ("2024-01-02", "2024-01-15", "2024-01-30", "2024-02-29", "2024-01-01", "2024-01-09")]
    seen += [("a", "2024-01-02"), ("b", "2024-02-29"), ("old", "2024-01-01"), ("off", "2024-01-02"), ("z", "2024-02-29")]
    logins = spark.createDataFrame([(a, f"{d} 10:00:00") for a, d in seen], LOGIN)
    got = cohort.retention(cohort_regi, logins, games(spark, 1), "2024-02-29")
    # 1, 14, 29 and 59 days after; the size counts both rows of account a.
    assert rows(got) == [("2024-01-01", 1, "c", 3, 1, 0, 0, 0, 0, 0, 1, 1, 2)]
    kept = cohort.retention(cohort_regi, logins, games(spark, 1), "2024-02-29", keep_empty=True)
    assert rows(kept)[1] == ("2024-01-02", 1, "21", 1, *[0] * 9)


def test_ltv_windows(spark, rows, cohort_regi):
    orders = money_frame(spark, [
        sale(1, "b", 1.0, "2024-01-01 10:00:00"), sale(2, "b", 2.0, "2024-01-02 10:00:00"),
        sale(3, "b", 4.0, "2024-01-03 10:00:00"), sale(4, "b", 0.5, "2024-01-03 11:00:00", status=8),
        sale(5, "b", 8.0, "2024-02-29 10:00:00"), sale(6, "b", 16.0, "2024-03-01 10:00:00"),
        sale(7, "a", 100.0, "2024-01-20 10:00:00"), sale(8, "b", 32.0, "2023-12-31 10:00:00"),
    ], ORDER)
    got = rows(cohort.ltv(cohort_regi, orders, games(spark, 1), "2024-02-29"))
    # Account a has two registration rows, so its order counts twice.
    assert got[0] == ("2024-01-01", 1, "c", 3, 3.0, 6.5, 6.5, 6.5, 6.5, 6.5, 6.5, 206.5, 214.5)
    assert got[1] == ("2024-01-02", 1, "21", 1, *[0.0] * 9)
    assert len(got) == 2


def test_cohort_accounts_can_be_normalised(spark, rows, cohort_regi):
    logins = spark.createDataFrame([(" B ", "2024-01-02 10:00:00")], LOGIN)
    assert rows(cohort.retention(cohort_regi, logins, games(spark, 1), "2024-02-01")) == []
    got = cohort.retention(cohort_regi, logins, games(spark, 1), "2024-02-01", normalise=True)
    assert rows(got) == [("2024-01-01", 1, "c", 3, 1, *[0] * 8)]


# --- bills --------------------------------------------------------------------------------


def test_bill_keys_are_unique_and_sandbox_orders_left_out(spark, rows):
    req = money_frame(spark, [
        (1, "A ", 1, 10.0, 1, "2024-01-01 00:00:00"), (2, "a", 1, 5.0, 1, "2024-01-01 05:00:00"),
        (3, "b", 1, 7.0, 1, "2024-01-01 05:00:00"), (4, "a", 1, 99.0, 0, "2024-01-01 05:00:00"),
        (5, "a", 1, 99.0, 1, "2024-01-02 00:00:00"), (6, "a", 1, 99.0, 1, "2024-01-01 05:00:00"),
        (None, "a", 1, 1.0, 1, "2024-01-01 06:00:00"),
    ], "order_no bigint, account string, game_id int, amount decimal(18,2), status int, req_time string")
    accounts = spark.createDataFrame([("a", None, None), ("c", 3, "ios")], "account string, account_channel int, os string")
    companies = spark.createDataFrame([(2, "x")], "id int, corporation_name string")
    receipts = spark.createDataFrame([(6, 1, 3), (1, 1, 1), (2, 0, 3)], "order_sn bigint, sandbox int, state int")
    got = bills.sdk_bills(req, accounts, companies, receipts, "2024-01-01", "2024-01-02")
    assert rows(got) == [("2024-01-01", 1, 0, "", "", 23.0)]


# --- recommendations ----------------------------------------------------------------------


def brute_pairs(rows):
    owned = {}
    for d, g in rows:
        owned.setdefault(d, set()).add(g)
    return Counter(p for s in owned.values() for p in permutations(sorted(s), 2))


@pytest.mark.parametrize("chunk", [1, 4, 256])
def test_co_download_counts(spark, chunk):
    rng = random.Random(5)
    rows = [(f"d{rng.randint(0, 60)}", rng.randint(0, 25)) for _ in range(600)]
    rows += [("hot", g) for g in range(26)] * 15  # one device holds a third of the rows
    rows += [(f"copy{i}", g) for i in range(40) for g in (1, 2, 3)]
    df = spark.createDataFrame(rows, "imei string, game_id int")
    got = {(r[0], r[1]): r[2] for r in recommend.co_download_counts(df, chunk).collect()}
    assert got == dict(brute_pairs(rows))


def test_top_lists(spark, rows):
    counts = spark.createDataFrame(
        [(1, 2, 9), (1, 3, 10), (1, 4, 100), (1, 5, 9)], "game_id int, game_id_rs int, download_num bigint"
    )
    assert rows(recommend.co_download_topk(counts, 3)) == [(1, "4|3|2")]
    assert rows(recommend.co_download_topk(counts, 3, "text")) == [(1, "4|3|2")]
    assert rows(recommend.co_download_topk(counts, 1, "text")) == [(1, "4")]
    low = spark.createDataFrame([(1, 2, 2), (1, 3, 10)], "game_id int, game_id_rs int, download_num bigint")
    assert rows(recommend.co_download_topk(low, 2, "text")) == [(1, "3|2")]


def test_ratings_and_lists(spark):
    rows = [(f"d{i}", g) for i in range(40) for g in range(i % 4, 12, 2)] + [("d1", 1)] * 3
    downloads = spark.createDataFrame(rows, "imei string, game_id int")
    ratings = recommend.als_ratings(downloads).cache()
    assert ratings.count() == len(rows)
    assert recommend.als_ratings(downloads, repeats=False).count() == len(set(rows))
    number = {d: i for i, d in enumerate(sorted({d for d, _ in rows}))}
    assert Counter((r[0], r[1]) for r in ratings.collect()) == Counter((number[d], g) for d, g in rows)
    grid = recommend.AlsGrid((2,), (0.1,), (3,))
    lists = recommend.als_lists(recommend.fit_als(ratings, grid), ratings, 5).collect()
    assert {r[0] for r in lists} == {g for _, g in rows}
    for game, text in lists:
        items = text.split("|")
        assert str(game) not in items and len(items) == len(set(items)) <= 5
    assert recommend.als_rmse(ratings, 2, 0.1, 3).first()["rmse"] < 1


# --- points -------------------------------------------------------------------------------


def test_points_names_and_defaults(spark):
    signin = spark.createDataFrame(
        [("t1", "10", "7", 0, 1.9, 0.0, 4), ("t2", "10", "", 0, 2.0, 0.0, 4), ("t3", "10", "7", 0, 2.0, 0.0, 3)],
        "obtain_time string, obtain_id string, uid string, game_id int, points double, ori_price double, resource int",
    )
    recharge = spark.createDataFrame(
        [("t4", "W1", 1, "acc", 5.0, 5.0, 4, "v2.2"), ("t5", "W2", 2, "none", 0.5, 0.5, 4, "v2.2"),
         ("t6", "W3", 1, "acc", 5.0, 5.0, 8, "v2.2"), ("t7", "W4", 1, "acc", 5.0, 5.0, 4, "v2.1")],
        "obtain_time string, obtain_id string, game_id int, game_account string, points double, ori_price double, "
        "order_state int, version string",
    )
    binds = spark.createDataFrame([("acc", "7")], "game_account string, bind_member_id string")
    members = spark.createDataFrame([("7", "seven"), ("0", "zero")], "member_id string, username string")
    names = spark.createDataFrame([(1, "one")], "game_id int, name string")
    resolved = points.resolve_points(points.points_union(signin, recharge), binds, names, 50)
    rich = points.enrich_points(points.points_union(signin, recharge), binds, members, names, 50)
    got = {r["obtain_time"]: (r["uid"], r["uname"], r["game_name"], r["points"]) for r in rich.collect()}
    assert got == {
        "t1": ("7", "seven", "", 1.9), "t2": ("0", "", "", 2.0), "t4": ("7", "seven", "one", 2.0),
        "t5": ("0", "zero", "", 1.0),
    }
    total = {r["obtain_time"]: (r["points"], r["real_points"]) for r in points.points_running_total(rich, 10).collect()}
    assert total == {"t1": (1, 11), "t2": (2, 13), "t4": (2, 15), "t5": (1, 16)}
    assert {tuple(r) for r in points.quota_sum(resolved, members).collect()} == {("7", "seven", 3), ("0", "", 3)}
    assert {tuple(r) for r in points.quota_count(resolved, members).collect()} == {("7", "seven", 2), ("0", "", 2)}


def test_als_ratings_are_joined_once(spark):
    """Fits and predictions read stored numbers; the lines are not numbered again for each."""
    downloads = spark.createDataFrame([(f"d{i % 9}", i % 4) for i in range(40)] + [("d1", 1)], "imei string, game_id int")
    ratings = recommend.als_ratings(downloads)
    plan = ratings._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and ratings.count() == 41


def test_blocks_of_games_have_no_bearing_on_the_model(spark, monkeypatch):
    rows = [(f"d{i % 60}", (i * i + i // 7) % 23) for i in range(400)]
    ratings = recommend.als_ratings(spark.createDataFrame(rows, "imei string, game_id int"))
    assert recommend._als(17, ratings).getNumItemBlocks() == 3
    few = recommend.als_rmse(ratings, 3, 0.1, 5).first()
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 40)
    assert recommend._als(17, ratings).getNumItemBlocks() == 10
    many = recommend.als_rmse(ratings, 3, 0.1, 5).first()
    assert few["predictions"] == many["predictions"] > 40 and abs(few["rmse"] - many["rmse"]) < 1e-5


def test_game_lists_come_from_the_best_games_of_each_owner(spark):
    rng = random.Random(4)
    for games, users, k in ((12, 30, 4), (12, 30, 20), (40, 200, 7), (5, 9, 4)):
        features = {g * 3 + 1: [float(rng.randint(-2, 2)) for _ in range(3)] for g in range(games)}
        tastes = {u: [float(rng.randint(-3, 3)) for _ in range(3)] for u in range(users)}
        owned = [(u, rng.choice(list(features))) for u in tastes for _ in range(rng.randint(1, 5))]
        votes = {}
        for u, g in {*owned, (1, 2)}:  # game 2 is in no model, but on a device
            best = sorted((-sum(x * y for x, y in zip(tastes[u], f)), h) for h, f in features.items() if h != g)[:k]
            for score, h in best:
                votes.setdefault(g, Counter())[h] += score
        want = {g: "|".join(str(h) for h, _ in sorted(v.items(), key=lambda x: (x[1], x[0]))[:k]) for g, v in votes.items()}
        model = SimpleNamespace(
            rank=3, userFactors=spark.createDataFrame(list(tastes.items()), "id int, features array<float>"),
            itemFactors=spark.createDataFrame(list(features.items()), "id int, features array<float>"))
        ratings = spark.createDataFrame([*owned, *owned[:9], (1, 2), (999, 1), (0, None), (None, 1)], "user_id int, game_id int")
        for chunk in (7, 1 << 15):
            assert {r[0]: r[1] for r in recommend.als_lists(model, ratings, k, chunk).collect()} == want


def test_best_games_do_not_depend_on_blocks():
    rng = np.random.default_rng(2)
    users, games = rng.integers(-2, 3, (50, 3)).astype(float), rng.integers(-2, 3, (37, 3)).astype(float)
    every = users @ games.T
    for k in (1, 5, 35, 36, 37, 60):
        for block, products in ((4096, 1 << 22), (4, 50), (1, 1)):
            best, scores, last = recommend._best_games(users, games, k, block, products)
            for i, row in enumerate(every):
                want = np.lexsort((np.arange(37), -row))[:k + 1]
                assert sorted(want) == list(best[i]) and list(scores[i]) == list(row[best[i]])
                assert last[i] == (list(best[i]).index(want[-1]) if k < 37 else -1)


def test_a_fit_keeps_one_iteration(spark):
    """Factors of games are stored each time, so what earlier iterations exchanged is dropped, and what a fit leaves is collected."""
    rows = [(f"d{i % 60}", (i * i + i // 7) % 23) for i in range(400)]
    ratings = recommend.als_ratings(spark.createDataFrame(rows, "imei string, game_id int"))
    assert recommend._als(17, ratings).getCheckpointInterval() == 1
    seen, let_go = [], recommend._let_go
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(recommend, "_let_go", lambda s: seen.append(let_go(s)))
        recommend.fit_als(ratings, recommend.AlsGrid((2, 3), (0.1,), (2,)))
    assert len(seen) == 2


def test_blocks_on_both_sides_grow_with_the_ratings(spark, monkeypatch):
    rows = [(f"d{i % 60}", (i * i + i // 7) % 23) for i in range(400)]
    ratings = recommend.als_ratings(spark.createDataFrame(rows, "imei string, game_id int"))
    few = recommend._als(17, ratings)
    assert (few.getNumUserBlocks(), few.getNumItemBlocks()) == (10, 3) and recommend.BLOCK_RATINGS <= 1 << 23
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 20)
    many = recommend._als(17, ratings)
    assert (many.getNumUserBlocks(), many.getNumItemBlocks()) == (20, 20)
    assert recommend.als_rmse(ratings, 3, 0.1, 5).first()["predictions"] > 40
