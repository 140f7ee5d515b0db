"""Sketches, masks of active days, pruned pairs and norm-bounded lists: same results as the full work, and less of it."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gamepulse.plans import activity, cohort, kpi_batch, recommend, sketches


@pytest.fixture(scope="module")
def regi(spark):
    rows = [(f"a{i % 4000}", f"2024-01-{5 + i % 2:02d} {i % 24:02d}:10:00", i % 3, "x_y_z", f"d{i % 900}") for i in range(30_000)]
    rows += [(None, "2024-01-05 03:00:00", 7, "x_y_z", None), ("one", "2024-01-05 03:00:00", 8, "", "d")]
    return spark.createDataFrame(rows, "game_account string, reg_time string, game_id int, expand_channel string, imei string")


def test_sketches_of_hours_add_up_to_days(regi, rows):
    span = ("2024-01-05", "2024-01-06")
    exact = {tuple(r[c] for c in sketches.KEYS): r for r in kpi_batch._regi_day(regi, *span).collect()}
    rough = {tuple(r[c] for c in sketches.KEYS): r for r in kpi_batch._regi_day(regi, *span, approximate=True).collect()}
    assert exact.keys() == rough.keys() and len(exact) == 8
    for key, r in exact.items():
        for name in ("regi_num", "regi_device_num"):
            assert abs(rough[key][name] - r[name]) <= 0.02 * r[name]
    assert rough["2024-01-05", 7, "x_y_z"]["regi_num"] == 0 and rough["2024-01-05", 8, "21"]["regi_num"] == 1


def test_increments_merge_to_the_same_sketch(regi, rows):
    span = ("2024-01-05", "2024-01-06")
    whole = sketches.counted(sketches.days_of(kpi_batch.regi_sketches_hour(regi, *span)))
    odd = F.xxhash64("game_account") % 2 == 0
    parts = [kpi_batch.regi_sketches_hour(p, *span) for p in (regi.filter(odd), regi.filter(~odd | odd.isNull()), regi)]  # overlaps count once
    again = sketches.counted(sketches.days_of(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    one, other = ({tuple(r[c] for c in sketches.KEYS): r["regi_num"] for r in f.collect()} for f in (whole, again))
    assert one.keys() == other.keys() and all(abs(one[k] - other[k]) <= 0.02 * one[k] for k in one)


@pytest.fixture(scope="module")
def cohorts(spark):
    rng, start = random.Random(4), date(2024, 1, 20)
    regi = [(f"a{i}", f"{start - timedelta(days=rng.randrange(70))} 08:00:00", i % 2 + 1, "x_y_z") for i in range(200)]
    logins = [(f"a{rng.randrange(210)}", f"{start + timedelta(days=rng.randrange(-70, 70))} 09:00:00") for _ in range(6000)]
    logins += [(None, "2024-01-20 01:00:00"), ("a1", "no day"), ("a2", None)]
    return (
        spark.createDataFrame(regi, "game_account string, reg_time string, game_id int, expand_channel string"),
        spark.createDataFrame(logins, "game_account string, login_time string"), spark.createDataFrame([(1,)], "game_id int"), start)


def test_masks_give_the_same_retention(cohorts, rows):
    regi, logins, games, day = cohorts
    parts = [activity.activity_masks(logins.filter(c)) for c in (F.col("login_time") < "2024-01-15", F.col("login_time") >= "2024-01-10")]
    masks = activity.merged_masks(parts[0].unionByName(parts[1]))
    got, want = activity.retention_from_masks(regi, masks, games, day), cohort.retention(regi, logins, games, day)
    assert got.columns == want.columns and rows(got) == rows(want) and want.count() > 20
    keep = [activity.retention_from_masks(regi, masks, games, day, keep_empty=True), cohort.retention(regi, logins, games, day, keep_empty=True)]
    assert rows(keep[0]) == rows(keep[1])


def test_every_day_has_its_bit(spark):
    days = [date(1969, 12, 31) + timedelta(days=i) for i in range(130)]
    frame = spark.createDataFrame([("a", f"{d} 00:00:00") for d in days] + [("a", f"{days[0]} 05:00:00")], "game_account string, login_time string")
    masks = {r["era"]: r["mask"] for r in activity.activity_masks(frame).collect()}
    assert masks == {-1: -(1 << 63), 0: -1, 1: -1, 2: 1}


def skewed_downloads(spark, rng):
    """Large baskets over a catalogue whose few first games are on most devices."""
    rows = []
    for device in range(120):
        rows += [(f"d{device}", g) for g in range(12) if rng.random() < 0.98]
        rows += [(f"d{device}", 12 + g) for g in rng.sample(range(1500), 120)]
    rows += [(None, 1), ("d1", None), ("lonely", 5), ("d2", 3), ("d2", 3)]
    return spark.createDataFrame(rows, "imei string, game_id int")


def test_pruned_pairs_give_the_same_lists(spark, rows):
    downloads = skewed_downloads(spark, random.Random(8)).persist()
    full = recommend.co_download_counts(downloads)
    head, tail = recommend.pruned_pairs(downloads, k=5)
    formed, every = head.count() + tail.count(), full.agg(F.sum("download_num")).first()[0]
    assert formed * 5 < every
    assert rows(recommend.co_download_topk_pruned(downloads, 5)) == rows(recommend.co_download_topk(full, 5))
    for k, heads in ((1, 1), (7, 3), (40, 2000)):  # too few heads to bound anything, and heads only
        assert rows(recommend.co_download_topk_pruned(downloads, k, heads)) == rows(recommend.co_download_topk(full, k))
    small = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "imei string, game_id int")
    assert rows(recommend.co_download_topk_pruned(small, 3)) == [(1, "2"), (2, "1")]
    assert recommend.co_download_topk_pruned(small.filter("false"), 3).count() == 0


def test_large_baskets_are_cut(spark):
    downloads = spark.createDataFrame([(f"d{d}", g) for d in range(3) for g in range(40)], "imei string, game_id int")
    owned = downloads.groupBy("imei").agg(F.array_sort(F.collect_list(F.struct(F.lit(-3).alias("less"), F.col("game_id").alias("game"), F.lit(0).alias("least"), F.lit(0).alias("last")))).alias("games"))
    baskets = owned.groupBy("games").agg(F.count("*").alias("devices"))
    cut, whole = (sorted(map(tuple, recommend.tail_pairs(baskets, [0, 1], chunk=c).collect())) for c in (7, 256))
    assert cut == whole and len(whole) == 2 * 38 + 38 * 37


def test_lists_skip_blocks_and_equal_the_full_search(spark):
    rng = random.Random(3)
    games = [(g, [float(rng.randint(-4, 4)) * (40 if g % 25 == 0 else 1) for _ in range(4)]) for g in range(400)]
    tastes = [(g, [float(rng.randint(-3, 3)) for _ in range(4)]) for g in range(410)]
    frame = spark.createDataFrame(games, "id int, features array<float>")
    taste = spark.createDataFrame(tastes, "game_id int, taste array<double>")
    for k in (3, 10):
        got = {r["game_id"]: r["game_id_rs"] for r in recommend.factor_lists(taste, frame, k, block=20).collect()}
        for g, t in tastes:
            best = sorted(((-sum(x * y for x, y in zip(t, f)), i) for i, f in games if i != g))[:k]
            assert got[g] == "|".join(str(i) for _, i in best)
    blocks = recommend.NormBlocks.of(frame, 20)
    assert blocks.bounds == sorted(blocks.bounds, reverse=True) and sum(blocks.sizes) == 400
    left = taste.withColumn("p", F.lit(0))
    start = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks.first(3) - 1))))
    later = recommend.surviving_blocks(left, recommend._scored(start, blocks, 3), blocks, 3)
    assert start.count() + later.count() < 0.5 * 410 * len(blocks.bounds)
    assert recommend.factor_lists(taste, frame.filter("false"), 3).count() == 0
    one = recommend.factor_lists(taste.limit(2), frame.filter("id = 0"), 3).collect()
    assert [(r["game_id"], r["game_id_rs"]) for r in one] == [(1, "0")]
