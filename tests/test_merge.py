from decimal import Decimal

import pytest

from gamepulse.operators.merge import INCREMENT, INSERT_ONLY, OVERWRITE, insert_or_touch, upsert, zero_stale
from gamepulse.streaming.store import AppendTable, MergeTable, list_commits

KEYS = {"k": "string"}
VALUES = {"n": "bigint", "m": "decimal(38,2)", "a": "string"}


@pytest.fixture
def table(tmp_path):
    return MergeTable(str(tmp_path / "t"), KEYS, VALUES)


def frame(spark, rows, schema="k string, n bigint, m decimal(18,2), a string"):
    return spark.createDataFrame(rows, schema)


def read(table, spark):
    return {r["k"]: (r["n"], r["m"], r["a"]) for r in table.read(spark).collect()}


def put(table, spark, batch_id, rule, rows, cols="k string, n bigint", writer="w"):
    table.write(spark.createDataFrame(rows, cols), writer, batch_id, {"n": rule})


def test_rules(spark, table):
    put(table, spark, 0, INCREMENT, [("x", 1), ("x", 2), ("y", 5)])
    put(table, spark, 1, INCREMENT, [("x", 10)])
    assert read(table, spark) == {"x": (13, None, None), "y": (5, None, None)}
    put(table, spark, 0, OVERWRITE, [("x", 100), ("y", None)], writer="batch")
    assert read(table, spark) == {"x": (100, None, None), "y": (5, None, None)}
    put(table, spark, 2, INCREMENT, [("x", 7)])
    assert read(table, spark)["x"][0] == 107


def test_replay_changes_nothing(spark, table):
    put(table, spark, 0, INCREMENT, [("x", 1)])
    put(table, spark, 0, OVERWRITE, [("x", 50)], writer="batch")
    put(table, spark, 1, INCREMENT, [("x", 2)])
    before = read(table, spark)
    put(table, spark, 0, INCREMENT, [("x", 1)])
    put(table, spark, 0, OVERWRITE, [("x", 50)], writer="batch")
    assert read(table, spark) == before == {"x": (52, None, None)}


def test_two_writers_do_not_blank_each_other(spark, table):
    table.write(frame(spark, [("x", 1, Decimal("2.50"), "p")]), "one", 0, {"n": OVERWRITE})
    table.write(frame(spark, [("x", 9, Decimal("3.50"), "q")]), "two", 0, {"m": OVERWRITE, "a": INSERT_ONLY})
    table.write(frame(spark, [("x", 9, Decimal("4.50"), "r")]), "two", 1, {"m": INCREMENT, "a": INSERT_ONLY})
    assert read(table, spark) == {"x": (1, Decimal("8.00"), "q")}


def test_compaction_keeps_the_table_and_later_writes(spark, table):
    put(table, spark, 0, INCREMENT, [("x", 1)])
    put(table, spark, 1, INCREMENT, [("x", 2), ("y", 3)])
    table.write(frame(spark, [("x", 0, None, "p")]), "attr", 0, {"a": INSERT_ONLY})
    table.compact(spark)
    assert read(table, spark) == {"x": (3, None, "p"), "y": (3, None, None)}
    put(table, spark, 1, INCREMENT, [("x", 2), ("y", 3)])  # replay of a compacted batch
    put(table, spark, 2, INCREMENT, [("x", 4)])
    table.write(frame(spark, [("x", 0, None, "q"), ("y", 0, None, "r")]), "attr", 1, {"a": INSERT_ONLY})
    assert read(table, spark) == {"x": (7, None, "p"), "y": (3, None, "r")}
    table.compact(spark)
    assert read(table, spark) == {"x": (7, None, "p"), "y": (3, None, "r")}


def test_covered_folders_can_go(spark, table):
    for i in range(3):
        put(table, spark, i, INCREMENT, [("x", 1)])
    table.compact(spark)
    assert table.drop_covered(spark) == 2
    assert read(table, spark) == {"x": (3, None, None)}
    put(table, spark, 2, INCREMENT, [("x", 1)])  # the newest batch repeated
    put(table, spark, 3, INCREMENT, [("x", 1)])
    assert read(table, spark) == {"x": (4, None, None)}


def test_unfinished_commit_is_not_read(spark, table, tmp_path):
    put(table, spark, 0, INCREMENT, [("x", 1)])
    put(table, spark, 1, INCREMENT, [("x", 2)])
    folder = next(c for c in list_commits(spark, table.path) if c.batch_id == "1").folder(str(tmp_path / "t"))
    (tmp_path / "t" / folder[len(str(tmp_path / "t")) + 1:] / "_SUCCESS").unlink()
    assert read(table, spark) == {"x": (1, None, None)}
    put(table, spark, 1, INCREMENT, [("x", 2)])
    assert read(table, spark) == {"x": (3, None, None)}


def test_empty_table_reads_empty(spark, table):
    assert table.read(spark).count() == 0


def test_keys_only_table_is_a_set(spark, tmp_path):
    keys = MergeTable(str(tmp_path / "k"), KEYS)
    for i in range(2):
        keys.write(spark.createDataFrame([("x",), ("x",), (f"y{i}",)], "k string"), "w", i, {})
    assert sorted(r[0] for r in keys.read(spark).collect()) == ["x", "y0", "y1"]


def test_append_table(spark, tmp_path):
    table = AppendTable(str(tmp_path / "a"), "v int")
    for i in (0, 1, 1):
        table.write(spark.createDataFrame([(i,), (i,)], "v int"), "w", i)
    assert sorted(r[0] for r in table.read(spark).collect()) == [0, 0, 1, 1]
    assert sorted(r[0] for r in table.read(spark, without=("w", 1)).collect()) == [0, 0]


def test_upsert_rules(spark, rows):
    target = frame(spark, [("x", 1, Decimal("1.00"), "old"), ("z", 5, Decimal("5.00"), None)])
    batch = frame(spark, [("x", 10, None, "new"), ("y", 20, Decimal("2.00"), "new")])
    got = upsert(target, batch, ["k"], {"n": INCREMENT, "m": OVERWRITE, "a": INSERT_ONLY})
    assert rows(got) == [
        ("x", 11, Decimal("1.00"), "old"), ("y", 20, Decimal("2.00"), "new"), ("z", 5, Decimal("5.00"), None),
    ]
    with pytest.raises(ValueError):
        upsert(target, batch, ["k"], {"n": "other"})


def test_touch_and_stale(spark, rows):
    target = spark.createDataFrame([("x", 3), ("y", 4)], "k string, n bigint")
    batch = spark.createDataFrame([("y", 9), ("z", 1), ("z", 1)], "k string, n bigint")
    assert rows(insert_or_touch(target, batch, ["k"])) == [("z",)]
    unique = batch.filter("k = 'y'")
    assert rows(zero_stale(target, unique, ["k"], ["n"])) == [("x", 0), ("y", 9)]
    partial = spark.createDataFrame([("y", None, "a")], "k string, n bigint, a string")
    assert rows(zero_stale(target, partial, ["k"], ["n"])) == [("x", 0, None), ("y", 0, "a")]


def test_oldest_base_rows_win_over_late_replays_in_any_read_order(spark, table):
    put(table, spark, "b", OVERWRITE, [("x", 2)])
    put(table, spark, "a", OVERWRITE, [("x", 3)])
    assert read(table, spark)["x"][0] == 3
    put(table, spark, "b", OVERWRITE, [("x", 2)])
    assert read(table, spark)["x"][0] == 3
