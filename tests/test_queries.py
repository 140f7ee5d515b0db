"""Every registered query against its SQL text, on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from gamepulse.checks.oracles import ORACLES
from gamepulse.checks.queries import QUERIES

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database(sf_dir):
    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"create view {n} as select * from '{sf_dir}/{n}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v if v is None else str(v)


def table(rows, columns):
    order = sorted(columns)
    return sorted([tuple(plain(dict(zip(columns, r))[c]) for c in order) for r in rows], key=str)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())
    assert set(QUERIES) - set(ORACLES) == {"als_rmse", "als_recommend"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, database, name):
    df = QUERIES[name](spark, sf_dir)
    got = table([tuple(r) for r in df.collect()], df.columns)
    rel = database.execute(ORACLES[name])
    columns = [c[0] for c in rel.description]
    want = table(rel.fetchall(), columns)
    assert sorted(df.columns) == sorted(columns)
    assert got == want
    assert len(got) > 0


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["publish_time", "game_id", "expand_channel", "pay_money"] and df.count() > 0


NO_BAD_JOIN = [
    "pay_money_hour", "pay_money_day", "pay_accounts_hour", "regi_accounts_devices_day", "click_show_day", "request_day",
    "retention", "ltv", "sdk_bills", "co_download_counts", "co_download_topk", "enrich_points", "net_pay_money_hour",
    "first_pay_accounts_hour", "enrich_pkg_dims", "upsert_mixed",
]


@pytest.mark.parametrize("name", NO_BAD_JOIN)
def test_plans_hold_no_product_or_global_window(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "SinglePartition" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize(("name", "pushed"), [
    ("pay_money_hour", "GreaterThanOrEqual(ts,2024-01-05T00:00)"), ("click_show_hour", "LessThan(ts,2024-01-13T00:00)"),
    ("ltv", "GreaterThanOrEqual(ts,2023-11-22T00:00)"), ("retention", "LessThan(ts,2024-03-20T00:00)"),
])
def test_time_bounds_reach_the_file_scan(spark, sf_dir, name, pushed):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert pushed in plan.replace(" ", "").replace("PushedFilters", "")
