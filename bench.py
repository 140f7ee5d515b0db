"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of the test tables, BENCH_CPUS the local core count. Each query
runs once to warm up; batch queries then report the median of three runs, the stream one run.
"""

import json
import os
import statistics
import time

from gamepulse.checks.queries import QUERIES
from gamepulse.session import build_session

HEADLINE = [
    "pay_money_hour", "pay_money_new_hour", "pay_money_day", "regi_accounts_hour", "regi_accounts_devices_day",
    "regi_devices_game_day", "pay_accounts_hour", "pay_accounts_day", "click_show_hour", "click_show_day",
    "request_hour", "request_day", "retention", "ltv", "sdk_bills", "parse_order", "parse_regi", "parse_request",
    "enrich_points", "points_running_total", "quota_sum", "co_download_counts", "co_download_topk", "upsert_mixed",
    "stream_base_kpi",
]
RUNS = {"stream_base_kpi": 1}


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # Python workers import the package from here, wherever the bench was started.
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH")]))
    spark = build_session(
        f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        **{"spark.driver.memory": "20g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS.get(name, 3))), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
