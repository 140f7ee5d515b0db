"""Batch and stream jobs from the command line: inputs are tables, results merge tables.

    python -m gamepulse.jobs ltv --tables /warehouse --out /results --day 2024-01-20
    python -m gamepulse.jobs base-kpi --lines /logs --tables /warehouse --out /results

A batch run is a commit of its own, named by --run-id; repeating a failed run under the same
id replaces what it wrote.
"""

import argparse
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamepulse import schema as S
from gamepulse.functions.channel import fold_channel, gate_channel, split_channel
from gamepulse.functions.times import day_range
from gamepulse.operators.day_table import DayTable
from gamepulse.operators.dims import game_attributes
from gamepulse.operators.merge import OVERWRITE, zero_stale
from gamepulse.plans import bills, cohort, kpi_batch, recommend
from gamepulse.session import build_session
from gamepulse.sources import logs
from gamepulse.sources.streams import file_lines, kafka_lines
from gamepulse.sources.tables import Tables, catalog_tables, parquet_tables, text_lines
from gamepulse.streaming.jobs import KeyedKpiJob, PointsJob, SideJob, compact
from gamepulse.streaming.run import start
from gamepulse.streaming.store import AppendTable, MergeTable, list_commits

Inputs = Mapping[str, DataFrame]

TABLES = [
    "registrations", "orders", "logins", "channel_events", "publish_games", "game_sdk", "downloads",
    "sdk_requests", "sdk_accounts", "companies", "receipts", "pkg", "pkg_day", "account_bind", "member",
    "game_name", "publish_game_main",
]


def results(out: str) -> dict[str, MergeTable]:
    return {
        "kpi_hour": MergeTable(f"{out}/kpi_hour", S.KPI_HOUR_KEYS, S.KPI_HOUR_VALUES),
        "kpi_day": MergeTable(f"{out}/kpi_day", S.KPI_DAY_KEYS, S.KPI_DAY_VALUES),
        "game_day": MergeTable(f"{out}/game_day", S.GAME_DAY_KEYS, S.GAME_DAY_VALUES),
        "cohort": MergeTable(f"{out}/cohort", S.COHORT_KEYS, S.COHORT_VALUES),
        "bills": MergeTable(f"{out}/bills", S.BILL_KEYS, S.BILL_VALUES),
        "recommend": MergeTable(f"{out}/recommend", S.RECOMMEND_KEYS, S.RECOMMEND_VALUES),
    }


def rejects_table(out: str) -> AppendTable:
    return AppendTable(f"{out}/rejects", "kind string, value string")


def folded(df: DataFrame) -> DataFrame:
    """Channels folded to their keys, so that counts of different accounts are made per key."""
    return df.withColumn("expand_channel", fold_channel("expand_channel"))


def keyed_rows(frames: list[DataFrame], measures: list[str]) -> tuple[DataFrame, DataFrame]:
    """(one row per KPI key over several results, rows whose channel does not fit).

    Every result has a key once, so the sum only joins the results; a measure no result gave
    stays null.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    valid, rejected = gate_channel(split_channel(rows, case="upper"))
    keys = [c for c in valid.columns if c not in measures]
    return valid.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]), rejected


def _keep_rejects(args: argparse.Namespace, **frames: DataFrame) -> None:
    """All rows this run refused, in one write that a repeated run replaces."""
    texts = [f.select(F.lit(kind).alias("kind"), F.to_json(F.struct(*f.columns)).alias("value")) for kind, f in frames.items()]
    rejects_table(args.out).write(reduce(DataFrame.unionByName, texts), args.job, args.run_id)


def by_day(table: MergeTable, args: argparse.Namespace) -> DayTable:
    return DayTable(f"{args.out}/by_day/{args.job}/{table.path.rsplit('/', 1)[1]}")


def _overwrite(table: MergeTable, rows: DataFrame, args: argparse.Namespace) -> None:
    """Write one result; with --zero-stale, stored keys of the same days it lacks become zero.

    With --by-day, a result of whole days goes to the job's own day table instead, which needs no zeroes.
    """
    names = [c for c in rows.columns if c in table.values]
    time_col = next(iter(table.keys))
    if args.by_day and time_col in ("publish_time", "publish_date") and args.start and args.end:
        typed = [F.col(c).cast(t).alias(c) for c, t in {**table.keys, **table.values}.items() if c in rows.columns]
        by_day(table, args).write(rows.select(*typed), time_col, args.start, args.end)
        return
    if args.zero_stale and args.start and args.end:
        measures = [c for c in names if table.values[c] != "string"]
        stored = day_range(table.read(rows.sparkSession, *measures), time_col, args.start, args.end)
        rows = zero_stale(stored, rows, list(table.keys), measures)
    table.write(rows, args.job, args.run_id, {c: OVERWRITE for c in names}, unique=True)


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("publish_time", "publish_date")


def base_kpi_offline(t: Inputs, out: dict[str, MergeTable], args: argparse.Namespace) -> None:
    """Pay money and registrations per hour and day, devices per game and day."""
    days = (args.start, args.end)
    orders, regi, games, sdk = t["orders"], folded(t["registrations"]), t["publish_games"], t["game_sdk"]
    hours, bad_hours = keyed_rows([
        kpi_batch.pay_money_hour(orders, regi, games, *days),
        kpi_batch.pay_money_new_hour(orders, regi, games, *days).withColumnRenamed("pay_money", "pay_money_new"),
        kpi_batch.regi_accounts_hour(regi, games, *days).withColumnRenamed("regi_num", "regi_account_num"),
    ], ["pay_money", "pay_money_new", "regi_account_num"])
    _overwrite(out["kpi_hour"], hours, args)
    day_rows, bad_days = keyed_rows([
        kpi_batch.pay_money_key_day(orders, regi, sdk, *days),
        kpi_batch.regi_key_day(regi, sdk, *days, args.approximate).withColumnRenamed("regi_num", "regi_account_num"),
    ], ["pay_money", "regi_account_num", "regi_device_num"])
    _overwrite(out["kpi_day"], _dated(day_rows.join(game_attributes(sdk), "game_id", "left")), args)
    _keep_rejects(args, kpi_hour=bad_hours, kpi_day=bad_days)
    devices = kpi_batch.regi_devices_game_day(regi, sdk, *days).groupBy("publish_time", "game_id").agg(
        *[F.min(c).alias(c) for c in ("os", "group_id", "parent_game_id")], F.max("regi_device_num").alias("regi_device_num")
    )
    _overwrite(out["game_day"], _dated(devices), args)


def pay_account_offline(t: Inputs, out: dict[str, MergeTable], args: argparse.Namespace) -> None:
    """Paying accounts, ad clicks and landing-page requests per hour and day."""
    days = (args.start, args.end)
    orders, regi, games, sdk = t["orders"], folded(t["registrations"]), t["publish_games"], t["game_sdk"]
    clicks = kpi_batch.clicks_hour(t["channel_events"], games, *days)
    frames = [clicks]
    if args.lines:
        frames.append(kpi_batch.requests_hour(text_lines(orders.sparkSession, args.lines), games, *days))
    counts = [*kpi_batch.CLICK_TYPES, "request_num"]
    events, bad_events = keyed_rows(frames, [c for c in counts if any(c in f.columns for f in frames)])
    counts = [c for c in counts if c in events.columns]
    # An hour without an event of some type leaves that column as it is.
    events = events.withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in counts})
    payers, bad_payers = keyed_rows([kpi_batch.pay_accounts_hour(orders, regi, games, *days)], ["pay_account_num"])
    both = payers.withColumn("dau_pay_account_num", F.col("pay_account_num")).unionByName(events, allowMissingColumns=True)
    measures = ["pay_account_num", "dau_pay_account_num", *counts]
    keys = list(S.KPI_HOUR_KEYS)
    _overwrite(out["kpi_hour"], both.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]), args)
    payers_day, bad_days = keyed_rows([kpi_batch.pay_accounts_key_day(orders, regi, sdk, *days)], ["pay_account_num"])
    events_day = kpi_batch.roll_up_days(events, *counts)
    both_days = _dated(payers_day.unionByName(events_day, allowMissingColumns=True))
    totals = [F.sum(m).alias(m) for m in ("pay_account_num", *counts)]
    one = both_days.groupBy(*S.KPI_DAY_KEYS).agg(*totals)
    _overwrite(out["kpi_day"], one.join(game_attributes(sdk).select("game_id", "os", "group_id"), "game_id", "left"), args)
    frames = {"events": bad_events, "payers": bad_payers, "payers_day": bad_days}
    if args.lines:
        frames["request"] = logs.request_rejects(text_lines(orders.sparkSession, args.lines))
    _keep_rejects(args, **frames)


def _cohort(rows: DataFrame, out: dict[str, MergeTable], args: argparse.Namespace) -> None:
    valid, rejected = keyed_rows([rows], [c for c in rows.columns if c in S.COHORT_VALUES])
    _overwrite(out["cohort"], valid, args)
    _keep_rejects(args, cohort=rejected)


def retention(t: Inputs, out: dict[str, MergeTable], args: argparse.Namespace) -> None:
    _cohort(cohort.retention(folded(t["registrations"]), t["logins"], t["publish_games"], args.day), out, args)


def ltv(t: Inputs, out: dict[str, MergeTable], args: argparse.Namespace) -> None:
    _cohort(cohort.ltv(folded(t["registrations"]), t["orders"], t["publish_games"], args.day), out, args)


def sdk_bills(t: Inputs, out: dict[str, MergeTable], args: argparse.Namespace) -> None:
    rows = bills.sdk_bills(
        t["sdk_requests"], t["sdk_accounts"], t["companies"], t["receipts"], args.start, args.end
    )
    one = rows.groupBy(*S.BILL_KEYS).agg(
        F.sum("amount").alias("amount"), F.min("corporation_name").alias("corporation_name")
    )
    _overwrite(out["bills"], one, args)


def co_download(t: Inputs, out: dict[str, MergeTable], args: argparse.Namespace) -> None:
    counts = recommend.co_download_counts(t["downloads"])
    _overwrite(out["recommend"], recommend.co_download_topk(counts), args)


def als(t: Inputs, out: dict[str, MergeTable], args: argparse.Namespace) -> None:
    downloads = logs.parse(text_lines(args.spark, args.lines), "appdownload")
    ratings = recommend.als_ratings(downloads).persist()
    _overwrite(out["recommend"], recommend.als_lists(recommend.fit_als(ratings), ratings), args)
    ratings.unpersist()


BATCH: dict[str, Callable[[Inputs, dict[str, MergeTable], argparse.Namespace], None]] = {
    "base-kpi-offline": base_kpi_offline, "pay-account-offline": pay_account_offline, "retention": retention, "ltv": ltv,
    "sdk-bills": sdk_bills, "co-download": co_download, "als": als,
}
STREAM = ("base-kpi", "side", "points")


def stream_job(name: str, t: Inputs, args: argparse.Namespace):
    if name == "base-kpi":
        dims = {n: t[n] for n in ("game_sdk", "pkg", "pkg_day", *(["publish_game_main"] if args.game_main else []))}
        return KeyedKpiJob(args.out, dims, args.day)
    if name == "side":
        return SideJob(args.out)
    dims = {"binds": t["account_bind"], "members": t["member"], "game_names": t["game_name"]}
    return PointsJob(args.out, dims, args.integral, args.quota)


def _stream_lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.brokers:
        limit = {"maxOffsetsPerTrigger": str(args.max_offsets)} if args.max_offsets else {}
        return kafka_lines(spark, args.brokers, args.topics.split(","), args.first_run, **limit)
    return file_lines(spark, args.lines, args.max_files)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="gamepulse.jobs")
    p.add_argument("job", choices=[*BATCH, *STREAM])
    p.add_argument("--tables", help="folder of parquet tables")
    p.add_argument("--database", help="catalog database, instead of --tables")
    p.add_argument("--alias", action="append", default=[], help="name=stored name, for tables called otherwise")
    p.add_argument("--out", required=True, help="folder of the result tables, shared by all executors")
    p.add_argument("--lines", help="log files, or the folder a file stream watches")
    p.add_argument("--start", help="first day")
    p.add_argument("--end", help="last day; for bills the day after it")
    p.add_argument("--day", help="cohort day, or the only day of first payments")
    p.add_argument("--run-id", default=datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f"))
    p.add_argument("--zero-stale", action="store_true", help="zero stored keys of the days that no longer qualify")
    p.add_argument("--by-day", action="store_true", help="keep KPI results as the job's own tables partitioned by day; a rerun replaces its days")
    p.add_argument("--approximate", action="store_true", help="count accounts and devices of a day by sketches, within about two percent")
    p.add_argument("--brokers")
    p.add_argument("--topics", default="")
    p.add_argument("--first-run", default="earliest", choices=["earliest", "latest"])
    p.add_argument("--every", help="micro-batch interval such as '10 minutes'; else once over what has arrived")
    p.add_argument("--max-files", type=int, help="files a micro-batch takes at most")
    p.add_argument("--max-offsets", type=int, help="messages a micro-batch takes at most")
    p.add_argument("--game-main", action="store_true", help="parent games from the table publish_game_main (game_id, main_id)")
    p.add_argument("--compact", action="store_true", help="after the run, fold the commits of the result tables; no other writer may be active")
    p.add_argument("--integral", type=int, default=0)
    p.add_argument("--quota", default="sum", choices=["sum", "count"])
    p.add_argument("--master")
    return p.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    args.spark = spark
    names = {n: n for n in TABLES} | dict(pair.split("=", 1) for pair in args.alias)
    if args.database:
        source = catalog_tables(spark, args.database, list(names.values()))
    else:
        source = parquet_tables(spark, args.tables, list(names.values()), suffix="")
    tables = Tables(TABLES, lambda n: source[names[n]])
    if args.job in BATCH:
        BATCH[args.job](tables, results(args.out), args)
        if args.compact:
            compact(spark, [r for r in results(args.out).values() if list_commits(spark, r.path)])
        return
    job = stream_job(args.job, tables, args)
    lines = _stream_lines(spark, args)
    if isinstance(job, KeyedKpiJob):
        lines = job.stream(lines)
    query = start(lines, job.process, f"{args.out}/_checkpoints/{args.job}", args.every)
    query.awaitTermination()
    if args.compact:
        compact(spark, job.merge_tables())


if __name__ == "__main__":
    options = arguments()
    run(build_session(options.master), options)
