"""Registered queries that run a stream over log lines rendered from the test tables.

Lines are written to the shared folder in a few steps; after each step the stream takes what
has arrived and stops, so every step but the first also resumes from its checkpoint.
"""

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamepulse.checks import params as P
from gamepulse.functions.times import access_log_hour
from gamepulse.operators.merge import OVERWRITE
from gamepulse.plans.kpi_stream import KEY_COLUMNS
from gamepulse.schema import STREAM_MEASURES
from gamepulse.session import new_folder
from gamepulse.sources.fixtures import VIEWS, fixture_tables, log_lines
from gamepulse.sources.streams import file_lines
from gamepulse.sources.tables import Tables
from gamepulse.streaming.jobs import BaseKpiJob, KeyedKpiJob, SideJob
from gamepulse.streaming.run import BatchFn, run_available
from gamepulse.streaming.store import MergeTable
from gamepulse.streaming.windows import WINDOW_KEYS, WindowJob, channel_hours

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TIMES = {"fx_channel": "channel_time", "fx_order": "order_time", "fx_login": "login_time", "fx_active": "update_time"}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def in_days(t: Tables, before: str | None = None, since: str | None = None) -> Tables:
    """The event tables cut to times before or since a day."""

    def open_table(name: str) -> DataFrame:
        df = t[name]
        time = access_log_hour("line") if name == "fx_request_line" else TIMES.get(name)
        if time is None:
            return df
        time = F.col(time) if isinstance(time, str) else time
        df = df if before is None else df.filter(time < before)
        return df if since is None else df.filter(time >= since)

    return Tables(list(VIEWS), open_table)


def feed(steps: Iterable[DataFrame], folder: str, take: Callable[[], None]) -> None:
    for i, lines in enumerate(steps):
        lines.write.text(f"{folder}/lines/step{i}")
        take()


def stream_lines(spark: SparkSession, steps: Iterable[DataFrame], folder: str, process: BatchFn) -> None:
    # A file stream needs its folder to exist before the first step is written.
    feed(steps, folder, lambda: run_available(file_lines(spark, f"{folder}/lines"), process, f"{folder}/checkpoint"))


BASE_KINDS = ("channel", "request", "order")


def base_kpi_steps(t: Tables) -> list[DataFrame]:
    half = P.LATE_SPLIT_DAY
    return [
        log_lines(t, "pubgame", "regi"),
        log_lines(in_days(t, before=half), *BASE_KINDS),
        log_lines(in_days(t, since=half), *BASE_KINDS),
    ]


def base_kpi_job(t: Tables, folder: str, kind: type[BaseKpiJob] = BaseKpiJob) -> BaseKpiJob:
    dims = {"game_sdk": t["fx_game_sdk"], "pkg": t["fx_pkg"], "pkg_day": t["fx_pkg_day"]}
    return kind(f"{folder}/tables", dims)


def keyed_lines(spark: SparkSession, steps: Iterable[DataFrame], folder: str, job: KeyedKpiJob) -> None:
    feed(steps, folder, lambda: run_available(job.stream(file_lines(spark, f"{folder}/lines")), job.process, f"{folder}/checkpoint"))


ATTRIBUTES = ("parent_game_id", "os", "group_id", "medium_account", "promotion_channel", "promotion_mode", "head_people")


@register
def stream_base_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, folder = fixture_tables(spark, sf_dir), new_folder(spark, "base-kpi")
    job = base_kpi_job(t, folder)
    stream_lines(spark, base_kpi_steps(t), folder, job.process)
    rows = job.kpi_hour.read(spark).select(*KEY_COLUMNS, *STREAM_MEASURES, "pay_account_num", *ATTRIBUTES)
    return rows.withColumn("pay_money", F.col("pay_money").cast("double"))


@register
def stream_keyed_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hours from keyed state, without reading what earlier batches stored."""
    t, folder = fixture_tables(spark, sf_dir), new_folder(spark, "keyed-kpi")
    job = base_kpi_job(t, folder, KeyedKpiJob)
    keyed_lines(spark, base_kpi_steps(t), folder, job)
    rows = job.kpi_hour.read(spark).select(*KEY_COLUMNS, *STREAM_MEASURES, "pay_account_num", *ATTRIBUTES)
    return rows.withColumn("pay_money", F.col("pay_money").cast("double"))


@register
def stream_base_kpi_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, folder = fixture_tables(spark, sf_dir), new_folder(spark, "base-kpi-day")
    job = base_kpi_job(t, folder)
    stream_lines(spark, base_kpi_steps(t), folder, job.process)
    rows = job.kpi_day.read(spark).select("publish_date", *KEY_COLUMNS[1:], *STREAM_MEASURES)
    return rows.withColumn("pay_money", F.col("pay_money").cast("double"))


SIDE_KINDS = ("channel", "login", "active")


@register
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System counts of a stream that stopped and went on from its checkpoint."""
    t, folder = fixture_tables(spark, sf_dir), new_folder(spark, "resume")
    job = SideJob(f"{folder}/tables")
    steps = [
        log_lines(t, "pubgame"),
        log_lines(in_days(t, before=P.LATE_SPLIT_DAY), *SIDE_KINDS),
        log_lines(in_days(t, since=P.LATE_SPLIT_DAY), *SIDE_KINDS),
    ]
    stream_lines(spark, steps, folder, job.process)
    return job.os_day.read(spark)


@register
def stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System counts after every batch was processed twice under its id."""
    t, folder = fixture_tables(spark, sf_dir), new_folder(spark, "replay")
    job = SideJob(f"{folder}/tables")

    def twice(batch: DataFrame, batch_id: int) -> None:
        job.process(batch, batch_id)
        job.process(batch, batch_id)

    steps = [log_lines(t, "pubgame", *SIDE_KINDS)]
    stream_lines(spark, steps, folder, twice)
    return job.os_day.read(spark)


def _window_counts(spark: SparkSession, folder: str, steps: list[DataFrame], delay: str) -> DataFrame:
    table = MergeTable(f"{folder}/hours", WINDOW_KEYS, {"event_num": "bigint"})

    def save(batch: DataFrame, batch_id: int) -> None:
        table.write(batch, "windows", batch_id, {"event_num": OVERWRITE})

    def take() -> None:
        counts = channel_hours(file_lines(spark, f"{folder}/lines"), delay)
        query = counts.writeStream.outputMode("update").foreachBatch(save)
        query = query.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
        query.start().awaitTermination()

    feed(steps, folder, take)
    return table.read(spark)


@register
def stream_hour_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, folder = fixture_tables(spark, sf_dir), new_folder(spark, "hour-window")
    day = P.LATE_SPLIT_DAY
    steps = [log_lines(in_days(t, before=day), "channel"), log_lines(in_days(t, since=day), "channel")]
    return _window_counts(spark, folder, steps, "2 hours")


@register
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per hour, events counted by the watermarked windows and events that came too late.

    The earlier days arrive after the later ones, all of them behind the watermark.
    """
    t, folder = fixture_tables(spark, sf_dir), new_folder(spark, "late-rows")
    day = P.LATE_SPLIT_DAY
    steps = [log_lines(in_days(t, since=day), "channel"), log_lines(in_days(t, before=day), "channel")]
    job = WindowJob(f"{folder}/tables", "1 hour")
    stream_lines(spark, steps, folder, job.process)
    sums = [t.read(spark).groupBy("publish_time").agg(F.sum("event_num").alias(n))
            for t, n in ((job.hours, "on_time_num"), (job.late, "late_num"))]
    both = sums[0].join(sums[1], "publish_time", "full")
    return both.select("publish_time", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("on_time_num", "late_num")])
