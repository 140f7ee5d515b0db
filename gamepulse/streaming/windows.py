"""Event-time windows with a watermark: Spark's own, and one that also counts the rows it turns down."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.operators.merge import INCREMENT
from gamepulse.sources import logs
from gamepulse.streaming.run import held
from gamepulse.streaming.store import AppendTable, MergeTable

WINDOW_KEYS = {"publish_time": "string", "type": "int", "game_id": "int", "expand_channel": "string"}


def _timed(lines: DataFrame) -> DataFrame:
    rows = logs.parse(lines, "channel_hour")
    stamp = F.concat("publish_time", F.lit(":00:00")).try_cast("timestamp").alias("event_time")
    return rows.select(stamp, "type", "game_id", "expand_channel")


def channel_hours(lines: DataFrame, delay: str) -> DataFrame:
    """Ad events per hour window, type, game and channel; rows behind the watermark are dropped."""
    timed = _timed(lines).withWatermark("event_time", delay)
    counts = timed.groupBy(F.window("event_time", "1 hour").alias("w"), "type", "game_id", "expand_channel").agg(
        F.count(F.lit(1)).alias("event_num")
    )
    start = F.date_format("w.start", "yyyy-MM-dd HH").alias("publish_time")
    return counts.select(start, "type", "game_id", "expand_channel", "event_num")


@dataclass(frozen=True)
class WindowJob:
    """The counts of `channel_hours`, with late rows counted per hour instead of lost.

    The watermark of a batch is the latest event time of the batches before it less `delay`, an
    interval; a row is late if its hour ended by then. Each batch stores its latest time, one
    row, so the watermark does not depend on anything held in memory and a repeated batch finds the one it had.
    Rows whose time is no timestamp belong to no window and are kept in `rejects`.
    """

    root: str
    delay: str
    writer: str = "windows"

    @property
    def hours(self) -> MergeTable:
        return MergeTable(f"{self.root}/window_hours", WINDOW_KEYS, {"event_num": "bigint"})

    @property
    def late(self) -> MergeTable:
        return MergeTable(f"{self.root}/late_hours", WINDOW_KEYS, {"event_num": "bigint"})

    @property
    def latest(self) -> AppendTable:
        return AppendTable(f"{self.root}/window_latest", "event_time timestamp, batch bigint")

    @property
    def rejects(self) -> AppendTable:
        return AppendTable(f"{self.root}/window_rejects", "kind string, value string")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Later batches are left out too, so a batch that is repeated out of turn is judged as it was.
        before = self.latest.read(spark).filter(F.col("batch") < batch_id)
        mark = before.agg(F.unix_micros(F.max("event_time") - F.expr(f"interval {self.delay}"))).first()[0]  # one row per batch
        timed = _timed(batch.select("value"))
        keys = [F.date_format("event_time", "yyyy-MM-dd HH").alias("publish_time"), "type", "game_id", "expand_channel"]
        counts = timed.groupBy("event_time", "type", "game_id", "expand_channel").agg(F.count(F.lit(1)).alias("event_num"))
        with held(counts) as counts:
            ends = F.unix_micros(F.col("event_time") + F.expr("interval 1 hour"))
            late = F.lit(False) if mark is None else ends <= mark
            for table, rows in ((self.hours, counts.filter(~late)), (self.late, counts.filter(late))):
                rows = rows.filter("event_time is not null").select(*keys, "event_num")
                table.write(rows, self.writer, batch_id, {"event_num": INCREMENT}, unique=True)
            untimed = counts.filter("event_time is null")
            text = F.to_json(F.struct(*untimed.columns[1:])).alias("value")
            refused = untimed.select(F.lit("time").alias("kind"), text)
            bad = logs.rejects(batch.select("value"), "channel_hour").select(F.lit("channel_hour").alias("kind"), "value")
            self.rejects.write(refused.unionByName(bad), self.writer, batch_id)
            top = counts.agg(F.max("event_time").alias("event_time")).withColumn("batch", F.lit(batch_id).cast("bigint"))
            self.latest.write(top, self.writer, batch_id)

    def merge_tables(self) -> list[MergeTable]:
        return [self.hours, self.late]
