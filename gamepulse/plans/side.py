"""Side outputs of the log stream: system counts, login accounts, activations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.functions.channel import gate_channel, split_channel
from gamepulse.operators.accounts import listed_games
from gamepulse.plans.kpi_batch import SHOW
from gamepulse.sources import logs


def os_day_count(lines: DataFrame, games: DataFrame) -> DataFrame:
    """Ad shows per day, game, channel and operating system; no length gate applies."""
    shows = logs.parse(lines, "channel_os").filter(F.col("type") == SHOW)
    counts = shows.groupBy("publish_time", "game_id", "expand_channel", "os").agg(F.count(F.lit(1)).alias("os_sum"))
    parts = split_channel(listed_games(counts, games))
    keys = [c for c in parts.columns if c != "os_sum"]
    return parts.groupBy(*keys).agg(F.sum("os_sum").alias("os_sum"))


def login_accounts_hour(lines: DataFrame, games: DataFrame, game_field: int = 8) -> DataFrame:
    """Distinct accounts that logged in, per hour, game and channel parts.

    The whitelist comes last, so that a busy game is not one task of the distinct step.
    """
    rows = logs.parse(lines, logs.login_kind("hour", game_field))
    return listed_games(gate_channel(split_channel(rows))[0].distinct(), games)


def active_events(lines: DataFrame, games: DataFrame) -> DataFrame:
    """Activations on listed games, one row per line."""
    return gate_channel(split_channel(listed_games(logs.parse(lines, "active_device"), games)))[0]


def side_rejects(lines: DataFrame, game_field: int = 8) -> DataFrame:
    """(kind, value): lines no parser takes, and parsed rows whose channel does not fit."""
    login = logs.login_kind("hour", game_field)
    refused = [(k, logs.rejects(lines, k)) for k in ("pubgame", "channel_os", login, "active_device")]
    frames = [df.select(F.lit(k if isinstance(k, str) else "login_hour").alias("kind"), "value") for k, df in refused]
    for name, kind in (("login_channel", login), ("active_channel", "active_device")):
        bad = gate_channel(split_channel(logs.parse(lines, kind)))[1]
        frames.append(bad.select(F.lit(name).alias("kind"), F.to_json(F.struct(*bad.columns)).alias("value")))
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out
