"""Distinct counts that can be added up: HyperLogLog sketches per hour, merged to days or over increments."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.functions.times import day_key

LG_K = 15  # 2^15 registers: a standard error of 0.6 percent; small groups are exact

KEYS = ("publish_time", "game_id", "expand_channel")
SKETCH_SCHEMA = "publish_time string, game_id int, expand_channel string, accounts binary, devices binary"


def sketched(rows: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """One sketch of `game_account` and one of `imei` per KEYS.

    Sketches are built before the shuffle, so it carries one row per task and key, whatever the number of accounts.
    """
    return rows.groupBy(*KEYS).agg(
        F.hll_sketch_agg("game_account", lg_k).alias("accounts"), F.hll_sketch_agg("imei", lg_k).alias("devices"))


def merged(sketches: DataFrame, *keys) -> DataFrame:
    """Sketches of increments or finer groups merged by the keys: as if their rows had been counted together."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("accounts").alias("accounts"), F.hll_union_agg("devices").alias("devices"))


def days_of(hours: DataFrame) -> DataFrame:
    return merged(hours, day_key("publish_time").alias("publish_time"), *KEYS[1:])


def counted(sketches: DataFrame) -> DataFrame:
    """The sketches as distinct counts, named as the exact ones."""
    return sketches.select(
        *[c for c in sketches.columns if c not in ("accounts", "devices")],
        F.hll_sketch_estimate("accounts").alias("regi_num"), F.hll_sketch_estimate("devices").alias("regi_device_num"))
