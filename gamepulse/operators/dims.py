"""Dimension lookups as left joins with defaults, applied to already aggregated rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.functions.times import day_key

# What a missing dimension row stands for.
DEFAULT_GROUP, DEFAULT_OS, DEFAULT_PARENT, DEFAULT_TEXT = "0", "1", "0", ""


def game_attributes(game_sdk: DataFrame) -> DataFrame:
    """One (group_id, os, parent_game_id) per game: the smallest (group, os) pair it has."""
    pair = F.min(F.struct(F.col("group_id"), F.col("system_type").alias("os")))
    one = game_sdk.groupBy(F.col("old_game_id").alias("game_id")).agg(
        pair.alias("p"), F.min(game_sdk["game_id"]).alias("parent")
    )
    texts = {"group_id": "p.group_id", "os": "p.os", "parent_game_id": "parent"}
    return one.select("game_id", *[F.col(c).cast("string").alias(n) for n, c in texts.items()])


DEFAULTS = {"group_id": DEFAULT_GROUP, "os": DEFAULT_OS, "parent_game_id": DEFAULT_PARENT}


def enrich_games(rows: DataFrame, game_sdk: DataFrame, *names: str) -> DataFrame:
    """Attributes of the game, with defaults where it is unknown."""
    joined = rows.join(game_attributes(game_sdk).select("game_id", *names), "game_id", "left")
    return joined.withColumns({n: F.coalesce(n, F.lit(DEFAULTS[n])) for n in names})


def enrich_game_group(rows: DataFrame, game_sdk: DataFrame) -> DataFrame:
    return enrich_games(rows, game_sdk, "group_id", "os")


def _first(df: DataFrame, keys: list, *values: str) -> DataFrame:
    """One row per key: the smallest values where a key has several rows."""
    one = df.groupBy(*keys).agg(F.min(F.struct(*values)).alias("v"))
    return one.select(*[c for c in one.columns if c != "v"], *[F.col(f"v.{n}").alias(n) for n in values])


def enrich_packages(rows: DataFrame, pkg: DataFrame, pkg_day: DataFrame, time_col: str = "publish_time") -> DataFrame:
    """Media account and promotion channel by package; mode and owner by package and day.

    Keyed rows hold upper-case channels, so packages are matched without regard to case.
    """
    code = F.upper("pkg_code").alias("_pkg")
    by_pkg = _first(pkg, [code], "medium_account", "promotion_channel")
    by_day = _first(pkg_day, [code, F.col("order_date").alias("_day")], "promotion_mode", "head_people")
    joined = (
        rows.withColumns({"_pkg": F.upper("ad_label"), "_day": day_key(time_col)})
        .join(by_pkg, "_pkg", "left")
        .join(by_day, ["_pkg", "_day"], "left")
        .drop("_pkg", "_day")
    )
    texts = ("medium_account", "promotion_channel", "promotion_mode", "head_people")
    return joined.withColumns({c: F.coalesce(c, F.lit(DEFAULT_TEXT)) for c in texts})


def enrich_kpi(
    rows: DataFrame, game_sdk: DataFrame, pkg: DataFrame, pkg_day: DataFrame, time_col: str = "publish_time",
    game_main: DataFrame | None = None,
) -> DataFrame:
    """All reporting attributes of keyed KPI rows.

    With `game_main` (game_id, main_id) the parent game comes from there, `"0"` where it has none.
    """
    rich = enrich_games(enrich_packages(rows, pkg, pkg_day, time_col), game_sdk, *DEFAULTS)
    if game_main is None:
        return rich
    main = game_main.groupBy("game_id").agg(F.min("main_id").cast("string").alias("_main"))
    parent = F.coalesce("_main", F.lit(DEFAULT_PARENT))
    return rich.join(main, "game_id", "left").withColumn("parent_game_id", parent).drop("_main")
