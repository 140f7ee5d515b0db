"""Accounts, registrations and the whitelist of published games."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamepulse.functions.channel import blank_to_default


def account_key(c: Column | str) -> Column:
    """Spelling-free account: case and outer spaces do not count."""
    return F.lower(F.trim(c))


def listed_games(df: DataFrame, games: DataFrame, key: str = "game_id") -> DataFrame:
    """Rows whose game is on the whitelist; duplicates on the list do not multiply rows.

    No broadcast is forced: Spark broadcasts the list only while its measured size is under
    the session's threshold, and otherwise shuffles with skewed games split by AQE.
    """
    listed = games.select(F.col("game_id").alias(key)).distinct()
    return df.join(listed, key, "left_semi")


def account_channels(regi: DataFrame, attribution: str = "all", extra: tuple[str, ...] = ()) -> DataFrame:
    """(acct_key, expand_channel, *extra, spellings) from registrations.

    A sale is credited once per distinct registered spelling and channel of its account;
    `spellings` carries that factor so that both join sides stay pre-aggregated.
    `attribution="first"` credits only the channel of the earliest registration.
    """
    by = ["acct_key", "expand_channel", *extra]
    rows = regi.withColumn("expand_channel", blank_to_default("expand_channel")).filter(
        F.col("game_account").isNotNull()
    )
    if attribution == "first":
        cols = [F.col(c) for c in ("reg_time", "expand_channel", *extra)]
        first = rows.groupBy(account_key("game_account").alias("acct_key")).agg(F.min(F.struct(*cols)).alias("f"))
        return first.select(
            "acct_key", *[F.col(f"f.{c}").alias(c) for c in by[1:]], F.lit(1).cast("bigint").alias("spellings")
        )
    if attribution != "all":
        raise ValueError(attribution)
    spelled = rows.select("game_account", *by[1:]).distinct()
    return spelled.groupBy(account_key("game_account").alias("acct_key"), *by[1:]).agg(
        F.count(F.lit(1)).alias("spellings")
    )
