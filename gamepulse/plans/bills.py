"""Partner bills from paid SDK orders."""

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.functions.times import as_date, day_key, day_range
from gamepulse.operators.accounts import account_key

# Fixed values of the SDK order and receipt tables.
SETTLED, SANDBOX, SANDBOX_STATE = 1, 1, 3


def without_sandbox(requests: DataFrame, receipts: DataFrame) -> DataFrame:
    """Orders that no verified sandbox receipt refers to."""
    test = receipts.filter((F.col("sandbox") == SANDBOX) & (F.col("state") == SANDBOX_STATE))
    return requests.join(test.select(F.col("order_sn").alias("order_no")), "order_no", "left_anti")


def sdk_bills(
    requests: DataFrame, accounts: DataFrame, companies: DataFrame, receipts: DataFrame,
    start: date | str, end: date | str,
) -> DataFrame:
    """Settled amount per day, game, account channel, system and company for [start, end).

    Amounts are summed per account and day before the account table is joined, so one busy
    account is a few rows. Missing channel, system and company take their defaults before
    the final grouping, which makes the bill key unique.
    """
    last = as_date(end) - timedelta(days=1)
    rows = day_range(requests, "req_time", start, last).filter(F.col("status") == SETTLED)
    daily = without_sandbox(rows, receipts).groupBy(
        day_key("req_time").alias("month_date"), "game_id", account_key("account").alias("acct_key")
    ).agg(F.sum("amount").alias("amount"))
    owners = accounts.filter(F.col("account").isNotNull()).groupBy(
        account_key("account").alias("acct_key"),
        F.coalesce("account_channel", F.lit(0)).alias("channel_id"), F.coalesce("os", F.lit("")).alias("os"),
    ).agg(F.count(F.lit(1)).alias("n"))
    keys = ["month_date", "game_id", "channel_id", "os"]
    by_owner = daily.join(owners, "acct_key", "left").groupBy(
        "month_date", "game_id",
        F.coalesce("channel_id", F.lit(0)).alias("channel_id"), F.coalesce("os", F.lit("")).alias("os"),
    ).agg(F.sum(F.col("amount") * F.coalesce("n", F.lit(1))).alias("amount"))
    names = companies.groupBy(F.col("id").alias("game_id"), "corporation_name").agg(F.count(F.lit(1)).alias("m"))
    named = by_owner.join(names, "game_id", "left").groupBy(
        *keys, F.coalesce("corporation_name", F.lit("")).alias("corporation_name")
    )
    return named.agg(F.sum(F.col("amount") * F.coalesce("m", F.lit(1))).cast("decimal(38,2)").alias("amount"))
