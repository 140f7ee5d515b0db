"""Hourly and daily KPIs recomputed from warehouse tables for a range of days.

Every job reduces its fact table to its own group keys first. Whitelists, dimensions and
account lookups then meet the reduced rows, so a busy game or account is no hot join key.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamepulse.functions.channel import blank_to_default
from gamepulse.functions.times import day_key, day_of, day_range, hour_key
from gamepulse.operators.accounts import account_channels, account_key, listed_games
from gamepulse.plans import sketches
from gamepulse.sources.logs import parse_request_batch

Day = date | str

# Fixed values of the order and ad-event tables.
PAID, REFUNDED, NEW_PAY_TYPE = 4, 8, 6
SHOW, DOWNLOAD, AD_PAGE = 1, 2, 3

def game_dimension(game_sdk: DataFrame, *names: str) -> DataFrame:
    """Distinct (game_id, *names) with names from os, group_id, parent_game_id."""
    source = {"os": "system_type", "group_id": "group_id", "parent_game_id": "game_id"}
    return game_sdk.select(F.col("old_game_id").alias("_game"), *[F.col(source[n]).alias(n) for n in names]).distinct()


def with_game_dimension(df: DataFrame, game_sdk: DataFrame, *names: str) -> DataFrame:
    dim = game_dimension(game_sdk, *names)
    return df.join(dim, df["game_id"] == dim["_game"], "inner").drop("_game")


def paid_orders(orders: DataFrame, start: Day, end: Day, new_pay: bool = False) -> DataFrame:
    rows = day_range(orders, "order_time", start, end).filter(F.col("order_status") == PAID)
    return rows.filter(F.col("prod_type") == NEW_PAY_TYPE) if new_pay else rows


def _distinct_orders(rows: DataFrame) -> DataFrame:
    """Rows without full repeats: orders that differ in any column of the table are different ones."""
    twins = [c for c in rows.columns if c.endswith("_ts") and c.removesuffix("_ts") in rows.columns]
    return rows.drop(*twins).distinct()


def _money_by_account(orders: DataFrame, time_key: Column, amount: Column) -> DataFrame:
    keys = [account_key("game_account").alias("acct_key"), time_key.alias("publish_time"), F.col("game_id")]
    return orders.groupBy(*keys).agg(F.sum(amount).alias("amount"))


def _credited_money(sales: DataFrame, accounts: DataFrame, *extra: str) -> DataFrame:
    amount = F.sum(F.col("amount") * F.col("spellings"))
    return (
        sales.join(accounts, "acct_key")
        .groupBy("publish_time", "game_id", "expand_channel", *extra)
        .agg(amount.cast("decimal(38,2)").alias("pay_money"))
    )


def pay_money_hour(
    orders: DataFrame, regi: DataFrame, games: DataFrame, start: Day, end: Day, attribution: str = "all"
) -> DataFrame:
    """Paid amount per hour, game of the order and channel of the account."""
    sales = _money_by_account(
        _distinct_orders(paid_orders(orders, start, end)), hour_key("order_time"), F.col("ori_price")
    )
    return _credited_money(sales, account_channels(listed_games(regi, games), attribution))


def pay_money_new_hour(
    orders: DataFrame, regi: DataFrame, games: DataFrame, start: Day, end: Day, attribution: str = "all"
) -> DataFrame:
    """The same for new-pay products, with both price parts."""
    amount = F.col("ori_price") + F.col("total_amt")
    sales = _money_by_account(
        _distinct_orders(paid_orders(orders, start, end, new_pay=True)), hour_key("order_time"), amount
    )
    return _credited_money(sales, account_channels(listed_games(regi, games), attribution))


def pay_money_day(
    orders: DataFrame, regi: DataFrame, game_sdk: DataFrame, start: Day, end: Day, attribution: str = "all"
) -> DataFrame:
    """New-pay amount per day with the operating system and group of the registered game."""
    amount = F.col("ori_price") + F.col("total_amt")
    sales = _money_by_account(
        _distinct_orders(paid_orders(orders, start, end, new_pay=True)), day_key("order_time"), amount
    )
    regs = with_game_dimension(_registered(regi, attribution), game_sdk, "os", "group_id")
    return _credited_money(sales, account_channels(regs, attribution, ("os", "group_id")), "os", "group_id")


def sdk_games(game_sdk: DataFrame) -> DataFrame:
    return game_sdk.select(F.col("old_game_id").alias("game_id"))


def pay_money_key_day(
    orders: DataFrame, regi: DataFrame, game_sdk: DataFrame, start: Day, end: Day, attribution: str = "all"
) -> DataFrame:
    """New-pay amount per day, game and channel, once however many dimension rows the game has."""
    amount = F.col("ori_price") + F.col("total_amt")
    sales = _money_by_account(
        _distinct_orders(paid_orders(orders, start, end, new_pay=True)), day_key("order_time"), amount
    )
    return _credited_money(sales, account_channels(listed_games(regi, sdk_games(game_sdk)), attribution))


def _registered(regi: DataFrame, attribution: str) -> DataFrame:
    """Registrations without repeats, before they meet a dimension."""
    names = ["game_account", "expand_channel", "game_id"]
    return regi.select(*names, "reg_time") if attribution == "first" else regi.select(*names).distinct()


def _registrations(regi: DataFrame, start: Day, end: Day, time_key: Column, *extra: str) -> DataFrame:
    rows = day_range(regi, "reg_time", start, end)
    return rows.select(
        time_key.alias("publish_time"), "game_id", blank_to_default("expand_channel").alias("expand_channel"), *extra
    )


def regi_accounts_hour(regi: DataFrame, games: DataFrame, start: Day, end: Day) -> DataFrame:
    rows = _registrations(regi, start, end, hour_key("reg_time"), "game_account")
    counts = rows.groupBy("publish_time", "game_id", "expand_channel").agg(
        F.count_distinct("game_account").alias("regi_num")
    )
    return listed_games(counts, games)


def regi_sketches_hour(regi: DataFrame, start: Day, end: Day) -> DataFrame:
    """Sketches of accounts and devices per hour, game and channel, to be merged into days or over increments."""
    return sketches.sketched(_registrations(regi, start, end, hour_key("reg_time"), "game_account", "imei"))


def _regi_day(regi: DataFrame, start: Day, end: Day, approximate: bool = False) -> DataFrame:
    if approximate:
        return sketches.counted(sketches.days_of(regi_sketches_hour(regi, start, end)))
    rows = _registrations(regi, start, end, day_key("reg_time"), "game_account", "imei")
    return rows.groupBy("publish_time", "game_id", "expand_channel").agg(
        F.count_distinct("game_account").alias("regi_num"), F.count_distinct("imei").alias("regi_device_num")
    )


def regi_key_day(regi: DataFrame, game_sdk: DataFrame, start: Day, end: Day, approximate: bool = False) -> DataFrame:
    """Accounts and devices per day, game and channel, for games with a dimension row.

    `approximate` counts by sketches, within about two percent, and without shuffling accounts.
    """
    return listed_games(_regi_day(regi, start, end, approximate), sdk_games(game_sdk))


def regi_accounts_devices_day(regi: DataFrame, game_sdk: DataFrame, start: Day, end: Day, approximate: bool = False) -> DataFrame:
    return with_game_dimension(_regi_day(regi, start, end, approximate), game_sdk, "os", "group_id", "parent_game_id")


def regi_devices_game_day(regi: DataFrame, game_sdk: DataFrame, start: Day, end: Day) -> DataFrame:
    """Devices per game and day; games without an operating system are left out."""
    rows = _registrations(regi, start, end, day_key("reg_time"), "imei")
    counts = rows.groupBy("publish_time", "game_id").agg(F.count_distinct("imei").alias("regi_device_num"))
    return with_game_dimension(counts, game_sdk, "os", "group_id", "parent_game_id").filter(F.col("os").isNotNull())


def pay_accounts_hour(orders: DataFrame, regi: DataFrame, games: DataFrame, start: Day, end: Day) -> DataFrame:
    """Accounts by the hour of their first paid order of the day, per game and channel."""
    rows = paid_orders(orders, start, end).filter(F.col("game_id").isNotNull())
    first = rows.groupBy(account_key("game_account").alias("acct_key"), day_of("order_time").alias("day"), "game_id").agg(
        F.min("order_time").alias("first_time")
    )
    joined = first.join(account_channels(listed_games(regi, games)), "acct_key")
    # (account, day, game) and (account, channel) are unique, so each row is one account.
    return joined.groupBy(hour_key("first_time").alias("publish_time"), "game_id", "expand_channel").agg(
        F.count(F.lit(1)).alias("pay_account_num")
    )


def _payers_day(orders: DataFrame, start: Day, end: Day) -> DataFrame:
    rows = paid_orders(orders, start, end, new_pay=True).filter(F.col("game_id").isNotNull())
    return rows.select(
        account_key("game_account").alias("acct_key"), day_key("order_time").alias("publish_time"), "game_id"
    ).distinct()


def pay_accounts_key_day(orders: DataFrame, regi: DataFrame, game_sdk: DataFrame, start: Day, end: Day) -> DataFrame:
    """Paying accounts per day, game and channel, once however many dimension rows a game has."""
    accounts = account_channels(listed_games(regi, sdk_games(game_sdk)))
    joined = _payers_day(orders, start, end).join(accounts, "acct_key")
    return joined.groupBy("publish_time", "game_id", "expand_channel").agg(F.count(F.lit(1)).alias("pay_account_num"))


def pay_accounts_day(orders: DataFrame, regi: DataFrame, game_sdk: DataFrame, start: Day, end: Day) -> DataFrame:
    payers = _payers_day(orders, start, end)
    regs = with_game_dimension(_registered(regi, "all"), game_sdk, "os", "group_id")
    joined = payers.join(account_channels(regs, extra=("os", "group_id")), "acct_key")
    return joined.groupBy("publish_time", "game_id", "expand_channel", "os", "group_id").agg(
        F.count(F.lit(1)).alias("pay_account_num")
    )


CLICK_TYPES = {"show_num": SHOW, "download_num": DOWNLOAD, "adpage_click_num": AD_PAGE}


def clicks_hour(channel_events: DataFrame, games: DataFrame, start: Day, end: Day) -> DataFrame:
    """All three ad counts per hour in one pass over the events."""
    rows = day_range(channel_events, "channel_time", start, end).filter(
        F.col("channel_type").isin(*CLICK_TYPES.values())
    )
    counts = rows.groupBy(
        hour_key("channel_time").alias("publish_time"),
        "game_id",
        blank_to_default(F.upper("expand_channel")).alias("expand_channel"),
    ).agg(*[F.count_if(F.col("channel_type") == t).alias(n) for n, t in CLICK_TYPES.items()])
    return listed_games(counts, games)


def roll_up_days(hours: DataFrame, *measures: str) -> DataFrame:
    """Day totals of additive hourly counts."""
    others = [c for c in hours.columns if c != "publish_time" and c not in measures]
    return hours.groupBy(day_key("publish_time").alias("publish_time"), *others).agg(
        *[F.sum(m).alias(m) for m in measures]
    )


def click_count(hours: DataFrame, measure: str, grain: str = "hour") -> DataFrame:
    """One ad count per hour or day; groups without such an event are absent."""
    one = hours.filter(F.col(measure) > 0).select("publish_time", "game_id", "expand_channel", measure)
    return roll_up_days(one, measure) if grain == "day" else one


def requests_hour(lines: DataFrame, games: DataFrame, start: Day, end: Day, drop_all_404: bool = False) -> DataFrame:
    rows = day_range(parse_request_batch(lines, drop_all_404), "publish_time", start, end)
    counts = rows.groupBy(hour_key("publish_time").alias("publish_time"), "game_id", "expand_channel").agg(
        F.count(F.lit(1)).alias("request_num")
    )
    return listed_games(counts, games)


def requests_day(lines: DataFrame, games: DataFrame, start: Day, end: Day, drop_all_404: bool = False) -> DataFrame:
    return roll_up_days(requests_hour(lines, games, start, end, drop_all_404), "request_num")
