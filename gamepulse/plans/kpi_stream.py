"""The measures of one micro-batch and their keyed form. Plain functions, no streaming here."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.functions.channel import PARTS, gate_channel, split_channel
from gamepulse.functions.times import day_key, hour_key
from gamepulse.operators.accounts import listed_games
from gamepulse.plans.kpi_batch import AD_PAGE, DOWNLOAD, PAID, REFUNDED, SHOW
from gamepulse.sources import logs

GROUP = ["publish_time", "game_id", "expand_channel"]
FIRST_PAY_KEYS = {"day": "string", "game_id": "int", "game_account": "string", "order_time": "string"}


def keyed(rows: DataFrame, measures: list[str], case: str = "upper") -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) with the channel in its three key parts, valid rows once per key.

    Channels that fall on one key, by letter case or by a dropped fourth part, are summed.
    """
    valid, rejects = gate_channel(split_channel(rows, case=case))
    keys = [c for c in valid.columns if c not in measures]
    return valid.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]), rejects


def days_from_hours(hours: DataFrame, measures: list[str]) -> DataFrame:
    """Daily rows of hourly ones, by the date part of the hour."""
    others = [c for c in hours.columns if c not in measures and c != "publish_time"]
    return hours.groupBy(day_key("publish_time").alias("publish_date"), *others).agg(
        *[F.sum(m).alias(m) for m in measures]
    )


def nonzero(rows: DataFrame, measures: list[str]) -> DataFrame:
    """Rows where at least one measure is not zero."""
    return rows.filter(reduce(lambda a, b: a | b, [F.coalesce(m, F.lit(0)) != 0 for m in measures]))


def _accounts(regi: DataFrame, games: DataFrame, *names: str, wanted: DataFrame) -> DataFrame:
    """(account, channel, n): distinct listed registrations behind each account and channel.

    Only of the accounts in `wanted`, so that a small batch does not shuffle all registrations.
    Made distinct before the whitelist: the other way round Spark would keep the whitelist's
    partitioning by game for it, and a busy game would be one task.
    """
    own = regi.join(wanted.select("game_account").distinct(), "game_account", "left_semi")
    distinct = own.select("game_account", "expand_channel", "game_id", *names).distinct()
    return listed_games(distinct, games).groupBy("game_account", "expand_channel").agg(F.count(F.lit(1)).alias("n"))


def net_pay_money_hour(orders: DataFrame, regi: DataFrame, games: DataFrame) -> DataFrame:
    """Paid minus refunded amount per hour, game of the order and registered channel."""
    signed = F.when(F.col("order_status") == PAID, F.col("paymoney")).otherwise(-F.col("paymoney"))
    sales = (
        orders.filter(F.col("order_status").isin(PAID, REFUNDED))
        .groupBy("game_account", "game_id", hour_key("order_time").alias("publish_time"))
        .agg(F.sum(signed).alias("amount"))
    )
    money = F.sum(F.col("amount") * F.col("n")).cast("decimal(38,2)")
    accounts = _accounts(regi, games, "resource_id", "publish_time", wanted=sales)
    return sales.join(accounts, "game_account").groupBy(*GROUP).agg(money.alias("pay_money"))


def first_payments(orders: DataFrame, run_date: str | None = None) -> DataFrame:
    """First paid time of each account per day and game, of one day or of every day."""
    paid = logs.paid_on(orders, run_date)
    return paid.groupBy(day_key("order_time").alias("day"), "game_id", "game_account").agg(
        F.min("order_time").alias("order_time")
    )


def first_pay_accounts_hour(first_paid: DataFrame, regi: DataFrame, games: DataFrame) -> DataFrame:
    """Accounts by the hour of their first paid order of the day, per game and channel."""
    first = first_paid.groupBy("day", "game_id", "game_account").agg(F.min("order_time").alias("order_time"))
    return first.join(_accounts(regi, games, wanted=first), "game_account").groupBy(
        hour_key("order_time").alias("publish_time"), "game_id", "expand_channel"
    ).agg(F.count(F.lit(1)).alias("pay_account_num"))


def touched_days(lines: DataFrame, first_paid: DataFrame) -> DataFrame:
    """(day, game_id) whose first-pay accounts this batch can change.

    Those of the accounts it registers or sees paying, and all days of the games it lists.
    """
    paying = logs.paid_on(logs.parse(lines, "order"), None).select("game_account")
    accounts = logs.parse(lines, "regi").select("game_account").union(paying).distinct()
    listed = logs.parse(lines, "pubgame").select("game_id").distinct()
    by_account = first_paid.join(accounts, "game_account", "left_semi")
    by_game = first_paid.join(listed, "game_id", "left_semi")
    return by_account.select("day", "game_id").union(by_game.select("day", "game_id")).distinct()


def _counts(rows: DataFrame, **columns) -> DataFrame:
    return rows.groupBy(*GROUP).agg(*[c.alias(n) for n, c in columns.items()])


def batch_measures(lines: DataFrame, regi_batch: DataFrame, regi: DataFrame, games: DataFrame) -> DataFrame:
    """Additive measures of one batch of lines, one row per source, hour, game and channel.

    `regi` and `games` are everything known including this batch; the measures of other sources are null.
    """
    money = net_pay_money_hour(logs.parse(lines, "order"), regi, games)
    return batch_counts(lines, regi_batch, games).unionByName(money, allowMissingColumns=True)


def batch_counts(lines: DataFrame, regi_batch: DataFrame, games: DataFrame) -> DataFrame:
    """The measures that need nothing but the batch and the list of games.

    Each source is reduced to its groups before the whitelist meets it.
    """
    kind = F.col("type")
    channel = _counts(
        logs.parse(lines, "channel_hour").filter(kind.isin(SHOW, DOWNLOAD, AD_PAGE)),
        show_num=F.count_if(kind == SHOW), download_num=F.count_if(kind == DOWNLOAD),
        adpage_click_num=F.count_if(kind == AD_PAGE),
    )
    requests = _counts(logs.parse_request(lines), request_num=F.count(F.lit(1)))
    registrations = _counts(regi_batch, regi_account_num=F.count(F.lit(1)))
    listed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [channel, requests, registrations])
    return listed_games(listed, games)


def with_listed_games(changes: DataFrame, games: DataFrame) -> DataFrame:
    """Changes of accounts with `listed`: whether one of the registered games behind them is on the list."""
    sets = changes.select("regi_games").distinct()
    each = sets.select("regi_games", F.explode(F.split("regi_games", ",").cast("array<int>")).alias("game_id"))
    known = listed_games(each, games).select("regi_games").distinct().withColumn("listed", F.lit(True))
    return changes.join(known, "regi_games", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


KEY_COLUMNS = ["publish_time", "game_id", *PARTS]
