"""Retention and lifetime value of registration cohorts (day, game, channel)."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamepulse.functions.channel import blank_to_default
from gamepulse.functions.times import as_date, day_of, day_range
from gamepulse.operators.accounts import account_key, listed_games
from gamepulse.plans.kpi_batch import PAID, REFUNDED

# Look-back, the reported return days and the lifetime windows in days.
LOOK_BACK_DAYS = 60
RETURN_DAYS = (1, 2, 3, 4, 5, 6, 14, 29, 59)
LTV_WINDOWS = (2, 3, 4, 5, 6, 7, 15, 30, 60)

COHORT = ("reg_time", "game_id", "expand_channel")


def account_of(normalise: bool) -> Column:
    return account_key("game_account") if normalise else F.col("game_account")


def cohort_accounts(regi: DataFrame, run_date: date, normalise: bool) -> DataFrame:
    """Registrations of the look-back as (cohort, account, rows)."""
    first = run_date - timedelta(days=LOOK_BACK_DAYS - 1)
    rows = day_range(regi, "reg_time", first, run_date)
    return rows.groupBy(
        day_of("reg_time").alias("reg_time"), "game_id",
        blank_to_default("expand_channel").alias("expand_channel"), account_of(normalise).alias("account"),
    ).agg(F.count("game_account").alias("n"))


def _span(df: DataFrame, time_col: str, run_date: date) -> DataFrame:
    """Events that can lie inside any window of the look-back's cohorts."""
    first = run_date - timedelta(days=LOOK_BACK_DAYS - 1)
    return day_range(df, time_col, first, run_date + timedelta(days=LOOK_BACK_DAYS - 1))


def text_day(df: DataFrame) -> DataFrame:
    return df.withColumn("reg_time", F.col("reg_time").cast("string"))


def retention(
    regi: DataFrame, logins: DataFrame, games: DataFrame, run_date: date | str,
    keep_empty: bool = False, normalise: bool = False,
) -> DataFrame:
    """Accounts of each cohort that logged in exactly d days after registering.

    Cohort size counts registration rows. Cohorts nobody returned to are absent unless
    `keep_empty`. Each account meets its own login days once, so sizes and returns are one grouping.
    """
    day = as_date(run_date)
    names = [f"retained_{d}day" for d in RETURN_DAYS]
    cohort = listed_games(cohort_accounts(regi, day, normalise), games).filter(
        F.col("game_id").isNotNull() & F.col("expand_channel").isNotNull()
    )
    seen = (
        _span(logins, "login_time", day).groupBy(account_of(normalise).alias("account"))
        .agg(F.collect_set(day_of("login_time")).alias("days"))  # at most one per day of the look-back
    )
    back = [F.coalesce(F.array_contains("days", F.date_add("reg_time", d)), F.lit(False)) for d in RETURN_DAYS]
    table = cohort.join(seen, "account", "left").groupBy(*COHORT).agg(
        F.sum("n").alias("add_user_num"), *[F.count_if(hit).alias(c) for hit, c in zip(back, names)]
    )
    if not keep_empty:
        table = table.filter(sum((F.col(c) for c in names[1:]), F.col(names[0])) > 0)
    return text_day(table.select(*COHORT, "add_user_num", *names))


def ltv(
    regi: DataFrame, orders: DataFrame, games: DataFrame, run_date: date | str, normalise: bool = False
) -> DataFrame:
    """Net amount paid by each cohort in its first N days, stored as `ltv_{N-1}day`.

    One join bounded by the longest window and one grouping replace a join per window.
    Every cohort is kept, zero where nothing was paid.
    """
    day = as_date(run_date)
    names = [f"ltv_{n - 1}day" for n in LTV_WINDOWS]
    cohort = listed_games(cohort_accounts(regi, day, normalise), games)
    signed = F.when(F.col("order_status") == PAID, F.col("ori_price")).otherwise(-F.col("ori_price"))
    paid = (
        _span(orders, "order_time", day)
        .filter(F.col("order_status").isin(PAID, REFUNDED))
        .groupBy(account_of(normalise).alias("account"), day_of("order_time").alias("pay_day"))
        .agg(F.sum(signed).alias("amount"))
        .groupBy("account").agg(F.collect_list(F.struct("pay_day", "amount")).alias("paid"))  # one per day of the span
    )
    zero = F.lit(0).cast("decimal(38,2)")

    def within(n: int) -> Column:
        fits = lambda p: (F.datediff(p["pay_day"], F.col("reg_time")) >= 0) & (F.datediff(p["pay_day"], F.col("reg_time")) < n)
        total = F.aggregate(F.filter("paid", fits), zero, lambda sum_, p: (sum_ + p["amount"]).cast("decimal(38,2)"))
        return F.when(F.col("expand_channel").isNotNull() & F.col("paid").isNotNull(), (total * F.col("n")).cast("decimal(38,2)")).otherwise(zero)

    # A null account counts no user, as count(account) does, and joins no order.
    table = cohort.join(paid, "account", "left").groupBy(*COHORT).agg(
        F.sum("n").alias("add_user_num"), *[F.sum(within(n)).cast("decimal(38,2)").alias(c) for n, c in zip(LTV_WINDOWS, names)]
    )
    return text_day(table.select(*COHORT, "add_user_num", *names))
