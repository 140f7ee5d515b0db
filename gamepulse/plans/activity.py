"""Days of activity as bits: one mask per account and era of 64 days, merged by `or`."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamepulse.functions.times import as_date, day_of
from gamepulse.operators.accounts import listed_games
from gamepulse.plans.cohort import COHORT, LOOK_BACK_DAYS, RETURN_DAYS, account_of, cohort_accounts, text_day

ERA_DAYS = 64
MASK_SCHEMA = "account string, era int, mask bigint"


def _number(day: Column) -> Column:
    return F.unix_date(day)


def activity_masks(logins: DataFrame, normalise: bool = False) -> DataFrame:
    """(account, era, mask): bit d of the mask is set if the account was active on day 64 * era + d since 1970-01-01.

    Rows whose time is no day are left out. Bits are set before the shuffle, so an account is one row per task and era.
    """
    day = _number(day_of("login_time"))
    rows = logins.select(account_of(normalise).alias("account"), day.alias("day")).filter("account is not null and day is not null")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("day", F.lit(ERA_DAYS)))
    return rows.groupBy("account", F.floor(F.col("day") / ERA_DAYS).cast("int").alias("era")).agg(F.bit_or(bit).alias("mask"))


def merged_masks(masks: DataFrame) -> DataFrame:
    """Masks of several ranges of days, with or without overlaps, as one."""
    return masks.groupBy("account", "era").agg(F.bit_or("mask").alias("mask"))


def retention_from_masks(
    regi: DataFrame, masks: DataFrame, games: DataFrame, run_date: date | str, keep_empty: bool = False, normalise: bool = False,
) -> DataFrame:
    """As `cohort.retention`, with logins given as masks: any offset is a bit test, and no login row is grouped again.

    Reads the eras that can lie inside the look-back's windows only.
    """
    day = as_date(run_date)
    names = [f"retained_{d}day" for d in RETURN_DAYS]
    cohort = listed_games(cohort_accounts(regi, day, normalise), games).filter(
        F.col("game_id").isNotNull() & F.col("expand_channel").isNotNull())
    era = lambda d: (d - date(1970, 1, 1)).days // ERA_DAYS
    first, last = era(day - timedelta(days=LOOK_BACK_DAYS - 1)), era(day + timedelta(days=LOOK_BACK_DAYS - 1))
    seen = masks.filter(F.col("era").between(first, last)).groupBy("account").agg(
        F.map_from_entries(F.collect_list(F.struct("era", "mask"))).alias("masks"))  # three eras at most

    def active(offset: int) -> Column:
        at = _number(F.date_add("reg_time", offset))
        mask = F.try_element_at("masks", F.floor(at / ERA_DAYS).cast("int"))
        return F.coalesce(F.call_function("shiftright", mask, F.pmod(at, F.lit(ERA_DAYS))).bitwiseAND(F.lit(1).cast("bigint")) == 1, F.lit(False))

    table = cohort.join(seen, "account", "left").groupBy(*COHORT).agg(
        F.sum("n").alias("add_user_num"), *[F.count_if(active(d)).alias(c) for d, c in zip(RETURN_DAYS, names)])
    if not keep_empty:
        table = table.filter(sum((F.col(c) for c in names[1:]), F.col(names[0])) > 0)
    return text_day(table.select(*COHORT, "add_user_num", *names))
