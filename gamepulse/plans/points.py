"""Reward points: detail rows with member and game names, running total, quotas."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamepulse.operators.ordering import running_total

# Fixed values of the points contract.
SIGN_IN, RECHARGE, PAID, RECHARGE_VERSION = 4, 1, 4, "v2.2"
UNBOUND, PERCENT = "0", 0.01
LARGEST = float(2**53)  # amounts are doubles, exact below it

DETAIL = ("obtain_time", "obtain_id", "uid", "game_account", "game_id", "points", "ori_price", "resource")
DETAIL_ORDER = ["obtain_time", "obtain_id", "uid"]


def points_union(signin: DataFrame, recharge: DataFrame) -> DataFrame:
    """Sign-in rows and paid recharge rows in one layout, repeats kept."""
    signed = signin.filter(F.col("resource") == SIGN_IN).withColumn("game_account", F.lit(""))
    paid = recharge.filter((F.col("order_state") == PAID) & (F.col("version") == RECHARGE_VERSION)).withColumns(
        {"uid": F.lit(""), "resource": F.lit(RECHARGE)}
    )
    return signed.select(*DETAIL).unionByName(paid.select(*DETAIL))


def countable(c: Column | str) -> Column:
    """Whether an amount is a finite number that whole points can hold."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False))


def points_gate(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a countable amount, the others)."""
    return points.filter(countable("points")), points.filter(~countable("points"))


def whole(c: Column | str) -> Column:
    """Truncation to whole points; an amount that is not countable has none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(countable(c), c.cast("bigint"))


def points_rule(points: Column | str, integral: int) -> Column:
    """Recharge points: a share of the amount, at least 1 for any positive share."""
    share = (F.col(points) if isinstance(points, str) else points) * F.lit(integral * PERCENT)
    return F.when((share > 0) & (share <= 1), F.lit(1.0)).otherwise(whole(share).cast("double"))


def resolve_points(points: DataFrame, binds: DataFrame, game_names: DataFrame, integral: int) -> DataFrame:
    """Detail rows with the member id behind a recharge, its game name and its final points.

    Sign-in rows do not pass the account lookup, so they are no null-key block in its join.
    """
    bound = binds.groupBy("game_account").agg(F.min("bind_member_id").alias("bind_member_id"))
    games = game_names.groupBy("game_id").agg(F.min("name").alias("game_name"))
    recharge = (
        points.filter(F.col("resource") == RECHARGE)
        .join(bound, "game_account", "left")
        .join(games, "game_id", "left")
        .withColumns({
            "uid": F.coalesce("bind_member_id", F.lit(UNBOUND)),
            "game_name": F.coalesce("game_name", F.lit("")),
            "points": points_rule("points", integral),
        })
    )
    others = points.filter(F.col("resource") != RECHARGE).withColumn("game_name", F.lit(""))
    columns = ["obtain_time", "obtain_id", "uid", "game_id", "game_name", "points", "ori_price", "resource"]
    return recharge.select(*columns).unionByName(others.select(*columns))


def name_members(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Member names; a blank member id has none and becomes the unbound one."""
    named = members.groupBy(F.col("member_id").alias("uid")).agg(F.min("username").alias("uname"))
    joined = rows.join(named, "uid", "left")
    uid = F.when(F.col("uid") == "", F.lit(UNBOUND)).otherwise(F.col("uid"))
    return joined.withColumns({"uid": uid, "uname": F.coalesce("uname", F.lit(""))})


def enrich_points(
    points: DataFrame, binds: DataFrame, members: DataFrame, game_names: DataFrame, integral: int
) -> DataFrame:
    """Detail rows with member id, member name, game name and final points."""
    rows = name_members(resolve_points(points, binds, game_names, integral), members)
    return rows.select(
        "obtain_time", "obtain_id", "uid", "uname", "game_id", "game_name", "points", "ori_price", "resource"
    )


def points_total(points: DataFrame) -> DataFrame:
    """Total of the points already stored, one row."""
    return points.agg(F.coalesce(F.sum(whole("points").cast("bigint")), F.lit(0)).alias("history_points_sum"))


def points_running_total(enriched: DataFrame, history_total: int | Column = 0) -> DataFrame:
    """Detail rows with whole points and `real_points`, the total up to and with the row."""
    rows = enriched.withColumn("points", whole("points"))
    return running_total(rows, DETAIL_ORDER, "points", "real_points", history_total)


def _quota(resolved: DataFrame, members: DataFrame, amount: Column) -> DataFrame:
    """Summed per member before the names are looked up, so a busy member is one row there."""
    each = resolved.groupBy("uid").agg(amount.alias("points"))
    return name_members(each, members).groupBy("uid").agg(
        F.min("uname").alias("uname"), F.sum("points").alias("points")
    )


def quota_sum(resolved: DataFrame, members: DataFrame) -> DataFrame:
    """Points per member."""
    return _quota(resolved, members, F.sum(whole("points").cast("bigint")))


def quota_count(resolved: DataFrame, members: DataFrame) -> DataFrame:
    """One point per detail row and member."""
    return _quota(resolved, members, F.count(F.lit(1)))
